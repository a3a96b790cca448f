"""Language identification by compression with zstandard raw-content dictionaries.

For each language a bounded sample of its texts becomes a dictionary of raw content. Texts and dictionaries are in lower
case, with one blank for each run of characters other than letters, so neither capitals nor symbols tell languages apart. A
text is cut into pieces of ``piece`` bytes; each piece is compressed with each dictionary, and the language with the least total size is
chosen. Where the second best is nearly as small, the guess is rejected: the margin (share of bytes that the best saves
against the second) is below ``least_margin``.

The sample is bounded: ``slices`` texts of each language with the least hashed ids, of each a slice of ``slice_chars``
characters at a place chosen by the hash. Predictions read whole texts. Null texts and texts without a letter
are ``und`` with score 0. Ties go to the language with more learned rows, then by name. With one learned language only, every text with
letters is that language; with none, all are ``und``. The driver holds languages x slices x slice_chars.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import add_columns, free_name
from .textarrays import blocks

UNKNOWN = "und"
LEAST_MARGIN = 0.02


#: ASCII bytes other than small letters become blanks
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


def learn(rows: DataFrame, text: str = "text", lang: str = "lang", slices: int = 64, slice_chars: int = 1000) -> dict[str, bytes]:
    """Raw dictionary content of each language of ``rows`` (which have a ``doc_id``), the language with most rows first."""
    key = F.xxhash64("doc_id", text)
    known = rows.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    place = F.pmod(F.xxhash64(key), F.greatest(F.length(text) - F.lit(slice_chars), F.lit(0)) + 1)
    cut = known.select(F.col(lang).alias("lang"), key.alias("key"),
                       F.substring(F.col(text), (place + 1).cast("int"), F.lit(slice_chars)).alias("piece"))
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("key", "piece")))
    found: dict[str, list] = {}
    for row in ranked.where(F.col("rank") <= slices).collect():
        found.setdefault(row["lang"], []).append((row["rank"], row["piece"]))
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    return {name: plain("\n".join(p for _, p in sorted(found[name]))) for name in sorted(found, key=lambda x: (-sizes[x], x))}


class Encoders:
    """One compressor per language, with its dictionary digested once."""

    def __init__(self, contents: dict[str, bytes], level: int):
        self.names = list(contents)
        self.compressors = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(
                level=level, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, data: bytes, piece: int) -> list[int]:
        """Total size of the pieces for each language; a short last piece joins the one before it."""
        cuts = [*range(0, max(len(data) - piece // 2, 1), piece), len(data)]
        parts = [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return [sum(len(c.compress(p)) for p in parts) for c in self.compressors]


def with_language(docs: DataFrame, contents: dict[str, bytes], text: str = "text", piece: int = 1024, level: int = 6,
                  least_margin: float = LEAST_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred`` (best language), ``score`` (0 to 1; below 0.5 the margin is too narrow) and
    ``lang_sure`` (``lang_pred``, or ``und`` where rejected). Names that the input has already get underscores."""
    names = [free_name(docs, c) for c in ("lang_pred", "score", "lang_sure")]
    letters = free_name(docs, "has_letter")
    shipped = docs.sparkSession.sparkContext.broadcast(contents)
    held: dict[str, Encoders] = {}

    def work(batch, place):
        if "it" not in held:
            held["it"] = Encoders(shipped.value, level)
        encoders = held["it"]
        for part, data, offsets in blocks(batch, batch.schema.names[place]):
            has = part.column(part.num_columns - 1).to_pylist()
            guess, score = [], []
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                if not has[i] or not encoders.names:
                    guess.append(UNKNOWN)
                    score.append(0.0)
                elif len(encoders.names) == 1:
                    guess.append(encoders.names[0])
                    score.append(1.0)
                else:
                    sizes = np.array(encoders.sizes(plain(data[a:b].tobytes().decode()), piece))
                    order = np.argsort(sizes, kind="stable")
                    margin = 1 - sizes[order[0]] / sizes[order[1]]
                    guess.append(encoders.names[order[0]])
                    score.append(float(min(1.0, margin / (2 * least_margin))))
            sure = [g if s >= 0.5 else UNKNOWN for g, s in zip(guess, score)]
            yield part, [guess, score, sure]

    added = T.StructType([T.StructField(n, k) for n, k in zip(names, (T.StringType(), T.DoubleType(), T.StringType()))])
    flagged = docs.withColumn(letters, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    return add_columns(flagged, text, added, work).drop(letters)
