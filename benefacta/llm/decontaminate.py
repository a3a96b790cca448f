"""Benchmark decontamination: a broadcast set of test n-grams, and a scan of training windows.

Benchmark texts are cut into windows of ``size`` normalised words (an item of fewer words, but not none, is
one window). Each task hashes all word windows of its texts by array operations. A benchmark of up to ``block_windows``
windows and ``BLOCK_BYTES`` goes to every task whole, and a window whose hash is in the table is compared word by word. For a
larger one, a Bloom filter of its hashes goes to every task (32 MB at most; 16 bits each up to 16 million windows, beyond which it fills
and more windows are shuffled); what passes is joined with the stored benchmark windows on hash and words. Either way one operator
scans the texts once, and what a task holds does not grow with the benchmark.

Normal form: A-Z in lower case, words are runs of letters and digits, where every character beyond ASCII
counts as a letter. A null or empty text has no words and is clean. An empty benchmark leaves all
clean; items with the same text are all reported; rows of one item are one item. Repeated documents are
judged one by one. A null item number is not reported, but its windows count as hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import materialise
from .frames import KeyFilter, add_columns, content_ids, free_name
from .textarrays import ALNUM, FOLD, Words, blocks, find_words, gram_hashes, signed, word_hashes

WORDS = 10
BLOCK_WINDOWS = 200_000
BLOCK_BYTES = 64 << 20
PIECE_WINDOWS = 20_000
MOST_FILTER_BITS = 28
_BITS = 20


class GramTable:
    """Windows of one length: sorted hashes, and for each hash its word sequences with their items."""

    def __init__(self, length: int, entries: dict[int, dict[bytes, set[str]]]):
        self.length, self.entries = length, entries
        self.keys = np.sort(np.fromiter(entries, np.uint64, len(entries)))
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - _BITS)] = True

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Positions of the grams whose hash is in the table."""
        at = np.flatnonzero(self.maybe[grams >> np.uint64(64 - _BITS)])
        near = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        return at[self.keys[near] == grams[at]]


def _normal(data: np.ndarray, starts, ends) -> bytes:
    return b" ".join(FOLD[data[s:e]].tobytes() for s, e in zip(starts, ends))


def gram_tables(windows: Iterator[tuple[int, int, bytes, str | None]]) -> list[GramTable]:
    """A table for each length of the windows given: length, hash, word sequence and item."""
    held: dict[int, dict[int, dict[bytes, set[str]]]] = {}
    for length, gram, sequence, item in windows:
        names = held.setdefault(length, {}).setdefault(gram, {}).setdefault(sequence, set())
        names.update([] if item is None else [item])
    return [GramTable(k, v) for k, v in sorted(held.items())]


def _span(words: Words, text: int, low: int, high: int) -> dict[str, int]:
    """Words ``low:high`` of a text: number of the first one, their count, and the code points they lie at."""
    origin = words.offsets[text]
    before = words.data[origin:words.starts[low]], words.data[origin:words.ends[high - 1]]
    return dict(zip(("first_word", "n_words", "start", "end"), (
        int(low - words.first[text]), int(high - low), *(int(((x & 0xC0) != 0x80).sum()) for x in before))))


def _scan(batch: pa.RecordBatch, place: int, tables: list[GramTable]):
    """Row slices with word counts, hit word ranges and item numbers."""
    for part, data, offsets in blocks(batch, batch.schema.names[place]):
        words = find_words(data, offsets, ALNUM)
        hashes, left, text_of = word_hashes(words, ALNUM, FOLD), words.left(), words.text_of
        change = np.zeros(len(hashes) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(part.num_rows)]
        for table in tables:
            grams = gram_hashes(hashes, table.length)
            for i in table.find(grams):
                if left[i] >= table.length:
                    end = i + table.length
                    sequence = _normal(data, words.starts[i:end], words.ends[i:end])
                    names = table.entries[int(grams[i])].get(sequence)
                    if names is not None:
                        change[i] += 1
                        change[end] -= 1
                        items[text_of[i]] |= names
        hit = np.cumsum(change[:-1]) > 0
        ranges: list[list[dict]] = [[] for _ in range(part.num_rows)]
        if hit.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                for text in np.unique(text_of[start:end]):  # a range may reach into the next text
                    low, high = max(start, words.first[text]), min(end, words.first[text + 1])
                    ranges[text].append(_span(words, text, low, high))
        yield part, [pa.array(words.counts, pa.int64()), ranges, [sorted(x) for x in items]]


_SPANS = "array<struct<first_word: long, n_words: long, start: long, end: long>>"


def _candidates(batch: pa.RecordBatch, lengths: list[int], known: KeyFilter, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Of each text (columns ``row`` and ``text``) its word count, and each distinct window whose hash ``known`` lets pass with its spans.

    The former is a row of length 0 with the row's key for a hash, so that these rows spread evenly in the join.
    """
    for part, data, offsets in blocks(batch, "text"):
        words = find_words(data, offsets, ALNUM)
        hashes, left, text_of = word_hashes(words, ALNUM, FOLD), words.left(), words.text_of
        row = part.column(0).to_pylist()
        yield pa.RecordBatch.from_pylist([{"row": r, "words": n, "length": 0, "gram": r, "sequence": b"", "spans": []}
                                          for r, n in zip(row, words.counts.tolist())], schema)
        found: dict[tuple[int, int, bytes], dict] = {}
        for length in lengths:
            grams = gram_hashes(hashes, length)
            at = np.flatnonzero(known(grams) & (left[:len(grams)] >= length)) if len(grams) else []
            for i in at:
                sequence, text = _normal(data, words.starts[i:i + length], words.ends[i:i + length]), int(text_of[i])
                held = found.setdefault((text, length, sequence), {"row": row[text], "length": length, "sequence": sequence, "spans": [],
                                                                   "gram": int(signed(grams[i:i + 1])[0])})
                held["spans"].append(_span(words, text, int(i), int(i) + length))
        if found:
            yield pa.RecordBatch.from_pylist(list(found.values()), schema)


def _by_join(docs: DataFrame, windows: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with the struct ``name``; the windows of the benchmark stay a stored table."""
    keys = windows.select("gram").distinct()
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most ``size`` of them
    bits = min(max(16, (16 * keys.count()).bit_length()), MOST_FILTER_BITS)
    shipped = docs.sparkSession.sparkContext.broadcast((lengths, KeyFilter.of(keys, "gram", bits)))
    kind = T.StructType.fromDDL(f"row long, words long, length int, gram long, sequence binary, spans {_SPANS}")
    schema = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            yield from _candidates(batch, *shipped.value, schema)

    key = content_ids(docs, [c for c in docs.columns if c in ("doc_id", text)])
    texts = docs.select(key.alias("row"), F.col(text).alias("text"))
    seen = texts.mapInArrow(run, kind).groupBy("row", "length", "gram", "sequence").agg(  # equal rows once
        F.max("words").alias("words"), F.first("spans").alias("spans"))
    judged = seen.join(windows.withColumn("hit", F.lit(True)), ["length", "gram", "sequence"], "left")
    found = judged.groupBy("row").agg(F.struct(
        F.max("words").alias("n_words"), F.array_sort(F.flatten(F.collect_set(F.when(F.col("hit"), F.col("spans"))))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items")).alias("found"))
    row = free_name(docs, "row")
    return docs.withColumn(row, key).join(found.toDF(row, name), row).select(*docs.columns, name)


def find_benchmark_windows(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WORDS,
                           item: str = "item_id", item_text: str = "text", block_windows: int = BLOCK_WINDOWS,
                           result: str = "benchmark_hits") -> tuple[DataFrame, str]:
    """``docs`` with a struct of its word count, hit spans (words, and code points of the text) and items.

    Returns the frame and the name of the struct column, which is ``result`` unless the input has such a column. Spans are
    in order of their first word; for a benchmark beyond ``block_windows`` they are single windows, which may overlap.
    """
    name = free_name(docs, result)
    windows = materialise(_windows(benchmark, item, item_text, size), "benchmark-windows")
    held = windows.agg(F.count("*").alias("n"), F.sum(F.length("sequence") + F.coalesce(F.length("item"), F.lit(0))).alias("bytes")).first()
    if held["n"] > block_windows or (held["bytes"] or 0) > BLOCK_BYTES:
        return _by_join(docs, windows, text, name), name
    tables = gram_tables((r["length"], r["gram"] % 2**64, bytes(r["sequence"]), r["item"]) for r in windows.toLocalIterator())
    shipped = docs.sparkSession.sparkContext.broadcast(tables)
    columns = [free_name(docs, f"{result}_{k}") for k in ("n_words", "spans", "items")]
    schema = T.StructType.fromDDL(f"{columns[0]} long, {columns[1]} {_SPANS}, {columns[2]} array<string>")
    found = add_columns(docs, text, schema, lambda b, p: _scan(b, p, shipped.value))
    both = F.struct(*[F.col(c).alias(k) for c, k in zip(columns, ("n_words", "spans", "items"))])
    return found.withColumn(name, both).drop(*columns), name


def _windows(benchmark: DataFrame, item: str, item_text: str, size: int) -> DataFrame:
    """Distinct windows of all items, cut and hashed in tasks: ``length``, ``gram``, ``sequence`` and ``item``."""
    def run(batches):
        for batch in batches:
            for part, data, offsets in blocks(batch, "t"):
                words = find_words(data, offsets, ALNUM)
                hashes = word_hashes(words, ALNUM, FOLD)
                for text, name in enumerate(part.column(0).to_pylist()):
                    low, high = int(words.first[text]), int(words.first[text + 1])
                    if low == high:
                        continue
                    length = min(size, high - low)
                    grams = signed(gram_hashes(hashes[low:high], length))
                    for at in range(0, len(grams), PIECE_WINDOWS):
                        piece = grams[at:at + PIECE_WINDOWS]
                        sequences = [_normal(data, words.starts[i:i + length], words.ends[i:i + length])
                                     for i in range(low + at, low + at + len(piece))]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([length] * len(piece), pa.int32()), pa.array(piece), pa.array(sequences, pa.binary()),
                            pa.array([name] * len(piece), pa.string())], names=["length", "gram", "sequence", "item"])

    items = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t"))
    return items.mapInArrow(run, "length int, gram long, sequence binary, item string").distinct()


def covered_words(spans: Column) -> Column:
    """Number of words in spans that may overlap."""
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("to"))

    def add(held, span):
        end = span["first_word"] + span["n_words"]
        return F.struct((held["sum"] + F.greatest(end - F.greatest(held["to"], span["first_word"]), F.lit(0).cast("long"))).alias("sum"),
                        F.greatest(held["to"], end).alias("to"))

    return F.aggregate(spans, zero, add)["sum"]


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "documents",
                        **options) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with the hit words cut from their texts."""
    found, name = find_benchmark_windows(docs, benchmark, text, **options)
    if remove == "documents":
        return found.where(F.size(F.col(name)["spans"]) == 0).drop(name)
    if remove != "spans":
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    spans = F.col(name)["spans"]
    zero = F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at"))

    def cut(held, span):
        piece = F.substring(F.col(text), (held["at"] + 1).cast("int"), F.greatest(span["start"] - held["at"], F.lit(0)).cast("int"))
        return F.struct(F.concat(held["kept"], piece).alias("kept"), F.greatest(held["at"], span["end"]).alias("at"))

    def rest(held):
        return F.concat(held["kept"], F.substring(F.col(text), (held["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    cleaned = F.when(F.size(spans) == 0, F.col(text)).otherwise(F.aggregate(spans, zero, cut, rest))
    return found.withColumn(text, cleaned).drop(name)


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: words, hit words, items found, their digest, and whether anything was hit."""
    found, name = find_benchmark_windows(docs, benchmark, **options)
    hit = F.col(name)
    return found.select(
        "doc_id", hit["n_words"].alias("n_words"), covered_words(hit["spans"]).alias("n_hit"),
        F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", hit["items"]), 256).alias("items_sha256"),
        (F.size(hit["spans"]) > 0).alias("contaminated"))


