"""Fill-in-the-middle transformation with content-defined chunk memoization.

A rolling (gear) hash over the last 32 bytes cuts a text into chunks where its top bits are zero, so equal passages give
equal chunks wherever they stand. Of each chunk a boundary summary is kept: its line ends, its code points, whether it holds
a marker, and its first and last bytes. Summaries are memoized by the chunk's whole content (a hit is confirmed byte by
byte), so chunks that documents share are read once a task; the memo is bounded and forgets the chunk unused
longest. A text's line count, its length and markers across chunk borders follow from its summaries; a cut is located by
the running sums, and only the chunk that holds it is searched.

The cuts follow from a hash of seed and id. ``psm`` writes prefix, suffix, middle, ``spm`` suffix, prefix, middle, each
behind its marker. A null or empty text, one that holds a marker and one left out by ``rate`` stay plain. A null id is
hashed as an empty one; repeated rows get equal cuts; a text of one line may have empty parts.
Columns of the input stay as they are: result names that it has already get underscores. One scan, no shuffle.
"""

from __future__ import annotations

from collections import OrderedDict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import add_columns, free_name
from .textarrays import blocks, mix

SEED = 7
RATE = 100
SPM = 50
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
WINDOW = 32
CHUNK_BITS = 10
LONGEST = 1 << 14
MEMO_BYTES = 8 << 20
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


class Summary(NamedTuple):
    """What a chunk adds to its text, and the bytes at its borders."""

    ends: int
    chars: int
    marked: bool
    head: bytes
    tail: bytes


def _chars(data: bytes) -> int:
    return int(((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).sum())


def _marked(data: bytes) -> bool:
    return PREFIX in data or SUFFIX in data or MIDDLE in data


def summarise(chunk: bytes) -> Summary:
    return Summary(chunk.count(b"\n"), _chars(chunk), _marked(chunk), chunk[:2], chunk[-2:])


class Memo:
    """Summaries by content, within ``limit`` bytes of chunks."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.held, self.size, self.hits = limit, OrderedDict(), 0, 0

    def __call__(self, chunk: bytes) -> Summary:
        found = self.held.get(chunk)
        if found is not None:
            self.hits += 1
            self.held.move_to_end(chunk)
            return found
        found = self.held[chunk] = summarise(chunk)
        self.size += len(chunk)
        while self.size > self.limit:
            self.size -= len(self.held.popitem(last=False)[0])
        return found


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Where the chunks of each text end, as places in ``data``; a text's own bytes alone decide."""
    rolled, span = _GEAR[data], 1
    while span < WINDOW:
        rolled[span:] += rolled[:-span] << np.uint32(span)  # the right side is computed before it is added
        span *= 2
    cuts = np.flatnonzero(rolled >> np.uint32(32 - CHUNK_BITS) == 0) + 1
    out = []
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        own = cuts[np.searchsorted(cuts, low + WINDOW):np.searchsorted(cuts, high)]
        ends = np.append(own, high) if high > low else own[:0]
        starts = np.append(low, ends[:-1])
        long = np.flatnonzero(ends - starts > LONGEST)  # a long run without a cut is cut at equal steps
        more = [np.arange(starts[i] + LONGEST, ends[i], LONGEST) for i in long]
        out.append(np.sort(np.concatenate([ends, *more])) if more else ends)
    return out


class Cuts:
    """Lines, code points and cut places of one text, combined from its chunks' summaries."""

    def __init__(self, text: bytes, ends: list[int], memo: Memo):
        self.text, self.starts = text, [0, *ends[:-1]]
        before, border, self.marked = (0, 0), b"", False
        self.before = []
        for start, end in zip(self.starts, ends):
            part = memo(text[start:end])
            self.marked |= part.marked or _marked(border + part.head)
            border = (border + part.tail)[-2:] if end - start > 1 else (border + part.head)[-2:]
            self.before.append(before)
            before = (before[0] + part.ends, before[1] + part.chars)
        self.ends, self.chars = before
        self.n = self.ends + (bool(text) and text[-1] != 0x0A)

    def after(self, lines: int) -> tuple[int, int]:
        """Byte and code point behind the first ``lines`` lines."""
        if lines <= 0:
            return 0, 0
        if lines >= self.n:
            return len(self.text), self.chars
        low, high = 0, len(self.before)  # the last chunk with fewer line ends before it
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.before[middle][0] < lines else (low, middle)
        ends, chars = self.before[low]
        at = self.starts[low] - 1
        for _ in range(lines - ends):
            at = self.text.index(b"\n", at + 1)
        return at + 1, chars + _chars(self.text[self.starts[low]:at + 1])


def arrange(text: bytes, cuts: Cuts, draws: list[int], rate: int, spm: int):
    """Form, code points of prefix and middle, and the text written in that form."""
    if not text or cuts.marked or draws[2] % 100 >= rate:
        return "plain", None, None, text
    (a, a_chars), (b, b_chars) = (cuts.after(x) for x in sorted((draws[0] % (cuts.n + 1), draws[1] % (cuts.n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < spm:
        return "spm", a_chars, b_chars - a_chars, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return "psm", a_chars, b_chars - a_chars, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, text: str = "text", identity: str = "doc_id", rate: int = RATE, spm: int = SPM,
                   seed: int = SEED) -> DataFrame:
    """``docs`` with ``n_lines``, ``form``, ``prefix_chars``, ``middle_chars`` and ``fim_text``.

    ``rate`` percent of the texts are rearranged, ``spm`` percent of those in that form.
    """
    draw = free_name(docs, "draw")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(identity).cast("string"), F.lit("")))
    drawn = docs.withColumn(draw, F.sha2(key.cast("binary"), 256))
    kinds = {"n_lines": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(),
             "fim_text": T.StringType()}
    added = T.StructType([T.StructField(free_name(docs, name), kind) for name, kind in kinds.items()])
    memo = Memo()  # each task gets its own

    def work(batch, place):
        batch = batch.rename_columns([f"_{i}" for i in range(batch.num_columns)])
        for part, data, offsets in blocks(batch, f"_{place}"):
            rows = []
            hashes = part.column(part.num_columns - 1).to_pylist()
            for low, high, ends, hexed in zip(offsets[:-1].tolist(), offsets[1:].tolist(), chunk_ends(data, offsets), hashes):
                whole = data[low:high].tobytes()
                cuts = Cuts(whole, (ends - low).tolist(), memo)
                rows.append((cuts.n, *arrange(whole, cuts, [int(hexed[i:i + 8], 16) for i in (0, 8, 16, 24)], rate, spm)))
            *columns, written = zip(*rows)
            yield part, [*map(list, columns), pa.array(written, pa.binary()).cast(pa.string())]

    return add_columns(drawn, text, added, work).drop(draw)


def restored(written: Column, form: Column) -> Column:
    """The exact text behind a rearranged one."""
    body = F.substr(written, F.lit(len(PREFIX) + 1))

    def split(first: str) -> tuple[Column, Column, Column]:
        rest = F.split_part(body, F.lit(first), F.lit(2))
        return (F.split_part(body, F.lit(first), F.lit(1)), F.split_part(rest, F.lit("<M>"), F.lit(1)),
                F.split_part(rest, F.lit("<M>"), F.lit(2)))

    prefix, suffix, middle = split("<S>")
    suffix_first, prefix_next, middle_last = split("<P>")
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix_next, middle_last, suffix_first)).otherwise(written))
