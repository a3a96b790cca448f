"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

Every step is one array operation per block of texts, so whole texts are tokenised and hashed
without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_GRAM = 0xD6E8FEB86659FD93
_WRAP = (1 << 64) - 1

# Bytes that belong to a word. PLAIN: all but blank, tab and line ends; ALNUM: letters, digits and
# everything beyond ASCII. FOLD lower-cases A-Z.
PLAIN = np.ones(256, bool)
PLAIN[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[_low:_high] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; the usual shift and multiply finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_powers = np.ones(1, np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 4096), _MULTIPLIER, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


@dataclass
class Words:
    """Words of a block: byte range of each, and ``first[i]:first[i + 1]`` those of text ``i``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices whose texts take up to ``limit`` bytes (one row at least), with their bytes and offsets."""
    data, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), batch.num_rows)
        yield batch.slice(low, high - low), data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def find_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = PLAIN) -> Words:
    """Maximal runs of word bytes; a run ends with its text."""
    inside = is_word[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    at = cuts[cuts < len(data)]
    begin[at] = inside[at]
    at = cuts[cuts > 0] - 1
    end[at] = inside[at]
    starts = np.flatnonzero(begin)
    return Words(data, offsets, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets))


def word_hashes(words: Words, is_word: np.ndarray = PLAIN, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each word's bytes, after ``fold``."""
    if not len(words.starts):
        return np.empty(0, np.uint64)
    lengths = words.ends - words.starts
    longest = int(lengths.max())
    base = int(words.starts[0])
    data = words.data[base:]
    place = np.arange(len(data), dtype=np.int64)
    place -= np.repeat(words.starts - base, np.diff(np.append(words.starts, len(words.data))))
    np.minimum(place, longest, out=place)  # blanks behind a word count nothing
    table = np.where(is_word, _BYTE[fold if fold is not None else np.arange(256)], np.uint64(0))
    values = table[data]
    values *= _powers_to(longest + 1)[place]
    return mix(np.add.reduceat(values, words.starts - base) + lengths.astype(np.uint64) * _MULTIPLIER)


def beginning_hashes(words: Words, sizes: tuple[int, ...], fold: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of ``sizes``: the words with more bytes than that, and the hash of so many first bytes."""
    table = _BYTE[fold if fold is not None else np.arange(256)]
    lengths = words.ends - words.starts
    out, hashes, chosen = [], np.zeros(len(lengths), np.uint64), np.arange(len(lengths))
    for size in range(1, max(sizes, default=0) + 1):
        on = lengths[chosen] >= size
        chosen, hashes = chosen[on], hashes[on]
        hashes = hashes * _MULTIPLIER + table[words.data[words.starts[chosen] + size - 1]]
        if size in sizes:
            longer = lengths[chosen] > size
            out.append((chosen[longer], mix(hashes[longer] + np.uint64(size))))
    return out


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values, by doubling; run ``i`` starts at value ``i``."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    out, have, span, power = None, 0, 1, hashes
    wanted = size
    while True:
        factor = np.uint64(pow(_GRAM, span, 1 << 64))
        if wanted & 1:
            if out is None:
                out = power
            else:
                n = len(hashes) - have - span + 1
                out = out[:n] * factor + power[have:have + n]
            have += span
        wanted >>= 1
        if not wanted:
            return mix(out)
        power = power[:-span] * factor + power[span:]
        span *= 2


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(hashes).view(np.int64)
