"""Small helpers that the operators share: free column names, Arrow output, bounded filters of keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .textarrays import mix


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores behind it while the input has a column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def add_columns(df: DataFrame, text: str, added: T.StructType,
                work: Callable[[pa.RecordBatch, int], Iterator[tuple[pa.RecordBatch, list]]]) -> DataFrame:
    """All columns of ``df`` and the ``added`` ones, which ``work`` computes batch by batch.

    ``work`` gets a batch and the place of the text column, and yields row slices with their new arrays.
    """
    place = df.columns.index(text)
    out = T.StructType(list(df.schema.fields) + list(added.fields))
    kinds = [f.type for f in to_arrow_schema(added)]

    def run(batches):
        for batch in batches:
            for part, arrays in work(batch, place):
                arrays = [a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=out.names)

    return df.mapInArrow(run, out)


MOST_CLASHES = 100_000


def _two_hashes(columns: list[Column]) -> tuple[Column, Column]:
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)


def content_ids(df: DataFrame, columns: list[str]) -> Column:
    """A long integer for each combination of values: rows get the same one if 128 bits of their hashes agree.

    The first hash is the number, but for the few values of it that rows with different second hashes have; there both
    hashes are hashed together. Finding those takes one scan; 10^10 rows have some three. More than ``MOST_CLASHES`` are an error.
    """
    one, two = _two_hashes([F.col(c) for c in columns])
    hashed = df.select(one.alias("one"), two.alias("two")).groupBy("one").agg(F.min("two").alias("low"), F.max("two").alias("high"))
    clashing = [r["one"] for r in hashed.where("low <> high").select("one").limit(MOST_CLASHES + 1).collect()]
    if len(clashing) > MOST_CLASHES:
        raise ValueError(f"more than {MOST_CLASHES} hashes stand for different rows")
    return F.when(one.isin(clashing), F.xxhash64(F.lit("both"), one, two)).otherwise(one) if clashing else one


MOST_LOG_BITS = 25


class KeyFilter:
    """A Bloom filter of 64-bit keys.

    It has 16 bits or more a key, up to ``2 ** MOST_LOG_BITS`` bits in all (4 MB), so what is broadcast is bounded. It never
    misses a key; other keys pass at a rate that grows once the filter is full, which costs work and changes no
    result. Spark builds the words of the filter; the driver receives no more than those.
    """

    def __init__(self, words: np.ndarray, log_bits: int):
        self.words, self.log_bits = words, log_bits

    @classmethod
    def of(cls, df: DataFrame, column: str, log_bits: int | None = None, keys: int | None = None) -> KeyFilter:
        """Filter of the keys in a column, sized for ``keys`` (counted if not given); ``log_bits`` fixes its size."""
        if log_bits is None:
            log_bits = min(max(16, (16 * (df.count() if keys is None else keys)).bit_length()), MOST_LOG_BITS)
        bits = 1 << log_bits
        key = F.col(column)
        first = F.shiftrightunsigned(key, 64 - log_bits)
        second = key.bitwiseAND(F.lit(bits - 1))
        words = (
            df.select(F.explode(F.array(first, second)).alias("bit"))
            .groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))
        ).toPandas()
        held = np.zeros(bits // 64, np.uint64)
        held[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
        return cls(held, log_bits)

    def _has(self, bit: np.ndarray) -> np.ndarray:
        return (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key (unsigned) may be among those the filter was built of."""
        found = self._has(keys >> np.uint64(64 - self.log_bits))
        at = np.flatnonzero(found)
        found[at] = self._has(keys[at] & np.uint64((1 << self.log_bits) - 1))
        return found


def unit(keys: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) from 64-bit keys."""
    return ((mix(keys) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
