"""Repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sample_order(key: str, seed: int):
    """Hash that orders rows the same way whatever the partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def seeded_sample(df: DataFrame, key: str, n: int = 1000, seed: int = 1) -> DataFrame:
    """``n`` rows in hash order; every task keeps its own first ``n`` only."""
    return df.orderBy(sample_order(key, seed), key).limit(n)
