"""Equi-joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

def balanced_join(fact: DataFrame, dimension: DataFrame, key: str, how: str = "inner",
                  spread_by: tuple[str, ...] = (), salts: int = 64, hot: tuple = ()) -> DataFrame:
    """Join a fact to a dimension on ``key`` (inner or left); adaptive execution splits skewed keys.

    Where it cannot, as before an aggregate on the same key, the caller names the ``hot`` keys: their rows are
    spread over ``salts`` tasks by the hash of ``spread_by``, and only their dimension rows are repeated.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins keep the fact side whole")
    if not hot:
        return fact.join(dimension, key, how)
    is_hot = F.coalesce(F.col(key).isin(*hot), F.lit(False))
    spread = F.pmod(F.xxhash64(*(spread_by or fact.columns)), F.lit(salts)).cast("int")
    salted = fact.withColumn("_salt", F.when(is_hot, spread).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = dimension.withColumn("_salt", F.explode(copies))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def unique(df: DataFrame, key: str) -> DataFrame:
    """``df``, which must have one row per ``key``; a repeated key is an error when the rows are read.

    The check is an aggregate by the key, whose partitioning a join on the key uses again.
    """
    repeated = F.raise_error(F.concat(F.lit(f"more than one row with {key} "), F.col(key).cast("string")))
    others = [c for c in df.columns if c != key]
    checked = df.groupBy(key).agg(*[F.any_value(c).alias(c) for c in others], F.count("*").alias("_rows"))
    return checked.filter(F.when(F.col("_rows") == 1, F.lit(True)).otherwise(repeated.cast("boolean"))).select(*df.columns)


def keep_members(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``; these are reduced to distinct keys before they are shuffled."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def mark_members(df: DataFrame, keys: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """Set ``column`` to ``value`` on the rows whose key occurs in ``keys``."""
    flagged = keys.select(key, F.lit(True).alias("_member")).distinct()
    return (df.join(flagged, key, "left")
            .withColumn(column, F.when(F.col("_member"), F.lit(value)).otherwise(F.col(column)))
            .drop("_member"))
