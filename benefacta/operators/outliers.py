"""Outlier split by 1.5 interquartile ranges."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from .quantiles import column_quantiles

WHISKER = 1.5


class Fences(NamedTuple):
    q1: float
    q3: float
    lower: float
    upper: float


def iqr_fences(df: DataFrame, column: str) -> Fences | None:
    """Quartiles and fences; None if the column holds no value."""
    quartiles = column_quantiles(df, column, [0.25, 0.75])
    if not quartiles:
        return None
    q1, q3 = quartiles
    reach = WHISKER * (q3 - q1)
    return Fences(q1, q3, q1 - reach, q3 + reach)


def split_outliers(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``(normal, outliers)``; the fences belong to normal, a null belongs to neither.

    The fences are plain numbers in the plan, so both filters reach the scan.
    """
    fences = iqr_fences(df, column)
    if fences is None:
        return df.limit(0), df.limit(0)
    value = F.col(column)
    return (df.filter(value.between(fences.lower, fences.upper)),
            df.filter(((value < fences.lower) | (value > fences.upper)) & ~F.isnan(value)))


def split_outliers_chained(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split by each column in turn; every column sees only what the earlier ones kept."""
    outliers = None
    for column in columns:
        df, out = split_outliers(df, column)
        outliers = out if outliers is None else outliers.unionByName(out)
    return df, outliers
