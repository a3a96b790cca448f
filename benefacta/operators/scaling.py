"""Population z-scores."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import standardised

# Mean and standard deviation used by the scoring service.
SERVICE_SCALING = {
    "dltv": (2052875.1935207853, 1106063.9693825627),
    "churn": (0.7525753912711541, 0.5247159306383898),
    "effectiveness": (0.9211417379699978, 0.14987482287122253),
}


class Moments(NamedTuple):
    mean: float
    std: float


def _moments(columns: list[str]) -> list[Column]:
    return [e for c in columns for e in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_sd"))]


def fit_moments(df: DataFrame, columns: list[str]) -> dict[str, Moments]:
    """Mean and population deviation as numbers, to be kept with a model."""
    row = df.agg(*_moments(columns)).first()
    return {c: Moments(row[f"{c}_mean"], row[f"{c}_sd"]) for c in columns}


def zscore(df: DataFrame, columns: list[str], suffix: str = "_std", over: DataFrame | None = None) -> DataFrame:
    """Scale by the moments of the frame itself, or of ``over``; stays lazy (one-row subquery)."""
    stats = (df if over is None else over).agg(F.struct(*_moments(columns)).alias("m")).scalar()
    scaled = {c + suffix: standardised(F.col(c), F.col(f"_m.{c}_mean"), F.col(f"_m.{c}_sd")) for c in columns}
    return df.withColumn("_m", stats).withColumns(scaled).drop("_m")


def zscore_with(df: DataFrame, moments: dict[str, tuple[float, float]], suffix: str = "_std") -> DataFrame:
    """Scale by given moments."""
    return df.withColumns({c + suffix: standardised(F.col(c), mean, std)
                           for c, (mean, std) in moments.items()})
