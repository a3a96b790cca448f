"""Scoring of request records; the same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import segment_label
from .clustering import nearest_centroid
from .scaling import SERVICE_SCALING, zscore_with

FEATURES = ("dltv", "churn", "effectiveness")  # order of the model
REQUEST_TYPES = {"churn": "double", "effectiveness": "double", "dltv": "double"}


def drop_null_features(df: DataFrame, columns=FEATURES) -> DataFrame:
    return df.dropna(subset=list(columns))


def validate(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Cast the fields to their types; ``errors`` lists the fields that hold something else.

    Null and NaN are allowed and become null.
    """
    types = types or REQUEST_TYPES
    cast = {c: F.col(c).try_cast(kind) for c, kind in types.items()}
    bad = [F.when(F.col(c).isNotNull() & cast[c].isNull(), F.lit(c)) for c in types]

    def clean(c, kind):
        return F.when(~F.isnan(cast[c]), cast[c]) if kind in ("double", "float") else cast[c]

    names = F.concat_ws(",", *bad)
    errors = F.when(names == "", F.array().cast("array<string>")).otherwise(F.split(names, ","))
    return df.withColumn("errors", errors).withColumns(
        {c: clean(c, kind) for c, kind in types.items()})


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, invalid)``; valid rows lose the empty error list."""
    ok = F.size("errors") == 0
    return validated.filter(ok).drop("errors"), validated.filter(~ok)


def score_requests(requests: DataFrame, centroids: dict[int, tuple[float, ...]]) -> DataFrame:
    """Validate, scale with the service constants, assign and label.

    Invalid or incomplete records keep a null code and carry the label for unclassified donors.
    """
    scaled = zscore_with(validate(requests), {c: SERVICE_SCALING[c] for c in FEATURES})
    code = F.when(F.size("errors") == 0, nearest_centroid([f"{c}_std" for c in FEATURES], centroids))
    return (scaled.withColumn("cluster", code).withColumn("segment", segment_label(F.col("cluster")))
            .drop(*[f"{c}_std" for c in FEATURES]))
