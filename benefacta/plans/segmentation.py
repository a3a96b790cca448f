"""Training of the segment model and assignment of segments to donors."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..functions.labels import NEW_DONOR, SEGMENTS, UNASSIGNED, mapped
from ..operators import clustering, joins, outliers, scaling, scoring
from ..session import materialise

FEATURES = ["dltv", "churn_prob", "effectiveness"]


class Training(NamedTuple):
    model: PipelineModel
    labelled: DataFrame
    k: int
    scores: list[tuple[int, float]]


def train_segments(table: DataFrame, features: list[str] | None = None, k: int | None = None,
                   restarts: int = 10, seed: int = 0, metric: str = "squaredEuclidean") -> Training:
    """Fit on the donors inside the fences of value and risk, then label the others with that model.

    Outliers are scaled with the statistics of the training rows, which the model contains. The
    table is read many times, so it is written to the shared folder first.
    """
    features = features or FEATURES
    complete = materialise(scoring.drop_null_features(table, features), "training-table")
    normal, outside = outliers.split_outliers_chained(complete, features[:2])
    fitted = clustering.segment(normal, features, k, restarts, seed, metric)
    labelled_outside = clustering.without_vectors(fitted.model.transform(outside), features)
    labelled = fitted.labelled.unionByName(labelled_outside)
    return Training(fitted.model, labelled, fitted.k, fitted.scores)


def with_segments(donors: DataFrame, labelled: DataFrame) -> DataFrame:
    """Donor table with cluster, value and effectiveness; every donor stays."""
    return donors.join(labelled.select("donor_id", "cluster", "dltv", "effectiveness"), "donor_id", "left")


def label_donors(coded: DataFrame, new_donors: DataFrame | None = None) -> DataFrame:
    """Segment names from the ``cluster`` column: unassigned where it is null, new donors marked.

    ``new_donors`` are appended if the table does not hold them.
    """
    name = F.coalesce(mapped(F.col("cluster"), SEGMENTS), F.lit(UNASSIGNED))
    out = coded.withColumn("segment", name).drop("cluster")
    if new_donors is None:
        return out
    out = joins.mark_members(out, new_donors, "donor_id", "segment", NEW_DONOR)
    missing = new_donors.dropDuplicates(["donor_id"]).join(coded.select("donor_id"), "donor_id", "left_anti")
    return out.unionByName(missing.withColumn("segment", F.lit(NEW_DONOR)), allowMissingColumns=True)


def assign_segments(donors: DataFrame, features: DataFrame, centroids: dict[int, tuple[float, ...]],
                    new_donors: DataFrame | None = None) -> DataFrame:
    """Scale by the moments of the complete rows, take the nearest centroid, name the segment.

    Incomplete rows get no code, so the codes need not be joined back to the donors.
    """
    extra = features.select("donor_id", "lifespan", "dltv", "effectiveness")
    joined = donors.join(extra, "donor_id", "left")
    scaled = scaling.zscore(joined, FEATURES, over=scoring.drop_null_features(joined, FEATURES))
    code = clustering.nearest_centroid([f"{c}_std" for c in FEATURES], centroids)
    coded = scaled.withColumn("cluster", code).drop(*[f"{c}_std" for c in FEATURES])
    return label_donors(coded, new_donors)


def assign_with_model(table: DataFrame, model: PipelineModel, features: list[str] | None = None) -> DataFrame:
    """Label with a trained model, which scales with its own statistics."""
    features = features or FEATURES
    complete = scoring.drop_null_features(table, features)
    return clustering.without_vectors(model.transform(complete), features)
