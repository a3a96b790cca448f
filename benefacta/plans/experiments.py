"""Clustering experiments on the lifetime-value table.

Each experiment reads its table many times (quantiles, moments, fits), so the columns it needs are
written to the shared folder first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import clustering, linkage, outliers, quality, reduction
from ..session import materialise

KMEANS_COLUMNS = ["dltv", "age", "churn_max"]
MIXED_NUMERIC = ["dltv", "age", "avg_paid", "avg_unpaid"]
MIXED_CATEGORICAL = ["gender", "main_channel"]
LINKED_CATEGORICAL = [*MIXED_CATEGORICAL, "marital_status"]
PCA_COLUMNS = ["age", "avg_paid", "avg_unpaid", "channels", "dltv", "churn_max"]


def kmeans_experiment(values: DataFrame, k: int = 5, restarts: int = 10, seed: int = 0) -> clustering.Segmentation:
    """Five segments of the donors without value outliers."""
    normal, _ = outliers.split_outliers(materialise(values, "kmeans-table"), "dltv")
    return clustering.segment(normal, KMEANS_COLUMNS, k, restarts, seed)


def pca_experiment(table: DataFrame, k: int | None = None, restarts: int = 10,
                   seed: int = 0) -> clustering.Segmentation:
    """Segments on three component scores; the number of segments is chosen by silhouette."""
    normal, _ = outliers.split_outliers(materialise(table, "pca-table"), "dltv")
    scores = reduction.pca_scores(normal, PCA_COLUMNS)
    return clustering.segment(scores, list(reduction.SCORE_NAMES), k, restarts, seed)


def hierarchical_experiment(table: DataFrame, clusters: int = 4) -> DataFrame:
    normal, _ = outliers.split_outliers(materialise(table, "hierarchy-table"), "dltv")
    return clustering.hierarchical_segments(normal, MIXED_NUMERIC, MIXED_CATEGORICAL, clusters)


def linkage_experiment(table: DataFrame, clusters: int = 4, most: int = linkage.MOST,
                       profiles: bool = False) -> tuple[linkage.Hierarchy, DataFrame]:
    """Average linkage of the donors without value outliers, and their segments when the tree is cut."""
    normal, _ = outliers.split_outliers(materialise(table, "linkage-table"), "dltv")
    found = linkage.hierarchy(normal, MIXED_NUMERIC, LINKED_CATEGORICAL, most, profiles)
    return found, found.label(normal.dropna(subset=MIXED_NUMERIC), clusters)


def run_record(fitted: clustering.Segmentation, columns: list[str], run_id: str, **parameters) -> DataFrame:
    """Everything a run leaves behind: parameters (``clusters``, ``variables`` and those given), run-level scores
    (``best_k``, ``n_clusters``, ``silhouette``) and the profile of each cluster."""
    vectors = fitted.model.transform(fitted.labelled.drop("cluster"))
    scores = {"best_k": fitted.k, "n_clusters": len(fitted.model.stages[-1].clusterCenters()),
              "silhouette": clustering.silhouette(vectors)}
    scores |= {f"silhouette_k{k}": s for k, s in fitted.scores}
    run = quality.run_metrics(fitted.labelled.sparkSession, run_id,
                              {"clusters": fitted.k, "variables": ", ".join(columns), **parameters}, scores)
    return run.unionByName(profile_metrics(fitted.labelled, columns, run_id), allowMissingColumns=True)


def profile_metrics(labelled: DataFrame, features: list[str], run_id: str) -> DataFrame:
    """Size, share and means per cluster in the long form of the metrics sink."""
    return quality.cluster_metrics(quality.cluster_profile(labelled, features), run_id)
