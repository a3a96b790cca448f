"""How good a segmentation is, and what its segments look like."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .sampling import sample_order, seeded_sample

CLUSTER = "cluster"


def cluster_profile(df: DataFrame, features: list[str], cluster: str = CLUSTER) -> DataFrame:
    """Size, share and feature means per cluster; one aggregate with partial sums."""
    total = df.agg(F.count(F.lit(1))).scalar()
    means = [F.avg(f).alias(f"mean_{f}") for f in features]
    return (df.groupBy(cluster).agg(F.count("*").alias("size"), *means)
            .withColumn("share", F.col("size") / total))


def cluster_metrics(profile: DataFrame, run_id: str, cluster: str = CLUSTER) -> DataFrame:
    """Long form ``run_id, cluster, metric, value`` of a profile."""
    metrics = [c for c in profile.columns if c != cluster]
    wide = profile.select(cluster, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(cluster, metrics, "metric", "value").select(
        F.lit(run_id).alias("run_id"), F.col(cluster), "metric", "value")


def cluster_category_counts(df: DataFrame, column: str, values: dict[str, str],
                            cluster: str = CLUSTER, other: str = "other") -> DataFrame:
    """Rows per cluster, one column per given category and ``other`` for all the rest."""
    listed = F.coalesce(F.col(column).isin(*values), F.lit(False))
    return df.groupBy(cluster).agg(*[F.count_if(F.col(column) == v).alias(name) for v, name in values.items()],
                                   F.count_if(~listed).alias(other))


def run_metrics(spark: SparkSession, run_id: str, parameters: dict[str, object], scores: dict[str, float]) -> DataFrame:
    """Parameters and run-level scores in the long form of ``cluster_metrics``; their cluster is null."""
    rows = [(run_id, None, name, float(value), None) for name, value in scores.items()]
    rows += [(run_id, None, name, None, str(value)) for name, value in parameters.items()]
    return spark.createDataFrame(rows, "run_id string, cluster int, metric string, value double, parameter string")


def cluster_categories(df: DataFrame, column: str, cluster: str = CLUSTER) -> DataFrame:
    """``cluster, category, n`` for every category found, null included."""
    return df.groupBy(cluster, F.col(column).alias("category")).agg(F.count("*").alias("n"))


def squared_silhouette(df: DataFrame, vector: str, cluster: str = CLUSTER, key: str = "id") -> DataFrame:
    """Exact silhouette of every row with squared Euclidean distance, without any pair of rows.

    The mean squared distance of a row to a cluster follows from the cluster's size, sum vector and
    sum of squares. Those are one row per cluster; with them each batch of rows is scored on its own.
    """
    rows = df.select(key, F.col(cluster).alias("_c"), F.col(vector).cast("array<double>").alias("_x"))
    packed = array_to_vector("_x")
    totals = rows.groupBy("_c").agg(
        F.count("*").alias("n"), vector_to_array(Summarizer.sum(packed)).alias("s"),
        vector_to_array(Summarizer.normL2(packed)).alias("norms")).orderBy("_c").collect()
    names = pd.Index([r["_c"] for r in totals])
    sizes = np.array([r["n"] for r in totals], dtype="float64")
    sums = np.array([r["s"] for r in totals])
    squares = np.array([np.square(r["norms"]).sum() for r in totals])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["_x"].to_numpy()).astype("float64")
            to_cluster = np.square(x).sum(axis=1)[:, None] * sizes - 2 * x @ sums.T + squares
            yield pd.DataFrame({key: batch[key], cluster: batch["_c"], "silhouette": _widths(
                np.maximum(to_cluster, 0.0), names.get_indexer(batch["_c"]), sizes)})

    return rows.mapInPandas(score, _silhouette_schema(df, key, cluster))


def _silhouette_schema(df, key, cluster):
    return T.StructType([df.schema[key], T.StructField(cluster, df.schema[cluster].dataType),
                         T.StructField("silhouette", T.DoubleType())])


def _widths(to_cluster: np.ndarray, own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Silhouettes from the total distance of each row to each cluster; 0 in a cluster of one."""
    at = np.arange(len(own))
    a = to_cluster[at, own] / np.maximum(sizes[own] - 1, 1)
    means = to_cluster / sizes
    means[at, own] = np.inf
    b = means.min(axis=1)
    largest = np.maximum(a, b)
    usable = (largest > 0) & np.isfinite(largest) & (sizes[own] > 1)
    return np.divide(b - a, largest, out=np.zeros_like(a), where=usable)


def sampled_silhouette(df: DataFrame, vector: str, cluster: str = CLUSTER, key: str = "id",
                       n: int = 1000, seed: int = 1) -> DataFrame:
    """Exact Euclidean silhouette within a seeded sample of ``n`` rows.

    The sample is the bound: its matrix goes to the tasks, which compare their own rows with it.
    """
    sample = seeded_sample(df.select(key, F.col(cluster).alias("_c"), F.col(vector).alias("_x")), key, n, seed)
    members = sample.collect()  # at most n rows
    points = np.array([m["_x"] for m in members], dtype="float64")
    labels, names = pd.factorize(pd.Series([m["_c"] for m in members]), sort=True)
    sizes = np.bincount(labels, minlength=len(names)).astype("float64")
    member = np.eye(len(names))[labels]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = pd.Index(names).get_indexer(batch["_c"])
            x = np.stack(batch["_x"].to_numpy()).astype("float64")
            distance = np.sqrt(np.maximum(((x[:, None, :] - points[None]) ** 2).sum(axis=2), 0.0))
            yield pd.DataFrame({key: batch[key], cluster: batch["_c"],
                                "silhouette": _widths(distance @ member, own, sizes)})

    spread = df.sparkSession.createDataFrame(members, sample.schema).repartition(8, key)
    return spread.mapInPandas(score, _silhouette_schema(df, key, cluster))


def segment_importance(df: DataFrame, columns: list[str], key: str, cluster: str = CLUSTER, seed: int = 1,
                       trees: int = 50, test_share: float = 0.25) -> DataFrame:
    """How well the columns explain the segments: test accuracy and importance per column.

    The split follows a hash of the key, so it does not change with the partitioning.
    """
    vectors = (VectorAssembler(inputCols=columns, outputCol="_v", handleInvalid="skip").transform(df)
               .select(F.col(cluster).cast("double").alias("_label"), "_v",
                       (F.conv(F.substring(sample_order(key, seed), 1, 8), 16, 10).cast("double")
                        / 0xFFFFFFFF < test_share).alias("_test"))).persist()
    try:
        model = RandomForestClassifier(featuresCol="_v", labelCol="_label", numTrees=trees,
                                       seed=seed).fit(vectors.filter("not _test"))
        accuracy = MulticlassClassificationEvaluator(labelCol="_label", metricName="accuracy").evaluate(
            model.transform(vectors.filter("_test")))
    finally:
        vectors.unpersist()
    weights = model.featureImportances.toArray()
    rows = [(c, float(w), float(accuracy)) for c, w in zip(columns, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, accuracy double")
