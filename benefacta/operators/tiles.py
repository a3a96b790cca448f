"""Euclidean silhouette of every row, by tiles of distances.

The mean distance of a row to a cluster has no closed form, so distances are summed tile by tile: the vectors of each
cluster are packed into blocks of bounded size, tasks read pairs of partitions of blocks without a shuffle of them, and return one sum for each
row and cluster. A tile is a matrix product; only close pairs, where a product loses digits, are computed from differences. Only clusters that matter are summed: the own one, and those that can be the nearest of the others. A
cluster's mean distance lies between the distance to its centre and the root of the mean squared distance, both of which
follow from one aggregate per cluster; a cluster whose lower bound exceeds another's upper bound is not the nearest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialise

CLUSTER = "cluster"
BLOCK = 4096
MOST_VALUES = 1 << 24  # of all centres together, which go to the tasks
CLOSE = 1e-5  # of the squared norms: closer pairs are computed from differences
_AT_ONCE = 1 << 21
_IN_CACHE = 1 << 17
_SUMS = 1 << 20  # held by a task before it returns them


class _Centres:
    """Name, size, mean and mean squared radius of each cluster."""

    def __init__(self, rows: DataFrame):
        packed = array_to_vector("x")
        size = rows.agg(F.count_distinct("c") * F.max(F.size("x"))).first()[0] or 0
        if size > MOST_VALUES:
            raise ValueError(f"the centres have {size} components; tasks hold {MOST_VALUES}")
        found = rows.groupBy("c").agg(F.count("*").alias("n"), vector_to_array(Summarizer.mean(packed)).alias("mean"),
                                      vector_to_array(Summarizer.variance(packed)).alias("variance")).orderBy("c").collect()
        self.names = pd.Index([r["c"] for r in found])
        self.sizes = np.array([r["n"] for r in found], np.float64)
        self.means = np.array([r["mean"] for r in found])
        # the variance is the sample's
        self.spread = np.array([sum(r["variance"]) * (r["n"] - 1) / r["n"] if r["n"] > 1 else 0.0 for r in found])

    def needed(self, x: np.ndarray, own: int) -> np.ndarray:
        """Rows by clusters: whether the mean distance counts."""
        lower = distances(x, self.means)
        upper = np.sqrt(lower ** 2 + self.spread)
        upper[:, own] = np.inf
        out = lower <= upper.min(axis=1)[:, None] * (1 + 1e-9) + 1e-12
        out[:, own] = self.sizes[own] > 1
        return out


def _by_differences(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(y)))
    step = max(1, _AT_ONCE // max(y.size, 1))
    for low in range(0, len(x), step):
        out[low:low + step] = np.sqrt(np.square(x[low:low + step, None] - y[None]).sum(axis=2))
    return out


def _parts(x: np.ndarray, y: np.ndarray):
    """Euclidean distances of some rows of ``x`` after the others to all of ``y``; equal rows are at 0."""
    step = max(1, _IN_CACHE // len(y))
    with np.errstate(invalid="ignore", over="ignore"):
        a, b = x - y.mean(axis=0), y - y.mean(axis=0)
        aa, bb = np.square(a).sum(axis=1), np.square(b).sum(axis=1)
    if not np.isfinite(aa.sum() + bb.sum()):
        yield from (_by_differences(x[low:low + step], y) for low in range(0, len(x), step))
        return
    left, right = np.column_stack([-2 * a, aa, np.ones(len(a))]), np.column_stack([b, np.ones(len(b)), bb]).T
    for low in range(0, len(x), step):
        part = left[low:low + step] @ right
        if part.min() < CLOSE * (aa[low:low + step].max() + bb.max()):
            i, j = np.nonzero(part < CLOSE * (aa[low:low + step, None] + bb))
            for at in range(0, len(i), some := max(1, _AT_ONCE // x.shape[1])):
                part[i[at:at + some], j[at:at + some]] = np.square(x[low + i[at:at + some]] - y[j[at:at + some]]).sum(axis=1)
        yield np.sqrt(part, out=part)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` to all of ``y``."""
    return np.concatenate(list(_parts(x, y))) if len(x) and len(y) else np.empty((len(x), len(y)))


def _distance_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of the distances of each row of ``x`` to all of ``y``."""
    return np.concatenate([part.sum(axis=1) for part in _parts(x, y)])


def _unpacked(value: pa.Scalar, dims: int, kind: type = np.float64) -> np.ndarray:
    return np.frombuffer(value.as_py(), kind).reshape(-1, dims).astype(np.float64)


def euclidean_silhouette(df: DataFrame, vector: str, cluster: str = CLUSTER, key: str = "id", block: int = BLOCK) -> DataFrame:
    """``key``, ``cluster`` and exact ``silhouette`` of every row, repeated ones included.

    0 in a cluster of one, and where there is one cluster only. Distances computed grow with the rows of the clusters
    that count; what is stored is one sum for each row and such cluster. Rows with a null vector are left out.
    """
    rows = df.select(F.col(key).alias("id"), F.col(cluster).alias("c"), F.col(vector).cast("array<double>").alias("x"))
    rows = materialise(rows.where("x is not null"), "silhouette-rows")
    out = T.StructType([df.schema[key], df.schema[cluster], T.StructField("silhouette", T.DoubleType())])
    centres = _Centres(rows)
    if not len(centres.names):
        return df.sparkSession.createDataFrame([], out)
    dims = centres.means.shape[1]
    single = df.schema[vector].dataType == T.ArrayType(T.FloatType(), df.schema[vector].dataType.containsNull)
    packed = np.float32 if single else np.float64  # either holds the values exactly
    shipped, most = df.sparkSession.sparkContext.broadcast(centres), _SUMS

    def deal(batches):
        count = TaskContext.get().partitionId()  # blocks are filled in turn, so repeated rows are spread too
        for batch in batches:
            codes = shipped.value.names.get_indexer(batch.column(1).to_pandas())
            spots = (count + np.arange(batch.num_rows)) % np.ceil(shipped.value.sizes[codes] / block).astype(np.int64)
            count += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int32()), pa.array(spots, pa.int32())],
                                             names=["id", "c", "x", "code", "spot"])

    def pack(table: pa.Table) -> pa.Table:
        x = table.column("x").combine_chunks().flatten().to_numpy().reshape(-1, dims)
        own = table.column("code")[0].as_py()
        needed = shipped.value.needed(x, own)
        return pa.table({"code": table.column("code")[:1], "spot": table.column("spot")[:1], "c": table.column("c")[:1],
                         "ids": pa.array([table.column("id").to_pylist()], pa.list_(table.schema.field("id").type)),
                         "x": pa.array([x.astype(packed).tobytes()], pa.binary()), "needed": pa.array([needed.tobytes()], pa.binary()),
                         "others": pa.array([np.flatnonzero(needed.any(axis=0))], pa.list_(pa.int32()))})

    def tile(batches):
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        held = {"at": None}

        def given():
            for (own, spot, other), total in sums.items():
                at = np.flatnonzero(~np.isnan(total[0]))
                n = shipped.value.sizes[other] - (own == other)
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(np.full(len(at), v), pa.int32()) for v in (own, spot)), pa.array(at, pa.int32()),
                    pa.array(np.full(len(at), other), pa.int32()), pa.array(total[1][at] / n)],
                    names=["code", "spot", "place", "other", "share"])
            sums.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                own, spot, other = (batch.column(c)[i].as_py() for c in ("code", "spot", "other"))
                if held["at"] != (own, spot):  # the same block comes with one after the other
                    x = _unpacked(batch.column("x")[i], dims, packed)
                    held = {"at": (own, spot), "x": x, "needed": np.frombuffer(batch.column("needed")[i].as_py(), bool).reshape(len(x), -1)}
                on = held["needed"][:, other]
                if (own, spot, other) not in sums:
                    if sums and (len(sums) + 1) * len(on) > most:
                        yield from given()
                    sums[own, spot, other] = np.array([np.where(on, 0.0, np.nan), np.zeros(len(on))])
                sums[own, spot, other][1][on] += _distance_sums(held["x"][on], _unpacked(batch.column("y")[i], dims, packed))
        yield from given()

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "c")}
    dealt = rows.mapInArrow(deal, T.StructType([*rows.schema.fields, T.StructField("code", T.IntegerType()), T.StructField("spot", T.IntegerType())]))
    count = int(np.ceil(centres.sizes / block).sum())
    spread = dealt.repartition(min(count, max(16, count // 8)), "code", "spot")
    blocks = materialise(spread.groupBy("code", "spot").applyInArrow(
        pack, f"code int, spot int, c {kinds['c']}, ids array<{kinds['id']}>, x binary, needed binary, others array<int>"), "silhouette-blocks")
    # every pair of partitions is a task that reads both, so the vectors are not written once for each tile
    tiles = blocks.select("code", "spot", "x", "needed", "others").join(
        blocks.select(F.col("code").alias("other"), F.col("x").alias("y")), F.array_contains("others", F.col("other"))).drop("others")
    sums = tiles.mapInArrow(tile, "code int, spot int, place int, other int, share double").groupBy(
        "code", "spot", "place", "other").agg(F.sum("share").alias("mean"))
    widths = sums.groupBy("code", "spot", "place").agg(
        F.max(F.when(F.col("other") == F.col("code"), F.col("mean"))).alias("a"),
        F.min(F.when(F.col("other") != F.col("code"), F.col("mean"))).alias("b"))
    each = blocks.select("code", "spot", "c", F.posexplode("ids").alias("place", "id"))
    width = F.when(F.greatest("a", "b") > 0, (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    scored = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), width)
    return each.join(widths, ["code", "spot", "place"], "left").select(
        F.col("id").alias(key), F.col("c").alias(cluster), F.coalesce(scored, F.lit(0.0)).alias("silhouette"))


def mean_silhouette(labelled: DataFrame, vector: str, cluster: str = CLUSTER) -> float | None:
    """Mean Euclidean silhouette of all rows."""
    numbered = labelled.select(F.lit(0).alias("id"), cluster, vector)
    return euclidean_silhouette(numbered, vector, cluster).agg(F.avg("silhouette")).first()[0]
