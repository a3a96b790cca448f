"""K-means with restarts, choice of k, nearest centroid, bisecting hierarchy."""

from __future__ import annotations

import pickle
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import BisectingKMeans, KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .scaling import Moments, fit_moments
from .tiles import mean_silhouette

FEATURES = "features"
CLUSTER = "cluster"
PARALLEL_FITS = 8
SAME_COST = 1e-9  # costs as near as this are equal but for rounding
MERGES = 8  # tasks that add up what the others found
_CHUNK = 1024
_AT_ONCE = 1 << 18  # distances that a task holds
_DRAWN = pa.schema([("run", pa.int32()), ("race", pa.float64()), ("x", pa.list_(pa.float64()))])


def scaling_stages(moments: dict[str, Moments]) -> list:
    """Pipeline stages from named columns to a scaled vector; the moments are part of the model."""
    scaled = []
    for name, (mean, std) in moments.items():
        expr = f"(`{name}` - {mean!r}D) / {std!r}D" if std else f"`{name}` * 0D"
        scaled.append(f"{expr} AS `{name}_std`")
    statement = f"SELECT *, {', '.join(scaled)} FROM __THIS__"
    assembler = VectorAssembler(inputCols=[f"{c}_std" for c in moments], outputCol=FEATURES)
    return [SQLTransformer(statement=statement), assembler]


def scaled_vectors(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list]:
    """The frame with a scaled vector, and the stages that produced it. Rows with nulls are dropped."""
    complete = df.dropna(subset=columns)
    stages = scaling_stages(fit_moments(complete, columns))
    return PipelineModel(stages=stages).transform(complete), stages


def fit_kmeans(vectors: DataFrame, k: int, restarts: int = 10, seed: int = 0, iterations: int = 300,
               tolerance: float = 1e-4, parallelism: int = PARALLEL_FITS) -> KMeansModel:
    """Best of several seeded fits by the sum of squared distances.

    ``tolerance`` bounds the squared shift of all centroids together, relative to unit variance;
    the estimator's own setting bounds the plain shift of each one.
    The estimator draws the starts; from there all fits advance together, one pass over the vectors an iteration. Only those whose
    costs cannot be told from the least are fitted by the estimator itself.
    """
    def estimator(attempt, most):
        return KMeans(k=k, seed=seed + attempt, maxIter=most, tol=(tolerance / k) ** 0.5, featuresCol=FEATURES, predictionCol=CLUSTER)

    def fit(attempt):
        model = estimator(attempt, iterations).fit(vectors)
        return model.summary.trainingCost, attempt, model

    attempts = list(range(restarts))
    if restarts > 1:
        starts = _side_by_side(lambda attempt: np.array(estimator(attempt, 0).fit(vectors).clusterCenters()), attempts, parallelism)
        values = vectors.select(vector_to_array(FEATURES).alias("x")).persist()
        try:
            costs = [cost for cost, _ in _advanced(values, starts, iterations, lambda shifts: shifts.max() <= tolerance / k)]
        finally:
            values.unpersist()
        attempts = [i for i in attempts if costs[i] <= min(costs) + SAME_COST * abs(min(costs))]
    return min(_side_by_side(fit, attempts, parallelism), key=lambda f: f[:2])[2]


def _side_by_side(fn, items, parallelism: int) -> list:
    """Submit independent Spark jobs from a few driver threads."""
    with ThreadPool(max(1, min(parallelism, len(items)))) as pool:
        return pool.map(fn, items, chunksize=1)


def silhouette(labelled: DataFrame, metric: str = "squaredEuclidean") -> float:
    """Mean silhouette: with ``squaredEuclidean`` distance linear in the rows, with ``euclidean`` by tiles of distances."""
    if metric == "euclidean":
        return mean_silhouette(labelled.withColumn("_x", vector_to_array(FEATURES)), "_x", CLUSTER)
    return ClusteringEvaluator(featuresCol=FEATURES, predictionCol=CLUSTER,
                               distanceMeasure=metric).evaluate(labelled)


def nearest_of(centres: np.ndarray):
    """Function from a vector column to the number of its nearest centre; one matrix per batch."""
    @F.pandas_udf("int")
    def nearest(column: pd.Series) -> pd.Series:
        return pd.Series(_nearest(np.stack(column.to_list()), centres)) if len(column) else pd.Series([], dtype="int32")

    return lambda column: nearest(vector_to_array(column))


def nearest_of_each(several: list[np.ndarray]):
    """Function from a vector column to the numbers of its nearest centre in each of ``several`` sets."""
    @F.pandas_udf("array<int>")
    def nearest(column: pd.Series) -> pd.Series:
        if not len(column):
            return pd.Series([], dtype="object")
        x = np.stack(column.to_list())
        return pd.Series(list(np.column_stack([_nearest(x, centres) for centres in several]).astype("int32")))

    return lambda column: nearest(vector_to_array(column))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre of each row."""
    step = max(1, _AT_ONCE // len(centres))
    return np.concatenate([_distances(x[low:low + step], centres).argmin(axis=1) for low in range(0, len(x), step)])


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    return np.maximum(np.square(x).sum(axis=1)[:, None] - 2 * x @ centres.T + np.square(centres).sum(axis=1), 0.0)


def _least_squares(x: np.ndarray, groups: list[np.ndarray]) -> np.ndarray:
    """Squared distance of each row to the nearest member of each group, from differences, so equal rows are at 0."""
    members, first = np.concatenate(groups), np.cumsum([0, *map(len, groups[:-1])])
    out, step = np.empty((len(x), len(groups))), max(1, _AT_ONCE // len(members))
    for low in range(0, len(x), step):
        part, total = x[low:low + step], 0.0
        for j in range(x.shape[1]):
            total = total + np.square(part[:, j, None] - members[None, :, j])
        out[low:low + step] = np.minimum.reduceat(total, first, axis=1)
    return out


def _races(hashes: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """An exponential variable for each hash, its own for each seed and turn."""
    mixed = hashes + np.uint64(((seed * 1_000_003 + turn) * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    mixed ^= mixed >> np.uint64(31)
    return -np.log(((mixed >> np.uint64(11)).astype("float64") + 0.5) / 2**53)


def _spread_starts(values: DataFrame, ks: list[int], seeds: list[int]) -> list[np.ndarray]:
    """For each run ``k`` rows of all, each drawn in proportion to its squared distance from those before it.

    A vector that occurs n times counts n times. The smallest of the exponential variables, each divided by its weight, is
    drawn; they follow a hash of vector, seed and turn, which the partitioning does not change. All runs draw in one pass a turn.
    A run with fewer distinct vectors than ``k`` repeats its first one.
    """
    weighted = values.groupBy("x").agg(F.count("*").alias("n")).withColumn("hash", F.xxhash64("x")).persist()

    def draw(chosen: dict[int, list], turn: int) -> dict[int, list]:
        def work(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, n = _matrix(batch.column("x")), batch.column("n").to_numpy().astype("float64")
                hashes, rows = batch.column("hash").to_numpy().view("uint64"), []
                far = _least_squares(x, [np.array(before) for before in chosen.values()]) if turn else np.ones((len(x), len(chosen)))
                for place, run in enumerate(chosen):
                    weight = n * far[:, place]
                    race = np.divide(_races(hashes, seeds[run], turn), weight, out=np.full(len(x), np.inf), where=weight > 0)
                    first = race.argmin()
                    if np.isfinite(race[first]):
                        rows.append({"run": run, "race": race[first], "x": x[first].tolist()})
                yield pa.RecordBatch.from_pylist(rows, schema=_DRAWN)

        best = weighted.mapInArrow(work, "run int, race double, x array<double>").groupBy("run").agg(
            F.min(F.struct("race", "x"))["x"].alias("x"))
        return {r["run"]: r["x"] for r in best.collect()}

    chosen: dict[int, list] = {run: [] for run in range(len(ks))}
    try:
        for turn in range(max(ks)):
            open_runs = {run: before for run, before in chosen.items() if len(before) < ks[run]}
            drawn = draw(open_runs, turn)
            for run, before in open_runs.items():
                before.append(drawn.get(run) or before[0])
    finally:
        weighted.unpersist()
    return [np.array(chosen[run]) for run in range(len(ks))]


def lloyd_runs(vectors: DataFrame, ks: list[int], seeds: list[int], iterations: int = 300, tolerance: float = 1e-4) -> list[tuple[float, np.ndarray]]:
    """``(cost, centres)`` of one k-means run for each k and seed.

    All runs advance together: an iteration is one pass over the vectors, whatever the number of runs, and each
    task returns one row per run and cluster. Starts are spread over all rows;
    the centres are what passes between iterations, so no lineage grows.
    """
    values = vectors.select(vector_to_array(FEATURES).alias("x")).persist()
    try:
        return _advanced(values, _spread_starts(values, ks, seeds), iterations, lambda shifts: shifts.sum() <= tolerance)
    finally:
        values.unpersist()


class _Sums:
    """Of each run's clusters over some rows: sums of the vectors and sizes; of each run its cost, kept with the first cluster.

    Runs of as many centres are handled together, some rows at a time, so the distances at hand stay small whatever a batch holds.
    """

    def __init__(self, moving: dict[int, np.ndarray]):
        self.runs: dict[int, list[int]] = {}
        for run, centres in moving.items():
            self.runs.setdefault(len(centres), []).append(run)
        self.dims = next(iter(moving.values())).shape[1]
        self.totals = {k: np.zeros((len(runs), k, self.dims + 2)) for k, runs in self.runs.items()}
        each = {k: np.stack([moving[run] for run in runs], axis=1).reshape(-1, self.dims) for k, runs in self.runs.items()}
        # times a vector and a 1: the squared distance less the vector's own square
        self.left = {k: np.column_stack([-2 * centres, np.square(centres).sum(axis=1)]) for k, centres in each.items()}

    def add(self, x: np.ndarray) -> None:
        for low in range(0, len(x), _CHUNK):
            part = x[low:low + _CHUNK]
            squares, part = np.square(part).sum(axis=1), np.column_stack([part, np.ones(len(part))])
            for k, total in self.totals.items():
                far = (self.left[k] @ part.T).reshape(k, len(total), -1)
                least = far.min(axis=0)
                on = far == least
                if np.count_nonzero(on) != least.size:  # of equal distances the first
                    on = far.argmin(axis=0) == np.arange(k)[:, None, None]
                found = on.reshape(-1, len(part)).astype(np.float64) @ part
                total[:, :, :-1] += found.reshape(k, len(total), -1).swapaxes(0, 1)
                total[:, 0, -1] += np.maximum(least + squares, 0.0).sum(axis=1)

    def __getstate__(self):
        return {"runs": self.runs, "totals": self.totals}

    def merge(self, other: _Sums) -> _Sums:
        for k, total in self.totals.items():
            total += other.totals[k]
        return self

    def each(self):
        """``run, sums, sizes, cost`` of each run."""
        for k, runs in self.runs.items():
            for run, total in zip(runs, self.totals[k]):
                yield run, total[:, :-2], total[:, -2], total[:, -1].sum()


def _advanced(values: DataFrame, centres: list[np.ndarray], iterations: int, rest) -> list[tuple[float, np.ndarray]]:
    """The runs from these starts, each until its centres rest: ``rest`` judges their squared shifts."""
    costs, centres = [np.inf] * len(centres), list(centres)

    def reduced(moving: dict[int, np.ndarray]) -> _Sums:
        def work(batches):
            sums = _Sums(moving)
            for batch in batches:
                if batch.num_rows:
                    sums.add(_matrix(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % MERGES], pa.int32()), pa.array([pickle.dumps(sums)], pa.binary())],
                                             names=["slot", "sums"])

        def merged(table: pa.Table) -> pa.Table:
            sums = reduce(_Sums.merge, (pickle.loads(v.as_py()) for v in table.column("sums")))
            return pa.table({"sums": pa.array([pickle.dumps(sums)], pa.binary())})

        found = values.mapInArrow(work, "slot int, sums binary").groupBy("slot").applyInArrow(merged, "sums binary").collect()  # a row per slot
        return reduce(_Sums.merge, (pickle.loads(r["sums"]) for r in found), _Sums(moving))

    moving = dict(enumerate(centres))
    for _ in range(iterations):
        for run, sums, sizes, cost in reduced(moving).each():
            held, old = sizes > 0, moving[run]
            centres[run], costs[run] = old.copy(), cost  # an empty cluster keeps its centre
            centres[run][held] = sums[held] / sizes[held, None]
            shifts = np.square(centres[run] - old).sum(axis=1)
            if rest(shifts):
                del moving[run]
            else:
                moving[run] = centres[run]
        if not moving:
            break
    return list(zip(costs, centres))


def k_scores(vectors: DataFrame, ks: range = range(2, 10), seed: int = 123, restarts: int = 10,
             parallelism: int = PARALLEL_FITS, metric: str = "squaredEuclidean") -> list[tuple[int, float]]:
    """``(k, silhouette)`` of the best of ``restarts`` runs for each k, by either metric. ``vectors`` should be persisted."""
    fits = [(k, seed + attempt) for k in ks for attempt in range(restarts)]
    runs = lloyd_runs(vectors, [k for k, _ in fits], [s for _, s in fits])
    best = {k: min((run for (of, _), run in zip(fits, runs) if of == k), key=lambda run: run[0])[1] for k in ks}

    # the nearest centres of all k are found in one pass
    labelled = vectors.select(FEATURES, nearest_of_each([best[k] for k in ks])(F.col(FEATURES)).alias("_nearest")).persist()

    def score(place):
        return ks[place], silhouette(labelled.withColumn(CLUSTER, F.col("_nearest")[place]), metric)

    try:
        labelled.count()
        return _side_by_side(score, range(len(ks)), parallelism)
    finally:
        labelled.unpersist()


def pick_k(scores: list[tuple[int, float]]) -> int:
    """Highest silhouette; if that is two clusters, the second highest."""
    ranked = sorted(scores, key=lambda s: (-s[1], s[0]))
    return ranked[1][0] if ranked[0][0] == 2 and len(ranked) > 1 else ranked[0][0]


class Segmentation(NamedTuple):
    model: PipelineModel  # scaling, vector, k-means
    labelled: DataFrame
    k: int
    scores: list[tuple[int, float]]


def segment(df: DataFrame, columns: list[str], k: int | None = None, restarts: int = 10,
            seed: int = 0, metric: str = "squaredEuclidean") -> Segmentation:
    """Scale, choose k by the silhouette of ``metric`` if none is given, fit and label."""
    vectors, stages = scaled_vectors(df, columns)
    vectors = vectors.persist()
    try:
        scores = [] if k else k_scores(vectors, restarts=restarts, metric=metric)
        k = k or pick_k(scores)
        kmeans = fit_kmeans(vectors, k, restarts, seed)
    finally:
        vectors.unpersist()
    model = PipelineModel(stages=[*stages, kmeans])
    return Segmentation(model, without_vectors(model.transform(df.dropna(subset=columns)), columns), k, scores)


def without_vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(FEATURES, *[f"{c}_std" for c in columns])


def lloyd_step(df: DataFrame, columns: list[str], centroids: dict[int, tuple[float, ...]]) -> DataFrame:
    """``cluster, n, <columns>``: means of the rows nearest to each centroid; one partial aggregate."""
    nearest = df.select(nearest_centroid(columns, centroids).alias(CLUSTER), *columns).filter(F.col(CLUSTER).isNotNull())
    return nearest.groupBy(CLUSTER).agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in columns])


def nearest_centroid(columns: list[str], centroids: dict[int, tuple[float, ...]]) -> Column:
    """Code of the closest centroid, lower code on ties; null if a coordinate is null."""
    def distance(center):
        return sum(((F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(columns, center)),
                   F.lit(0.0))

    candidates = [F.struct(distance(center).alias("distance"), F.lit(code).alias("code"))
                  for code, center in sorted(centroids.items())]
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return F.when(complete, F.array_min(F.array(*candidates))["code"])


def hierarchical_segments(df: DataFrame, numeric: list[str], categorical: list[str], clusters: int = 4,
                          seed: int = 1) -> DataFrame:
    """Divisive hierarchy cut at ``clusters``, on scaled numbers and one-hot categories."""
    complete = df.dropna(subset=[*numeric, *categorical])
    scaled = scaling_stages(fit_moments(complete, numeric))[0]
    index = StringIndexer(inputCols=categorical, outputCols=[f"{c}_index" for c in categorical],
                          stringOrderType="alphabetAsc")
    one_hot = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"{c}_onehot" for c in categorical],
                            dropLast=False)
    assembler = VectorAssembler(inputCols=[f"{c}_std" for c in numeric] + one_hot.getOutputCols(),
                                outputCol=FEATURES)
    vectors = scaled.transform(complete)
    for stage in (index, one_hot):
        vectors = stage.fit(vectors).transform(vectors)
    vectors = assembler.transform(vectors).persist()
    try:
        model = BisectingKMeans(k=clusters, seed=seed, featuresCol=FEATURES, predictionCol=CLUSTER).fit(vectors)
    finally:
        vectors.unpersist()
    helpers = [f"{c}_std" for c in numeric] + index.getOutputCols() + one_hot.getOutputCols() + [FEATURES]
    return model.transform(vectors).drop(*helpers)
