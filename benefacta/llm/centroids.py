"""Exact k-means on integer vectors with heap-ordered bounds.

Vectors are stored in blocks, one row each. Beside its vectors a block holds, for every cluster, a heap of the
cluster's vectors by their gap: a lower bound of the distance to any other centroid minus an upper bound of the distance to
the own one. When centroids move, a gap shrinks by no more than the own centroid's drift plus the largest drift of the
others; this sum is accumulated per cluster and a gap is stored with what had accumulated when it entered, so a round
changes no entry. Only entries whose gap has expired are popped, their vectors compared with all centroids in integers,
and pushed again. A round reads and writes the blocks once, without a shuffle; what moved between clusters is
summed per block, and ``k`` centroids pass through the driver.

Components are ``floor(scale * x)``, compared exactly; ties go to the smaller number. Gaps are rounded down, so an entry that
might tie is popped. Vectors that are null, have another number of components, or a null or non-finite one are left out. A
component beyond 2^27 in size counts as 2^27, so that a squared distance fits a long. Starts are the vectors with the
least hashes of seed and id, equal ids by their components; with fewer than ``k`` vectors each is a start. An empty table
gives an empty result, a null id is hashed as an empty one, and repeated rows are vectors of their own. Other columns of the
input are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, fresh_path, materialise

K = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = 2
BLOCK = 4096
LARGEST = 1 << 27
_SLACK = 1e-9
_AT_ONCE = 1024
_FAR = 2.0 ** 40


def whole_vectors(df: DataFrame, identity: str, vector: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``id`` and integer components ``x`` of the vectors that are complete and finite."""
    def usable(v):
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))

    def whole(v):
        return F.floor(F.greatest(F.least(v * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")

    values = df.select(F.col(identity).alias("id"), F.transform(vector, lambda v: v.cast("double")).alias("v"))
    kept = values.where(F.col("v").isNotNull() & (F.size("v") == dimensions) & F.forall("v", usable))
    return kept.select("id", F.transform("v", whole).alias("x"))


def starts(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The first ``k`` vectors by hash of seed and id."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [r["x"] for r in vectors.orderBy(named, "x").limit(k).select("x").collect()]


class Block:
    """Vectors of one block, their clusters, and a heap of (gap, vector) for each cluster."""

    def __init__(self, x: np.ndarray, owner: np.ndarray, heaps: list[list[tuple[float, int]]]):
        self.x, self.owner, self.heaps = x, owner, heaps

    @classmethod
    def fresh(cls, x: np.ndarray, k: int) -> Block:
        """Nothing is known yet: all gaps have expired."""
        return cls(x, np.full(len(x), -1, np.int32), [[(-np.inf, i) for i in range(len(x))], *([] for _ in range(k - 1))])

    def advance(self, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, int]:
        """Reassign the vectors whose gap has expired; sums and counts that entered each cluster, less those that left it, and
        how many vectors were compared."""
        k = len(centroids)
        expired = []
        for heap, gone in zip(self.heaps, (drift * (1 + _SLACK) + _SLACK).tolist()):
            while heap and heap[0][0] <= gone:
                expired.append(heapq.heappop(heap)[1])
        moved = np.zeros((k, self.x.shape[1] + 1), np.int64)
        for low in range(0, len(expired), _AT_ONCE):
            at = np.array(expired[low:low + _AT_ONCE])
            x = self.x[at].astype(np.int64)
            squared = squared_distances(x, centroids)
            nearest = squared.argmin(axis=1)
            upper = np.sqrt(squared[np.arange(len(at)), nearest].astype(np.float64))
            squared[np.arange(len(at)), nearest] = np.iinfo(np.int64).max
            lower = np.sqrt(squared.min(axis=1).astype(np.float64)) if k > 1 else np.full(len(at), _FAR)
            gap = lower - upper - _SLACK * (1 + lower + upper)
            for i, cluster, key in zip(at.tolist(), nearest.tolist(), (gap + drift[nearest]).tolist()):
                heapq.heappush(self.heaps[cluster], (key, i))
            before, change = self.owner[at], self.owner[at] != nearest
            counted = np.column_stack([x, np.ones(len(at), np.int64)])
            np.add.at(moved, nearest[change], counted[change])
            left = change & (before >= 0)
            np.subtract.at(moved, before[left], counted[left])
            self.owner[at] = nearest
        return moved, len(expired)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids (long integers)."""
    return np.square(x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + np.square(centroids).sum(axis=1)


def _lists(parts: list, kind: pa.DataType) -> pa.Array:
    flat = np.concatenate([np.asarray(p) for p in parts]) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat, kind))


_STATE = "x binary, owner array<int>, gap array<double>, entry array<int>, first array<int>, moved array<long>, compared long"


def _stored(ids: list, states: list[tuple[Block, np.ndarray, int]], kind: pa.DataType) -> pa.RecordBatch:
    heaps = [b.heaps for b, *_ in states]
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.list_(kind)), pa.array([b.x.tobytes() for b, *_ in states], pa.binary()),
        _lists([b.owner for b, *_ in states], pa.int32()),
        _lists([[g for heap in h for g, _ in heap] for h in heaps], pa.float64()),
        _lists([[i for heap in h for _, i in heap] for h in heaps], pa.int32()),
        _lists([np.cumsum([0, *map(len, h)]) for h in heaps], pa.int32()),
        _lists([m.reshape(-1) for _, m, _ in states], pa.int64()), pa.array([c for *_, c in states], pa.int64()),
    ], names=["ids", "x", "owner", "gap", "entry", "first", "moved", "compared"])


def _read(batch: pa.RecordBatch, i: int, dimensions: int) -> Block:
    row = {c: batch.column(c)[i] for c in ("x", "owner", "gap", "entry", "first")}
    gaps, entries, first = (row[c].values.to_pylist() for c in ("gap", "entry", "first"))
    heaps = [list(zip(gaps[a:b], entries[a:b])) for a, b in zip(first[:-1], first[1:])]
    return Block(np.frombuffer(row["x"].as_py(), np.int32).reshape(-1, dimensions), row["owner"].values.to_numpy().copy(), heaps)


def cluster_vectors(df: DataFrame, identity: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
                    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``identity``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid`` of every vector.

    ``rounds`` times all vectors are assigned and the centroids moved to the floor of their means; then they are assigned
    once more. An inertia beyond a long is null.
    """
    spark = df.sparkSession
    vectors = whole_vectors(df, identity, vector, dimensions, scale)
    centroids = np.array(starts(vectors, k, seed), np.int64).reshape(-1, dimensions)
    k = len(centroids)
    out = T.StructType([T.StructField(identity, vectors.schema["id"].dataType), T.StructField("cluster", T.IntegerType()),
                        T.StructField("distance", T.LongType()), T.StructField("cluster_inertia", T.LongType()),
                        T.StructField("inertia", T.LongType()), T.StructField("centroid", T.ArrayType(T.LongType()))])
    if not k:
        return spark.createDataFrame([], out)
    id_ddl = vectors.schema["id"].dataType.simpleString()

    def first_blocks(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, block):
                part = batch.slice(low, block)
                x = part.column(1).flatten().to_numpy().reshape(-1, dimensions)
                none = np.zeros((k, dimensions + 1), np.int64)
                yield _stored([part.column(0).to_pylist()], [(Block.fresh(x, k), none, 0)], part.schema.field(0).type)

    def pass_over(state: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    held = _read(batch, i, dimensions)
                    yield _stored([batch.column("ids")[i].as_py()], [(held, *held.advance(centroids, drift))],
                                  batch.schema.field("ids").type.value_type)

        return state.mapInArrow(run, state.schema)

    sums, drift = [[0] * (dimensions + 1) for _ in range(k)], np.zeros(k)
    state, old = vectors.mapInArrow(first_blocks, f"ids array<{id_ddl}>, {_STATE}"), None
    for turn in range(rounds + 1):
        path = fresh_path(spark, "centroid-blocks")
        pass_over(state, centroids, drift).write.parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        if old:
            discard(spark, old)  # the new blocks hold all of it
        old = path
        if turn == rounds:
            break
        for r in (state.select(F.posexplode("moved").alias("place", "change")).groupBy("place")
                  .agg(F.sum(F.col("change").cast("decimal(20,0)")).alias("change")).collect()):  # k rows of components
            sums[r["place"] // (dimensions + 1)][r["place"] % (dimensions + 1)] += int(r["change"])
        new = np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old_row for row, old_row in zip(sums, centroids.tolist())], np.int64)
        step = np.sqrt(np.square(new - centroids).sum(axis=1).astype(np.float64)) * (1 + _SLACK)
        if not step.any():
            break  # nothing will change any more
        others = [max([*step[:c], *step[c + 1:]], default=0.0) for c in range(k)]
        drift, centroids = drift + step + others, new

    def results(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("x")[i].as_py(), np.int32).reshape(-1, dimensions).astype(np.int64)
                owner = batch.column("owner")[i].values.to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(owner, pa.int32()),
                                                  pa.array(np.square(x - centroids[owner]).sum(axis=1))],
                                                 names=[identity, "cluster", "distance"])

    found = materialise(state.select("ids", "x", "owner").mapInArrow(results, T.StructType(out.fields[:3])), "nearest-centroids")
    discard(spark, old)
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}

    def long(value):
        return value if value < 1 << 63 else None

    facts = [(c, long(s), long(sum(inertia.values())), centroids[c].tolist()) for c, s in inertia.items()]  # k rows at most
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(table), "cluster").select(*out.names)


def centroid_digest(centroid):
    """SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ",").cast("binary"), 256)
