"""The exact nearest records of every row by Gower distance, without comparing all pairs.

Equal records are one point with its lowest keys. A tree of cuts, grown on a bounded sample, deals all points to cells; each cell is
cut on, until its blocks hold a bounded number of points, and every block keeps its box: the range of each number, and of the
codes of each category. A cell searches its own blocks, which gives every point a bound for its ``k``-th neighbour. Then a point
is sent to those blocks whose boxes lie within its bound, and a block returns only what is no farther than that. So a row meets a few blocks around
it, however many rows there are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import materialise
from .mixed import column_ranges
from .sampling import seeded_sample

CELLS = 256
SAMPLE = 16384  # points that the cells' tree is grown on
BLOCK = 512
DIGITS = 9
SLACK = 1e-8  # distances are compared after rounding
CELL = ["pivot", "ring", "spot"]
OTHER = ["to_pivot", "to_ring", "to_spot"]


class _Space:
    """Ranges of the numbers; distances between points, which are the numbers followed by the codes of the categories."""

    def __init__(self, spans: np.ndarray, columns: int):
        self.spans, self.live = np.where(spans > 0, spans, 1.0), (spans > 0).astype(float)
        self.numbers, self.parts = len(spans), max(len(spans) + columns, 1)

    def distances(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gower distances, rounded so that equal ones are equal."""
        total = np.zeros((len(x), len(y)))
        for j in range(self.numbers):
            total += np.abs(x[:, j, None] - y[None, :, j]) / self.spans[j] * self.live[j]
        for j in range(self.numbers, x.shape[1]):
            total += x[:, j, None] != y[None, :, j]
        return np.round(total / self.parts, DIGITS)

    def gaps(self, low: np.ndarray, high: np.ndarray, its_low: np.ndarray, its_high: np.ndarray) -> np.ndarray:
        """Least distances between boxes; a point is a box, too."""
        apart = np.maximum(np.maximum(its_low - high, low - its_high), 0.0)
        n = self.numbers
        return ((apart[..., :n] / self.spans * self.live).sum(axis=-1) + (apart[..., n:] > 0).sum(axis=-1)) / self.parts

    def widths(self, x: np.ndarray) -> np.ndarray:
        spread = np.ptp(x, axis=0)
        return np.concatenate([spread[:self.numbers] / self.spans * self.live, spread[self.numbers:] > 0])


class _Tree:
    """Cuts of the widest column at its median, until a leaf holds ``size`` points or equal ones only."""

    def __init__(self, x: np.ndarray, space: _Space, size: int):
        self.column, self.cut, self.left, self.right = [0], [0.0], [0], [0]  # a node without children is a leaf
        open_nodes = [(0, np.arange(len(x)))]
        while open_nodes:
            node, at = open_nodes.pop()
            widths = space.widths(x[at]) if len(at) > size else np.zeros(1)
            j = len(widths) - 1 - int(widths[::-1].argmax())  # of equal widths a category
            if widths[j] <= 0:
                continue
            values = x[at, j]
            cut = np.partition(values, (len(at) - 1) // 2)[(len(at) - 1) // 2]
            if cut == values.max():
                cut = values[values < cut].max()
            low = values <= cut
            self.column[node], self.cut[node] = j, cut
            self.left[node], self.right[node] = len(self.cut), len(self.cut) + 1
            for part in (low, ~low):
                open_nodes.append((len(self.cut), at[part]))
                for values, first in ((self.column, 0), (self.cut, 0.0), (self.left, 0), (self.right, 0)):
                    values.append(first)
        self.column, self.left, self.right, self.cut = (np.array(v) for v in (self.column, self.left, self.right, self.cut))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node where each point ends."""
        at = np.zeros(len(x), np.int64)
        inner = np.flatnonzero(self.left[at] > 0)
        while len(inner):
            node = at[inner]
            at[inner] = np.where(x[inner, self.column[node]] <= self.cut[node], self.left[node], self.right[node])
            inner = inner[self.left[at[inner]] > 0]
        return at


def _points(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def _unpacked(value: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(value.as_py(), np.float64).reshape(-1, width)


def _nearest(far: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the ``k`` least of each row, of equal ones the first; ``far`` is used up."""
    every, k = np.arange(len(far)), min(k, far.shape[1])
    places, found = np.empty((len(far), k), np.int64), np.empty((len(far), k))
    for i in range(k):
        places[:, i] = far.argmin(axis=1)
        found[:, i] = far[every, places[:, i]]
        far[every, places[:, i]] = np.inf
    return places, found


def _codes(df: DataFrame, categorical: list[str]) -> list:
    """A number for each category, exact as a double; another seed if two categories of a column share one."""
    out = []
    for c in categorical:
        seed = 0
        while True:
            code = F.xxhash64(F.lit(seed), F.col(c).cast("string")).bitwiseAND(F.lit(2**52 - 1)).cast("double")
            named, coded = df.agg(F.count_distinct(F.struct(F.col(c).cast("string"))), F.count_distinct(code)).first()
            if named == coded:
                break
            seed += 1
        out.append(code)
    return out


def block_pairs(facts: DataFrame, rings: int) -> DataFrame:
    """Blocks and the blocks where their rows' neighbours may lie, from reach and distances to pivots.

    For blocks filed by pivot and ring; ``gower_neighbours`` compares boxes, which bound distances more closely.
    """
    first = F.greatest(F.floor((F.col("span.l") - F.col("reach")) * rings - 1e-6), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("span.h") + F.col("reach")) * rings + 1e-6), F.lit(rings - 1)).cast("int")
    spans = F.transform(F.arrays_zip("low", "high"), lambda z: F.struct(z["low"].alias("l"), z["high"].alias("h")))
    wanted = (facts.select(*CELL, "reach", "low", "high", F.posexplode(spans).alias("to_pivot", "span"))
              .select(*CELL, "reach", "low", "high", "to_pivot", F.explode(F.sequence(first, F.greatest(first, last))).alias("to_ring")))
    its = facts.select(*[F.col(c).alias(o) for c, o in zip(CELL, OTHER)], F.col("low").alias("its_low"), F.col("high").alias("its_high"))
    apart = F.array_max(F.transform(F.arrays_zip("low", "high", "its_low", "its_high"),
                                    lambda z: F.greatest(z["low"] - z["its_high"], z["its_low"] - z["high"])))
    return wanted.join(its, ["to_pivot", "to_ring"]).where(apart <= F.col("reach") + 1e-8).select(*CELL, *OTHER)


def box_pairs(facts: DataFrame, space: _Space) -> DataFrame:
    """Blocks and the blocks whose boxes lie within their reach, those of near cells only; ``facts`` has a block's cell, spot, reach, low and high."""
    n, spans = space.numbers, F.array(*[F.lit(float(s)) for s in space.spans]).cast("array<double>")
    live = F.array(*[F.lit(float(v)) for v in space.live]).cast("array<double>")

    def gap(low, high, its_low, its_high):
        apart = F.zip_with(F.zip_with(its_low, high, lambda a, b: a - b), F.zip_with(low, its_high, lambda a, b: a - b),
                           lambda a, b: F.greatest(a, b, F.lit(0.0)))
        shares = F.zip_with(F.slice(apart, 1, n), F.zip_with(live, spans, lambda a, b: a / b), lambda a, b: a * b) if n else F.array().cast("array<double>")
        differ = F.size(F.filter(F.slice(apart, n + 1, space.parts), lambda v: v > 0))
        return (F.aggregate(shares, F.lit(0.0), lambda a, b: a + b) + differ) / space.parts

    width = len(facts.select("low").first()["low"])
    ends = [F.array(*[of(F.col(c)[j]) for j in range(width)]).cast("array<double>").alias(c) for c, of in (("low", F.min), ("high", F.max))]
    cells = facts.groupBy("cell").agg(F.max("reach").alias("reach"), *ends)
    its = cells.select(F.col("cell").alias("to_cell"), F.col("low").alias("its_low"), F.col("high").alias("its_high"))
    within = gap(F.col("low"), F.col("high"), F.col("its_low"), F.col("its_high")) <= F.col("reach") + SLACK
    near = cells.crossJoin(its).where(within).select("cell", "to_cell")  # a bounded number of cells
    its = facts.select(F.col("cell").alias("to_cell"), F.col("spot").alias("to_spot"), F.col("low").alias("its_low"), F.col("high").alias("its_high"))
    return facts.join(near, "cell").join(its, "to_cell").where(within).select("cell", "spot", "to_cell", "to_spot", "its_low", "its_high")


def gower_neighbours(df: DataFrame, key: str, numeric: list[str], categorical: list[str], k: int = 5, pivots: int | None = None,
                     rings: int | None = None, block: int = BLOCK, seed: int = 1) -> DataFrame:
    """``key, neighbour, distance, place``: the ``k`` other rows nearest to each row, by distance and then by key.

    Ranges are those of the whole table. Rows with a missing number are left out; a missing category equals another
    missing one. Repeated rows are neighbours of each other at distance 0. With fewer than ``k`` other rows all are listed.
    ``pivots`` and ``rings`` have no effect any more.
    """
    d, width, spark = len(numeric), len(numeric) + len(categorical), df.sparkSession
    kept = materialise(df.select(F.col(key).alias("id"), *[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(numeric)],
                                 *[F.col(c).alias(f"w{j}") for j, c in enumerate(categorical)])
                       .where(F.forall(F.array(*[F.col(c).cast("double") for c in numeric]).cast("array<double>"), lambda v: v.isNotNull() & ~F.isnan(v))),
                       "neighbour-rows")
    ranges = column_ranges(kept, [f"x{j}" for j in range(d)]) if d else {}
    space = _Space(np.array([ranges[f"x{j}"] or 0.0 for j in range(d)]), len(categorical))
    kind = df.schema[key].dataType
    out = T.StructType([T.StructField(key, kind), T.StructField("neighbour", kind), T.StructField("distance", T.DoubleType()),
                        T.StructField("place", T.IntegerType())])
    codes = _codes(kept, [f"w{j}" for j in range(len(categorical))])
    rows = kept.select("id", F.array(*[F.col(f"x{j}") + 0.0 for j in range(d)], *codes).cast("array<double>").alias("z"))
    lowest = rows.withColumn("turn", F.row_number().over(Window.partitionBy("z").orderBy("id"))).where(F.col("turn") <= k + 1)
    points = materialise(lowest.groupBy("z").agg(F.collect_list(F.struct("id")).alias("ids")), "neighbour-points")
    chosen = seeded_sample(points.select("z"), "z", SAMPLE, seed).collect()  # a bounded number of points
    if not chosen:
        return spark.createDataFrame([], out)
    sample = np.array([r["z"] for r in chosen], np.float64).reshape(len(chosen), width)
    shipped = spark.sparkContext.broadcast(_Tree(sample, space, -(-len(sample) // CELLS)))

    def locate(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shipped.value.leaves(_points(batch.column(0), width)), pa.int32())],
                                             names=["z", "ids", "cell"])

    id_ddl = kind.simpleString()
    located = points.mapInArrow(locate, f"z array<double>, ids array<struct<id: {id_ddl}>>, cell int")

    def build(table: pa.Table) -> pa.Table:
        z, ids = _points(table.column("z").combine_chunks(), width), table.column("ids").combine_chunks()
        counts = ids.value_lengths().to_numpy()
        leaves = _Tree(z, space, block).leaves(z)
        order = np.argsort(leaves, kind="stable")
        members = np.split(order, np.flatnonzero(np.diff(leaves[order])) + 1)
        low, high = (np.array([of(z[m], axis=0) for m in members]) for of in (np.min, np.max))
        bounds = []
        for at, m in enumerate(members):
            x, near = z[m], np.full((len(m), k + 1), np.inf)
            gaps = space.gaps(low[at], high[at], low, high)
            for other in [at, *(o for o in np.argsort(gaps, kind="stable") if o != at)]:
                on = np.flatnonzero(space.gaps(x, x, low[other], high[other]) <= near[:, -1] + SLACK) if gaps[other] <= near[:, -1].max() + SLACK else []
                if len(on):
                    far = space.distances(x[on], np.repeat(z[members[other]], counts[members[other]], axis=0))
                    merged = np.concatenate([near[on], _nearest(far, k + 1)[1]], axis=1)
                    near[on] = np.sort(merged, axis=1)[:, :k + 1]
            bounds.append(near[:, -1])
        return pa.table({"cell": pa.array(np.full(len(members), table.column("cell")[0].as_py()), pa.int32()),
                         "spot": pa.array(np.arange(len(members)), pa.int32()), "z": pa.array([z[m].tobytes() for m in members], pa.binary()),
                         "counts": pa.array([counts[m].astype(np.int64).tobytes() for m in members], pa.binary()),
                         "ids": pa.array([ids.take(pa.array(m)).flatten().field(0).to_pylist() for m in members], pa.list_(ids.type.value_type.field(0).type)),
                         "bounds": pa.array([b.tobytes() for b in bounds], pa.binary()), "reach": pa.array([min(float(b.max()), 1.0) for b in bounds]),
                         "low": pa.array(list(low), pa.list_(pa.float64())), "high": pa.array(list(high), pa.list_(pa.float64()))})

    blocks = materialise(located.groupBy("cell").applyInArrow(
        build, f"cell int, spot int, z binary, counts binary, ids array<{id_ddl}>, bounds binary, reach double, low array<double>, high array<double>"), "neighbour-blocks")
    ways = box_pairs(blocks.select("cell", "spot", "reach", "low", "high"), space)
    routes = ways.groupBy("cell", "spot").agg(F.collect_list(F.struct("to_cell", "to_spot", "its_low", "its_high")).alias("ways"))

    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x, bounds = _unpacked(batch.column(0)[i], width), np.frombuffer(batch.column(1)[i].as_py(), np.float64)
                for way in batch.column(2)[i].as_py():
                    on = space.gaps(x, x, np.array(way["its_low"]), np.array(way["its_high"])) <= bounds + SLACK
                    if on.any():
                        yield pa.RecordBatch.from_arrays([pa.array([way["to_cell"]], pa.int32()), pa.array([way["to_spot"]], pa.int32()),
                                                          pa.array([x[on].tobytes()], pa.binary()), pa.array([bounds[on].tobytes()], pa.binary())],
                                                         names=["cell", "spot", "x", "bounds"])

    sent = blocks.join(routes, ["cell", "spot"]).select("z", "bounds", "ways").mapInArrow(send, "cell int, spot int, x binary, bounds binary")
    tiles = sent.join(blocks.select("cell", "spot", "z", "counts", "ids"), ["cell", "spot"]).select("x", "bounds", "z", "counts", "ids")

    def tile(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x, z = _unpacked(batch.column(0)[i], width), _unpacked(batch.column(2)[i], width)
                bounds, counts = np.frombuffer(batch.column(1)[i].as_py(), np.float64), np.frombuffer(batch.column(3)[i].as_py(), np.int64)
                its = batch.column(4)[i].values
                order = np.argsort(pd.Series(its.to_pylist()).rank(method="first").to_numpy(), kind="stable")
                places, gap = _nearest(space.distances(x, np.repeat(z, counts, axis=0)[order]), k + 1)  # of equal distances the lower key
                on, place = np.nonzero(gap <= bounds[:, None] + SLACK)
                yield pa.RecordBatch.from_arrays([pa.array(list(x[on]), pa.list_(pa.float64())), pa.array(gap[on, place]), its.take(pa.array(order[places[on, place]]))],
                                                 names=["z", "distance", "neighbour"])

    found = tiles.mapInArrow(tile, f"z array<double>, distance double, neighbour {id_ddl}")
    # a point's list holds its own rows, too: a row leaves itself out, or else the last one
    nearest = found.groupBy("z").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "neighbour"))), 1, k + 1).alias("n"))
    own = F.array_position(F.transform("n", lambda e: (e["distance"] == 0) & e["neighbour"].eqNullSafe(F.col("id"))), True)
    others = rows.join(nearest, "z").withColumn("own", own - 1)
    others = others.withColumn("n", F.slice(F.filter("n", lambda _e, i: i != F.col("own")), 1, k))
    return others.select(F.col("id").alias(key), F.posexplode("n").alias("place", "n")).select(
        key, "n.neighbour", "n.distance", (F.col("place") + 1).alias("place"))
