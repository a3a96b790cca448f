"""Multi-class gradient boosting on binned features, and what it says about the columns.

A round grows one tree for each class on the gradients of the softmax loss. Features are cut into bins at quantiles once; a level of all
trees of a round is one pass: tasks add up gradients and curvatures by class, node, feature and bin, Spark adds the
tasks' sums and picks the best cut of each node, and the driver receives one row per node. The margins of all rows are
stored once a round, so a pass walks only the trees of its own round and no lineage grows.

A cut sends ``x <= cut`` left. Its gain is half of ``L^2/(HL + penalty) + R^2/(HR + penalty) - G^2/(H + penalty)``; both sides need
the curvature ``least_weight``. Gains that differ by rounding only are equal, then the earlier feature and lower cut count. Rows with a
null or NaN feature go left everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import discard, fresh_path
from .sampling import sample_order

BINS = 64
ROUNDS = 20
DEPTH = 4
RATE = 0.3
PENALTY = 1.0
LEAST_WEIGHT = 1.0


class Tree(NamedTuple):
    """Nodes in heap order: children of ``i`` are ``2 i + 1`` and ``2 i + 2``; feature -1 marks a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n))

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row after ``depth`` steps, or the leaf it has reached before."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(depth):
            inner = np.flatnonzero(self.feature[at] >= 0)
            node = at[inner]
            right = bins[inner, self.feature[node]] > self.cut[node]
            at[inner] = 2 * node + 1 + right
        return at


@dataclass
class Boosted:
    """Trees of each round and class, the cuts of each feature, and the gain of every split by feature."""

    classes: list
    cuts: list[np.ndarray]
    depth: int
    rounds: list[list[Tree]] = field(default_factory=list)
    splits: list[tuple[int, float]] = field(default_factory=list)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bins), len(self.classes)))
        for trees in self.rounds:
            out += _step(trees, bins, self.depth)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Index of the class with the largest margin, the first of equals."""
        return self.margins(binned(x, self.cuts)).argmax(axis=1)


def _step(trees: list[Tree], bins: np.ndarray, depth: int) -> np.ndarray:
    return np.stack([t.value[t.nodes(bins, depth)] for t in trees], axis=1)


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: how many cuts lie below it; 0 for NaN."""
    out = [np.searchsorted(c, np.nan_to_num(column, nan=-np.inf, posinf=np.inf, neginf=-np.inf), "left") for c, column in zip(cuts, x.T)]
    return np.stack(out, axis=1).astype(np.int64)


def gradients(margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the softmax loss for each row and class."""
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    p = e / e.sum(axis=1, keepdims=True)
    g = p.copy()
    g[np.arange(len(label)), label] -= 1
    return g, np.maximum(2 * p * (1 - p), 1e-16)


def quantile_cuts(rows: DataFrame, columns: list[str], bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins - 1`` cuts of each column, distinct quantiles of its values from bounded sketches."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), shares, 10_000).alias(f"q{i}")
                       for i, c in enumerate(columns)]).first()
    return [np.unique(np.array(found[f"q{i}"] or [], np.float64)) for i in range(len(columns))]


def _histograms(state: DataFrame, trees: list[Tree], level: int, features: int, bins: int) -> DataFrame:
    """``class, node, feature, bin, g, h``: sums over the rows that have reached a node of this level."""
    first, width = 2 ** level - 1, 2 ** level

    def run(batches):
        sums = None
        for batch in batches:
            held = batch.column("bins").flatten().to_numpy().reshape(-1, features)
            margins = batch.column("margins").flatten().to_numpy().reshape(len(held), -1)
            g, h = gradients(margins, batch.column("label").to_numpy())
            if sums is None:
                sums = np.zeros((2, len(trees), width, features, bins))
            for c, tree in enumerate(trees):
                node = tree.nodes(held, level) - first
                on = np.flatnonzero(node >= 0)  # others have ended in a leaf above
                for f in range(features):
                    cell = node[on] * bins + held[on, f]
                    for part, weight in zip(sums, (g[on, c], h[on, c])):
                        part[c, :, f] += np.bincount(cell, weight, width * bins).reshape(width, bins)
        if sums is not None:
            c, node, f, b = np.nonzero(sums[1])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(node + first, pa.int32()), pa.array(f, pa.int32()), pa.array(b, pa.int32()),
                                              pa.array(sums[0, c, node, f, b]), pa.array(sums[1, c, node, f, b])],
                                             names=["class", "node", "feature", "bin", "g", "h"])

    parts = state.mapInArrow(run, "class int, node int, feature int, bin int, g double, h double")
    return parts.groupBy("class", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def _best_cuts(histograms: DataFrame, penalty: float, least_weight: float) -> DataFrame:
    """One row per class and node: its sums, and its best cut if one gains anything."""
    upto = Window.partitionBy("class", "node", "feature").orderBy("bin")
    every = Window.partitionBy("class", "node", "feature")

    def score(g, h):
        return g * g / (h + F.lit(penalty))

    left_g, left_h = F.sum("g").over(upto), F.sum("h").over(upto)
    cut = histograms.select("class", "node", "feature", "bin", left_g.alias("lg"), left_h.alias("lh"),
                            F.sum("g").over(every).alias("g"), F.sum("h").over(every).alias("h"))
    gain = 0.5 * (score(F.col("lg"), F.col("lh")) + score(F.col("g") - F.col("lg"), F.col("h") - F.col("lh")) - score(F.col("g"), F.col("h")))
    possible = (F.col("lh") >= least_weight) & (F.col("h") - F.col("lh") >= least_weight)
    judged = cut.withColumn("gain", F.when(possible, F.round(gain, 9)))
    order = F.struct(F.col("gain").alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"))
    return judged.groupBy("class", "node").agg(
        F.max_by("g", F.struct(-F.col("feature"), "bin")).alias("g"), F.max_by("h", F.struct(-F.col("feature"), "bin")).alias("h"),
        F.max(F.when(F.col("gain") > 1e-6, order)).alias("best"))


def fit(rows: DataFrame, columns: list[str], label: str, cuts: list[np.ndarray] | None = None, rounds: int = ROUNDS,
        depth: int = DEPTH, rate: float = RATE, penalty: float = PENALTY, least_weight: float = LEAST_WEIGHT) -> Boosted:
    """Trees for the classes found in ``label``; rows without a label are left out. No more trees are grown once none splits."""
    spark = rows.sparkSession
    rows = rows.where(F.col(label).isNotNull())
    cuts = quantile_cuts(rows, columns) if cuts is None else cuts
    classes = [r[0] for r in rows.select(label).distinct().orderBy(label).collect()]  # one row per class
    model = Boosted(classes, cuts, depth)
    if not classes:
        return model
    width, code = max(map(len, cuts)) + 1, {c: i for i, c in enumerate(classes)}
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns])

    def first(batches):
        for batch in batches:
            held = binned(batch.column("x").flatten().to_numpy().reshape(-1, len(columns)), cuts).astype(np.int32)
            yield _state(held, np.array([code[v] for v in batch.column("label").to_pylist()]), np.zeros((len(held), len(classes))))

    def after(trees):
        def run(batches):
            for batch in batches:
                held = batch.column("bins").flatten().to_numpy().reshape(-1, len(columns))
                margins = batch.column("margins").flatten().to_numpy().reshape(len(held), -1)
                yield _state(held, batch.column("label").to_numpy(), margins + _step(trees, held, depth))
        return run

    schema, state, old = "label int, bins array<int>, margins array<double>", None, None
    for turn in range(rounds):
        path = fresh_path(spark, "boosting-margins")
        source = rows.select(F.col(label).alias("label"), x.alias("x")).mapInArrow(first, schema) if state is None else state.mapInArrow(
            after(model.rounds[-1]), schema)
        source.write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
        if old:
            discard(spark, old)
        old, trees, grown = path, [Tree.empty(depth) for _ in classes], False
        for level in range(depth + 1):
            open_nodes = _best_cuts(_histograms(state, trees, level, len(columns), width), penalty, least_weight).collect()
            split = False
            for r in sorted(open_nodes, key=lambda r: (r["class"], r["node"])):  # one row per class and node
                tree, best = trees[r["class"]], r["best"]
                if best is None or level == depth:
                    tree.value[r["node"]] = -rate * r["g"] / (r["h"] + penalty)
                else:
                    tree.feature[r["node"]], tree.cut[r["node"]] = -best["feature"], -best["bin"]
                    model.splits.append((-best["feature"], best["gain"]))
                    split = True
            grown |= split
            if not split:
                break
        model.rounds.append(trees)
        if not grown:
            break
    discard(spark, old)
    return model


def _state(bins: np.ndarray, label: np.ndarray, margins: np.ndarray) -> pa.RecordBatch:
    def lists(values, kind):
        return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32()), pa.array(values.reshape(-1), kind))

    return pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), lists(bins, pa.int32()), lists(margins, pa.float64())],
                                      names=["label", "bins", "margins"])


def accuracy(rows: DataFrame, columns: list[str], label: str, model: Boosted) -> float | None:
    """Share of rows whose label the model names."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns])

    def run(batches):
        for batch in batches:
            named = model.predict(batch.column("x").flatten().to_numpy().reshape(-1, len(columns))) if batch.num_rows else []
            right = [model.classes[i] == v for i, v in zip(named, batch.column("label").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(right, pa.bool_())], names=["correct"])

    if not model.classes:
        return None
    found = rows.select(F.col(label).alias("label"), x.alias("x")).mapInArrow(run, "correct boolean")
    return found.agg(F.avg(F.col("correct").cast("double"))).first()[0]


def boosted_importance(df: DataFrame, columns: list[str], key: str, label: str = "cluster", seed: int = 1,
                       test_share: float = 0.25, **options) -> DataFrame:
    """``feature, splits, gain, accuracy``: how often and how much each column was used, and the share of right labels on held-out rows.

    The split follows a hash of the key, so it does not change with the partitioning.
    """
    draw = F.conv(F.substring(sample_order(key, seed), 1, 8), 16, 10).cast("double") / 0xFFFFFFFF
    held_out = draw < test_share
    model = fit(df.where(~held_out), columns, label, **options)
    right = accuracy(df.where(held_out & F.col(label).isNotNull()), columns, label, model)
    rows = []
    for i, c in enumerate(columns):
        gains = [gain for f, gain in model.splits if f == i]
        rows.append((c, len(gains), float(sum(gains)), right))
    return df.sparkSession.createDataFrame(rows, "feature string, splits long, gain double, accuracy double")
