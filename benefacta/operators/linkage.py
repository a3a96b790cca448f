"""Average linkage over mixed columns: clustering features built where the rows lie, then a tree of their merges.

A leaf sums up records that lie close together: how many, the sums of their numbers, how often each category occurs. Leaves
are mergeable. Every task keeps at most ``most`` of them: a record joins its nearest leaf within the threshold or opens one, and
when there are too many the threshold grows and the leaves are inserted again. The tasks' leaves are merged a few tasks at a
time by the same rule, until one task's remain; those are linked. With fewer distinct records than ``most`` each is a leaf of its
own, and the tree is the plain average linkage of all rows, equal ones merged at height 0.

The distance of two leaves is Gower's between their means: numbers by their range, categories by the probability that two
members differ. With ``profiles`` the Euclidean distance of their rows in the distance matrix of all records is linked
instead, which is what a linkage computes that is handed a square matrix as observations. A missing category equals another missing one; rows with a missing
number are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialise
from .mixed import column_ranges

MOST = 512
MERGED_AT_ONCE = 8
CLUSTER = "cluster"


@dataclass
class Leaves:
    """Sizes, means of the numbers, and the share of each word of each categorical column, one row per leaf."""

    n: np.ndarray
    means: np.ndarray
    words: list[list[str]]
    shares: list[np.ndarray]

    def distances(self, other: Leaves, spans: np.ndarray) -> np.ndarray:
        """Mean Gower distance of all leaves to all of ``other``."""
        total = np.zeros((len(self.n), len(other.n)))
        for j, span in enumerate(spans):
            if span > 0:
                total += np.abs(self.means[:, j, None] - other.means[None, :, j]) / span
        for own_words, own, its_words, its in zip(self.words, self.shares, other.words, other.shares):
            place = {w: i for i, w in enumerate(its_words)}
            common = [(i, place[w]) for i, w in enumerate(own_words) if w in place]
            total += 1 - own[:, [i for i, _ in common]] @ its[:, [i for _, i in common]].T
        return total / max(len(spans) + len(self.words), 1)

    def merged(self, group: np.ndarray, n: int) -> Leaves:
        """One leaf for each of ``n`` groups."""
        weight = np.zeros((n, len(self.n)))
        weight[group, np.arange(len(self.n))] = self.n
        sizes = weight.sum(axis=1)
        return Leaves(sizes.astype(np.int64), weight @ self.means / sizes[:, None], self.words,
                      [weight @ s / sizes[:, None] for s in self.shares])

    def __add__(self, other: Leaves) -> Leaves:
        words, shares = [], []
        for own_words, own, its_words, its in zip(self.words, self.shares, other.words, other.shares):
            every = list(dict.fromkeys([*own_words, *its_words]))
            place = {w: i for i, w in enumerate(every)}
            both = np.zeros((len(own) + len(its), len(every)))
            both[:len(own), [place[w] for w in own_words]] = own
            both[len(own):, [place[w] for w in its_words]] = its
            words.append(every)
            shares.append(both)
        return Leaves(np.append(self.n, other.n), np.concatenate([self.means, other.means]), words, shares)

    def bounded(self, spans: np.ndarray, most: int) -> Leaves:
        """At most ``most`` leaves: equal ones first, then the closest, under a growing threshold."""
        leaves, threshold = self, 0.0
        while True:
            distance = leaves.distances(leaves, spans)
            np.fill_diagonal(distance, np.inf)
            group, leaders = np.empty(len(leaves.n), np.int64), []
            for i in range(len(leaves.n)):
                near = int(np.argmin(distance[i, leaders])) if leaders else -1
                if near >= 0 and distance[i, leaders[near]] <= threshold + 1e-12:
                    group[i] = near
                else:
                    group[i] = len(leaders)
                    leaders.append(i)
            if len(leaders) < len(leaves.n):
                leaves = leaves.merged(group, len(leaders))
            if len(leaves.n) <= most:
                return leaves
            distance = leaves.distances(leaves, spans)
            np.fill_diagonal(distance, np.inf)
            threshold = max(threshold * 1.25, float(np.median(distance.min(axis=1))))


def _word(value) -> str:
    """Categories as map keys: a missing one is the empty key."""
    return "" if value is None or value != value else f"={value}"


def _of_records(batch: pd.DataFrame, numeric: list[str], categorical: list[str]) -> Leaves:
    """The distinct records of a batch."""
    frame = pd.DataFrame({c: batch[c].astype("float64") for c in numeric} | {c: batch[c].map(_word) for c in categorical})
    found = frame.groupby(list(frame.columns), sort=False).size().reset_index(name="_n") if len(frame.columns) else pd.DataFrame({"_n": [len(frame)]})
    words, shares = [], []
    for c in categorical:
        codes, names = pd.factorize(found[c])
        words.append(list(names))
        shares.append(np.eye(len(names))[codes])
    return Leaves(found["_n"].to_numpy(), found[numeric].to_numpy("float64").reshape(len(found), len(numeric)), words, shares)


_SCHEMA = "n long, means array<double>, shares array<map<string, double>>"


def _rows(leaves: Leaves) -> pd.DataFrame:
    shares = [[{w: float(v) for w, v in zip(words, s[i]) if v} for words, s in zip(leaves.words, leaves.shares)] for i in range(len(leaves.n))]
    return pd.DataFrame({"n": leaves.n, "means": list(leaves.means), "shares": shares})


def _of_rows(rows, columns: int) -> Leaves:
    words, shares = [], []
    for j in range(columns):
        held = [dict(r) for r in (row[j] for row in rows["shares"])]
        names = list(dict.fromkeys(w for h in held for w in h))
        words.append(names)
        shares.append(np.array([[h.get(w, 0.0) for w in names] for h in held]).reshape(len(held), len(names)))
    return Leaves(rows["n"].to_numpy(np.int64), np.array(rows["means"].to_list(), np.float64).reshape(len(rows), -1), words, shares)


def leaves_of(rows: DataFrame, numeric: list[str], categorical: list[str], spans: np.ndarray, most: int = MOST,
              at_once: int = MERGED_AT_ONCE) -> Leaves | None:
    """At most ``most`` leaves of all rows, or None without rows. A task holds ``at_once`` times as many."""
    def build(batches):
        held = None
        for batch in batches:
            for low in range(0, len(batch), most):
                part = _of_records(batch.iloc[low:low + most], numeric, categorical)
                held = (part if held is None else held + part).bounded(spans, most)
        if held is not None:
            yield _rows(held)

    def merge(batches):
        held = None
        for batch in batches:
            for low in range(0, len(batch), most):
                part = _of_rows(batch.iloc[low:low + most], len(categorical))
                held = (part if held is None else held + part).bounded(spans, most)
        if held is not None:
            yield _rows(held)

    parts = materialise(rows.select(*numeric, *categorical).mapInPandas(build, _SCHEMA), "leaves")
    left = parts.count()
    while left > most:
        parts = materialise(parts.repartition(max(1, -(-left // (most * at_once)))).mapInPandas(merge, _SCHEMA), "leaves")
        left = parts.count()
    found = parts.toPandas()  # at most ``most`` rows
    if not len(found):
        return None
    order = sorted(range(len(found)), key=lambda i: (list(found["means"][i]), sorted(map(sorted, (dict(s).items() for s in found["shares"][i])))))
    return _of_rows(found.iloc[order].reset_index(drop=True), len(categorical)).bounded(spans, most)


def average_linkage(distance: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, float, int]]:
    """Merges ``(left, right, height, size)`` in order; node ``len(sizes) + i`` is what merge ``i`` made.

    The distance of two clusters is the mean over all pairs of members; of equal distances the lower nodes merge first.
    """
    m, merges = len(sizes), []
    held = distance.astype(np.float64).copy()
    np.fill_diagonal(held, np.inf)
    node, n = np.arange(m), sizes.astype(np.float64).copy()
    for step in range(m - 1):
        i, j = sorted(divmod(int(np.argmin(held)), m))
        height = float(held[i, j])
        merges.append((*sorted((int(node[i]), int(node[j]))), height, int(n[i] + n[j])))
        held[i] = (n[i] * held[i] + n[j] * held[j]) / (n[i] + n[j])
        held[:, i] = held[i]
        held[i, i] = np.inf
        held[j], held[:, j] = np.inf, np.inf
        node[i], n[i] = m + step, n[i] + n[j]
    return merges


def cut(merges: list[tuple[int, int, float, int]], leaves: int, clusters: int) -> np.ndarray:
    """Cluster of each leaf, numbered from 1 by the least leaf, when the last merges are undone."""
    parent = list(range(leaves + len(merges)))
    for step, (left, right, *_) in enumerate(merges[:max(leaves - clusters, 0)]):
        parent[left] = parent[right] = leaves + step
    roots = []
    for i in range(leaves):
        while parent[i] != i:
            i = parent[i]
        roots.append(i)
    code = {root: number + 1 for number, root in enumerate(dict.fromkeys(roots))}
    return np.array([code[r] for r in roots])


@dataclass
class Hierarchy:
    """The leaves, the merges of their tree, and the ranges of the numbers."""

    leaves: Leaves | None
    merges: list[tuple[int, int, float, int]]
    spans: np.ndarray
    numeric: list[str]
    categorical: list[str]

    def tree(self, spark) -> DataFrame:
        """``step, left, right, height, size``: the data behind a dendrogram."""
        return spark.createDataFrame([(i, *m) for i, m in enumerate(self.merges)], "step int, left int, right int, height double, size long")

    def label(self, df: DataFrame, clusters: int = 4, cluster: str = CLUSTER) -> DataFrame:
        """``df`` with the cluster of the nearest leaf; null where a number is missing."""
        schema = T.StructType([*df.schema.fields, T.StructField(cluster, T.IntegerType())])
        if self.leaves is None:
            return df.withColumn(cluster, F.lit(None).cast("int"))
        codes = cut(self.merges, len(self.leaves.n), clusters)

        def run(batches):
            for batch in batches:
                out = pd.Series([None] * len(batch), index=batch.index, dtype="Int32")
                known = batch[batch[self.numeric].notna().all(axis=1)] if self.numeric else batch
                for low in range(0, len(known), 4096):
                    part = known.iloc[low:low + 4096]
                    shares = [np.array([[w == name for name in words] for w in part[c].map(_word)], float).reshape(len(part), len(words))
                              for c, words in zip(self.categorical, self.leaves.words)]
                    each = Leaves(np.ones(len(part)), part[self.numeric].to_numpy("float64"), self.leaves.words, shares)
                    out[part.index] = codes[each.distances(self.leaves, self.spans).round(12).argmin(axis=1)]
                yield batch.assign(**{cluster: out})

        return df.mapInPandas(run, schema)


def hierarchy(df: DataFrame, numeric: list[str], categorical: list[str], most: int = MOST, profiles: bool = False) -> Hierarchy:
    """Leaves of all rows and the average linkage of their distances."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in numeric], *categorical).dropna(subset=numeric)
    ranges = column_ranges(rows, numeric)
    spans = np.array([ranges[c] or 0.0 for c in numeric])
    leaves = leaves_of(rows, numeric, categorical, spans, most)
    if leaves is None:
        return Hierarchy(None, [], spans, numeric, categorical)
    distance = leaves.distances(leaves, spans)
    if profiles:
        scaled = distance * np.sqrt(leaves.n)
        np.fill_diagonal(scaled, 0.0)
        distance = np.sqrt(np.maximum(np.square(scaled).sum(axis=1)[:, None] + np.square(scaled).sum(axis=1) - 2 * scaled @ scaled.T, 0.0))
    return Hierarchy(leaves, average_linkage(distance, leaves.n), spans, numeric, categorical)
