"""Distances and prototypes for numbers and categories together."""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialise
from .clustering import _races
from .sampling import sample_order, seeded_sample


def column_ranges(df: DataFrame, numeric: list[str]) -> dict[str, float]:
    row = df.agg(*[(F.max(c) - F.min(c)).cast("double").alias(c) for c in numeric]).first()
    return row.asDict()


def gower_distance(ranges: dict[str, float], categorical: list[str], other: dict) -> Column:
    """Gower distance of each row to one record given as literals; null if a number is missing."""
    parts = [F.abs(F.col(c) - F.lit(float(other[c]))) / F.lit(r) if r else F.lit(0.0)
             for c, r in ranges.items()]
    parts += [F.when(F.col(c).eqNullSafe(F.lit(other[c])), 0.0).otherwise(1.0) for c in categorical]
    return sum(parts, F.lit(0.0)) / F.lit(float(len(parts)))


def gower_to_prototypes(df: DataFrame, key: str, numeric: list[str], categorical: list[str],
                        prototypes: dict[int, dict]) -> DataFrame:
    """``key, prototype, distance`` for every row and each of a few prototypes; no join."""
    ranges = column_ranges(df, numeric)
    distances = [F.struct(F.lit(code).alias("prototype"), gower_distance(ranges, categorical, p).alias("distance"))
                 for code, p in prototypes.items()]
    return df.select(key, F.explode(F.array(*distances)).alias("d")).select(key, "d.prototype", "d.distance")


def gower_matrix(df: DataFrame, key: str, numeric: list[str], categorical: list[str], n: int = 1000,
                 seed: int = 1) -> DataFrame:
    """Distance matrix of a seeded sample of ``n`` rows: ``key, others, distances``, one row each.

    The sample bounds the matrix; its records are a one-row result that every row of the sample is compared with.
    """
    sample = materialise(seeded_sample(df.select(key, *numeric, *categorical).dropna(subset=numeric), key, n, seed), "gower-sample")
    records = sample.agg(F.collect_list(F.struct(key, *numeric, *categorical))).scalar()
    spans = sample.agg(F.array(*[(F.max(c) - F.min(c)).cast("double") for c in numeric]).cast("array<double>")).scalar()

    def distance(other: Column) -> Column:
        parts = [F.when(F.col("_spans")[j] > 0, F.abs(F.col(c) - other[c]) / F.col("_spans")[j]).otherwise(0.0) for j, c in enumerate(numeric)]
        parts += [F.when(F.col(c).eqNullSafe(other[c]), 0.0).otherwise(1.0) for c in categorical]
        return sum(parts, F.lit(0.0)) / F.lit(float(len(parts)))

    spread = sample.repartition(F.col(key)).select("*", records.alias("_records"), spans.alias("_spans"))
    return spread.select(key, F.transform("_records", lambda r: r[key]).alias("others"), F.transform("_records", distance).alias("distances"))


def gower_summary(matrix: DataFrame, key: str) -> DataFrame:
    """Mean and largest distance of each sampled row to the others."""
    total = F.aggregate("distances", F.lit(0.0), lambda acc, d: acc + d)
    return matrix.select(key, (F.size("distances") - 1).cast("bigint").alias("others"),
                         F.try_divide(total, F.size("distances") - 1).alias("mean_distance"),
                         F.array_max("distances").alias("max_distance"))


def split_by_type(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """``(numeric, categorical)``: text columns are categories."""
    kinds = dict(df.dtypes)
    return ([c for c in columns if kinds[c] != "string"], [c for c in columns if kinds[c] == "string"])


def _reduced(rows: DataFrame, runs: dict[int, list[dict]], numeric, categorical, gamma) -> DataFrame:
    """Closest prototype of each row in each run (lower number on ties), reduced where the row lies.

    One row per batch, run, cluster, column and word: ``n`` rows with that word, and on the leading
    column also the cost and the sums of the numbers. Distances are one matrix per batch and run;
    the same in column expressions would be interpreted term by term.
    """
    columns = list(categorical) or [None]
    carried = ["cost", *numeric]

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[numeric].to_numpy(dtype="float64")
            coded = [pd.factorize(batch[c].where(batch[c].notna(), None), use_na_sentinel=False) if c else
                     (np.zeros(len(batch), dtype="int64"), np.array([None], dtype=object)) for c in columns]
            parts = []
            for run, prototypes in runs.items():
                center = np.array([[p[c] for c in numeric] for p in prototypes], dtype="float64")
                cost = ((x[:, None, :] - center[None]) ** 2).sum(axis=2)
                for c, (codes, words) in zip(columns, coded):
                    if c:
                        differs = [[not _same(w, p[c]) for p in prototypes] for w in words]
                        cost += gamma * np.array(differs, dtype="float64")[codes]
                own = cost.argmin(axis=1)
                sums = np.column_stack([cost[np.arange(len(own)), own], x])
                for i, (c, (codes, words)) in enumerate(zip(columns, coded)):
                    cell = own * len(words) + codes
                    seen, place, n = np.unique(cell, return_inverse=True, return_counts=True)
                    part = pd.DataFrame({"run": run, "cluster": seen // len(words), "column": c or "",
                                         "word": [None if pd.isna(w) else w for w in words[seen % len(words)]], "n": n})
                    for name, values in zip(carried, sums.T):
                        part[name] = np.bincount(place, weights=values) if i == 0 else np.nan
                    parts.append(part)
            yield pd.concat(parts, ignore_index=True)

    schema = ("run int, cluster int, column string, word string, n long, "
              + ", ".join(f"`{c}` double" for c in carried))
    reduced = rows.select(*numeric, *categorical).mapInPandas(reduce, schema)
    return reduced.groupBy("run", "cluster", "column", "word").agg(
        F.sum("n").alias("n"), *[F.sum(F.nanvl(c, F.lit(None))).alias(c) for c in carried])


def _same(a, b) -> bool:
    return a == b or (pd.isna(a) and pd.isna(b))


def _first_records(rows: DataFrame, key: str, n: int, seed: int) -> list[dict]:
    """The first ``n`` distinct records in hash order, by the first place of each; an error if there are fewer."""
    return _starts(rows, key, n, [seed])[0]


def _starts(rows: DataFrame, key: str, n: int, seeds: list[int]) -> list[list[dict]]:
    """The first ``n`` distinct records in the hash order of each seed, from one pass over all rows."""
    columns = [c for c in rows.columns if c != key]
    places = [F.min(F.struct(sample_order(key, seed).alias("hash"), F.col(key).alias("key"))).alias(f"_place{i}")
              for i, seed in enumerate(seeds)]
    records = rows.groupBy(*columns).agg(*places).persist()
    try:
        found = [[r.asDict() for r in records.orderBy(f"_place{i}").limit(n).select(*columns).collect()]
                 for i in range(len(seeds))]
    finally:
        records.unpersist()
    if len(found[0]) < n:
        raise ValueError(f"{n} clusters need as many distinct records; there are {len(found[0])}")
    return found


def _uniform(seed: int, turn: int, places) -> np.ndarray:
    """Numbers in (0, 1) that follow from seed, turn and place alone."""
    return np.exp(-_races(np.asarray(places, np.uint64), seed, turn))


def huang_starts(rows: DataFrame, numeric: list[str], categorical: list[str], sizes: list[int], seeds: list[int]) -> list[list[dict]]:
    """For each run ``sizes[i]`` prototypes: numbers drawn from a normal distribution with the column's mean and deviation,
    categories in proportion to their frequency, each column for itself, then moved to the nearest record.

    A category is drawn by the least of exponential variables divided by the frequencies, all runs and prototypes in one
    aggregate per column. Then one pass over the distinct combinations of categories finds the nearest ones of each prototype;
    one prototype after the other takes the nearest that is no other's categories, the first by its words of equally near ones,
    or the nearest of all if none is free.
    """
    draws = [(run, i) for run, size in enumerate(sizes) for i in range(size)]
    starts: list[list[dict]] = [[{} for _ in range(size)] for size in sizes]
    if numeric:
        moments = rows.agg(*[F.avg(c).alias(f"m{j}") for j, c in enumerate(numeric)],
                           *[F.stddev_pop(c).alias(f"s{j}") for j, c in enumerate(numeric)]).first()
        for run, i in draws:
            for j, (c, u) in enumerate(zip(numeric, _uniform(seeds[run], i, range(len(numeric))))):
                normal = NormalDist().inv_cdf(min(max(float(u), 1e-12), 1 - 1e-12))
                starts[run][i][c] = (moments[f"m{j}"] or 0.0) + normal * (moments[f"s{j}"] or 0.0)
    if not categorical:
        return starts
    combined = rows.groupBy(*categorical).agg(F.count("*").alias("_n")).persist()
    try:
        for j, c in enumerate(categorical):
            for r in _drawn_words(combined.groupBy(F.col(c).alias("word")).agg(F.sum("_n").alias("n")), draws, seeds, len(numeric) + j).collect():
                run, i = draws[r["draw"]]
                starts[run][i][c] = r["word"]
        near: dict[int, list[tuple]] = {}
        for r in _nearest_records(combined.select(*categorical), categorical, [starts[run][i] for run, i in draws], max(sizes) + 1).collect():
            near.setdefault(r["draw"], []).append((r["differs"], tuple(r[c] for c in categorical)))
    finally:
        combined.unpersist()
    for draw, (run, i) in enumerate(draws):
        taken = [tuple(p[c] for c in categorical) for p in starts[run][:i] + starts[run][i + 1:]]
        ranked = [words for _, words in sorted(near.get(draw, []), key=lambda x: (x[0], [(w is not None, w or "") for w in x[1]]))]
        chosen = next((words for words in ranked if words not in taken), ranked[0])
        starts[run][i].update(zip(categorical, chosen))
    return starts


def _drawn_words(counts: DataFrame, draws: list[tuple[int, int]], seeds: list[int], column: int) -> DataFrame:
    """``draw, word``: one word for each prototype of each run, in proportion to ``n``."""
    def race(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            hashes, n = batch["hash"].to_numpy("int64").view("uint64"), batch["n"].to_numpy("float64")
            best = []
            for run, i in draws:
                times = _races(hashes, seeds[run], 1000 * (column + 1) + i) / n
                first = int(times.argmin())
                best.append((float(times[first]), batch["word"].iloc[first]))
            yield pd.DataFrame({"draw": range(len(draws)), "time": [t for t, _ in best],
                                "word": [None if pd.isna(w) else w for _, w in best]})

    raced = counts.withColumn("hash", F.xxhash64("word")).mapInPandas(race, "draw int, time double, word string")
    return raced.groupBy("draw").agg(F.min(F.struct("time", "word"))["word"].alias("word"))


def _nearest_records(records: DataFrame, categorical: list[str], prototypes: list[dict], most: int) -> DataFrame:
    """``draw, differs`` and the words of the ``most`` records nearest to each prototype."""
    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch.astype(object).where(batch.notna(), None).reset_index(drop=True)
            words = words.sort_values(categorical, na_position="first", kind="stable")
            parts = []
            for draw, p in enumerate(prototypes):
                differs = sum(~((words[c] == p[c]) | (words[c].isna() & (p[c] is None))) for c in categorical).astype("int32")
                at = differs.sort_values(kind="stable").index[:most]
                parts.append(words.loc[at].assign(draw=draw, differs=differs.loc[at]))
            if parts and len(batch):
                yield pd.concat(parts)[["draw", "differs", *categorical]]

    schema = "draw int, differs int, " + ", ".join(f"`{c}` string" for c in categorical)
    ranked = records.mapInPandas(rank, schema)
    order = Window.partitionBy("draw").orderBy("differs", *[F.col(c).asc_nulls_first() for c in categorical])
    return ranked.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= most).drop("_place")


def kprototypes_fits(df: DataFrame, columns: list[str], key: str, ks: range = range(2, 10), max_iterations: int = 20,
                     gamma: float | None = None, seed: int = 123, restarts: int = 1, init: str = "records") -> list[tuple[int, float, int, list[dict], float]]:
    """``(k, cost, iterations, prototypes, gamma)`` of the cheapest of ``restarts`` runs of k-prototypes for each k.

    All runs of all k advance together, so an iteration is one pass over the data whatever their number. The
    state between passes is the prototypes only, a few records that go along with the next pass;
    no lineage builds up. Prototypes are means and most frequent categories. Runs start from the first k distinct records in
    the hash order of their own seed, or with ``init`` ``huang`` as ``huang_starts`` says; the partitioning changes neither.
    """
    numeric, categorical = split_by_type(df, columns)
    rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in numeric], *categorical)
    rows = rows.dropna(subset=numeric).persist()
    try:
        if gamma is None:
            deviations = rows.agg(*[F.stddev_pop(c).alias(c) for c in numeric]).first()
            gamma = 0.5 * sum(deviations) / len(numeric)
        fits = [(k, seed + i) for k in ks for i in range(restarts)]
        if init == "huang":
            if not rows.take(1):
                return []
            starts = huang_starts(rows, numeric, categorical, [k for k, _ in fits], [s for _, s in fits])
        else:
            by_seed = dict(zip([seed + i for i in range(restarts)], _starts(rows, key, max(ks), [seed + i for i in range(restarts)])))
            starts = [by_seed[s][:k] for k, s in fits]
        runs = dict(enumerate(starts))
        costs: dict[int, float] = {}
        spent = {run: 0 for run in runs}
        moving = dict(runs)
        for _ in range(max_iterations):
            before = dict(costs)
            reduced = _reduced(rows, moving, numeric, categorical, gamma)
            updated = _updated_prototypes(reduced, moving, numeric, categorical, costs)
            still = {}
            for run, prototypes in updated.items():
                spent[run] += 1
                if prototypes != moving[run]:
                    runs[run] = prototypes
                    if not (run in before and costs[run] >= before[run]):
                        still[run] = prototypes
            moving = still
            if not moving:
                break
        final = _reduced(rows, runs, numeric, categorical, gamma).groupBy("run").agg(F.sum("cost").alias("cost"))
        results = {r["run"]: r["cost"] for r in final.collect()}
    finally:
        rows.unpersist()
    table = []
    for k in ks:
        of_k = [run for run in results if fits[run][0] == k]
        if of_k:  # costs that differ by rounding only are equal, then the first run counts
            best = min(of_k, key=lambda run: (float(f"{results[run]:.10g}"), run))
            table.append((k, float(results[best]), spent[best], runs[best], gamma))
    return table


def kprototypes_costs(df: DataFrame, columns: list[str], key: str, ks: range = range(2, 10), **options) -> DataFrame:
    """``k, cost, iterations`` of the best run for each k; options as for ``kprototypes_fits``."""
    table = [fit[:3] for fit in kprototypes_fits(df, columns, key, ks, **options)]
    return df.sparkSession.createDataFrame(table, "k int, cost double, iterations int")


def assigned_cost(df: DataFrame, columns: list[str], prototypes: list[dict], gamma: float) -> DataFrame:
    """``cost``: squared gaps and ``gamma`` for each other category, summed over the nearest prototypes."""
    numeric, categorical = split_by_type(df, columns)
    far = [sum([(F.col(c).cast("double") - F.lit(float(p[c]))) ** 2 for c in numeric]
               + [F.when(F.col(c).eqNullSafe(F.lit(p[c])), 0.0).otherwise(gamma) for c in categorical], F.lit(0.0)) for p in prototypes]
    return df.dropna(subset=numeric).agg(F.sum(F.array_min(F.array(*far))).alias("cost"))


def kprototypes_step(df: DataFrame, columns: list[str], prototypes: list[dict], gamma: float) -> tuple[list[dict], float]:
    """Prototypes after one pass from the given ones, and the cost of that pass."""
    numeric, categorical = split_by_type(df, columns)
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in numeric], *categorical).dropna(subset=numeric)
    runs, costs = {len(prototypes): prototypes}, {}
    reduced = _reduced(rows, runs, numeric, categorical, gamma)
    return _updated_prototypes(reduced, runs, numeric, categorical, costs)[len(prototypes)], costs[len(prototypes)]


def _updated_prototypes(reduced, moving, numeric, categorical, costs) -> dict[int, list[dict]]:
    """New prototypes per run from the reduced rows; an empty cluster keeps its old one."""
    carried = ["cost", *numeric]
    frequent = F.min(F.struct((-F.col("n")).alias("order"), F.col("word").alias("word")))["word"]
    clusters = reduced.groupBy("run", "cluster", "column").agg(
        F.sum("n").alias("n"), frequent.alias("word"), *[F.sum(c).alias(c) for c in carried]).collect()

    updated = {run: [dict(p) for p in prototypes] for run, prototypes in moving.items()}
    costs.update({run: 0.0 for run in moving})
    for c in clusters:  # one row per run, cluster and categorical column
        prototype = updated[c["run"]][c["cluster"]]
        if c["column"] in categorical:
            prototype[c["column"]] = c["word"]
        if c["cost"] is not None:
            costs[c["run"]] += c["cost"]
            prototype.update({name: c[name] / c["n"] for name in numeric})
    return updated
