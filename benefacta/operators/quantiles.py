"""Exact quantiles of large columns without gathering a column in one task.

The built-in exact percentile keeps every distinct value of a group in one buffer. Here each
wanted rank is first narrowed to a small value range by counting into bins, one pass over the
column per round for all columns, groups and ranks together. Only when the range holds few rows
are its values sorted. What reaches the driver is one row per wanted rank.

For groups (``by``) nothing per group reaches the driver: mergeable rank sketches (KLL) bracket every wanted rank of all groups in one
pass, and one more pass counts what lies below a bracket and sorts what lies inside. Counts are exact, so a sketch that
misses costs another turn and changes nothing; brackets of more than ``gather_rows`` rows are narrowed by further sketches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.window import Window

from ..session import materialise

SKETCH = 800  # size of a rank sketch; its ranks are off by less than 0.5 percent nearly always
MARGIN = 0.01
GRID = 256
INFINITE = "infinite values have no interpolated quantile"


def long_values(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., column, value`` without null and NaN values."""
    if len(columns) == 1:  # range filters on a plain column reach the scan
        stacked = df.select(*by, F.lit(columns[0]).alias("column"),
                            F.col(columns[0]).cast("double").alias("value"))
    else:
        pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                 for c in columns]
        stacked = df.select(*by, F.explode(F.array(*pairs)).alias("cell")).select(
            *by, "cell.column", "cell.value")
    return stacked.filter(F.col("value").isNotNull() & ~F.isnan("value"))


class _Range:
    """A closed value range of one group and column, and the ranks wanted inside it."""

    def __init__(self, key, lo, hi, rows, ranks):
        self.key, self.lo, self.hi, self.rows = key, lo, hi, rows
        self.ranks = ranks  # {rank within the range: rank within the column}


def _whole_ranges(df: DataFrame, columns: list[str]) -> list[_Range]:
    """Rows, lowest and highest value of each column; one wide aggregate."""
    wide = []
    for i, c in enumerate(columns):
        known = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        wide += [F.count(known).alias(f"rows{i}"), F.min(known).alias(f"lo{i}"), F.max(known).alias(f"hi{i}")]
    found = df.agg(*wide).first()
    ranges = [_Range((name,), found[f"lo{i}"], found[f"hi{i}"], found[f"rows{i}"], {}) for i, name in enumerate(columns) if found[f"rows{i}"]]
    if any(math.isinf(r.lo) or math.isinf(r.hi) for r in ranges):
        raise ValueError(INFINITE)
    return ranges


def _frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def _members(values: DataFrame, ranges: list[_Range], by: tuple[str, ...]) -> DataFrame:
    """Rows of ``values`` inside one of the ranges, with the number and limits of the range."""
    key_fields = [values.schema[c] for c in (*by, "column")]
    schema = T.StructType(
        [T.StructField("_" + f.name, f.dataType) for f in key_fields]
        + [T.StructField("_range", T.IntegerType()), T.StructField("_lo", T.DoubleType()),
           T.StructField("_hi", T.DoubleType())])
    table = _frame(values.sparkSession, schema,
                   [(*r.key, i, r.lo, r.hi) for i, r in enumerate(ranges)])
    lowest, highest = min(r.lo for r in ranges), max(r.hi for r in ranges)
    same_key = [F.col(c).eqNullSafe(F.col("_" + c)) for c in (*by, "column")]
    inside = F.col("value").between(F.col("_lo"), F.col("_hi"))
    condition = inside
    for part in same_key:
        condition = part & condition
    # at most one range per wanted rank and column
    return values.filter(F.col("value").between(lowest, highest)).join(F.broadcast(table), condition)


def _hits(counted: DataFrame, ranges: list[_Range], order: str) -> list[Row]:
    """The rows of ``counted`` (range, ordering value, rows) in which a wanted rank falls."""
    wanted = _frame(counted.sparkSession, "_range int, _rank long",
                    [(i, rank) for i, r in enumerate(ranges) for rank in r.ranks])
    running = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("_upto", F.sum("rows").over(running))
    inside = (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("rows"))
    return upto.join(F.broadcast(wanted), "_range").filter(inside).collect()


def _narrow(values, ranges, by, bins) -> list[_Range]:
    lo, hi = F.col("_lo") * 0.5, F.col("_hi") * 0.5  # halves cannot overflow when subtracted
    share = (F.col("value") * 0.5 - lo) / (hi - lo)
    bin_no = F.least(F.floor(share * bins), F.lit(bins - 1))
    counted = (_members(values, ranges, by).groupBy("_range", bin_no.alias("_bin"))
               .agg(F.count("*").alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi")))
    found: dict[tuple, _Range] = {}
    for hit in _hits(counted, ranges, "_bin"):
        parent = ranges[hit["_range"]]
        child = found.setdefault((hit["_range"], hit["_bin"]),
                                 _Range(parent.key, hit["lo"], hit["hi"], hit["rows"], {}))
        child.ranks[hit["_rank"] - (hit["_upto"] - hit["rows"])] = parent.ranks[hit["_rank"]]
    return list(found.values())


def _gather(values, ranges, by) -> dict[tuple, float]:
    counted = (_members(values, ranges, by).groupBy("_range", "value")
               .agg(F.count("*").alias("rows")))
    return {(ranges[h["_range"]].key, ranges[h["_range"]].ranks[h["_rank"]]): h["value"]
            for h in _hits(counted, ranges, "value")}


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float],
                    by: tuple[str, ...] = (), gather_rows: int = 50_000, bins: int = 2048) -> DataFrame:
    """Quantiles with linear interpolation: ``by..., column, rows, probability, quantile``.

    Nulls and NaN do not count. Any number of groups takes two scans, unless one has millions of rows.
    """
    if by:
        return _grouped_quantiles(long_values(df, columns, by), [*by, "column"], [float(p) for p in probabilities], gather_rows)
    values = long_values(df, columns)
    schema = T.StructType([values.schema["column"], T.StructField("rows", T.LongType()), T.StructField("probability", T.DoubleType()),
                           T.StructField("quantile", T.DoubleType())])
    return _frame(df.sparkSession, schema, _quantiles_of(values, _whole_ranges(df, columns), probabilities, (), gather_rows, bins))


def _grid(column: Column) -> Column:
    """Quantiles of a column at equal steps, from its sketch; null without values."""
    sketch = F.kll_sketch_agg_double(column, SKETCH)
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return F.when(F.count(column) > 0, F.kll_sketch_get_quantile_double(sketch, steps))


def _bracket(grid: Column, low: Column, high: Column, rows: Column) -> list[Column]:
    """``lo``, ``hi`` and the share of the values between, for ranks ``low`` to ``high`` of so many."""
    first = F.greatest(F.floor((low / rows - MARGIN) * GRID), F.lit(0)).cast("int")
    last = F.least(F.ceil((high / rows + MARGIN) * GRID), F.lit(GRID)).cast("int")
    lo, hi = F.get(grid, first), F.get(grid, last)
    share = F.when(lo == hi, 0.0).when((first == 0) & (last == GRID), 1.0).otherwise((last - first) / F.lit(float(GRID)) + 2 * MARGIN)
    return [lo.alias("lo"), hi.alias("hi"), share.alias("share")]


def _beside(values: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, p, v``: the values inside each bracket of their group, and a null for each value below it."""
    held = brackets.groupBy(*keys).agg(F.collect_list(F.struct("p", "lo", "hi")).alias("_brackets"))
    held = held.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)], "_brackets")
    same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(keys)]
    met = F.filter("_brackets", lambda b: F.col("value") <= b["hi"])
    each = F.transform(met, lambda b: F.struct(b["p"].alias("p"), F.when(F.col("value") >= b["lo"], F.col("value")).alias("v")))
    return values.join(held, same).select(*keys, F.explode(each).alias("_cell")).select(*keys, "_cell.p", "_cell.v")


def _narrowed(values: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """The same brackets, drawn closer by a sketch of what they hold, or moved to the side where the rank lies."""
    seen = _beside(values, brackets, keys).groupBy(*keys, "p").agg(
        F.count_if(F.col("v").isNull()).alias("below"), F.count("v").alias("inside"), _grid(F.col("v")).alias("grid"))
    seen = seen.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)], F.col("p").alias("_p"), "below", "inside", "grid")
    same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(keys)] + [F.col("p") == F.col("_p")]
    met = brackets.join(seen, same).withColumn("side", F.when(F.col("low") < F.col("below"), -1).when(
        F.col("high") >= F.col("below") + F.col("inside"), 1).otherwise(0))
    lo, hi, share = _bracket(F.col("grid"), F.col("low") - F.col("below"), F.col("high") - F.col("below"), F.col("inside"))
    met = met.select("*", F.struct(lo, hi, share).alias("new"))
    stuck = (F.col("new.lo") == F.col("lo")) & (F.col("new.hi") == F.col("hi"))
    low_side, high_side = F.col("side") == -1, F.col("side") == 1
    return met.select(
        *keys, "rows", "p", "low", "high", "least", "most",
        F.when(low_side, F.col("least")).when(high_side, F.col("lo")).otherwise(F.col("new.lo")).alias("lo"),
        F.when(low_side, F.col("hi")).when(high_side, F.col("most")).otherwise(F.col("new.hi")).alias("hi"),
        F.when(F.col("side") != 0, F.col("rows").cast("double")).when(stuck, 0.0).otherwise(F.col("new.share") * F.col("inside")).alias("held"))


def _grouped_quantiles(values: DataFrame, keys: list[str], probabilities: list[float], gather_rows: int) -> DataFrame:
    groups = values.groupBy(*keys).agg(F.count("*").alias("rows"), F.min("value").alias("least"), F.max("value").alias("most"),
                                       _grid(F.col("value")).alias("grid"))
    infinite = F.greatest(F.abs("least"), F.abs("most")) == float("inf")
    place = F.col("p") * (F.col("rows") - 1)
    ranked = groups.select("*", F.explode(F.array(*[F.lit(p) for p in probabilities])).alias("p")).select(
        "*", F.floor(place).alias("low"), F.ceil(place).alias("high"))
    lo, hi, share = _bracket(F.col("grid"), F.col("low"), F.col("high"), F.col("rows"))
    brackets = ranked.select(*keys, F.when(infinite, F.raise_error(F.lit(INFINITE))).otherwise(F.col("rows")).cast("long").alias("rows"),
                             "p", "low", "high", "least", "most", lo, hi, (share * F.col("rows")).alias("held"))
    return _settled(values, materialise(brackets, "quantile-brackets"), keys, gather_rows)


def _settled(values: DataFrame, brackets: DataFrame, keys: list[str], gather_rows: int) -> DataFrame:
    while not brackets.where(F.col("held") > gather_rows).isEmpty():
        wide = brackets.where(F.col("held") > gather_rows)
        brackets = materialise(_narrowed(values, wide, keys).unionByName(brackets.where(F.col("held") <= gather_rows)), "quantile-brackets")
    counted = _beside(values, brackets, keys).groupBy(*keys, "p", "v").agg(F.count("*").alias("n"))
    running = Window.partitionBy(*keys, "p").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("upto", F.sum("n").over(running))
    upto = upto.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)], F.col("p").alias("_p"), "v", "upto")
    same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(keys)] + [F.col("p") == F.col("_p")]

    def at(rank: str) -> Column:
        return F.min(F.when(F.col("upto") > F.col(rank), F.struct("upto", "v")))["v"]

    found = brackets.join(upto, same).groupBy(*keys, "rows", "p", "low", "high", "least", "most").agg(at("low").alias("a"), at("high").alias("b"))
    found = materialise(found, "quantile-ranks")
    missed = found.where("a IS NULL OR b IS NULL")
    step = F.col("p") * (F.col("rows") - 1) - F.col("low")
    hit = found.where("a IS NOT NULL AND b IS NOT NULL").select(
        *keys, "rows", F.col("p").alias("probability"), (F.col("a") + (F.col("b") - F.col("a")) * step).alias("quantile"))
    if missed.isEmpty():
        return hit
    again = missed.select(*keys, "rows", "p", "low", "high", "least", "most", F.col("least").alias("lo"), F.col("most").alias("hi"),
                          F.col("rows").cast("double").alias("held"))
    return hit.unionByName(_settled(values, again, keys, gather_rows))


def _quantiles_of(values: DataFrame, ranges: list[_Range], probabilities: list[float], by: tuple[str, ...],
                  gather_rows: int, bins: int) -> list[tuple]:
    for r in ranges:
        last = r.rows - 1
        ranks = {int(rank) for p in probabilities for rank in (math.floor(p * last), math.ceil(p * last))}
        r.ranks = {rank: rank for rank in ranks}
    keys = {r.key: r.rows for r in ranges}

    at_rank: dict[tuple, float] = {}
    while ranges:
        for r in (r for r in ranges if r.lo == r.hi):
            at_rank.update({(r.key, rank): r.lo for rank in r.ranks.values()})
        ranges = [r for r in ranges if r.lo != r.hi]
        few = [r for r in ranges if r.rows <= gather_rows]
        many = [r for r in ranges if r.rows > gather_rows]
        if few:
            at_rank.update(_gather(values, few, by))
        ranges = _narrow(values, many, by, bins) if many else []

    out = []
    for key, rows in keys.items():
        for p in probabilities:
            place = p * (rows - 1)
            low, high = at_rank[key, math.floor(place)], at_rank[key, math.ceil(place)]
            out.append((*key, rows, float(p), low + (high - low) * (place - math.floor(place))))
    return out


def column_quantiles(df: DataFrame, column: str, probabilities: list[float], **options) -> list[float]:
    """The quantiles of one column as numbers; empty if the column holds no value."""
    rows = exact_quantiles(df, [column], probabilities, **options).collect()
    return [r["quantile"] for r in sorted(rows, key=lambda r: r["probability"])]
