"""The tables behind the exploratory charts: a few rows each, whatever the size of the input."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from .joins import balanced_join
from .quantiles import exact_quantiles, long_values


def null_profile(df: DataFrame) -> DataFrame:
    """``column, nulls`` for the columns that have any; one pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column", "nulls").filter("nulls > 0")


def value_counts(df: DataFrame, *columns: str, with_share: bool = False) -> DataFrame:
    counts = df.groupBy(*columns).agg(F.count("*").alias("n"))
    if not with_share:
        return counts
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("n") / total)


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Most frequent values; ties by name."""
    known = df.filter(F.col(column).isNotNull())
    return value_counts(known, column).orderBy(F.col("n").desc(), column).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("distinct_values"))


def describe_columns(df: DataFrame, columns: list[str], decimals: int = 2) -> DataFrame:
    """``column, statistic, value``: count, mean, std, min, quartiles, max."""
    cells, wide = [], []
    for i, c in enumerate(columns):
        known = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        for name, fn in (("count", F.count), ("mean", F.avg), ("std", F.stddev), ("min", F.min), ("max", F.max)):
            wide.append(fn(known).cast("double").alias(f"{name}{i}"))
            cells.append(F.struct(F.lit(c).alias("column"), F.lit(name).alias("statistic"),
                                  F.col(f"{name}{i}").alias("value")))
    long = df.agg(*wide).select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    names = F.concat((F.col("probability") * 100).cast("int").cast("string"), F.lit("%"))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", names.alias("statistic"), F.col("quantile").alias("value"))
    return long.unionByName(quartiles).withColumn("value", F.round("value", decimals))


def box_statistics(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Quartiles and whiskers per column: the whiskers are the outermost values inside the fences."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by)
    keys = [*by, "column"]
    boxes = quartiles.groupBy(*keys).agg(
        *[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
          for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    # few groups are broadcast, many are joined by key, where adaptive execution splits a large group
    named = boxes.withColumnsRenamed({c: f"_{c}" for c in keys})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    fenced = long_values(df, columns, by).join(named, same)
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    ends = fenced.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("lo"), F.max(F.when(inside, F.col("value"))).alias("hi"),
        F.count_if(~inside).alias("fliers"))
    return ends.select(*keys, "q1", "median", "q3", F.least("q1", "lo").alias("whisker_low"),
                       F.greatest("q3", "hi").alias("whisker_high"), "fliers")


def _limits(df: DataFrame, column: str) -> Column:
    """Lowest and highest value; a single value gets a range of one around it."""
    lo, hi = F.min(column).cast("double"), F.max(column).cast("double")
    return df.agg(_widened(lo, hi)).scalar()


def _widened(lo: Column, hi: Column) -> Column:
    return F.struct(F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"),
                    F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"))


def _bin(column: str, limits: str, bins: int) -> Column:
    lo, hi = F.col(f"{limits}.lo"), F.col(f"{limits}.hi")
    bucket = F.width_bucket(F.col(column).cast("double"), lo, hi, F.lit(bins))
    return F.when(F.col(column).isNotNull(), F.least(bucket, F.lit(bins)).cast("int"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``bin, lower, upper, n`` with equal bins from the lowest to the highest value."""
    known = df.select(column).filter(F.col(column).isNotNull())
    counts = (known.withColumn("_l", _limits(known, column))
              .groupBy(_bin(column, "_l", bins).alias("bin"), "_l").agg(F.count("*").alias("n")))
    width = (F.col("_l.hi") - F.col("_l.lo")) / bins
    return counts.select("bin", (F.col("_l.lo") + (F.col("bin") - 1) * width).alias("lower"),
                         (F.col("_l.lo") + F.col("bin") * width).alias("upper"), "n")


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 20, by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., x_bin, y_bin, n``: the density of a scatter plot, per colour if ``by`` is given."""
    known = df.select(x, y, *by).filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    limited = known.withColumn("_x", _limits(known, x)).withColumn("_y", _limits(known, y))
    return (limited.groupBy(*by, _bin(x, "_x", bins).alias("x_bin"), _bin(y, "_y", bins).alias("y_bin"))
            .agg(F.count("*").alias("n")))


def pair_bins(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """``x, y, x_bin, y_bin, n`` for every pair of columns, in one pass after the limits.

    Bins of a column run over all its values, whatever the other column of the pair.
    """
    limits = df.agg(F.struct(*[_widened(F.min(c).cast("double"), F.max(c).cast("double")).alias(c)
                               for c in columns]).alias("l"))
    limited = df.select(*columns).withColumn("_l", limits.scalar())
    binned = limited.select(*[_bin(c, f"_l.{c}", bins).alias(c) for c in columns])
    cells = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(a).alias("x_bin"), F.col(b).alias("y_bin"))
             for a, b in combinations(columns, 2)]
    pairs = binned.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    known = pairs.filter(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
    return known.groupBy("x", "y", "x_bin", "y_bin").agg(F.count("*").alias("n"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Lower triangle as ``column_a, column_b, correlation``; all pairs in one aggregate."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[_pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(b).alias("column_a"), F.lit(a).alias("column_b"),
                               F.col(f"r{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def _pearson(a: str, b: str) -> Column:
    """Correlation of the rows where both values are known."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return F.corr(F.when(both, F.col(a)).cast("double"), F.when(both, F.col(b)).cast("double"))


def by_date(df: DataFrame, date: str, value: str | None = None, alias: str = "n") -> DataFrame:
    """Sum of ``value`` per date, or the number of rows; rows without a date are left out."""
    measure = F.sum(F.col(value).cast("decimal(18,2)")).cast("double") if value else F.count("*")
    return df.filter(F.col(date).isNotNull()).groupBy(date).agg(measure.alias(alias))


def donor_mean_by_category(transactions: DataFrame, donors: DataFrame, tx_category: str | None,
                           donor_category: str, value: str = "amount") -> DataFrame:
    """Mean, count and standard error of a transaction value by a donor category and, if given, by
    one of the transaction.

    Transactions are reduced to (donor, category) before the join, so a donor with very many
    transactions is one row per category there.
    """
    known = transactions.filter(F.col(value).isNotNull())
    of_tx = [tx_category] if tx_category else []
    partial = known.groupBy("donor_id", *of_tx).agg(
        F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("s"),
        F.sum(F.col(value) * F.col(value)).alias("ss"))
    joined = partial.join(donors.select("donor_id", donor_category), "donor_id")
    totals = joined.groupBy(*of_tx, donor_category).agg(
        F.sum("n").alias("n"), F.sum("s").cast("double").alias("s"), F.sum("ss").alias("ss"))
    mean = F.col("s") / F.col("n")
    spread = F.greatest(F.col("ss") - F.col("s") * mean, F.lit(0.0))
    deviation = F.when(F.col("n") > 1, F.sqrt(spread / (F.col("n") - 1)))
    return totals.select(*of_tx, donor_category, "n", mean.alias("mean"),
                         (deviation / F.sqrt(F.col("n"))).alias("standard_error"))


def donor_count_by_category(transactions: DataFrame, donors: DataFrame, tx_category: str,
                            donor_category: str) -> DataFrame:
    """Transactions by two categories, one per table; reduced by donor before the join."""
    partial = transactions.groupBy("donor_id", tx_category).agg(F.count("*").alias("n"))
    joined = partial.join(donors.select("donor_id", donor_category), "donor_id")
    return joined.groupBy(tx_category, donor_category).agg(F.sum("n").alias("n"))


def transactions_with_donor(transactions: DataFrame, donors: DataFrame) -> DataFrame:
    """Row-level join for charts that need single transactions; busy donors are split."""
    return balanced_join(transactions, donors, "donor_id", "inner")
