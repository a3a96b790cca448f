"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of the corpus divided by its present share, by characters. Each document is
repeated a Poisson number of times with that rate as mean: a hash of seed and id gives a uniform number, which the
source's cumulative distribution turns into a count. Copies get a hash of seed, id and copy; they are dealt to partitions and sorted
by it, so the order is a random permutation of the whole corpus. All of it is column expressions.

Without targets a source's weight is its size to the power of ``temperature``, which evens out the sources. With targets,
weights are as given, and sources that are not listed have weight 0. A source without characters keeps its documents at rate 1
(targets aside). A null source is a source; a null id is hashed as the text "null"; rows of one id get equal counts and are
all repeated. The total size is the input's on average.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialise
from .frames import free_name

SOURCES_TO_BROADCAST = 20_000
TEMPERATURE = 0.5
SEED = 7


def _hash(digits: int, *parts) -> Column:
    """The first hexadecimal digits of an MD5 as a number, up to 15 of them."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, (int, str)) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def source_rates(docs: DataFrame, source: str = "source", text: str = "text", targets: dict[str, float] | None = None,
                 temperature: float = TEMPERATURE) -> DataFrame:
    """``of_source``, ``size`` and ``rate`` of every source."""
    sizes = materialise(docs.groupBy(F.col(source).alias("of_source")).agg(
        F.sum(F.coalesce(F.length(text), F.lit(0)).cast("long")).alias("size")), "source-sizes")
    if targets is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(temperature))
        weight = F.when(F.col("size") > 0, weight).otherwise(0.0)
    else:
        listed = [x for s, w in targets.items() for x in (F.lit(s), F.lit(float(w)))]
        weight = F.coalesce(F.get(F.map_values(F.map_filter(F.create_map(*listed), lambda k, _: k == F.col("of_source"))), F.lit(0)), F.lit(0.0))
    weighted = sizes.withColumn("weight", weight)
    sums = weighted.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    total, weights = float(sums["size"] or 0), sums["weight"] or 0.0
    empty = F.lit(1.0) if targets is None else F.when(F.col("weight") > 0, 1.0).otherwise(0.0)
    rate = F.when(F.col("size") > 0, F.col("weight") / F.lit(weights or 1.0) * F.lit(total) / F.col("size")).otherwise(empty)
    return materialise(weighted.select("of_source", "size", rate.alias("rate")), "source-rates")


def cumulative(rate: Column) -> Column:
    """P(count <= j) for j from 0 to far beyond the mean; terms are kept as logarithms, so none underflows."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30)
    zero = F.struct((-rate).alias("term"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))

    def add(held, j):
        term = held["term"] + F.log(rate) - F.log(j.cast("double"))
        total = held["sum"] + F.exp(term)
        return F.struct(term.alias("term"), total.alias("sum"), F.array_append(held["all"], total).alias("all"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), last), zero, add, lambda h: h["all"])).otherwise(
        F.array(F.lit(1.0)))


def distributions(rates: DataFrame) -> DataFrame:
    """``rates`` with ``first`` and ``cumulative``: P(count <= first), P(count <= first + 1), ... for each ``of_source``.

    Only counts within 12 deviations of the mean are listed, some 24 times the root of the rate; what lies beyond has less
    than 1e-30. Terms are running sums of log ratios, scaled by the largest, so none underflows and none is off by more than rounding.
    """
    rate = F.col("rate")
    low = F.greatest(F.floor(rate - 12 * F.sqrt(rate) - 30), F.lit(0)).cast("long")
    high = F.when(rate > 0, F.ceil(rate + 12 * F.sqrt(rate) + 30)).otherwise(low).cast("long")
    each = rates.select("of_source", "rate", low.alias("first"), F.explode(F.sequence(low, high)).alias("j"))
    source = Window.partitionBy("of_source")
    upto = source.orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("j") > F.col("first"), F.log("rate") - F.log(F.col("j").cast("double"))).otherwise(0.0)
    logs = each.withColumn("log", F.sum(step).over(upto))
    terms = logs.withColumn("term", F.exp(F.col("log") - F.max("log").over(source)))
    sums = terms.withColumn("upto", F.sum("term").over(upto) / F.sum("term").over(source))
    listed = sums.groupBy("of_source").agg(F.min("first").alias("first"), F.array_sort(F.collect_list(F.struct("j", "upto"))).alias("cells"))
    return listed.select("of_source", "first", F.transform("cells", lambda c: c["upto"]).alias("cumulative"))


def replicate(docs: DataFrame, source: str = "source", text: str = "text", targets: dict[str, float] | None = None,
              temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Repeated rows of ``docs`` with ``copy`` (from 1) and ``shuffle_key``, in the order of the key within partitions.

    Names that the input has already get underscores.
    """
    rates = source_rates(docs, source, text, targets, temperature)
    of, first, cdf, u, n, copy, key = (free_name(docs, c) for c in (
        "of_source", "first_count", "distribution", "distribution_u", "distribution_n", "copy", "shuffle_key"))
    table = materialise(distributions(rates).toDF(of, first, cdf), "source-distributions")
    if rates.count() <= SOURCES_TO_BROADCAST:  # else adaptive execution splits a hot source
        table = F.broadcast(table)
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    uniform = (_hash(13, seed, identity).cast("double") + 0.5) / F.lit(float(16 ** 13))
    count = F.col(first) + F.size(F.filter(F.col(cdf), lambda c: c <= F.col(u)))
    drawn = docs.join(table, F.col(source).eqNullSafe(F.col(of))).withColumn(u, uniform).withColumn(n, count)
    copies = drawn.where(F.col(n) > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))).alias(copy))
    keyed = copies.withColumn(key, _hash(15, seed, identity, F.col(copy).cast("string")))
    return keyed.repartition(F.col(key)).sortWithinPartitions(key)

