"""Donor lifetime value: donation history at present value, then an annuity over the lifespan left."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions import numbers
from ..operators import cleaning, joins
from ..session import materialise


def inflation_yearly(monthly: DataFrame) -> DataFrame:
    """``year, rate``: mean of the monthly percentages as a fraction."""
    return (monthly.groupBy(F.substring("period", 1, 4).cast("int").alias("year"))
            .agg((F.avg("pct") / 100).alias("rate")))


def inflation_factors(years: DataFrame, inflation: DataFrame, as_of: dt.date) -> DataFrame:
    """``year, factor``: what a sum of that year is worth now.

    Compounds over the given years only; the current year does not compound. A past year without
    a rate is an error. The frame has one row per calendar year, so the ordered window is small.
    """
    known = years.select("year").distinct().join(F.broadcast(inflation), "year", "left")
    missing = F.raise_error(F.concat(F.lit("no inflation rate for "), F.col("year").cast("string")))
    growth = (F.when(F.col("year") == as_of.year, F.lit(1.0))
              .when(F.col("rate").isNull(), missing.cast("double"))
              .otherwise(1 + F.col("rate")))
    later = Window.orderBy(F.col("year").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return known.select("year", F.product(growth).over(later).alias("factor"))


def present_value_history(donations: DataFrame, inflation: DataFrame, as_of: dt.date) -> DataFrame:
    """``donor_id, total_value, first_year`` of donations with a ``tx_year``.

    The donations are read once, into exact sums per donor and year; years, factors and totals follow
    from that stored table. The yearly factors are broadcast (one row per calendar year). A donor's years
    are added up in their order, so the last digits do not depend on the partitioning.
    """
    yearly = materialise(yearly_donations(donations), "yearly-donations")
    factors = inflation_factors(yearly.select(F.col("tx_year").alias("year")), inflation, as_of)
    valued = yearly.join(F.broadcast(factors), F.col("tx_year") == F.col("year"))
    value = F.struct("tx_year", (F.col("amount").cast("double") * F.col("factor")).alias("value"))
    return valued.groupBy("donor_id").agg(
        F.aggregate(F.array_sort(F.collect_list(value)), F.lit(0.0), lambda total, v: total + F.coalesce(
            v["value"], F.lit(0.0))).alias("total_value"),
        F.min("tx_year").alias("first_year"),
    )


def first_year(donations: DataFrame) -> DataFrame:
    return donations.groupBy("donor_id").agg(F.min("tx_year").alias("first_year"))


def yearly_donations(donations: DataFrame) -> DataFrame:
    """Long form: ``donor_id, tx_year, amount``."""
    return donations.groupBy("donor_id", "tx_year").agg(F.sum(numbers.money(F.col("amount"))).alias("amount"))


def yearly_donations_pivot(donations: DataFrame, years: list[int]) -> DataFrame:
    """One column per given year, 0 where the donor gave nothing, and ``other_years`` for all the rest.

    Conditional sums, one shuffle; the long form with every year is ``yearly_donations``.
    """
    amount = numbers.money(F.col("amount"))

    def total(condition, name):
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0)).cast("double").alias(name)

    listed = F.coalesce(F.col("tx_year").isin(*years), F.lit(False))
    return donations.groupBy("donor_id").agg(
        *[total(F.col("tx_year") == y, f"y{y}") for y in years], total(~listed, "other_years"))


def lifespan(donors: DataFrame) -> DataFrame:
    """Add the larger risk and the expected years; donors without risk are left out."""
    risk = numbers.largest_risk(F.col("churn_prob"), F.col("lapsed_prob"))
    return (donors.withColumn("churn_max", risk).filter(F.col("churn_max") != 0)
            .withColumn("lifespan", numbers.capped_lifespan(F.col("churn_max"), F.col("age"))))


def latest_rate(inflation: DataFrame):
    """Rate of the latest year of the series, as a one-value column."""
    return inflation.agg(F.max_by("rate", "year")).scalar()


def donor_lifetime_value(donors: DataFrame, transactions: DataFrame, inflation_monthly: DataFrame,
                         as_of: dt.date) -> DataFrame:
    """The lifetime-value table of active donors with regular donations."""
    inflation = inflation_yearly(inflation_monthly)
    donations = cleaning.regular_donations(cleaning.collected_transactions(transactions, as_of))
    history = present_value_history(donations, inflation, as_of)
    active, _ = cleaning.split_active(lifespan(donors))
    tenure = F.lit(as_of.year) - F.col("first_year")
    joined = history.join(joins.unique(active.select("donor_id", "lifespan", "age", "churn_max"), "donor_id"), "donor_id")
    valued = joined.withColumns({
        "tenure_years": tenure,
        "yearly_average": F.try_divide(F.col("total_value"), tenure + 1),
    })
    value = numbers.annuity_value(F.col("yearly_average"), F.col("_rate"),
                                  numbers.annuity_periods(F.col("lifespan")))
    return (valued.withColumn("_rate", latest_rate(inflation))
            .withColumn("dltv", value).drop("_rate"))


def with_instalment_averages(values: DataFrame, donors: DataFrame) -> DataFrame:
    """Add paid and unpaid instalments per year of tenure, as the experiments expect them."""
    counts = joins.unique(donors.select("donor_id", "instalments_paid", "instalments_unpaid"), "donor_id")
    years = F.col("tenure_years") + 1
    return (values.join(counts, "donor_id", "left")
            .withColumns({"avg_paid": F.try_divide(F.col("instalments_paid"), years),
                          "avg_unpaid": F.try_divide(F.col("instalments_unpaid"), years)})
            .drop("instalments_paid", "instalments_unpaid"))
