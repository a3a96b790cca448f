"""Per-donor features from transactions. Sums and counts are partial before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import numbers
from .cleaning import COLLECTED, LOST


def stage_totals(transactions: DataFrame) -> DataFrame:
    """``donor_id, collected, lost``: whole amounts per donor, cut towards zero."""
    amount = numbers.money(F.col("amount"))

    def total(stage):
        return F.coalesce(F.sum(F.when(F.col("stage") == stage, amount)), F.lit(0)).cast("bigint")

    return transactions.groupBy("donor_id").agg(total(COLLECTED).alias("collected"), total(LOST).alias("lost"))


def collection_effectiveness(transactions: DataFrame) -> DataFrame:
    """Collected, total and their ratio per donor; null ratio if nothing was due."""
    due = F.col("collected") + F.col("lost")
    return stage_totals(transactions).select(
        "donor_id",
        F.col("collected").alias("total_collected"),
        due.alias("total_amount"),
        F.try_divide(F.col("collected").cast("double"), due.cast("double")).alias("effectiveness"),
    )


def donor_features(values: DataFrame, transactions: DataFrame) -> DataFrame:
    """Lifetime values with the collection columns; every donor stays."""
    return values.join(collection_effectiveness(transactions), "donor_id", "left")


def segmentation_input(features: DataFrame, donors: DataFrame) -> DataFrame:
    return features.join(donors.select("donor_id", "churn_prob"), "donor_id")


def category_counts(df: DataFrame, key: str, column: str, counted: str = "amount") -> DataFrame:
    """``key, category, n``: non-null ``counted`` per key and category found, null included."""
    return (df.filter(F.col(counted).isNotNull())
            .groupBy(key, F.col(column).alias("category")).agg(F.count("*").alias("n")))


def count_pivot(df: DataFrame, key: str, column: str, values: dict[str, str],
                counted: str = "amount", other: str = "other") -> DataFrame:
    """Non-null ``counted`` per key, one column per given category and ``other`` for all the rest.

    ``values`` is ``{category: column name}``; known categories make this one aggregate. The long form
    with every category is ``category_counts``.
    """
    listed = F.coalesce(F.col(column).isin(*values), F.lit(False))
    counts = [F.count(F.when(F.col(column) == category, F.col(counted))).alias(name)
              for category, name in values.items()]
    return df.groupBy(key).agg(*counts, F.count(F.when(~listed, F.col(counted))).alias(other))


def donor_channels(transactions: DataFrame, channel: str = "record_type") -> DataFrame:
    """Number of channels and most used channel per donor; ties go to the first name.

    Counts per (donor, channel) first, so a donor with very many rows is one row per channel
    before anything is gathered per donor.
    """
    known = F.col(channel).isNotNull() & F.col("amount").isNotNull()
    counts = (transactions.filter(known).groupBy("donor_id", channel)
              .agg(F.count("*").alias("n")))
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col(channel).alias("name")))
    return counts.groupBy("donor_id").agg(F.count("*").alias("channels"),
                                          best["name"].alias("main_channel"))


def conversion_days(donors: DataFrame) -> DataFrame:
    return donors.withColumn("conversion_days", F.datediff("first_charge", "capture_date"))


def experiment_table(values: DataFrame, donors: DataFrame, transactions: DataFrame) -> DataFrame:
    """Lifetime values with gender and channels, as the mixed-type experiment uses them."""
    people = donors.select("donor_id", "gender")
    return (values.join(people, "donor_id", "left")
            .join(donor_channels(transactions), "donor_id", "left"))
