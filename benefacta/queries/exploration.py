"""Tables behind the exploratory charts."""

from __future__ import annotations

import datetime as dt
from itertools import combinations

from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import cleaning, exploration as ex, outliers, sampling
from ..plans import lifetime
from .registry import query

NUMERIC = ["age", "churn_prob", "lapsed_prob", "instalments_paid", "instalments_unpaid", "current_amount"]


@query("null_profile", """
SELECT * FROM (SELECT 'age' AS "column", count(*) FILTER (age IS NULL) AS nulls FROM donors
  UNION ALL SELECT 'churn_prob', count(*) FILTER (churn_prob IS NULL) FROM donors
  UNION ALL SELECT 'lapsed_prob', count(*) FILTER (lapsed_prob IS NULL) FROM donors) WHERE nulls > 0""")
def _(t):
    return ex.null_profile(t.donors)


@query("null_profile_raw", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM donors_raw"
    for c in ("psn", "capture_date", "children", "has_children", "amount_text")) + ") WHERE nulls > 0")
def _(t):
    return ex.null_profile(t.donors_raw)


@query("stage_counts", "SELECT stage, count(*) AS n FROM transactions GROUP BY stage")
def _(t):
    return ex.value_counts(t.transactions, "stage")


@query("gender_share", """
SELECT gender, count(*) AS n, round(count(*) / (SELECT count(*) FROM donors), 8) AS share FROM donors GROUP BY gender""")
def _(t):
    return ex.value_counts(t.donors, "gender", with_share=True).withColumn("share", F.round("share", 8))


@query("distinct_campaigns", "SELECT count(DISTINCT campaign) AS distinct_values FROM donors")
def _(t):
    return ex.distinct_values(t.donors, "campaign")


@query("top10_campaigns", "SELECT campaign, count(*) AS n FROM donors GROUP BY campaign ORDER BY n DESC, campaign LIMIT 10")
def _(t):
    return ex.top_values(t.donors, "campaign")


@query("future_tx_by_stage", "SELECT stage, count(*) AS n FROM transactions WHERE tx_date > DATE '2001-01-15' GROUP BY stage")
def _(t):
    return ex.value_counts(cleaning.future_transactions(t.transactions, dt.date(2001, 1, 15)), "stage")


def _describe_sql(table: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        stats = {"count": f"CAST(count({c}) AS DOUBLE)", "mean": f"avg({c})", "std": f"stddev_samp({c})",
                 "min": f"CAST(min({c}) AS DOUBLE)", "25%": f"quantile_cont({c}, 0.25)",
                 "50%": f"quantile_cont({c}, 0.5)", "75%": f"quantile_cont({c}, 0.75)",
                 "max": f"CAST(max({c}) AS DOUBLE)"}
        parts += [f"SELECT '{c}' AS \"column\", '{s}' AS statistic, CAST(round({e}, 2) AS DOUBLE) AS value FROM {table}"
                  for s, e in stats.items()]
    return " UNION ALL ".join(parts)


@query("describe_columns", _describe_sql("donors", NUMERIC))
def _(t):
    return ex.describe_columns(t.donors, NUMERIC)


@query("describe_event_values", _describe_sql("events", ["value"]))
def _(t):
    return ex.describe_columns(t.events, ["value"])


@query("describe_collected", _describe_sql("(SELECT amount FROM transactions WHERE stage = 'Cobrada') s", ["amount"]))
def _(t):
    return ex.describe_columns(t.transactions.filter(F.col("stage") == "Cobrada"), ["amount"])


@query("amount_by_date", """
SELECT tx_date, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM transactions
WHERE stage = 'Cobrada' GROUP BY tx_date""")
def _(t):
    return ex.by_date(t.transactions.filter(F.col("stage") == "Cobrada"), "tx_date", "amount", "amount")


@query("captures_by_date", """
SELECT capture_date, count(*) AS n FROM (SELECT donor_id, min(tx_date) AS capture_date FROM transactions GROUP BY donor_id)
GROUP BY capture_date""")
def _(t):
    captured = t.transactions.groupBy("donor_id").agg(F.min("tx_date").alias("capture_date"))
    return ex.by_date(captured, "capture_date")


def banded(t):
    return t.donors.filter("age is not null").withColumn("band", numbers.age_band(F.col("age")))


_BANDED = """b AS (SELECT donor_id, gender, CASE WHEN age < 30 THEN 'Adulto Joven' WHEN age < 59 THEN 'Adulto' ELSE 'Tercera Edad' END AS band
  FROM donors WHERE age IS NOT NULL)"""


@query("mean_by_category", f"""WITH {_BANDED}
SELECT stage, band, count(*) AS n, round(avg(amount), 4) AS mean,
       round(stddev_samp(amount) / sqrt(count(*)), 4) AS standard_error
FROM transactions JOIN b USING (donor_id) GROUP BY stage, band""")
def _(t):
    return ex.donor_mean_by_category(t.transactions, banded(t), "stage", "band").withColumns(
        {"mean": F.round("mean", 4), "standard_error": F.round("standard_error", 4)})


@query("mean_by_gender", """
SELECT stage, gender, count(*) AS n, round(avg(amount), 4) AS mean,
       round(stddev_samp(amount) / sqrt(count(*)), 4) AS standard_error
FROM transactions JOIN donors USING (donor_id) GROUP BY stage, gender""")
def _(t):
    return ex.donor_mean_by_category(t.transactions, t.donors, "stage", "gender").withColumns(
        {"mean": F.round("mean", 4), "standard_error": F.round("standard_error", 4)})


@query("mean_by_marital_status", """
SELECT marital_status, count(*) AS n, round(avg(amount), 4) AS mean,
       round(stddev_samp(amount) / sqrt(count(*)), 4) AS standard_error
FROM transactions t JOIN donor_file f ON t.donor_id = CAST(f.donor_id AS BIGINT) GROUP BY marital_status""")
def _(t):
    people = t.donor_file.select(F.col("donor_id").cast("bigint").alias("donor_id"), "marital_status")
    return ex.donor_mean_by_category(t.transactions, people, None, "marital_status").withColumns(
        {"mean": F.round("mean", 4), "standard_error": F.round("standard_error", 4)})


@query("count_payment_by_band", f"""WITH {_BANDED}
SELECT payment_method, band, count(*) AS n FROM transaction_file t JOIN b ON CAST(t.donor_id AS BIGINT) = b.donor_id
GROUP BY payment_method, band""")
def _(t):
    paid = t.transaction_file.select(F.col("donor_id").cast("bigint").alias("donor_id"), "payment_method")
    return ex.donor_count_by_category(paid, banded(t), "payment_method", "band")


@query("count_by_category", f"""WITH {_BANDED}
SELECT record_type, band, count(*) AS n FROM transactions JOIN b USING (donor_id) GROUP BY record_type, band""")
def _(t):
    return ex.donor_count_by_category(t.transactions, banded(t), "record_type", "band")


@query("tx_with_donor", """
SELECT tx_id, donor_id, amount, stage, age, gender, CAST(month(tx_date) AS INT) AS tx_month, CAST(year(tx_date) AS INT) AS tx_year
FROM transactions JOIN donors USING (donor_id)""")
def _(t):
    people = t.donors.select("donor_id", "age", "gender")
    return ex.transactions_with_donor(t.transactions, people).select(
        "tx_id", "donor_id", "amount", "stage", "age", "gender", F.month("tx_date").alias("tx_month"),
        F.year("tx_date").alias("tx_year"))


def _histogram_sql(table: str, column: str) -> str:
    return f"""
SELECT bin, round(lo + (bin - 1) * (hi - lo) / 20, 6) AS lower, round(lo + bin * (hi - lo) / 20, 6) AS upper, count(*) AS n
FROM (SELECT lo, hi, CAST(least(floor(20 * ({column} - lo) / (hi - lo)) + 1, 20) AS INT) AS bin
      FROM {table}, (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {table})
      WHERE {column} IS NOT NULL) GROUP BY bin, lo, hi"""


@query("histogram20", _histogram_sql("events", "value"))
def _(t):
    return ex.histogram(t.events, "value").withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query("histogram20_age", _histogram_sql("donors", "age"))
def _(t):
    return ex.histogram(t.donors, "age").withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


_BOX = """
SELECT {keys} "column", round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(least(q1, min(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))), 4) AS whisker_low,
       round(greatest(q3, max(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))), 4) AS whisker_high,
       count(*) FILTER (NOT (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))) AS fliers
FROM long JOIN (SELECT {keys} "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                       quantile_cont(v, 0.75) AS q3 FROM long GROUP BY {keys} "column") USING ({keys} "column")
GROUP BY {keys} "column", q1, median, q3"""
_BOX_COLUMNS = ("q1", "median", "q3", "whisker_low", "whisker_high")


@query("boxplot_stats", """WITH long AS (
  SELECT 'instalments_paid' AS "column", CAST(instalments_paid AS DOUBLE) AS v FROM donors
  UNION ALL SELECT 'instalments_unpaid', CAST(instalments_unpaid AS DOUBLE) FROM donors)""" + _BOX.format(keys=""))
def _(t):
    boxes = ex.box_statistics(t.donors, ["instalments_paid", "instalments_unpaid"])
    return boxes.withColumns({c: F.round(c, 4) for c in _BOX_COLUMNS})


@query("boxplot_events", """WITH long AS (
  SELECT event_type, 'value' AS "column", value AS v FROM events)""" + _BOX.format(keys="event_type,"))
def _(t):
    boxes = ex.box_statistics(t.events, ["value"], ("event_type",))
    return boxes.withColumns({c: F.round(c, 4) for c in _BOX_COLUMNS})


@query("boxplot_by_user", """WITH long AS (
  SELECT user_id, 'value' AS "column", value AS v FROM events)""" + _BOX.format(keys="user_id,"))
def _(t):
    boxes = ex.box_statistics(t.events, ["value"], ("user_id",))
    return boxes.withColumns({c: F.round(c, 4) for c in _BOX_COLUMNS})


_BOX_YEARS = [1999, 2000, 2001]


@query("boxplot_by_year", "WITH paid AS (SELECT donor_id, " + ", ".join(
    f"CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (year(tx_date) = {y}), 0) AS DOUBLE) AS y{y}" for y in _BOX_YEARS)
       + " FROM transactions WHERE stage = 'Cobrada' AND donor_id IN (SELECT donor_id FROM donors) GROUP BY donor_id), long AS ("
       + " UNION ALL ".join(f"SELECT 'y{y}' AS \"column\", y{y} AS v FROM paid" for y in _BOX_YEARS) + ")"
       + _BOX.format(keys=""))
def _(t):
    collected = cleaning.collected_transactions(t.transactions, dt.date(2001, 8, 2))
    yearly = lifetime.yearly_donations_pivot(collected, _BOX_YEARS).join(t.donors.select("donor_id"), "donor_id", "left_semi")
    boxes = ex.box_statistics(yearly, [f"y{y}" for y in _BOX_YEARS])
    return boxes.withColumns({c: F.round(c, 4) for c in _BOX_COLUMNS})


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{b}' AS column_a, '{a}' AS column_b, round(corr({a}, {b}), 8) AS correlation FROM donors"
    for a, b in combinations(NUMERIC, 2)))
def _(t):
    return ex.correlation_matrix(t.donors, NUMERIC).withColumn("correlation", F.round("correlation", 8))


@query("scatter_bins", """
SELECT CAST(least(floor(20 * (age - alo) / (ahi - alo)) + 1, 20) AS INT) AS x_bin,
       CAST(least(floor(20 * (current_amount - clo) / (chi - clo)) + 1, 20) AS INT) AS y_bin, count(*) AS n
FROM donors, (SELECT CAST(min(age) AS DOUBLE) AS alo, CAST(max(age) AS DOUBLE) AS ahi, min(current_amount) AS clo,
                     max(current_amount) AS chi FROM donors WHERE age IS NOT NULL AND current_amount IS NOT NULL)
WHERE age IS NOT NULL AND current_amount IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return ex.scatter_bins(t.donors, "age", "current_amount")


@query("scatter_age_amount", """WITH d AS (
  SELECT age, amount FROM transactions JOIN donors USING (donor_id) WHERE age IS NOT NULL)
SELECT CAST(least(floor(20 * (age - alo) / (ahi - alo)) + 1, 20) AS INT) AS x_bin,
       CAST(least(floor(20 * (amount - clo) / (chi - clo)) + 1, 20) AS INT) AS y_bin, count(*) AS n
FROM d, (SELECT CAST(min(age) AS DOUBLE) AS alo, CAST(max(age) AS DOUBLE) AS ahi, min(amount) AS clo, max(amount) AS chi FROM d)
GROUP BY 1, 2""")
def _(t):
    joined = ex.transactions_with_donor(t.transactions, t.donors.select("donor_id", "age"))
    return ex.scatter_bins(joined, "age", "amount")


_PAIR_COLUMNS = ["age", "churn_prob", "instalments_paid", "current_amount"]


@query("pair_bins", "WITH " + ", ".join(
    f"b_{c} AS (SELECT donor_id, CASE WHEN {c} IS NOT NULL THEN CAST(least(floor(20 * ({c} - lo) / (hi - lo)) + 1, 20) AS INT) END AS bin FROM donors, "
    f"(SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM donors))" for c in _PAIR_COLUMNS)
       + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, p.bin AS x_bin, q.bin AS y_bin, count(*) AS n FROM b_{a} p JOIN b_{b} q USING (donor_id) "
    f"WHERE p.bin IS NOT NULL AND q.bin IS NOT NULL GROUP BY 3, 4" for a, b in combinations(_PAIR_COLUMNS, 2)))
def _(t):
    return ex.pair_bins(t.donors, _PAIR_COLUMNS)


@query("cluster_scatter", """
SELECT label AS cluster, CAST(least(floor(20 * (a - alo) / (ahi - alo)) + 1, 20) AS INT) AS x_bin,
       CAST(least(floor(20 * (b - blo) / (bhi - blo)) + 1, 20) AS INT) AS y_bin, count(*) AS n
FROM (SELECT label, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b FROM embeddings),
     (SELECT CAST(min(embedding[1]) AS DOUBLE) AS alo, CAST(max(embedding[1]) AS DOUBLE) AS ahi,
             CAST(min(embedding[2]) AS DOUBLE) AS blo, CAST(max(embedding[2]) AS DOUBLE) AS bhi FROM embeddings)
GROUP BY 1, 2, 3""")
def _(t):
    frame = t.embeddings.select(F.col("label").alias("cluster"), *[
        F.col("embedding")[i].cast("double").alias(f"x{i}") for i in (0, 1)])
    return ex.scatter_bins(frame, "x0", "x1", by=("cluster",))


_FENCES = """fences AS (SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))"""


@query("iqr_outliers", f"""WITH {_FENCES}
SELECT event_id, value, value < lower OR value > upper AS is_outlier FROM events, fences WHERE value IS NOT NULL""")
def _(t):
    normal, out = outliers.split_outliers(t.events.select("event_id", "value"), "value")
    return normal.withColumn("is_outlier", F.lit(False)).unionByName(out.withColumn("is_outlier", F.lit(True)))


_CHAINED = f"""{_FENCES},
step1 AS (SELECT *, value < lower OR value > upper AS out1, user_id AS score FROM events, fences),
fences2 AS (SELECT q1 - 1.5 * (q3 - q1) AS lower2, q3 + 1.5 * (q3 - q1) AS upper2
  FROM (SELECT quantile_cont(score * score, 0.25) AS q1, quantile_cont(score * score, 0.75) AS q3 FROM step1 WHERE NOT out1)),
labelled AS (SELECT event_id, value, score * score AS score, out1 OR score * score < lower2 OR score * score > upper2 AS is_outlier
  FROM step1, fences2)"""


def _chained(t):
    frame = t.events.select("event_id", "value", (F.col("user_id") * F.col("user_id")).alias("score"))
    return outliers.split_outliers_chained(frame, ["value", "score"])


@query("iqr_chained", f"WITH {_CHAINED} SELECT event_id, value, score FROM labelled WHERE NOT is_outlier")
def _(t):
    return _chained(t)[0]


@query("union_outliers", f"WITH {_CHAINED} SELECT event_id, value, score, is_outlier FROM labelled")
def _(t):
    normal, out = _chained(t)
    return normal.withColumn("is_outlier", F.lit(False)).unionByName(out.withColumn("is_outlier", F.lit(True)))


@query("seeded_sample", """
SELECT donor_id, age, gender FROM donors ORDER BY md5('1:' || CAST(donor_id AS VARCHAR)), donor_id LIMIT 1000""")
def _(t):
    return sampling.seeded_sample(t.donors.select("donor_id", "age", "gender"), "donor_id")
