"""Lifetime value."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, numbers
from ..operators import cleaning, features
from ..plans import lifetime
from .inputs import AS_OF
from .registry import query

REGULAR = "('DI - Regular', 'DI - Regular Montos Variables (BO)', 'DI - Regular Tiempo determinado', 'PF - Padrinazgo familiar', 'PI - Padrinazgo individual')"

_RATES = """rates AS (SELECT CAST(substr(period, 1, 4) AS INT) AS year, avg(pct) / 100 AS rate FROM inflation_m GROUP BY 1)"""
_REG = f"""reg AS (SELECT donor_id, tx_date, CAST(year(tx_date) AS INT) AS y, amount FROM transactions
  WHERE stage = 'Cobrada' AND record_type IN {REGULAR})"""
_FACTORS = f"""{_RATES}, {_REG},
growth AS (SELECT d.y, CASE WHEN d.y = 2001 THEN 1.0 ELSE 1 + r.rate END AS g
           FROM (SELECT DISTINCT y FROM reg) d LEFT JOIN rates r ON r.year = d.y),
factors AS (SELECT a.y, product(b.g) AS factor FROM growth a JOIN growth b ON b.y >= a.y GROUP BY a.y)"""
_HISTORY = f"""{_FACTORS},
yearly AS (SELECT donor_id, y, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS given FROM reg GROUP BY 1, 2),
history AS (SELECT donor_id, sum(given * factor ORDER BY yearly.y) AS total_value, min(yearly.y) AS first_year
            FROM yearly JOIN factors ON yearly.y = factors.y GROUP BY donor_id)"""
_LIFE = """life AS (SELECT donor_id, age, is_active, risk AS churn_max,
         CASE WHEN 100.0 / risk + age > 90 THEN CAST(90 - age AS DOUBLE) ELSE 100.0 / risk END AS lifespan
  FROM (SELECT *, CASE WHEN churn_prob IS NULL THEN coalesce(lapsed_prob, 0)
                       WHEN lapsed_prob IS NULL OR churn_prob > lapsed_prob THEN churn_prob
                       ELSE lapsed_prob END AS risk FROM donors) WHERE risk <> 0)"""
_LFV = f"""{_HISTORY}, {_LIFE},
joined AS (SELECT h.donor_id, h.total_value, h.first_year, l.lifespan, l.age, l.churn_max,
                  CAST(2001 - h.first_year AS INT) AS tenure_years,
                  h.total_value / (2001 - h.first_year + 1) AS yearly_average,
                  (SELECT rate FROM rates ORDER BY year DESC LIMIT 1) AS i
           FROM history h JOIN life l ON h.donor_id = l.donor_id WHERE l.is_active),
lfv AS (SELECT donor_id, total_value, first_year, lifespan, age, churn_max, tenure_years, yearly_average,
               CASE WHEN lifespan <= -1 THEN 0.0
                    ELSE list_sum(list_transform(range(1, 1 + CASE WHEN lifespan < 1 THEN 1 ELSE CAST(floor(lifespan) AS BIGINT) END),
                                                 lambda t: yearly_average / pow(1 + i, t))) END AS dltv
        FROM joined)"""
LFV_SQL = _LFV  # common table expressions up to ``lfv``, for other oracles


def regular_collected(t):
    return cleaning.regular_donations(cleaning.collected_transactions(t.transactions, AS_OF))


def lifetime_table(t):
    return lifetime.donor_lifetime_value(t.donors, t.transactions, t.inflation_m, AS_OF)


@query("inflation_yearly", f"WITH {_RATES} SELECT year, round(rate, 8) AS rate FROM rates")
def _(t):
    return lifetime.inflation_yearly(t.inflation_m).withColumn("rate", F.round("rate", 8))


@query("inflation_factors", f"WITH {_FACTORS} SELECT y AS year, round(factor, 8) AS factor FROM factors")
def _(t):
    years = regular_collected(t).select(F.col("tx_year").alias("year"))
    return lifetime.inflation_factors(years, lifetime.inflation_yearly(t.inflation_m), AS_OF).withColumn(
        "factor", F.round("factor", 8))


@query("lifespan", f"WITH {_LIFE} SELECT donor_id, age, churn_max, round(lifespan, 6) AS lifespan FROM life")
def _(t):
    return lifetime.lifespan(t.donors).select("donor_id", "age", "churn_max", F.round("lifespan", 6).alias("lifespan"))


@query("collected_transactions", """
SELECT tx_id, donor_id, tx_date, amount, record_type, CAST(month(tx_date) AS INT) AS tx_month,
       CAST(year(tx_date) AS INT) AS tx_year, CAST(2001 - year(tx_date) AS INT) AS years_ago
FROM transactions WHERE stage = 'Cobrada'""")
def _(t):
    return cleaning.collected_transactions(t.transactions, AS_OF).drop("stage")


@query("regular_donations", f"SELECT tx_id, donor_id, record_type, amount FROM transactions WHERE record_type IN {REGULAR}")
def _(t):
    return cleaning.regular_donations(t.transactions).select("tx_id", "donor_id", "record_type", "amount")


@query("first_year", f"WITH {_REG} SELECT donor_id, min(y) AS first_year FROM reg GROUP BY donor_id")
def _(t):
    return lifetime.first_year(regular_collected(t))


@query("yearly_donations", f"""WITH {_REG}
SELECT donor_id, y AS tx_year, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM reg GROUP BY 1, 2""")
def _(t):
    return lifetime.yearly_donations(regular_collected(t)).withColumn("amount", F.col("amount").cast("double"))


YEARS = list(range(1996, 2002))  # earlier years go to other_years


@query("yearly_donations_pivot", f"WITH {_REG} SELECT donor_id, " + ", ".join(
    f"CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (y = {y}), 0) AS DOUBLE) AS y{y}" for y in YEARS)
       + ", CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (y NOT BETWEEN 1996 AND 2001), 0) AS DOUBLE) AS other_years"
       + " FROM reg GROUP BY donor_id")
def _(t):
    return lifetime.yearly_donations_pivot(regular_collected(t), YEARS)


@query("present_value_history", f"""WITH {_HISTORY}
SELECT donor_id, round(total_value, 2) AS total_value, first_year FROM history""")
def _(t):
    inflation = lifetime.inflation_yearly(t.inflation_m)
    return lifetime.present_value_history(regular_collected(t), inflation, AS_OF).withColumn(
        "total_value", F.round("total_value", 2))


@query("annuity_pv", f"""WITH {_RATES}, {_LIFE},
p AS (SELECT donor_id, current_amount, l.lifespan,
             CAST(CASE WHEN l.lifespan <= -1 THEN 0 WHEN l.lifespan < 1 THEN 1 ELSE floor(l.lifespan) END AS INT) AS periods,
             (SELECT max_by(rate, year) FROM rates) AS i
      FROM donors JOIN life l USING (donor_id))
SELECT donor_id, periods,
       round(coalesce(list_sum(list_transform(range(1, periods + 1), lambda t: current_amount / pow(1 + i, t))), 0.0), 3) AS value
FROM p""")
def _(t):
    rate = lifetime.latest_rate(lifetime.inflation_yearly(t.inflation_m))
    periods = numbers.annuity_periods(F.col("lifespan"))
    return (lifetime.lifespan(t.donors).withColumns({"periods": periods, "i": rate})
            .select("donor_id", "periods", F.round(numbers.annuity_value(
                F.col("current_amount"), F.col("i"), F.col("periods")), 3).alias("value")))


@query("donor_lifetime_value", f"""WITH {_LFV}
SELECT donor_id, round(total_value, 2) AS total_value, first_year, round(lifespan, 6) AS lifespan, age, churn_max,
       tenure_years, round(yearly_average, 2) AS yearly_average, round(dltv, 2) AS dltv FROM lfv""")
def donor_lifetime_value(t):
    return lifetime_table(t).withColumns({
        "total_value": F.round("total_value", 2), "lifespan": F.round("lifespan", 6),
        "yearly_average": F.round("yearly_average", 2), "dltv": F.round("dltv", 2)})


@query("instalment_averages", f"""WITH {_LFV}
SELECT lfv.donor_id, round(instalments_paid / (tenure_years + 1), 6) AS avg_paid,
       round(instalments_unpaid / (tenure_years + 1), 6) AS avg_unpaid
FROM lfv JOIN donors USING (donor_id)""")
def _(t):
    return lifetime.with_instalment_averages(lifetime_table(t), t.donors).select(
        "donor_id", F.round("avg_paid", 6).alias("avg_paid"), F.round("avg_unpaid", 6).alias("avg_unpaid"))


@query("stage_totals", """
SELECT donor_id, CAST(trunc(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (stage = 'Cobrada'), 0)) AS BIGINT) AS collected,
       CAST(trunc(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (stage = 'Perdida'), 0)) AS BIGINT) AS lost
FROM transactions GROUP BY donor_id""")
def _(t):
    return features.stage_totals(t.transactions)


EFFECT_SQL = """effect AS (SELECT donor_id, c AS total_collected, c + l AS total_amount,
         CAST(c AS DOUBLE) / nullif(c + l, 0) AS effectiveness
  FROM (SELECT donor_id, CAST(trunc(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (stage = 'Cobrada'), 0)) AS BIGINT) AS c,
               CAST(trunc(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (stage = 'Perdida'), 0)) AS BIGINT) AS l
        FROM transactions GROUP BY donor_id))"""


@query("collection_effectiveness", f"""WITH {EFFECT_SQL}
SELECT donor_id, total_collected, total_amount, round(effectiveness, 8) AS effectiveness FROM effect""")
def _(t):
    return features.collection_effectiveness(t.transactions).withColumn("effectiveness", F.round("effectiveness", 8))


@query("donor_features", f"""WITH {_LFV}, {EFFECT_SQL}
SELECT lfv.donor_id, round(dltv, 2) AS dltv, total_collected, total_amount, round(effectiveness, 8) AS effectiveness
FROM lfv LEFT JOIN effect ON lfv.donor_id = effect.donor_id""")
def _(t):
    return features.donor_features(lifetime_table(t), t.transactions).select(
        "donor_id", F.round("dltv", 2).alias("dltv"), "total_collected", "total_amount",
        F.round("effectiveness", 8).alias("effectiveness"))


@query("segmentation_input", f"""WITH {_LFV}, {EFFECT_SQL}
SELECT lfv.donor_id, round(dltv, 2) AS dltv, d.churn_prob, round(effectiveness, 8) AS effectiveness
FROM lfv LEFT JOIN effect ON lfv.donor_id = effect.donor_id JOIN donors d ON d.donor_id = lfv.donor_id""")
def _(t):
    table = features.segmentation_input(features.donor_features(lifetime_table(t), t.transactions), t.donors)
    return table.select("donor_id", F.round("dltv", 2).alias("dltv"), "churn_prob",
                        F.round("effectiveness", 8).alias("effectiveness"))


KINDS = {"DI - Regular": "regular", "PF - Padrinazgo familiar": "family", "PI - Padrinazgo individual": "individual",
         "Unica": "single"}  # other kinds, such as Evento, go to other


@query("channel_counts_pivot", "SELECT donor_id, " + ", ".join(
    f"count(amount) FILTER (record_type = '{kind}') AS {name}" for kind, name in KINDS.items())
       + f", count(amount) FILTER (record_type NOT IN {tuple(KINDS)}) AS other FROM transactions GROUP BY donor_id")
def _(t):
    return features.count_pivot(t.transactions, "donor_id", "record_type", KINDS)


@query("channel_counts", "SELECT donor_id, record_type AS category, count(amount) AS n FROM transactions GROUP BY 1, 2")
def _(t):
    return features.category_counts(t.transactions, "donor_id", "record_type")


@query("stage_counts_pivot", "SELECT donor_id, " + ", ".join(
    f"count(amount) FILTER (stage = '{s}') AS {s.lower()}" for s in ("Cobrada", "Perdida"))
       + ", count(amount) FILTER (stage NOT IN ('Cobrada', 'Perdida')) AS other FROM transactions GROUP BY donor_id")
def _(t):
    return features.count_pivot(t.transactions, "donor_id", "stage", {s: s.lower() for s in ("Cobrada", "Perdida")})


@query("stage_counts_by_donor", "SELECT donor_id, stage AS category, count(amount) AS n FROM transactions GROUP BY 1, 2")
def _(t):
    return features.category_counts(t.transactions, "donor_id", "stage")


CHANNELS_SQL = """channels AS (SELECT donor_id, count(*) AS channels,
         first(record_type ORDER BY n DESC, record_type) AS main_channel
  FROM (SELECT donor_id, record_type, count(*) AS n FROM transactions GROUP BY 1, 2) GROUP BY donor_id)"""


@query("donor_channels", f"WITH {CHANNELS_SQL} SELECT donor_id, channels, main_channel FROM channels")
def _(t):
    return features.donor_channels(t.transactions)


@query("tenure_years", """
SELECT donor_id, min(tx_date) AS capture_date, CAST(2001 - year(min(tx_date)) AS INT) AS tenure
FROM transactions GROUP BY donor_id""")
def _(t):
    captured = t.transactions.groupBy("donor_id").agg(F.min("tx_date").alias("capture_date"))
    return captured.withColumn("tenure", dates.years_since(F.col("capture_date"), AS_OF))


@query("conversion_days", """
SELECT donor_id, CAST(datediff('day', min(tx_date), min(tx_date) FILTER (stage = 'Cobrada')) AS INT) AS conversion_days
FROM transactions GROUP BY donor_id""")
def _(t):
    first = t.transactions.groupBy("donor_id").agg(
        F.min("tx_date").alias("capture_date"),
        F.min(F.when(F.col("stage") == "Cobrada", F.col("tx_date"))).alias("first_charge"))
    return features.conversion_days(first).select("donor_id", "conversion_days")
