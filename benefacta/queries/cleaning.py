"""Cleaning steps and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, labels, numbers, places, text
from ..operators import cleaning, joins, scaling, scoring
from ..plans import cleaning_jobs
from ..session import materialise
from ..sources import readers, schemas
from .inputs import AS_OF
from .registry import query

_PARSED = "CAST(coalesce(try_strptime(capture_date, '%Y-%m-%d'), try_strptime(capture_date, '%d/%m/%Y')) AS DATE)"


def raw_file(view, layout):
    """A file view under the headers of the client file."""
    return view.select(*[F.col(f.name).alias(f.raw) for f in layout])


def with_capture(t):
    return t.donors_raw.select(F.col("psn").cast("bigint").alias("donor_id"),
                               dates.tolerant_date(F.col("capture_date"), dates.DAY_FIRST).alias("capture_date"))


@query("split_text_dates", """
SELECT psn, capture_date, coalesce(regexp_matches(capture_date, '[A-Za-z]'), false) AS is_error FROM donors_raw""")
def _(t):
    kept, errors = cleaning.split_text_dates(t.donors_raw, "capture_date")
    return (kept.withColumn("is_error", F.lit(False)).unionByName(errors.withColumn("is_error", F.lit(True)))
            .select("psn", "capture_date", "is_error"))


@query("parse_dates", f"SELECT psn, {_PARSED} AS capture_date FROM donors_raw")
def _(t):
    return t.donors_raw.select("psn", dates.tolerant_date(F.col("capture_date"), dates.DAY_FIRST).alias("capture_date"))


@query("drop_sentinel", "SELECT psn, capture_date FROM donors_raw WHERE capture_date IS DISTINCT FROM 'Nº de error'")
def _(t):
    return cleaning.drop_sentinel(t.donors_raw, "capture_date").select("psn", "capture_date")


@query("conform_donors", """
SELECT CAST(donor_id AS BIGINT) AS donor_id, CAST(birth_date AS DATE) AS birth_date,
       CAST(coalesce(try_strptime(capture_date, '%Y-%m-%d'), try_strptime(capture_date, '%m/%d/%Y')) AS DATE) AS capture_date,
       CAST(try_strptime(payment_anniversary, '%Y-%m-%d') AS DATE) AS payment_anniversary,
       CAST(age AS INT) AS age, TRY_CAST(children AS INT) AS children,
       TRY_CAST(churn_prob AS DOUBLE) AS churn_prob, TRY_CAST(lapsed_prob AS DOUBLE) AS lapsed_prob,
       CASE has_children WHEN 'Si' THEN true WHEN 'No' THEN false END AS has_children,
       is_active = '1' AS is_active, contact_type, gender, marital_status, occupation, rfm_segment,
       CAST(instalments_paid AS INT) AS instalments_paid,
       CAST(trunc(CAST(instalments_unpaid AS DOUBLE)) AS INT) AS instalments_unpaid, campaign, city, department,
       CAST(current_amount AS DOUBLE) AS current_amount
FROM donor_file""")
def _(t):
    return cleaning.conform(raw_file(t.donor_file, schemas.DONORS), schemas.DONORS, dates.MONTH_FIRST)


@query("active_donors", "SELECT donor_id, is_active FROM donors")
def _(t):
    active, inactive = cleaning.split_active(t.donors)
    return active.unionByName(inactive).select("donor_id", "is_active")


@query("recent_donor_split", f"""
SELECT donor_id, capture_date, CASE WHEN capture_date < DATE '2001-05-04' THEN 'older' ELSE 'newer' END AS side
FROM (SELECT CAST(psn AS BIGINT) AS donor_id, {_PARSED} AS capture_date FROM donors_raw)
WHERE capture_date <> DATE '2001-05-04'""")
def _(t):
    older, newer = cleaning.split_recent(with_capture(t), "capture_date", dates.days_before(AS_OF))
    return older.withColumn("side", F.lit("older")).unionByName(newer.withColumn("side", F.lit("newer")))


@query("recent_donor_split_quarter", f"""
SELECT donor_id, capture_date FROM (SELECT CAST(psn AS BIGINT) AS donor_id, {_PARSED} AS capture_date FROM donors_raw)
WHERE capture_date < DATE '2001-01-31'""")
def _(t):
    return cleaning.split_recent(with_capture(t), "capture_date", dates.quarter_start_cutoff(AS_OF))[0]


@query("age_range", "SELECT donor_id, age FROM donors WHERE age >= 18 AND age <= 90")
def _(t):
    return cleaning.in_age_range(t.donors).select("donor_id", "age")


_AGES = """ages AS (SELECT donor_id, age AS old_age, coalesce(age >= 18 AND age <= 90, false) AS valid,
         (SELECT CAST(floor(avg(age)) AS INT) FROM donors WHERE age >= 18 AND age <= 90) AS mean_age FROM donors)"""


@query("fix_ages", f"""WITH {_AGES}
SELECT donor_id, CASE WHEN valid THEN old_age ELSE mean_age END AS age, NOT valid AS age_was_error FROM ages""")
def _(t):
    return cleaning.fix_ages(t.donors, AS_OF).select("donor_id", "age", "age_was_error")


@query("age_errors", f"WITH {_AGES} SELECT donor_id, mean_age AS age FROM ages WHERE NOT valid")
def _(t):
    return cleaning.fix_ages(t.donors, AS_OF).filter("age_was_error").select("donor_id", "age")


@query("rebuild_birthdate", f"""WITH {_AGES}
SELECT donor_id, CASE WHEN valid THEN DATE '1960-01-01' + CAST(donor_id % 365 AS INT)
                      ELSE DATE '2001-08-02' - mean_age * 365 END AS birth_date FROM ages""")
def _(t):
    born = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("donor_id") % 365).cast("int"))
    return cleaning.fix_ages(t.donors.withColumn("birth_date", born), AS_OF).select("donor_id", "birth_date")


_CHILDREN = """CASE WHEN has_children = 'No' THEN 0 WHEN children = 'mas de 10' THEN 10
                    ELSE CAST(TRY_CAST(children AS DOUBLE) AS INT) END"""


@query("fix_children", f"SELECT psn, {_CHILDREN} AS children, coalesce(children = 'mas de 10', false) AS was_text FROM donors_raw")
def _(t):
    fixed = cleaning.children_count(F.col("children"), F.col("has_children"))
    was_text = F.coalesce(F.col("children") == cleaning.MORE_THAN_TEN, F.lit(False))
    return t.donors_raw.select("psn", fixed.alias("children"), was_text.alias("was_text"))


@query("has_children", f"SELECT psn, coalesce({_CHILDREN}, 0) > 0 AS has_children FROM donors_raw")
def _(t):
    fixed = cleaning.children_count(F.col("children"), F.col("has_children"))
    return t.donors_raw.select("psn", cleaning.has_children(fixed).alias("has_children"))


@query("fill_defaults", """
SELECT donor_id, coalesce(age, 0) AS age, coalesce(churn_prob, 0) AS churn_prob, coalesce(lapsed_prob, 0) AS lapsed_prob,
       is_active, instalments_paid, instalments_unpaid, gender, current_amount, department, campaign FROM donors""")
def _(t):
    return cleaning.fill_defaults(t.donors)


@query("normalise_prob", """
SELECT donor_id, churn_prob / 100 AS churn_fraction,
       CASE WHEN lapsed_prob > 1 THEN lapsed_prob / 100 ELSE lapsed_prob END AS lapsed_fraction FROM donors""")
def _(t):
    return t.donors.select("donor_id", numbers.percent_to_fraction(F.col("churn_prob")).alias("churn_fraction"),
                           numbers.percent_to_fraction(F.col("lapsed_prob"), True).alias("lapsed_fraction"))


@query("coalesce_dates", f"""
SELECT psn, coalesce({_PARSED}, d) AS anniversary FROM donors_raw
JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1) o ON CAST(psn AS BIGINT) = o.o_custkey""")
def _(t):
    first = t.orders.groupBy(F.col("o_custkey").cast("string").alias("psn")).agg(
        F.min("o_orderdate").cast("date").alias("d"))
    parsed = dates.tolerant_date(F.col("capture_date"), dates.DAY_FIRST)
    return t.donors_raw.join(first, "psn").select("psn", F.coalesce(parsed, "d").alias("anniversary"))


@query("anniversary_in_year", """
SELECT tx_id, CASE WHEN month(tx_date) = 2 AND day(tx_date) = 29 THEN NULL
                   ELSE make_date(2023, month(tx_date), day(tx_date)) END AS anniversary FROM transactions""")
def _(t):
    return t.transactions.select("tx_id", dates.in_year(F.col("tx_date"), 2023).alias("anniversary"))


@query("decimal_comma", "SELECT psn, TRY_CAST(replace(amount_text, ',', '.') AS DOUBLE) AS amount FROM donors_raw")
def _(t):
    return t.donors_raw.select("psn", text.decimal_comma(F.col("amount_text")).alias("amount"))


# The letters of Latin-1 that lose a mark, written down apart from the code: one string of marked letters per plain one.
_BARE = {"A": "ÀÁÂÃÄÅ", "C": "Ç", "E": "ÈÉÊË", "I": "ÌÍÎÏ", "D": "Ð", "N": "Ñ", "O": "ÒÓÔÕÖØ", "U": "ÙÚÛÜ", "Y": "ÝŸ",
         "a": "àáâãäå", "c": "ç", "e": "èéêë", "i": "ìíîï", "d": "ð", "n": "ñ", "o": "òóôõöø", "u": "ùúûü", "y": "ýÿ",
         "x": "×", "/": "÷"}


# A word counts if its whole run of letters, digits and underscores consists of Latin-1 letters.
_WORDS = r"""list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'), lambda w: regexp_full_match(w, '[A-Za-zÀ-ÖØ-öø-ÿ]+'))"""
_TITLED = f"array_to_string(list_transform({_WORDS}, lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || lower(w[2:])), ' ')"


@query("place_tokens", f"SELECT doc_id, {_TITLED} AS words FROM documents")
def _(t):
    return t.documents.select("doc_id", text.letter_words(F.col("text")).alias("words"))


_PAIRS = [("Æ", "AE"), ("æ", "ae"), ("Þ", "Th"), ("þ", "th"), ("ß", "ss")]


def _plain_sql(col: str) -> str:
    out = col
    for bare, marked in _BARE.items():
        out = f"regexp_replace({out}, '[{marked}]', '{bare}', 'g')"
    for letter, pair in _PAIRS:
        out = f"replace({out}, '{letter}', '{pair}')"
    return out


@query("strip_accents", f"SELECT doc_id, {_plain_sql('text')} AS plain FROM documents")
def _(t):
    return t.documents.select("doc_id", text.strip_accents(F.col("text")).alias("plain"))


@query("canonical_city", """
SELECT psn, city_text, coalesce(city, '') AS city FROM donors_raw d LEFT JOIN places_city p ON d.place_id = p.place_id""")
def _(t):
    typed = t.donors_raw.join(t.places_city.select("place_id", "city_text"), "place_id", "left")
    return places.canonical_places(typed.withColumn("city", F.col("city_text")), {"city": places.CITY_RULES}).select(
        "psn", "city_text", "city")


@query("canonical_department", """
SELECT psn, coalesce(department, '') AS department
FROM donors_raw d LEFT JOIN places_department p ON d.department_id = p.place_id""")
def _(t):
    typed = t.donors_raw.join(t.places_department.select(F.col("place_id").alias("department_id"), F.col(
        "department_text").alias("department")), "department_id", "left")
    return places.canonical_places(typed, {"department": places.DEPARTMENT_RULES}).select("psn", "department")


_CLEAN = f"""typed AS (SELECT CAST(donor_id AS BIGINT) AS donor_id, CAST(birth_date AS DATE) AS birth_date,
         CAST(coalesce(try_strptime(capture_date, '%Y-%m-%d'), try_strptime(capture_date, '%m/%d/%Y')) AS DATE) AS capture_date,
         coalesce(regexp_matches(payment_anniversary, '[A-Za-z]'), false) AS text_date,
         CAST(try_strptime(payment_anniversary, '%Y-%m-%d') AS DATE) AS payment_anniversary,
         CAST(age AS INT) AS old_age, coalesce(CAST(age AS INT) BETWEEN 18 AND 90, false) AS valid,
         coalesce({_CHILDREN}, 0) AS children, coalesce(CAST(churn_prob AS DOUBLE), 0) AS churn_prob,
         coalesce(CAST(lapsed_prob AS DOUBLE), 0) AS lapsed_prob, is_active = '1' AS is_active, contact_type, gender,
         marital_status, occupation, rfm_segment, CAST(instalments_paid AS INT) AS instalments_paid,
         CAST(CAST(instalments_unpaid AS DOUBLE) AS INT) AS instalments_unpaid, campaign, city AS ct, department AS dt,
         CAST(current_amount AS DOUBLE) AS current_amount
  FROM donor_file),
mean AS (SELECT CAST(floor(avg(old_age)) AS INT) AS mean_age FROM typed WHERE valid AND NOT text_date),
cleaned AS (SELECT donor_id, CASE WHEN valid THEN birth_date ELSE DATE '2001-08-02' - mean_age * 365 END AS birth_date,
         capture_date, payment_anniversary, CASE WHEN valid THEN old_age ELSE mean_age END AS age, children,
         children > 0 AS has_children, churn_prob, lapsed_prob, is_active, contact_type, gender, marital_status,
         occupation, rfm_segment, instalments_paid, instalments_unpaid, campaign, coalesce(pc.city, '') AS city,
         coalesce(pd.department, '') AS department, current_amount, NOT valid AS age_was_error,
         CASE WHEN text_date THEN 'text_date' WHEN capture_date IS NULL THEN 'no_capture_date'
              WHEN capture_date < DATE '2001-05-04' THEN 'ok' WHEN capture_date > DATE '2001-05-04' THEN 'new'
              ELSE 'cutoff' END AS row_status
  FROM typed CROSS JOIN mean LEFT JOIN places_city pc ON ct = pc.city_text
  LEFT JOIN places_department pd ON dt = pd.department_text)"""


def cleaned_donors(t):
    staged = materialise(raw_file(t.donor_file, schemas.DONORS), "donors-raw")  # as the cleaning job does
    return cleaning_jobs.clean_donors(staged, AS_OF)


@query("clean_donors", f"WITH {_CLEAN} SELECT * FROM cleaned")
def _(t):
    return cleaned_donors(t)


@query("clean_donors_status", f"""WITH {_CLEAN}
SELECT row_status, age_was_error, count(*) AS n FROM cleaned GROUP BY 1, 2""")
def _(t):
    return cleaned_donors(t).groupBy("row_status", "age_was_error").agg(F.count("*").alias("n"))


def _day_first(col):
    return f"CAST(coalesce(try_strptime({col}, '%Y-%m-%d'), try_strptime({col}, '%d/%m/%Y')) AS DATE) AS {col}"


@query("clean_transactions", f"""
SELECT CAST(donor_id AS BIGINT) AS donor_id, {_day_first('tx_date')}, {_day_first('booking_date')},
       {_day_first('first_charge')}, {_day_first('last_donation')},
       TRY_CAST(replace(amount, ',', '.') AS DOUBLE) AS amount, stage, campaign_channel, status, commitment,
       payment_method, record_type,
       CASE WHEN regexp_matches(tx_date, '[A-Za-z]') THEN 'text_date' ELSE 'ok' END AS row_status
FROM transaction_file""")
def _(t):
    return cleaning_jobs.clean_transactions(raw_file(t.transaction_file, schemas.TRANSACTIONS))


@query("clean_cancellations", f"""
SELECT CAST(donor_id AS BIGINT) AS donor_id, {_day_first('cancel_date')}, {_day_first('first_charge')},
       {_day_first('last_donation')}, reason, status,
       CASE WHEN regexp_matches(cancel_date, '[A-Za-z]') THEN 'text_date' ELSE 'ok' END AS row_status
FROM cancellation_file""")
def _(t):
    return cleaning_jobs.clean_cancellations(raw_file(t.cancellation_file, schemas.CANCELLATIONS))


@query("exploration_donors", f"""
SELECT donor_id, capture_date, CASE WHEN month(a) = 2 AND day(a) = 29 THEN NULL ELSE make_date(2023, month(a), day(a)) END AS payment_anniversary,
       age, children, children > 0 AS has_children,
       CASE WHEN churn_prob > 1 THEN churn_prob / 100 ELSE churn_prob END AS churn_prob,
       CASE WHEN lapsed_prob > 1 THEN lapsed_prob / 100 ELSE lapsed_prob END AS lapsed_prob
FROM (SELECT CAST(donor_id AS BIGINT) AS donor_id, capture_date, coalesce(CAST(try_strptime(payment_anniversary, '%Y-%m-%d') AS DATE), capture_date) AS a,
             CAST(age AS INT) AS age, CAST(coalesce(CASE WHEN children = 'mas de 10' THEN 10 ELSE TRY_CAST(children AS DOUBLE) END, 0) AS INT) AS children,
             TRY_CAST(churn_prob AS DOUBLE) AS churn_prob, TRY_CAST(lapsed_prob AS DOUBLE) AS lapsed_prob, is_active, payment_anniversary
      FROM (SELECT * REPLACE (CAST(coalesce(try_strptime(capture_date, '%Y-%m-%d'), try_strptime(capture_date, '%m/%d/%Y')) AS DATE) AS capture_date) FROM donor_file))
WHERE payment_anniversary IS DISTINCT FROM 'Nº de error' AND is_active = '1' AND age BETWEEN 18 AND 90
  AND capture_date < DATE '2001-01-31'""")
def _(t):
    keep_text = ("children", "payment_anniversary")
    layout = [f._replace(kind="string") if f.name in keep_text else f for f in schemas.DONORS]
    typed = cleaning.conform(raw_file(t.donor_file, schemas.DONORS), layout, dates.MONTH_FIRST)
    return cleaning_jobs.prepare_exploration(typed, AS_OF, 2023).select(
        "donor_id", "capture_date", "payment_anniversary", "age", "children", "has_children", "churn_prob", "lapsed_prob")


@query("age_band_order", """
SELECT donor_id, CASE WHEN age < 30 THEN 'Adulto Joven' WHEN age < 59 THEN 'Adulto' ELSE 'Tercera Edad' END AS band,
       CAST(CASE WHEN age < 30 THEN 0 WHEN age < 59 THEN 1 ELSE 2 END AS INT) AS band_rank FROM donors""")
def _(t):
    return t.donors.withColumn("band", numbers.age_band(F.col("age"))).select(
        "donor_id", "band", numbers.age_band_rank(F.col("band")).alias("band_rank"))


@query("age_bands", """
SELECT CASE WHEN age < 30 THEN 'Adulto Joven' WHEN age < 59 THEN 'Adulto' ELSE 'Tercera Edad' END AS band, count(*) AS n
FROM donors WHERE age IS NOT NULL GROUP BY 1""")
def _(t):
    known = t.donors.filter("age is not null")
    return known.groupBy(numbers.age_band(F.col("age")).alias("band")).agg(F.count("*").alias("n"))


_NAMES = "CASE label WHEN 0 THEN 'Hibernando' WHEN 1 THEN 'Comprometidos' WHEN 2 THEN 'En riesgo' WHEN 3 THEN 'Campeones' WHEN 4 THEN 'En fuga' END"


@query("map_segment_names", f"SELECT vec_id, {_NAMES} AS segment FROM embeddings")
def _(t):
    return labels.map_columns(t.embeddings.select("vec_id", F.col("label").alias("segment")), ["segment"], labels.SEGMENTS)


@query("segment_label_fallback", f"SELECT vec_id, coalesce({_NAMES}, 'No se puede clasificar') AS segment FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", labels.segment_label(F.col("label")).alias("segment"))


@query("drop_null_features", "SELECT donor_id, age, churn_prob, lapsed_prob FROM donors WHERE age IS NOT NULL AND churn_prob IS NOT NULL AND lapsed_prob IS NOT NULL")
def _(t):
    return scoring.drop_null_features(t.donors, ["age", "churn_prob", "lapsed_prob"]).select(
        "donor_id", "age", "churn_prob", "lapsed_prob")


@query("parse_requests", """
SELECT request_id, CAST(0 AS INT) AS position, churn, dltv, effectiveness FROM requests
UNION ALL SELECT request_id, CAST(1 AS INT), churn, dltv, '0' FROM requests""")
def _(t):
    def record(effectiveness):
        return F.struct(F.col("churn").alias("Churn"), F.col("dltv").alias("DLTV"),
                        effectiveness.alias("Efectividad_cobro"))

    inputs = F.array(record(F.col("effectiveness")), record(F.lit("0")))
    bodies = t.requests.select("request_id", F.to_json(F.struct(inputs.alias("inputs"))).alias("body"))
    return readers.parse_requests(bodies, "body", ("request_id",))


@query("validate_requests", """
SELECT request_id, TRY_CAST(churn AS DOUBLE) AS churn, TRY_CAST(effectiveness AS DOUBLE) AS effectiveness,
       TRY_CAST(dltv AS DOUBLE) AS dltv,
       CASE WHEN churn IS NOT NULL AND TRY_CAST(churn AS DOUBLE) IS NULL THEN 'churn' ELSE '' END AS bad_fields
FROM requests""")
def _(t):
    return scoring.validate(t.requests).withColumn("bad_fields", F.array_join("errors", ",")).drop("errors")


@query("zscore_frozen", """
SELECT request_id, round((TRY_CAST(dltv AS DOUBLE) - 2052875.1935207853) / 1106063.9693825627, 8) AS dltv_std,
       round((TRY_CAST(churn AS DOUBLE) - 0.7525753912711541) / 0.5247159306383898, 8) AS churn_std,
       round((TRY_CAST(effectiveness AS DOUBLE) - 0.9211417379699978) / 0.14987482287122253, 8) AS effectiveness_std
FROM requests""")
def _(t):
    scaled = scaling.zscore_with(scoring.validate(t.requests), scaling.SERVICE_SCALING)
    return scaled.select("request_id", *[F.round(f"{c}_std", 8).alias(f"{c}_std") for c in scaling.SERVICE_SCALING])


@query("time_slice_trim", """
SELECT event_id, ts, value FROM (
  SELECT event_id, ts, value, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS rn FROM events
  WHERE ts >= TIMESTAMP '2024-01-03 00:00:00') WHERE rn > 90""")
def _(t):
    start = F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")
    return cleaning.trim_newest(t.events.select("event_id", "ts", "value"), ("ts", "event_id"), start, horizon=30)


@query("semi_join_keys", """
SELECT donor_id, gender FROM donors WHERE donor_id IN (SELECT donor_id FROM transactions WHERE stage = 'Perdida')""")
def _(t):
    lost = t.transactions.filter(F.col("stage") == cleaning.LOST)
    return joins.keep_members(t.donors, lost, "donor_id").select("donor_id", "gender")
