import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from benefacta.functions import dates
from benefacta.operators import cleaning, joins
from benefacta.plans import cleaning_jobs
from benefacta.sources import schemas
from conftest import AS_OF

CUT = AS_OF - dt.timedelta(days=90)


def test_text_dates(spark):
    df = spark.createDataFrame([(1, "Nº de error"), (2, "BCD"), (3, None), (4, "2021-01-01")], "i int, d string")
    kept, errors = cleaning.split_text_dates(df, "d")
    assert [r["i"] for r in kept.collect()] == [3, 4] and [r["i"] for r in errors.collect()] == [1, 2]


def test_sentinel_keeps_null(spark):
    df = spark.createDataFrame([("Nº de error",), (None,), ("x",)], "d string")
    assert {r["d"] for r in cleaning.drop_sentinel(df, "d").collect()} == {None, "x"}


def test_active_and_inactive(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, is_active boolean")
    assert [[r["i"] for r in f.collect()] for f in cleaning.split_active(df)] == [[1], [2]]


def test_recent_split_is_strict(spark):
    rows = [(1, CUT - dt.timedelta(days=1)), (2, CUT), (3, CUT + dt.timedelta(days=1)), (4, None)]
    df = spark.createDataFrame(rows, "i int, d date")
    older, newer = cleaning.split_recent(df, "d", dates.days_before(AS_OF))
    assert [r["i"] for r in older.collect()] == [1] and [r["i"] for r in newer.collect()] == [3]
    status = df.select("i", cleaning.recency_status(F.col("d"), dates.days_before(AS_OF)).alias("s")).collect()
    assert {r["i"]: r["s"] for r in status} == {1: "ok", 2: "cutoff", 3: "new", 4: "no_capture_date"}


def test_fix_ages(spark):
    born = dt.date(1990, 1, 1)
    df = spark.createDataFrame([(1, 20, born), (2, 31, born), (3, 17, born), (4, 91, born), (5, None, born), (6, 90, born)],
                               "i int, age int, birth_date date")
    out = {r["i"]: r for r in cleaning.fix_ages(df, AS_OF).collect()}
    assert [out[i]["age"] for i in range(1, 7)] == [20, 31, 47, 47, 47, 90]  # mean of 20, 31, 90
    assert [out[i]["age_was_error"] for i in range(1, 7)] == [False, False, True, True, True, False]
    assert out[1]["birth_date"] == born and out[3]["birth_date"] == AS_OF - dt.timedelta(days=47 * 365)
    assert len(out) == 6  # no extra row


def test_children(spark):
    rows = [("mas de 10", "Si"), ("3", "Si"), ("3", "No"), (None, "Si"), (None, None), ("2.0", None)]
    df = spark.createDataFrame(rows, "c string, h string")
    fixed = cleaning.children_count(F.col("c"), F.col("h"))
    out = df.select(fixed.alias("n"), cleaning.has_children(fixed).alias("h")).collect()
    assert [r["n"] for r in out] == [10, 3, 0, None, None, 2]
    assert [r["h"] for r in out] == [True, True, False, False, False, True]


def test_fill_defaults_by_type(spark):
    df = spark.createDataFrame([(None, None, None, None, None)], "a int, b double, c string, d date, e boolean")
    assert tuple(cleaning.fill_defaults(df).first()) == (0, 0.0, None, None, False)


def test_conform_keeps_null_text(spark):
    layout = [schemas.Field("A b", "X", "a", "string"), schemas.Field("N", "N", "n", "long"),
              schemas.Field("F", "F", "f", "bool")]
    df = spark.createDataFrame([(None, "12", "1"), ("t", "12.0", "0.0"), ("u", "x", "true")], "`A b` string, N string, F string")
    assert [tuple(r) for r in cleaning.conform(df, layout).collect()] == [(None, 12, True), ("t", 12, False), ("u", None, True)]


@pytest.mark.parametrize("horizon,want", [(0, []), (117, [1, 2]), (118, [1, 2, 3]), (120, [1, 2, 3, 4, 5])])
def test_trim_newest(spark, horizon, want):
    rows = [(i, dt.date(2020, 1, i // 2 + 1)) for i in range(1, 6)] + [(9, dt.date(2010, 1, 1))]
    df = spark.createDataFrame(rows, "i int, d date")
    got = cleaning.trim_newest(df, ("d", "i"), dt.date(2020, 1, 1), horizon)
    assert sorted(r["i"] for r in got.collect()) == want


def raw_frame(spark, layout, records):
    names = [f.name for f in layout]
    rows = [tuple(r.get(n) for n in names) for r in records]
    return spark.createDataFrame(rows, schemas.raw_schema(layout))


def test_clean_donors_status(spark):
    old, new = "2020-01-31", AS_OF.isoformat()
    records = [
        dict(donor_id="1", capture_date=old, age="40", children="2", has_children="Si", city="BOGOTA D.C.", is_active="1"),
        dict(donor_id="2", capture_date=new, age="50", children=None, has_children="Si", department="NARIÑO"),
        dict(donor_id="3", capture_date=None, age="5"),
        dict(donor_id="4", capture_date=CUT.isoformat(), age="60"),
        dict(donor_id="5", capture_date=old, payment_anniversary="Nº de error", age="18"),
        dict(donor_id="6", capture_date="02/03/2021", age=None, churn_prob="1,5"),
    ]
    out = {r["donor_id"]: r for r in cleaning_jobs.clean_donors(raw_frame(spark, schemas.DONORS, records), AS_OF).collect()}
    assert {i: r["row_status"] for i, r in out.items()} == {
        1: "ok", 2: "new", 3: "no_capture_date", 4: "cutoff", 5: "text_date", 6: "ok"}
    assert out[1]["city"] == "Bogotá" and out[2]["department"] == "Nariño" and out[3]["city"] == ""
    assert out[6]["age"] == 50 and out[6]["age_was_error"] and out[6]["churn_prob"] == 1.5  # mean of 40, 50, 60
    assert out[6]["capture_date"] == dt.date(2021, 2, 3)  # month first
    assert out[2]["children"] == 0 and out[2]["has_children"] is False and out[1]["has_children"] is True
    assert out[3]["capture_date"] is None and out[2]["gender"] is None


def test_clean_transactions(spark):
    records = [dict(donor_id="7", tx_date="03/02/2021", amount="12,5", stage="Cobrada"),
               dict(donor_id="8", tx_date="sin fecha", amount="1"), dict(donor_id="9", tx_date="2021-1-5", amount="1.2.3")]
    out = cleaning_jobs.clean_transactions(raw_frame(spark, schemas.TRANSACTIONS, records)).collect()
    assert [(r["donor_id"], r["tx_date"], r["amount"], r["row_status"]) for r in out] == [
        (7, dt.date(2021, 2, 3), 12.5, "ok"), (8, None, 1.0, "text_date"), (9, dt.date(2021, 1, 5), None, "ok")]


def test_clean_cancellations_keeps_rejected_rows(spark):
    records = [dict(donor_id="7", cancel_date="03/02/2021"), dict(donor_id="8", cancel_date="pendiente"), dict(donor_id="9")]
    out = cleaning_jobs.clean_cancellations(raw_frame(spark, schemas.CANCELLATIONS, records)).collect()
    assert [(r["donor_id"], r["row_status"]) for r in out] == [(7, "ok"), (8, "text_date"), (9, "ok")]


def test_flag_words(evaluate):
    words = ["Si", "Sí", " no ", "No", "true", "0", "2", "quizás", None]
    assert evaluate(words, "string", cleaning.flag) == [True, True, False, False, True, False, True, None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.sampled_from(["2020-01-31", AS_OF.isoformat(), None, CUT.isoformat(), "mal", "99/99/2020"]),
                min_size=1, max_size=20))
def test_no_donor_vanishes(spark, captures):
    records = [dict(donor_id=str(i), capture_date=c) for i, c in enumerate(captures)]
    out = cleaning_jobs.clean_donors(raw_frame(spark, schemas.DONORS, records), AS_OF)
    assert sorted(r["donor_id"] for r in out.collect()) == list(range(len(captures)))


def test_balanced_join_with_hot_keys(spark):
    fact = spark.createDataFrame([(i, 1 if i % 3 else i % 20, i) for i in range(600)] + [(None, None, 0)],
                                 "tx int, k int, v int").select("tx", "k", "v")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(1, 15)], "k int, name string")
    for how in ("inner", "left"):
        want = sorted(map(str, (tuple(r) for r in fact.join(dim, "k", how).collect())))
        got = joins.balanced_join(fact, dim, "k", how, ("tx",), salts=4, hot=(1,))
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == want
    with pytest.raises(ValueError):
        joins.balanced_join(fact, dim, "k", "full")


def test_unique_fails_on_a_repeated_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, s string")
    assert sorted(map(str, joins.unique(df, "k").collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="more than one row with k 2"):
        joins.unique(df.unionByName(df), "k").filter("k = 2").collect()


def test_membership(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, s string")
    keys = spark.createDataFrame([(2,), (2,), (9,)], "k int")
    assert [r["k"] for r in joins.keep_members(df, keys, "k").collect()] == [2]
    marked = joins.mark_members(df, keys, "k", "s", "Nuevo").orderBy("k").collect()
    assert [r["s"] for r in marked] == ["a", "Nuevo", None]
