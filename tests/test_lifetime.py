import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st

from benefacta.operators import features
from benefacta.plans import lifetime

NOW = dt.date(2022, 7, 1)


def donations(spark, rows):
    return spark.createDataFrame(rows, "donor_id int, tx_year int, amount double")


def rates(spark, table):
    return spark.createDataFrame(list(table.items()), "year int, rate double")


def fold(by_year, table, years):
    total = 0.0
    for year in sorted(years):
        total += by_year.get(year, 0.0)
        if year != NOW.year:
            total *= 1 + table[year]
    return total


def test_compounds_over_present_years_only(spark):
    rows = [(1, 2019, 10.0), (1, 2021, 20.0), (1, 2022, 5.0)]
    out = lifetime.present_value_history(donations(spark, rows), rates(spark, {2019: 0.1, 2020: 9.0, 2021: 0.2, 2022: 0.3}), NOW)
    row = out.first()
    assert row["total_value"] == pytest.approx(42.2) and row["first_year"] == 2019


def test_future_years_compound(spark):
    out = lifetime.present_value_history(donations(spark, [(1, 2022, 1.0), (1, 2023, 1.0)]), rates(spark, {2023: 0.5}), NOW)
    assert out.first()["total_value"] == pytest.approx(fold({2022: 1, 2023: 1}, {2023: 0.5}, [2022, 2023]))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(2015, 2023), st.integers(0, 10**7).map(lambda c: c / 100)), min_size=1, max_size=25))
def test_factors_are_the_fold(spark, rows):
    table = {y: (y - 2010) / 100 for y in range(2010, 2025)}
    out = lifetime.present_value_history(donations(spark, rows), rates(spark, table), NOW).collect()
    years = {y for _, y, _ in rows}
    for r in out:
        mine = {}
        for donor, year, amount in rows:
            if donor == r["donor_id"]:
                mine[year] = mine.get(year, 0.0) + amount
        assert r["total_value"] == pytest.approx(fold(mine, table, years), rel=1e-9, abs=1e-9)


def test_missing_rate_fails(spark):
    out = lifetime.present_value_history(donations(spark, [(1, 2018, 1.0)]), rates(spark, {2019: 0.1}), NOW)
    with pytest.raises(Exception, match="no inflation rate for 2018"):
        out.collect()


def test_missing_rate_of_current_year_is_fine(spark):
    out = lifetime.present_value_history(donations(spark, [(1, 2022, 3.0)]), rates(spark, {2019: 0.1}), NOW)
    assert out.first()["total_value"] == 3.0


def test_lifetime_value_by_hand(spark):
    donors = spark.createDataFrame(
        [(1, 40, 50.0, 20.0, True), (2, 40, 0.0, None, True), (3, 40, 50.0, None, False), (4, 88, None, 10.0, True)],
        "donor_id int, age int, churn_prob double, lapsed_prob double, is_active boolean")
    tx = spark.createDataFrame(
        [(d, dt.date(2021, 3, 1), 100.0, "Cobrada", "DI - Regular") for d in (1, 2, 3, 4)]
        + [(1, dt.date(2022, 3, 1), 50.0, "Cobrada", "PF - Padrinazgo familiar"), (1, dt.date(2022, 3, 1), 999.0, "Perdida", "DI - Regular"),
           (1, dt.date(2020, 3, 1), 999.0, "Cobrada", "Unica")],
        "donor_id int, tx_date date, amount double, stage string, record_type string")
    monthly = spark.createDataFrame([("202101", 10.0), ("202102", 30.0), ("202201", 50.0)], "period string, pct double")
    out = {r["donor_id"]: r for r in lifetime.donor_lifetime_value(donors, tx, monthly, NOW).collect()}
    assert set(out) == {1, 4}  # 2 has no risk, 3 is not active
    one = out[1]
    assert one["total_value"] == pytest.approx(100 * 1.2 + 50)
    assert (one["first_year"], one["tenure_years"], one["lifespan"]) == (2021, 1, 2.0)
    assert one["dltv"] == pytest.approx(85 / 1.5 + 85 / 1.5 ** 2)
    assert out[4]["lifespan"] == 2.0  # 90 - 88


def test_instalment_averages(spark):
    values = spark.createDataFrame([(1, 3), (2, 0)], "donor_id int, tenure_years int")
    donors = spark.createDataFrame([(1, 8, 2), (3, 1, 1)], "donor_id int, instalments_paid int, instalments_unpaid int")
    out = {r["donor_id"]: (r["avg_paid"], r["avg_unpaid"]) for r in lifetime.with_instalment_averages(values, donors).collect()}
    assert out == {1: (2.0, 0.5), 2: (None, None)}


TX = [(1, "A", "Cobrada", 10.9), (1, "B", "Perdida", 5.0), (2, "A", "Cobrada", 1.0), (2, "A", "Cobrada", 1.0),
      (2, "A", "Cobrada", 1.0), (2, "B", "Perdida", 1.5), (3, "B", "Eliminada", 4.0), (3, "A", "Eliminada", None)]


def transactions(spark):
    return spark.createDataFrame(TX, "donor_id int, record_type string, stage string, amount double")


def test_channels(spark):
    out = {r["donor_id"]: (r["channels"], r["main_channel"]) for r in features.donor_channels(transactions(spark)).collect()}
    assert out == {1: (2, "A"), 2: (2, "A"), 3: (1, "B")}


def test_effectiveness(spark):
    out = {r["donor_id"]: tuple(r)[1:] for r in features.collection_effectiveness(transactions(spark)).collect()}
    assert out == {1: (10, 15, 10 / 15), 2: (3, 4, 0.75), 3: (0, 0, None)}


def test_count_pivot(spark):
    out = {r["donor_id"]: (r["a"], r["b"]) for r in features.count_pivot(
        transactions(spark), "donor_id", "record_type", {"A": "a", "B": "b"}).collect()}
    assert out == {1: (1, 1), 2: (3, 1), 3: (0, 1)}


def test_pivots_keep_what_is_not_listed(spark):
    tx = transactions(spark)
    wide = features.count_pivot(tx, "donor_id", "record_type", {"A": "a"}).collect()
    assert {r["donor_id"]: (r["a"], r["other"]) for r in wide} == {1: (1, 1), 2: (3, 1), 3: (0, 1)}
    assert sum(r["n"] for r in features.category_counts(tx, "donor_id", "record_type").collect()) == 7
    given = donations(spark, [(1, 2019, 10.0), (1, 2021, 20.0), (2, 1990, 5.0), (2, None, 1.0)])
    out = {r["donor_id"]: (r["y2021"], r["other_years"]) for r in lifetime.yearly_donations_pivot(given, [2021]).collect()}
    assert out == {1: (20.0, 10.0), 2: (0.0, 6.0)}


def test_repeated_donor_fails(spark):
    donors = spark.createDataFrame([(1, 40, 50.0, 20.0, True)] * 2, "donor_id int, age int, churn_prob double, lapsed_prob double, is_active boolean")
    tx = spark.createDataFrame([(1, dt.date(2021, 3, 1), 100.0, "Cobrada", "DI - Regular")],
                               "donor_id int, tx_date date, amount double, stage string, record_type string")
    monthly = spark.createDataFrame([("202101", 10.0)], "period string, pct double")
    with pytest.raises(Exception, match="more than one row with donor_id 1"):
        lifetime.donor_lifetime_value(donors, tx, monthly, NOW).collect()


def test_transactions_are_read_once(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "tx")
    donations(spark, [(1, 2019, 10.0), (2, 2021, 20.0)]).write.parquet(path)
    out = lifetime.present_value_history(spark.read.parquet(path), rates(spark, {2019: 0.1, 2021: 0.2}), NOW)
    assert out.count() == 2 and path not in out._jdf.queryExecution().toString()
    assert out.agg(F.sum("total_value")).first()[0] == pytest.approx(10 * 1.1 * 1.2 + 20 * 1.2)
