import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from benefacta.operators import exploration, outliers, quantiles


def quantile_map(frame, *keys):
    return {tuple(r[k] for k in (*keys, "column", "probability")): r["quantile"] for r in frame.collect()}


@pytest.mark.parametrize("gather_rows,bins", [(50_000, 2048), (5, 4), (0, 2), (0, 16)])
def test_like_numpy(spark, gather_rows, bins):
    rng = np.random.default_rng(3)
    # a third of the rows share one value, the rest has a long tail
    values = [7.0] * 200 + list(np.exp(rng.normal(0, 4, 401)))
    df = spark.createDataFrame([(float(v), float(-i)) for i, v in enumerate(values)] + [(None, None), (float("nan"), 5.0)],
                               "a double, b double").repartition(5)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = quantile_map(quantiles.exact_quantiles(df, ["a", "b"], ps, gather_rows=gather_rows, bins=bins))
    for p in ps:
        assert got["a", p] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert got["b", p] == pytest.approx(np.quantile([-i for i in range(len(values))] + [5.0], p), rel=1e-12)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(-1e300, 1e300), min_size=1, max_size=40))
def test_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantiles.column_quantiles(df, "x", [0.25, 0.5, 0.75], gather_rows=0, bins=3)
    assert got == pytest.approx([float(np.quantile(values, p)) for p in (0.25, 0.5, 0.75)], rel=1e-9)


def test_by_group_with_null_group(spark):
    rows = [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 10), (None, 3), (None, 5), ("c", None)]
    df = spark.createDataFrame(rows, "g string, x int")
    for gather in (100, 0):
        got = quantile_map(quantiles.exact_quantiles(df, ["x"], [0.25, 0.75], ("g",), gather_rows=gather), "g")
        assert got == {("a", "x", 0.25): 1.75, ("a", "x", 0.75): 3.25, ("b", "x", 0.25): 10.0, ("b", "x", 0.75): 10.0,
                       (None, "x", 0.25): 3.5, (None, "x", 0.75): 4.5}


def test_empty_and_infinite(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert quantiles.column_quantiles(empty, "x", [0.5]) == []
    assert [f.count() for f in outliers.split_outliers(empty, "x")] == [0, 0]
    with pytest.raises(ValueError):
        quantiles.column_quantiles(spark.createDataFrame([(float("inf"),), (1.0,)], "x double"), "x", [0.5])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50), st.just(10_000)), min_size=1, max_size=40))
def test_outlier_split_is_a_partition(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x int")
    normal, out = outliers.split_outliers(df, "x")
    ids = [r["i"] for f in (normal, out) for r in f.collect()]
    assert sorted(ids) == [i for i, v in enumerate(values) if v is not None]


def test_fences(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "x int")
    assert outliers.iqr_fences(df, "x") == (1.75, 3.25, -0.5, 5.5)
    nan = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert [f.count() for f in outliers.split_outliers(nan, "x")] == [1, 0]


def test_chained_outliers(spark):
    rows = [(i, i % 7, i % 5) for i in range(50)] + [(50, 1000, 2), (51, 3, 1000), (52, 1000, 1000)]
    df = spark.createDataFrame(rows, "i int, a int, b int")
    normal, out = outliers.split_outliers_chained(df, ["a", "b"])
    assert normal.count() == 50 and sorted(r["i"] for r in out.collect()) == [50, 51, 52]


def test_box_and_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)], "x double")
    box = exploration.box_statistics(df, ["x"]).first()
    assert (box["q1"], box["median"], box["q3"], box["whisker_low"], box["whisker_high"], box["fliers"]) == (2, 3, 4, 1, 4, 1)
    bins = {r["bin"]: r["n"] for r in exploration.histogram(df, "x").collect()}
    assert bins == {1: 4, 20: 1}
    constant = exploration.histogram(df.filter("x = 3"), "x").first()
    assert (constant["bin"], constant["n"], constant["lower"]) == (11, 1, 3.0)


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5.0, None), (4, 6.0, "c")], "x int, y double, s string")
    got = {(r["column"], r["statistic"]): r["value"] for r in exploration.describe_columns(df, ["x", "y"]).collect()}
    assert got["x", "50%"] == 2 and got["y", "count"] == 2 and got["x", "std"] == 1.53 and got["y", "75%"] == 5.75
    assert {(r["column"], r["nulls"]) for r in exploration.null_profile(df).collect()} == {("y", 1), ("s", 1)}


def test_correlation_uses_known_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    rows = exploration.correlation_matrix(df, ["a", "b"]).collect()
    assert len(rows) == 1 and rows[0]["correlation"] == pytest.approx(1.0)


def test_mean_by_category_standard_error(spark):
    tx = spark.createDataFrame([(1, "x", 1.0), (1, "x", 3.0), (2, "x", 5.0), (3, "x", None)],
                               "donor_id int, stage string, amount double")
    donors = spark.createDataFrame([(1, "m"), (2, "m"), (3, "m")], "donor_id int, g string")
    row = exploration.donor_mean_by_category(tx, donors, "stage", "g").first()
    assert (row["n"], row["mean"]) == (3, 3.0)
    assert row["standard_error"] == pytest.approx(2 / 3 ** 0.5)
    assert exploration.donor_count_by_category(tx, donors, "stage", "g").first()["n"] == 4


def grouped(spark, rows, ps, **options):
    df = spark.createDataFrame(rows, "g string, h int, x double").repartition(4)
    out = quantiles.exact_quantiles(df, ["x"], ps, ("g", "h"), **options).collect()
    assert all(r["rows"] == sum(v is not None and v == v for g, h, v in rows if (g, h) == (r["g"], r["h"])) for r in out)
    return {(r["g"], r["h"], r["probability"]): r["quantile"] for r in out}


@pytest.mark.parametrize("gather_rows", [50_000, 300, 0])
def test_many_groups_like_numpy(spark, gather_rows):
    rng = np.random.default_rng(6)
    held = {(g, h): rng.normal(0, 1, 1 + (i * 7) % 40).tolist() for i, (g, h) in enumerate(
        (f"g{a}", b if b else None) for a in range(12) for b in range(5))}
    held["large", 1] = [*np.exp(rng.normal(0, 3, 20_000)).tolist(), *[1.0] * 8000]
    held["equal", 1], held["two", 1], held[None, 1] = [3.0] * 900, [1.0, 2.0] * 700, [5.0, -1e300, 1e300]
    rows = [(*k, float(v)) for k, values in held.items() for v in values] + [("none", 1, None), ("none", 2, float("nan"))]
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = grouped(spark, rows, ps, gather_rows=gather_rows)
    assert got == {(*k, p): pytest.approx(float(np.quantile(v, p)), rel=1e-9) for k, v in held.items() for p in ps}


def test_a_sketch_that_misses_changes_nothing(spark, monkeypatch):
    rows = [("a", 1, float(i * i)) for i in range(3000)]
    for margin in (-0.2, -0.02):  # brackets that leave the rank out
        monkeypatch.setattr(quantiles, "MARGIN", margin)
        calls, plain = [], quantiles._settled

        def mended(values, brackets, keys, gather_rows):
            if calls:
                monkeypatch.setattr(quantiles, "MARGIN", 0.01)
            calls.append(1)
            return plain(values, brackets, keys, gather_rows)

        monkeypatch.setattr(quantiles, "_settled", mended)
        got = grouped(spark, rows, [0.25, 0.5], gather_rows=2000)
        monkeypatch.setattr(quantiles, "_settled", plain)
        assert len(calls) == 2
        assert got == {("a", 1, p): float(np.quantile([r[2] for r in rows], p)) for p in (0.25, 0.5)}


def test_infinite_values_of_a_group(spark):
    with pytest.raises(Exception, match="no interpolated quantile"):
        grouped(spark, [("a", 1, float("inf")), ("a", 1, 1.0)], [0.5])
