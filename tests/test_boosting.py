import numpy as np
import pytest

from benefacta.operators import boosting


def plain(x, y, cuts, rounds, depth, rate=0.3, penalty=1.0, least=1.0):
    """Node by node over all rows, with the same rules and no histograms."""
    bins = np.array([[sum(v > c for c in column) for v, column in zip(row, cuts)] for row in x])
    k = max(y) + 1
    margins, splits = np.zeros((len(x), k)), []

    def grow(rows, g, h, level):
        big, heavy = g[rows].sum(), h[rows].sum()
        best = None
        for f in range(len(cuts)):
            for b in range(len(cuts[f])):
                left = rows[bins[rows, f] <= b]
                lg, lh = g[left].sum(), h[left].sum()
                if lh >= least and heavy - lh >= least:
                    gain = round(0.5 * (lg**2 / (lh + penalty) + (big - lg)**2 / (heavy - lh + penalty) - big**2 / (heavy + penalty)), 9)
                    if gain > 1e-6 and (best is None or gain > best[0]):
                        best = (gain, f, b)
        if best is None or level == depth:
            return {int(i): -rate * big / (heavy + penalty) for i in rows}
        splits.append(best)
        right = bins[rows, best[1]] > best[2]
        return grow(rows[~right], g, h, level + 1) | grow(rows[right], g, h, level + 1)

    for _ in range(rounds):
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        step = np.zeros_like(margins)
        for c in range(k):
            for i, v in grow(np.arange(len(x)), p[:, c] - (np.array(y) == c), 2 * p[:, c] * (1 - p[:, c]), 0).items():
                step[i, c] = v
        margins += step
    return margins, splits


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, 1, (240, 3)), 2)
    y = (x[:, 0] > 0.3).astype(int) + (x[:, 0] + x[:, 1] > 1).astype(int)
    y[rng.random(240) < 0.05] = 0
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), f"class{c}") for i, (r, c) in enumerate(zip(x, y))],
                                 "id long, a double, b double, c double, label string").repartition(5)


def test_equal_to_a_plain_version(spark, table):
    x, y = table
    cuts = [np.unique(np.quantile(column, np.arange(1, 12) / 12).round(2)) for column in x.T]
    model = boosting.fit(frame(spark, x, y), ["a", "b", "c"], "label", cuts, rounds=4, depth=3)
    margins, splits = plain(x, y, cuts, 4, 3)
    assert model.classes == ["class0", "class1", "class2"]
    assert model.margins(boosting.binned(x, cuts)) == pytest.approx(margins, abs=1e-9)
    count = lambda found: [sum(f == i for f, _ in found) for i in range(3)]
    assert count(model.splits) == count([(f, g) for g, f, _ in splits])
    assert sum(g for _, g in model.splits) == pytest.approx(sum(g for g, *_ in splits), rel=1e-6)
    right = boosting.accuracy(frame(spark, x, y), ["a", "b", "c"], "label", model)
    assert right == pytest.approx((margins.argmax(axis=1) == y).mean()) and right > 0.9


def test_importance_and_held_out_accuracy(spark, table):
    x, y = table
    out = {r["feature"]: r for r in boosting.boosted_importance(frame(spark, x, y), ["a", "b", "c"], "id", "label", rounds=5, depth=3).collect()}
    assert out["a"]["gain"] > out["b"]["gain"] > out["c"]["gain"] and out["a"]["accuracy"] > 0.8


def test_nulls_one_class_and_empty_tables(spark):
    schema = "id long, a double, b double, label string"
    odd = [(i, None if i % 3 else float("nan"), float(i % 7), "x" if i % 7 > 3 else "y") for i in range(60)] + [(99, 1.0, 1.0, None)]
    model = boosting.fit(spark.createDataFrame(odd, schema), ["a", "b"], "label", rounds=3)
    assert {f for f, _ in model.splits} == {1} and model.classes == ["x", "y"]
    assert boosting.accuracy(spark.createDataFrame(odd[:60], schema), ["a", "b"], "label", model) == 1.0
    one = boosting.fit(spark.createDataFrame([(1, 1.0, 2.0, "x")] * 5, schema), ["a", "b"], "label")
    assert one.classes == ["x"] and not one.splits
    none = spark.createDataFrame([], schema)
    assert boosting.boosted_importance(none, ["a", "b"], "id", "label").first()["accuracy"] is None
