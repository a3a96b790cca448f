import numpy as np
import pytest

from benefacta.operators import clustering, tiles


def by_hand(x, c):
    x, c = np.array(x, float), np.array(c)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        own = (c == c[i]) & (np.arange(len(x)) != i)
        others = [d[i, c == other].mean() for other in set(c.tolist()) - {c[i]}]
        a = d[i, own].mean() if own.any() else None
        out.append(0.0 if a is None or not others or max(a, min(others)) == 0 else (min(others) - a) / max(a, min(others)))
    return out


def run(spark, x, c, **options):
    rows = [(i, [float(v) for v in r], str(k)) for i, (r, k) in enumerate(zip(x, c))]
    df = spark.createDataFrame(rows, "id long, v array<double>, cluster string").repartition(3)
    out = tiles.euclidean_silhouette(df, "v", **options).collect()
    assert [r["cluster"] for r in sorted(out, key=lambda r: r["id"])] == [str(k) for k in c]
    return [r["silhouette"] for r in sorted(out, key=lambda r: r["id"])]


@pytest.mark.parametrize("spread,block", [(0.1, 1024), (3.0, 16), (1.0, 7)])
def test_like_all_pairs(spark, spread, block):
    rng = np.random.default_rng(int(spread * 10))
    centres = rng.normal(0, 3, (6, 4))
    c = rng.integers(0, 6, 300)
    x = centres[c] + rng.normal(0, spread, (300, 4))
    c[:40] = 5  # a cluster that lies everywhere
    assert run(spark, x, c, block=block) == pytest.approx(by_hand(x, c), abs=1e-9)


def test_ties_repeats_and_small_clusters(spark):
    x = [[0, 0]] * 30 + [[0, 1]] * 30 + [[5, 5]] + [[0, 0]] * 3 + [[2, 2], [2, 2]]
    c = ["a"] * 30 + ["b"] * 30 + ["alone"] + ["b"] * 3 + ["twin"] * 2
    assert run(spark, x, c, block=8) == pytest.approx(by_hand(x, c), abs=1e-12)
    assert run(spark, [[1, 2], [3, 4]], ["a", "a"]) == [0.0, 0.0]
    assert run(spark, [[1, 1]] * 6, ["a"] * 3 + ["b"] * 3) == [0.0] * 6


def test_empty_null_vectors_and_too_many_clusters(spark, monkeypatch):
    schema = "id long, v array<double>, cluster int"
    assert tiles.euclidean_silhouette(spark.createDataFrame([], schema), "v").count() == 0
    df = spark.createDataFrame([(1, None, 0), (2, [1.0], 0), (2, [1.0], 1), (2, [4.0], None)], schema)
    assert sorted(r["id"] for r in tiles.euclidean_silhouette(df, "v").collect()) == [2, 2, 2]
    monkeypatch.setattr(tiles, "MOST_VALUES", 1)
    with pytest.raises(ValueError):
        tiles.euclidean_silhouette(df, "v")


def test_far_clusters_are_skipped():
    class Rows(tiles._Centres):
        def __init__(self):
            self.sizes, self.means, self.spread = np.array([9.0, 9.0, 9.0]), np.array([[0.0], [5.0], [99.0]]), np.array([1.0, 1.0, 1.0])

    assert Rows().needed(np.array([[0.5], [52.0]]), 0).tolist() == [[True, True, False], [True, True, True]]


def test_choice_of_k_by_either_metric(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(m, 0.2, (40, 2)) for m in ((0, 0), (4, 0), (0, 4))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    fitted = clustering.segment(df, ["a", "b"], restarts=2, metric="euclidean")
    assert fitted.k == 3
    scaled = (x - x.mean(axis=0)) / x.std(axis=0)
    labels = {r["id"]: r["cluster"] for r in fitted.labelled.collect()}
    assert dict(fitted.scores)[3] == pytest.approx(np.mean(by_hand(scaled, [labels[i] for i in range(120)])), abs=1e-9)


def test_vectors_are_not_shuffled_for_each_tile(spark, capsys):
    df = spark.createDataFrame([(i, [float(i), 1.0], i % 2) for i in range(40)], "id long, v array<double>, cluster int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tiles.euclidean_silhouette(df, "v", block=8).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert "CartesianProduct" in plan and "hashpartitioning(other#" not in plan


def test_close_and_far_pairs_keep_their_digits():
    rng = np.random.default_rng(7)
    x = 1000 + rng.normal(0, 1, (300, 64))
    y = np.concatenate([x[:100], x[100:200] + rng.normal(0, 1e-7, (100, 64)), rng.normal(0, 1, (100, 64))])
    plain = np.sqrt(np.square(x[:, None] - y[None]).sum(axis=2))
    assert np.allclose(tiles.distances(x, y), plain, rtol=1e-9, atol=0) and (tiles.distances(x, y)[:100].diagonal() == 0).all()
    y[3, 2] = np.inf
    assert np.array_equal(tiles.distances(x, y), np.sqrt(np.square(x[:, None] - y[None]).sum(axis=2)))


def test_floats_and_many_small_tiles(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x, c = rng.normal(0, 1, (90, 3)).astype(np.float32).astype(float), rng.integers(0, 3, 90)
    monkeypatch.setattr(tiles, "_SUMS", 40)
    df = spark.createDataFrame([(i, r.tolist(), int(k)) for i, (r, k) in enumerate(zip(x, c))], "id long, v array<float>, cluster int")
    out = sorted((r["id"], r["silhouette"]) for r in tiles.euclidean_silhouette(df, "v", block=5).collect())
    assert [s for _, s in out] == pytest.approx(by_hand(x, c), abs=1e-9)
