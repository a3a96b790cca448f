import numpy as np
import pytest
from pyspark.sql import functions as F

from benefacta.functions import labels
from benefacta.operators import clustering, mixed, quality, reduction, sampling, scaling, scoring
from benefacta.plans import segmentation
from benefacta.sources import readers, sinks

GROUPS = [(0.0, 0.0, 0.0), (50.0, 5.0, 0.5), (100.0, 0.0, 1.0), (150.0, 9.0, 0.2)]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *(float(x) for x in np.array(GROUPS[i % 4]) + rng.normal(0, [2, 0.2, 0.02]))) for i in range(200)]
    rows += [(500, 9000.0, 1.0, 0.5), (501, 10.0, 400.0, 0.5), (502, None, 1.0, 0.5)]
    return spark.createDataFrame(rows, "donor_id long, dltv double, churn_prob double, effectiveness double").repartition(3)


def test_zscore_is_population(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (3.0, 5), (4.0, 5)], "x double, c int")
    out = scaling.zscore(df, ["x", "c"]).orderBy("x").collect()
    assert [r["x_std"] for r in out] == pytest.approx([-1.5 / 1.1180339887, -0.5 / 1.1180339887, 0.5 / 1.1180339887, 1.5 / 1.1180339887])
    assert {r["c_std"] for r in out} == {0.0}
    assert scaling.fit_moments(df, ["x"])["x"].std == pytest.approx(1.1180339887)


def test_train_labels_everyone(spark, table, tmp_path):
    training = segmentation.train_segments(table, restarts=2)
    assert training.k == 4 and len(training.scores) == 8
    labelled = {r["donor_id"]: r["cluster"] for r in training.labelled.collect()}
    assert sorted(labelled) == [*range(200), 500, 501]
    assert len({labelled[i] for i in range(4)}) == 4
    assert all(labelled[i] == labelled[i % 4] for i in range(200))

    path = sinks.save_model(training.model, str(tmp_path / "models"), "0.1")
    again = segmentation.assign_with_model(table.repartition(7), readers.load_model(path))
    assert {r["donor_id"]: r["cluster"] for r in again.collect()} == labelled

    donors = spark.createDataFrame([(1,), (777,)], "donor_id long")
    out = segmentation.with_segments(donors, training.labelled).collect()
    assert {r["donor_id"]: r["cluster"] for r in out} == {1: labelled[1], 777: None}


def test_pick_k():
    assert clustering.pick_k([(2, 0.9), (3, 0.5), (4, 0.7)]) == 4
    assert clustering.pick_k([(2, 0.1), (3, 0.5), (4, 0.5)]) == 3
    assert clustering.pick_k([(2, 0.1)]) == 2


def test_same_seed_same_clusters(table):
    one, two = (clustering.segment(table, segmentation.FEATURES, k=3, restarts=1, seed=5).labelled for _ in range(2))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_nearest_centroid(spark):
    centroids = {3: (0.0, 0.0), 1: (2.0, 0.0), 2: (10.0, 0.0)}
    df = spark.createDataFrame([(0, 0.1, 0.0), (1, 1.0, 5.0), (2, 9.0, 0.0), (3, None, 0.0)], "i int, a double, b double")
    code = clustering.nearest_centroid(["a", "b"], centroids)
    for parts in (1, 4):
        out = {r["i"]: r["c"] for r in df.repartition(parts).select("i", code.alias("c")).collect()}
        assert out == {0: 3, 1: 1, 2: 2, 3: None}  # 1 is a tie between 1 and 3


def test_label_donors(spark):
    coded = spark.createDataFrame([(1, "a", 3), (2, "b", 0), (3, "c", None)], "donor_id long, gender string, cluster int")
    new = spark.createDataFrame([(2,), (9,), (9,)], "donor_id long")
    rows = segmentation.label_donors(coded, new).collect()
    out = {r["donor_id"]: r["segment"] for r in rows}
    assert len(rows) == 4 and out == {1: "Campeones", 2: labels.NEW_DONOR, 3: labels.UNASSIGNED, 9: labels.NEW_DONOR}


def test_validate_and_score(spark):
    df = spark.createDataFrame([(1, "0.5", "2000000", "1"), (2, "n/a", "x", "1"), (3, None, "5", "NaN")],
                               "i int, churn string, dltv string, effectiveness string")
    valid, invalid = scoring.split_valid(scoring.validate(df))
    assert [r["i"] for r in valid.collect()] == [1, 3]
    assert invalid.first()["errors"] == ["churn", "dltv"]
    assert valid.filter("i = 3").first()["effectiveness"] is None
    centroids = {0: (0.0, 0.0, 0.0), 3: (5.0, 5.0, 5.0)}
    out = {r["i"]: (r["cluster"], r["segment"]) for r in scoring.score_requests(df, centroids).collect()}
    assert out == {1: (0, "Hibernando"), 2: (None, labels.UNCLASSIFIED), 3: (None, labels.UNCLASSIFIED)}


def silhouette_by_hand(points, own, squared):
    n = len(points)
    gap = ((points[:, None, :] - points[None]) ** 2).sum(axis=2)
    gap = gap if squared else np.sqrt(gap)
    out = []
    for i in range(n):
        mean = {c: gap[i][[j for j in range(n) if own[j] == c and j != i]].mean()
                for c in set(own) if any(own[j] == c and j != i for j in range(n))}
        if own[i] not in mean:
            out.append(0.0)
            continue
        a, b = mean[own[i]], min(v for c, v in mean.items() if c != own[i])
        out.append((b - a) / max(a, b))
    return out


@pytest.mark.parametrize("squared", [True, False])
def test_silhouettes(spark, squared):
    rng = np.random.default_rng(2)
    points = rng.normal(0, 1, (40, 3)) + np.repeat([[0, 0, 0], [3, 0, 0]], 20, axis=0)
    own = [0] * 20 + [1] * 19 + [2]
    df = spark.createDataFrame([(i, [float(x) for x in p], c) for i, (p, c) in enumerate(zip(points, own))],
                               "id long, v array<double>, cluster int").repartition(3)
    fn = quality.squared_silhouette if squared else quality.sampled_silhouette
    got = {r["id"]: r["silhouette"] for r in fn(df, "v").collect()}
    assert [got[i] for i in range(40)] == pytest.approx(silhouette_by_hand(points, own, squared), abs=1e-9)


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    samples = [sorted(r["k"] for r in sampling.seeded_sample(df.repartition(p), "k", 20, 7).collect()) for p in (1, 9)]
    assert samples[0] == samples[1] and len(samples[0]) == 20
    assert samples[0] != sorted(r["k"] for r in sampling.seeded_sample(df, "k", 20, 8).collect())


def test_profile_and_metrics(spark):
    df = spark.createDataFrame([(0, 1.0, "a"), (0, 3.0, "b"), (1, 5.0, "a"), (1, None, "a")], "cluster int, x double, g string")
    profile = {r["cluster"]: r for r in quality.cluster_profile(df, ["x"]).collect()}
    assert (profile[0]["size"], profile[0]["share"], profile[0]["mean_x"], profile[1]["mean_x"]) == (2, 0.5, 2.0, 5.0)
    counts = {r["cluster"]: (r["a"], r["b"]) for r in quality.cluster_category_counts(df, "g", {"a": "a", "b": "b"}).collect()}
    assert counts == {0: (1, 1), 1: (2, 0)}
    long = quality.cluster_metrics(quality.cluster_profile(df, ["x"]), "r1").collect()
    assert len(long) == 6 and {r["run_id"] for r in long} == {"r1"}


def test_importance(table):
    fitted = clustering.segment(table.filter("donor_id < 200"), segmentation.FEATURES, k=4, restarts=1)
    out = quality.segment_importance(fitted.labelled, segmentation.FEATURES, "donor_id", trees=10).collect()
    assert sum(r["importance"] for r in out) == pytest.approx(1.0) and out[0]["accuracy"] > 0.9


def test_pca_scores(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (60, 4)) @ rng.normal(0, 1, (4, 4)) + 10
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double, c double, d double")
    out = reduction.pca_scores(df, ["a", "b", "c", "d"]).orderBy("i").collect()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    _, _, axes = np.linalg.svd(z, full_matrices=False)
    for i, name in enumerate(reduction.SCORE_NAMES):
        axis = axes[i] * np.sign(axes[i][np.abs(axes[i]).argmax()])
        assert [r[name] for r in out] == pytest.approx(list(z @ axis), abs=1e-8)


MIXED = [(1, 0.0, 10.0, "a"), (2, 1.0, 10.0, "a"), (3, 10.0, 10.0, "b"), (4, 11.0, 10.0, "b"), (5, 12.0, 10.0, None)]


def mixed_frame(spark):
    return spark.createDataFrame(MIXED, "id long, x double, flat double, g string").repartition(2)


def gower_by_hand(p, q):
    return (abs(p[1] - q[1]) / 12 + 0 + (0 if p[3] == q[3] else 1)) / 3


def test_gower(spark):
    df = mixed_frame(spark)
    rows = mixed.gower_matrix(df, "id", ["x", "flat"], ["g"]).collect()
    by_id = {r[0]: r for r in MIXED}
    for r in rows:
        assert r["distances"] == pytest.approx([gower_by_hand(by_id[r["id"]], by_id[o]) for o in r["others"]])
    summary = {r["id"]: r for r in mixed.gower_summary(mixed.gower_matrix(df, "id", ["x", "flat"], ["g"]), "id").collect()}
    assert summary[1]["others"] == 4 and summary[1]["max_distance"] == pytest.approx(2 / 3)
    proto = {1: {"x": 0.0, "flat": 10.0, "g": "a"}, 2: {"x": 12.0, "flat": 10.0, "g": "b"}}
    out = mixed.gower_to_prototypes(df, "id", ["x", "flat"], ["g"], proto).collect()
    for r in out:
        p = proto[r["prototype"]]
        assert r["distance"] == pytest.approx(gower_by_hand(by_id[r["id"]], (0, p["x"], 0, p["g"])))


def kprototypes_by_hand(records, k, start, gamma, limit):
    protos, last = [dict(p) for p in start[:k]], None
    for _ in range(limit):
        def cost(r, p):
            return (r["x"] - p["x"]) ** 2 + (0 if r["g"] == p["g"] else gamma)
        own = [min(range(k), key=lambda i: (cost(r, protos[i]), i)) for r in records]
        total = sum(cost(r, protos[i]) for r, i in zip(records, own))
        new = []
        for i in range(k):
            mine = [r for r, o in zip(records, own) if o == i]
            if not mine:
                new.append(protos[i])
                continue
            words = sorted({r["g"] for r in mine}, key=lambda w: (-sum(r["g"] == w for r in mine), w))
            new.append({"x": sum(r["x"] for r in mine) / len(mine), "g": words[0]})
        stop = new == protos or (last is not None and total >= last)
        protos, last = new, total
        if stop:
            break
    return sum(min(cost(r, p) for p in protos) for r in records)


def test_kprototypes_like_by_hand(spark):
    rng = np.random.default_rng(5)
    records = [{"id": i, "x": float(rng.integers(0, 40)), "g": "abc"[rng.integers(0, 3)]} for i in range(60)]
    df = spark.createDataFrame([(r["id"], r["x"], r["g"]) for r in records], "id long, x double, g string")
    in_order = [(r["x"], r["g"]) for r in df.orderBy(sampling.sample_order("id", 123)).collect()]
    start = [{"x": x, "g": g} for x, g in list(dict.fromkeys(in_order))[:4]]
    assert mixed._first_records(df, "id", 4, 123) == start
    got = {}
    for parts in (1, 5):
        out = mixed.kprototypes_costs(df.repartition(parts), ["x", "g"], "id", range(2, 5), gamma=30.0).collect()
        got[parts] = {r["k"]: r["cost"] for r in out}
    assert got[1] == pytest.approx(got[5])
    for k, cost in got[1].items():
        assert cost == pytest.approx(kprototypes_by_hand(records, k, start, 30.0, 20))


def test_kprototypes_is_the_best_of_ten_starts(spark):
    rng = np.random.default_rng(5)
    records = [{"id": i, "x": float(rng.integers(0, 40)), "g": "abc"[rng.integers(0, 3)]} for i in range(60)]
    df = spark.createDataFrame([(r["id"], r["x"], r["g"]) for r in records], "id long, x double, g string").repartition(3)
    starts = [mixed._first_records(df, "id", 4, seed) for seed in range(123, 133)]
    assert len({str(s) for s in starts}) == 10
    got = {r["k"]: r["cost"] for r in mixed.kprototypes_costs(df, ["x", "g"], "id", range(2, 5), gamma=30.0, restarts=10).collect()}
    for k, cost in got.items():
        by_hand = [kprototypes_by_hand(records, k, s, 30.0, 20) for s in starts]
        assert cost == pytest.approx(min(by_hand))
        assert k == 2 or min(by_hand) < max(by_hand) * 0.9


def test_kprototypes_query_makes_ten_runs(monkeypatch):
    from benefacta.queries import segments
    from benefacta.queries.registry import QUERIES
    given = {}
    monkeypatch.setattr(segments, "experiment_table", lambda t: None)
    monkeypatch.setattr(mixed, "kprototypes_costs", lambda *args, **named: given.update(named))
    QUERIES["kprototypes_cost"](None)
    assert given["restarts"] == 10


def test_hierarchy(spark):
    rows = [(i, float(i // 25 * 100 + i % 3), "ab"[i % 2]) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, x double, g string")
    out = clustering.hierarchical_segments(df, ["x"], ["g"], 4)
    assert out.columns == ["id", "x", "g", "cluster"] and out.select("cluster").distinct().count() == 4


def test_more_clusters_than_records_is_an_error(spark):
    df = spark.createDataFrame([(i, float(i % 3), "a") for i in range(20)], "id long, x double, g string")
    with pytest.raises(ValueError, match="there are 3"):
        mixed.kprototypes_costs(df, ["x", "g"], "id", range(2, 5), gamma=1.0)


def test_lloyd_step(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (9.0, 1.0), (None, 1.0)], "a double, b double")
    out = {r["cluster"]: (r["n"], r["a"], r["b"]) for r in clustering.lloyd_step(df, ["a", "b"], {0: (0.0, 0.0), 7: (10.0, 0.0)}).collect()}
    assert out == {0: (2, 0.5, 0.0), 7: (1, 9.0, 1.0)}


def test_run_record(table):
    from benefacta.plans import experiments
    fitted = clustering.segment(table.filter("donor_id < 200"), segmentation.FEATURES, restarts=1)
    rows = experiments.run_record(fitted, segmentation.FEATURES, "r", n_components=3).collect()
    run = {r["metric"]: r["value"] for r in rows if r["cluster"] is None and r["parameter"] is None}
    given = {r["metric"]: r["parameter"] for r in rows if r["parameter"] is not None}
    assert run["best_k"] == run["n_clusters"] == fitted.k and run["silhouette"] == pytest.approx(dict(fitted.scores)[fitted.k], abs=0.05)
    assert given == {"clusters": str(fitted.k), "variables": "dltv, churn_prob, effectiveness", "n_components": "3"}
    assert sum(r["value"] for r in rows if r["metric"] == "size") == 200


def test_starts_are_drawn_from_all_rows(spark):
    from pyspark.ml.functions import array_to_vector
    # 40 far rows among 20,000, a third of which are one vector
    x = F.when(F.col("id") >= 19_960, 1000.0 + F.col("id") % 7).when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 20_000)
    df = spark.range(20_000).select(array_to_vector(F.array(x, x * 0)).alias(clustering.FEATURES))
    values = df.select(clustering.vector_to_array(clustering.FEATURES).alias("x"))
    drawn = [clustering._spread_starts(values.repartition(p), [2] * 10, list(range(10))) for p in (2, 7)]
    assert all((a == b).all() for a, b in zip(*drawn))
    assert all(start[:, 0].max() >= 1000 for start in drawn[0])
    assert len({float(start[0, 0]) for start in drawn[0]}) > 4
    for cost, centres in clustering.lloyd_runs(df, [2] * 10, list(range(10)), iterations=1):
        assert centres[:, 0].max() >= 1000 and cost < 20_000


def test_first_starts_follow_how_often_a_vector_occurs(spark):
    values = spark.range(900).select(F.array(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double"))).alias("x"))
    first = [float(s[0, 0]) for s in clustering._spread_starts(values, [1] * 300, list(range(300)))]
    assert 70 <= first.count(7.0) <= 130 and len(set(first)) > 120
    same = clustering._spread_starts(spark.range(5).select(F.array(F.lit(3.0)).alias("x")), [3], [1])
    assert same[0].tolist() == [[3.0]] * 3


def peak_mb(fn):
    import tracemalloc
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_a_batch_takes_little_memory_whatever_the_runs():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (40_000, 3))
    runs = {i: rng.normal(0, 1, (2 + i % 8, 3)) for i in range(80)}
    assert peak_mb(lambda: clustering._least_squares(x, list(runs.values()))) < 50  # 24 of them are the result
    assert peak_mb(lambda: clustering._nearest(x, np.concatenate(list(runs.values())))) < 20
    sums = clustering._Sums(runs)
    assert peak_mb(lambda: sums.add(x)) < 20
    far = np.square(x[:, None] - runs[7][None]).sum(axis=2)
    _run, total, sizes, cost = next(r for r in sums.each() if r[0] == 7)
    assert sizes.tolist() == np.bincount(far.argmin(axis=1), minlength=9).tolist() and cost == pytest.approx(far.min(axis=1).sum())
    assert total == pytest.approx(np.array([x[far.argmin(axis=1) == j].sum(axis=0) for j in range(9)]))


def test_restarts_advance_together_and_the_estimator_fits_the_best_only(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.random((400, 2))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    vectors = clustering.scaled_vectors(df, ["a", "b"])[0].persist()
    full, fitted = clustering.KMeans.fit, []
    monkeypatch.setattr(clustering.KMeans, "fit", lambda self, *a: fitted.append((self.getSeed(), self.getMaxIter())) or full(self, *a))
    found = clustering.fit_kmeans(vectors, 6, restarts=5, seed=3)
    assert sorted(s for s, most in fitted if most == 0) == [3, 4, 5, 6, 7] and 1 <= sum(most > 0 for _, most in fitted) < 5
    each = [full(clustering.KMeans(k=6, seed=3 + i, maxIter=300, tol=(1e-4 / 6) ** 0.5, featuresCol="features", predictionCol="cluster"), vectors) for i in range(5)]
    best = min(each, key=lambda m: m.summary.trainingCost)
    assert np.allclose(found.clusterCenters(), best.clusterCenters(), rtol=0, atol=1e-12)


def calls(fn):
    import sys
    seen = []
    sys.setprofile(lambda frame, event, arg: seen.append(event))
    try:
        fn()
    finally:
        sys.setprofile(None)
    return len(seen)


def test_a_pass_does_not_go_centre_by_centre():
    x = np.random.default_rng(4).normal(0, 1, (3000, 3))
    few, many = clustering._Sums({0: x[:2]}), clustering._Sums({0: x[:9]})
    assert calls(lambda: few.add(x)) == calls(lambda: many.add(x))


def test_of_equally_near_centres_the_first_takes_the_row():
    runs = {0: np.array([[0.0], [2.0], [2.0]]), 1: np.array([[3.0], [5.0], [9.0]])}
    sums = clustering._Sums(runs)
    sums.add(np.array([[1.0], [2.0], [4.0], [7.0], [8.0]]))
    found = {run: (total[:, 0].tolist(), sizes.tolist(), cost) for run, total, sizes, cost in sums.each()}
    assert found == {0: ([1.0, 21.0, 0.0], [1, 4, 0], 1 + 4 + 25 + 36), 1: ([7.0, 7.0, 8.0], [3, 1, 1], 4 + 1 + 1 + 4 + 1)}


def test_starts_make_no_python_object_of_each_row(spark, monkeypatch):
    values = spark.range(60).select(F.array(F.col("id").cast("double"), F.col("id") % 7 + 0.5).alias("x"))
    monkeypatch.setattr(type(values), "mapInPandas", None)
    starts = clustering._spread_starts(values, [2, 5], [1, 2])
    assert [len({*map(tuple, s.tolist())}) for s in starts] == [2, 5]


def test_nearest_centres_of_all_k_are_found_in_one_pass(spark, monkeypatch):
    x = np.random.default_rng(5).random((300, 2))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double")
    vectors = clustering.scaled_vectors(df, ["a", "b"])[0].persist()
    rows, plain, runs, lloyd = spark.sparkContext.accumulator(0), clustering._nearest, [], clustering.lloyd_runs

    def counted(part, centres):
        rows.add(len(part))
        return plain(part, centres)

    monkeypatch.setattr(clustering, "_nearest", counted)
    monkeypatch.setattr(clustering, "lloyd_runs", lambda *a: runs.extend(lloyd(*a)) or runs)
    scores = clustering.k_scores(vectors, range(2, 5), restarts=1)
    assert rows.value == 3 * 300
    for (k, score), (_, centres) in zip(scores, runs):
        apart = vectors.withColumn("cluster", clustering.nearest_of(centres)(F.col("features")))
        assert len(centres) == k and score == pytest.approx(clustering.silhouette(apart), abs=1e-12)
    vectors.unpersist()
