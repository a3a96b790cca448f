"""Scaling, clustering, segment assignment and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import boosting, cleaning, clustering, features, mixed, neighbours, outliers, quality, reduction, scaling, scoring, tiles
from ..plans import experiments, lifetime, segmentation
from ..session import fresh_path, materialise
from ..streaming.scoring import score_available, score_available_apart
from .inputs import AS_OF
from .registry import query
from .values import CHANNELS_SQL, EFFECT_SQL, LFV_SQL, lifetime_table

# Scaled positions (value, risk, effectiveness) that stand in for a trained model where SQL must agree.
CENTROIDS = {0: (-0.5, 0.0, -0.5), 1: (0.25, -0.75, 0.5), 2: (-0.25, 0.75, 0.25), 3: (1.5, -0.5, 0.5), 4: (-0.75, 1.5, -1.0)}
CENTROIDS_SQL = "centroids AS (SELECT * FROM (VALUES " + ", ".join(
    f"({code}, {x}, {y}, {z})" for code, (x, y, z) in CENTROIDS.items()) + ") AS c(code, x, y, z))"
SERVICE_CENTROIDS = {0: (-1.75, 200.0, -4.0), 1: (0.5, 100.0, 0.5), 2: (-0.25, 500.0, 0.25), 3: (1.5, 50.0, 0.5), 4: (-1.0, 700.0, -2.5)}
SERVICE_CENTROIDS_SQL = "centroids AS (SELECT * FROM (VALUES " + ", ".join(
    f"({code}, {x}, {y}, {z})" for code, (x, y, z) in SERVICE_CENTROIDS.items()) + ") AS c(code, x, y, z))"

NAMES_SQL = "CASE {0} WHEN 0 THEN 'Hibernando' WHEN 1 THEN 'Comprometidos' WHEN 2 THEN 'En riesgo' WHEN 3 THEN 'Campeones' WHEN 4 THEN 'En fuga' END"
KMEANS_RESTARTS = 10
KPROTOTYPES_RESTARTS = 10


def _z(c: str, table: str) -> str:
    return f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()"


@query("zscore_features", f"""
SELECT event_id, round({_z('value', 'events')}, 6) AS value_std,
       round({_z('user_id', 'events')}, 6) AS user_id_std FROM events""")
def _(t):
    frame = t.events.select("event_id", "value", "user_id")
    return scaling.zscore(frame, ["value", "user_id"]).select(
        "event_id", *[F.round(f"{c}_std", 6).alias(f"{c}_std") for c in ("value", "user_id")])


_TABLE = f"""{LFV_SQL}, {EFFECT_SQL},
features AS (SELECT lfv.donor_id, lfv.lifespan, lfv.dltv, effectiveness FROM lfv LEFT JOIN effect ON lfv.donor_id = effect.donor_id),
complete AS (SELECT d.donor_id, f.dltv, d.churn_prob, f.effectiveness FROM donors d JOIN features f ON d.donor_id = f.donor_id
  WHERE f.dltv IS NOT NULL AND d.churn_prob IS NOT NULL AND f.effectiveness IS NOT NULL),
scaled AS (SELECT donor_id, {_z('dltv', '')} AS a, {_z('churn_prob', '')} AS b, {_z('effectiveness', '')} AS c FROM complete)"""
_NEAREST = f"""{CENTROIDS_SQL},
coded AS (SELECT donor_id, first(code ORDER BY d, code) AS cluster
  FROM (SELECT donor_id, code, (a - x) * (a - x) + (b - y) * (b - y) + (c - z) * (c - z) AS d FROM scaled CROSS JOIN centroids)
  GROUP BY donor_id)"""

TABLE_SQL, NEAREST_SQL = _TABLE, _NEAREST  # for other modules


def donor_table(t):
    return features.donor_features(lifetime_table(t), t.transactions)


def segmentation_table(t):
    return features.segmentation_input(donor_table(t), t.donors)


@query("assign_centroids", f"WITH {_TABLE}, {_NEAREST} SELECT donor_id, CAST(cluster AS INT) AS cluster FROM coded")
def _(t):
    table = materialise(scoring.drop_null_features(segmentation_table(t), segmentation.FEATURES), "training-table")
    code = clustering.nearest_centroid([f"{c}_std" for c in segmentation.FEATURES], CENTROIDS)
    return scaling.zscore(table, segmentation.FEATURES).select("donor_id", code.alias("cluster"))


@query("assign_segments", f"""WITH {_TABLE}, {_NEAREST}
SELECT d.donor_id, round(f.dltv, 2) AS dltv,
       CASE WHEN d.donor_id IN (SELECT donor_id FROM transactions GROUP BY donor_id HAVING max(tx_date) > DATE '2001-05-04') THEN 'Nuevo'
            ELSE coalesce({NAMES_SQL.format('cluster')}, 'No asignado') END AS segment
FROM donors d LEFT JOIN features f ON d.donor_id = f.donor_id LEFT JOIN coded ON d.donor_id = coded.donor_id
UNION ALL SELECT s_suppkey + 1000000000, NULL, 'Nuevo' FROM supplier""")
def _(t):
    captured = t.transactions.groupBy("donor_id").agg(F.max("tx_date").alias("capture_date"))
    known = cleaning.split_recent(captured, "capture_date", dates.days_before(AS_OF))[1].select("donor_id")
    unknown = t.supplier.select((F.col("s_suppkey") + 1_000_000_000).alias("donor_id"))
    table = materialise(donor_table(t), "donor-features")  # stored by the lifetime-value job
    out = segmentation.assign_segments(t.donors, table, CENTROIDS, known.unionByName(unknown))
    return out.select("donor_id", F.round("dltv", 2).alias("dltv"), "segment")


_SCORED = f"""{SERVICE_CENTROIDS_SQL},
typed AS (SELECT request_id, TRY_CAST(churn AS DOUBLE) AS churn, TRY_CAST(dltv AS DOUBLE) AS dltv,
                 TRY_CAST(effectiveness AS DOUBLE) AS effectiveness FROM requests),
z AS (SELECT *, (dltv - 2052875.1935207853) / 1106063.9693825627 AS a, (churn - 0.7525753912711541) / 0.5247159306383898 AS b,
             (effectiveness - 0.9211417379699978) / 0.14987482287122253 AS c FROM typed),
best AS (SELECT request_id, first(code ORDER BY (a - x) * (a - x) + (b - y) * (b - y) + (c - z.c0) * (c - z.c0), code) AS cluster
  FROM (SELECT z.request_id, z.a, z.b, z.c, k.code, k.x, k.y, k.z AS c0 FROM z CROSS JOIN centroids k
        WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL) z GROUP BY request_id)
SELECT typed.request_id, churn, dltv, effectiveness, CAST(cluster AS INT) AS cluster,
       coalesce({NAMES_SQL.format('cluster')}, 'No se puede clasificar') AS segment
FROM typed LEFT JOIN best ON typed.request_id = best.request_id"""


@query("score_requests", f"WITH {_SCORED}")
def _(t):
    return scoring.score_requests(t.requests, SERVICE_CENTROIDS).drop("errors")


@query("score_stream", f"WITH {_SCORED}")
def _(t):
    scored = score_available(t.spark, t.folder, "events.parquet", lambda events: t.view("requests", events=events),
                             SERVICE_CENTROIDS, fresh_path(t.spark, "scores"), fresh_path(t.spark, "scores-progress"))
    return scored.drop("errors")


def _streamed_apart(t):
    return score_available_apart(t.spark, t.folder, "events.parquet", lambda events: t.view("requests", events=events),
                                 SERVICE_CENTROIDS, fresh_path(t.spark, "scores-apart"), fresh_path(t.spark, "scores-apart-progress"))


@query("score_stream_accepted", """WITH accepted AS ({}) SELECT a.* FROM accepted a JOIN requests r ON a.request_id = r.request_id
WHERE r.churn IS NULL OR TRY_CAST(r.churn AS DOUBLE) IS NOT NULL""".format(f"WITH {_SCORED}"))
def _(t):
    return _streamed_apart(t)[0]


@query("score_stream_rejected", """
SELECT request_id, churn, dltv, effectiveness, 'churn' AS errors FROM requests WHERE churn IS NOT NULL AND TRY_CAST(churn AS DOUBLE) IS NULL""")
def _(t):
    _scores, rejected = _streamed_apart(t)
    return rejected.withColumn("errors", F.array_join("errors", ","))


DIMENSIONS = 64  # of the embeddings


def embedding_columns(t):
    return t.embeddings.select(F.col("label").alias("cluster"), *[
        F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(DIMENSIONS)])


@query("cluster_profile", """
SELECT label AS cluster, count(*) AS size, """ + ", ".join(f"round(avg(embedding[{i + 1}]), 5) AS mean_x{i}" for i in range(DIMENSIONS)) + """,
       round(count(*) / (SELECT count(*) FROM embeddings), 8) AS share FROM embeddings GROUP BY label""")
def _(t):
    names = [f"x{i}" for i in range(DIMENSIONS)]
    profile = quality.cluster_profile(embedding_columns(t), names)
    return profile.withColumns({f"mean_{x}": F.round(f"mean_{x}", 5) for x in names} | {"share": F.round("share", 8)})


@query("cluster_metrics_long", """WITH p AS (
  SELECT label AS cluster, CAST(count(*) AS DOUBLE) AS size, count(*) / (SELECT count(*) FROM embeddings) AS share FROM embeddings GROUP BY label),
m AS (SELECT label AS cluster, i, avg(embedding[i + 1]) AS mean FROM embeddings, range(64) AS r(i) GROUP BY 1, 2)
SELECT 'run' AS run_id, cluster, 'size' AS metric, round(size, 5) AS value FROM p
UNION ALL SELECT 'run', cluster, 'mean_x' || i, round(mean, 5) FROM m
UNION ALL SELECT 'run', cluster, 'share', round(share, 5) FROM p""")
def _(t):
    return experiments.profile_metrics(embedding_columns(t), [f"x{i}" for i in range(DIMENSIONS)], "run").withColumn(
        "value", F.round("value", 5))


_KINDS = {"DI - Regular": "regular", "PF - Padrinazgo familiar": "family", "PI - Padrinazgo individual": "individual",
          "Unica": "single"}  # other channels, such as Evento, go to other


@query("cluster_categories", f"""WITH {CHANNELS_SQL}
SELECT gender AS cluster, main_channel AS category, count(*) AS n FROM donors JOIN channels USING (donor_id) GROUP BY 1, 2""")
def _(t):
    table = t.donors.join(features.donor_channels(t.transactions), "donor_id")
    return quality.cluster_categories(table.withColumn("cluster", F.col("gender")), "main_channel")


@query("cluster_category_counts", f"""WITH {CHANNELS_SQL}
SELECT gender AS cluster, {", ".join(f"count(*) FILTER (main_channel = '{k}') AS {v}" for k, v in _KINDS.items())},
       count(*) FILTER (main_channel NOT IN {tuple(_KINDS)}) AS other
FROM donors JOIN channels USING (donor_id) GROUP BY gender""")
def _(t):
    table = t.donors.join(features.donor_channels(t.transactions), "donor_id")
    return quality.cluster_category_counts(table.withColumn("cluster", F.col("gender")), "main_channel", _KINDS)


_SILHOUETTE = """pairs AS (SELECT a.vec_id, a.label AS own, b.label AS other, {distance} AS d
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
means AS (SELECT vec_id, own, other, avg(d) AS m FROM pairs GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, own, max(m) FILTER (own = other) AS a, min(m) FILTER (own <> other) AS b FROM means GROUP BY 1, 2)
SELECT vec_id, own AS cluster, round(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END, 5) AS silhouette FROM ab"""
_SQUARED = "list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (CAST(p[1] AS DOUBLE) - p[2]) * (CAST(p[1] AS DOUBLE) - p[2])))"


@query("silhouette_squared", "WITH " + _SILHOUETTE.format(distance=_SQUARED))
def _(t):
    frame = t.embeddings.withColumnRenamed("label", "cluster")
    return quality.squared_silhouette(frame, "embedding", key="vec_id").withColumn("silhouette", F.round("silhouette", 5))


@query("silhouette_euclidean", "WITH " + _SILHOUETTE.format(distance=f"sqrt({_SQUARED})"))
def _(t):
    frame = t.embeddings.withColumnRenamed("label", "cluster")
    return tiles.euclidean_silhouette(frame, "embedding", key="vec_id").withColumn("silhouette", F.round("silhouette", 5))


_MIXED_SQL = f"""{LFV_SQL}, {CHANNELS_SQL},
mixed AS (SELECT lfv.donor_id, dltv, lfv.age, churn_max, instalments_paid / (tenure_years + 1) AS avg_paid,
                 instalments_unpaid / (tenure_years + 1) AS avg_unpaid, gender, main_channel, channels
  FROM lfv JOIN donors USING (donor_id) LEFT JOIN channels USING (donor_id))"""
MIXED_SQL = _MIXED_SQL.removeprefix(f"{LFV_SQL}, ")
_NUMERIC = experiments.MIXED_NUMERIC
_CATEGORICAL = experiments.MIXED_CATEGORICAL


def experiment_table(t):
    values = lifetime.with_instalment_averages(lifetime_table(t), t.donors)
    return features.experiment_table(values, t.donors, t.transactions)


_GOWER_KEYS = f"""known AS (SELECT * FROM mixed WHERE dltv IS NOT NULL AND age IS NOT NULL),
picked AS (SELECT * FROM known ORDER BY md5('1:' || CAST(donor_id AS VARCHAR)), donor_id LIMIT 1000),
spans AS (SELECT max(dltv) - min(dltv) AS r1, max(age) - min(age) AS r2, max(avg_paid) - min(avg_paid) AS r3,
                 max(avg_unpaid) - min(avg_unpaid) AS r4 FROM {{0}})"""
_GOWER = """(abs({a}.dltv - {b}.dltv) / r1 + abs({a}.age - {b}.age) / r2 + abs({a}.avg_paid - {b}.avg_paid) / r3
  + abs({a}.avg_unpaid - {b}.avg_unpaid) / r4 + CASE WHEN {a}.gender = {b}.gender THEN 0 ELSE 1 END
  + CASE WHEN {a}.main_channel = {b}.main_channel THEN 0 ELSE 1 END) / 6"""

GOWER_KEYS_SQL, GOWER_SQL = _GOWER_KEYS, _GOWER  # for other modules


@query("gower_pairs", f"""WITH {_MIXED_SQL}, {_GOWER_KEYS.format('picked')},
pairs AS (SELECT p.donor_id, {_GOWER.format(a='p', b='q')} AS d FROM picked p JOIN picked q ON p.donor_id <> q.donor_id, spans)
SELECT donor_id, count(*) AS others, round(avg(d), 5) AS mean_distance, round(max(d), 5) AS max_distance
FROM pairs GROUP BY donor_id""")
def _(t):
    matrix = mixed.gower_matrix(experiment_table(t), "donor_id", _NUMERIC, _CATEGORICAL)
    return mixed.gower_summary(matrix, "donor_id").withColumns(
        {c: F.round(c, 5) for c in ("mean_distance", "max_distance")})


NEIGHBOURS = 3


@query("gower_neighbours", f"""WITH {_MIXED_SQL}, {_GOWER_KEYS.format('known')},
pairs AS (SELECT p.donor_id, q.donor_id AS neighbour, round({_GOWER.format(a='p', b='q')}, 9) AS d
          FROM known p JOIN known q ON p.donor_id <> q.donor_id, spans),
ranked AS (SELECT *, row_number() OVER (PARTITION BY donor_id ORDER BY d, neighbour) AS place FROM pairs)
SELECT donor_id, neighbour, round(d, 6) AS distance, CAST(place AS INT) AS place FROM ranked WHERE place <= {NEIGHBOURS}""")
def _(t):
    found = neighbours.gower_neighbours(experiment_table(t), "donor_id", _NUMERIC, _CATEGORICAL, NEIGHBOURS)
    return found.withColumn("distance", F.round("distance", 6))


PROTOTYPES = {
    0: {"dltv": 100000.0, "age": 30, "avg_paid": 2.0, "avg_unpaid": 1.0, "gender": "BUILDING", "main_channel": "DI - Regular"},
    1: {"dltv": 500000.0, "age": 45, "avg_paid": 4.0, "avg_unpaid": 0.5, "gender": "MACHINERY", "main_channel": "Unica"},
    2: {"dltv": 900000.0, "age": 60, "avg_paid": 8.0, "avg_unpaid": 2.0, "gender": "HOUSEHOLD", "main_channel": "Evento"},
    3: {"dltv": 50000.0, "age": 75, "avg_paid": 1.0, "avg_unpaid": 0.0, "gender": "FURNITURE", "main_channel": "PF - Padrinazgo familiar"},
}
_PROTOTYPES_SQL = "protos AS (SELECT * FROM (VALUES " + ", ".join(
    f"({code}, {p['dltv']}, {p['age']}, {p['avg_paid']}, {p['avg_unpaid']}, '{p['gender']}', '{p['main_channel']}')"
    for code, p in PROTOTYPES.items()) + ") AS p(prototype, dltv, age, avg_paid, avg_unpaid, gender, main_channel))"

PROTOTYPES_SQL = _PROTOTYPES_SQL


@query("gower_to_prototypes", f"""WITH {_MIXED_SQL}, {_GOWER_KEYS.format('known')}, {_PROTOTYPES_SQL}
SELECT k.donor_id, CAST(p.prototype AS INT) AS prototype, round({_GOWER.format(a='k', b='p')}, 6) AS distance
FROM known k, protos p, spans""")
def _(t):
    table = materialise(experiment_table(t).dropna(subset=_NUMERIC), "mixed-table")
    return mixed.gower_to_prototypes(table, "donor_id", _NUMERIC, _CATEGORICAL, PROTOTYPES).withColumn(
        "distance", F.round("distance", 6))


# Iterative fits: no SQL twin; ``fits`` has what SQL can say about them.

@query("kmeans_segments")
def _(t):
    return experiments.kmeans_experiment(lifetime_table(t), restarts=KMEANS_RESTARTS).labelled


@query("kmeans_embeddings")
def _(t):
    frame = t.embeddings.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(64)])
    fitted = clustering.segment(frame, [f"x{i}" for i in range(64)], k=10)
    return fitted.labelled.select("vec_id", "cluster")


@query("best_k")
def _(t):
    table = materialise(scoring.drop_null_features(segmentation_table(t), segmentation.FEATURES), "training-table")
    vectors, _stages = clustering.scaled_vectors(table, segmentation.FEATURES)
    vectors = vectors.persist()
    try:
        scores = clustering.k_scores(vectors)
    finally:
        vectors.unpersist()
    best = clustering.pick_k(scores)
    return t.spark.createDataFrame([(k, s, k == best) for k, s in scores], "k int, silhouette double, chosen boolean")


@query("train_segments")
def _(t):
    training = segmentation.train_segments(segmentation_table(t))
    return segmentation.with_segments(t.donors, training.labelled).select(
        "donor_id", "cluster", "dltv", "effectiveness")


@query("segment_importance")
def _(t):
    training = segmentation.train_segments(segmentation_table(t), k=5)
    return quality.segment_importance(training.labelled, segmentation.FEATURES, "donor_id")


@query("boosted_importance")
def _(t):
    training = segmentation.train_segments(segmentation_table(t))
    return boosting.boosted_importance(training.labelled, segmentation.FEATURES, "donor_id")


@query("pca_scores")
def _(t):
    normal, _out = outliers.split_outliers(materialise(experiment_table(t), "pca-table"), "dltv")
    return reduction.pca_scores(normal, experiments.PCA_COLUMNS).select("donor_id", *reduction.SCORE_NAMES)


@query("pca_segments")
def _(t):
    fitted = experiments.pca_experiment(experiment_table(t))
    return quality.cluster_profile(fitted.labelled, list(reduction.SCORE_NAMES))


@query("kprototypes_cost")
def _(t):
    return mixed.kprototypes_costs(experiment_table(t), [*_NUMERIC, *_CATEGORICAL], "donor_id", restarts=KPROTOTYPES_RESTARTS, init="huang")


@query("hierarchical_segments")
def _(t):
    return experiments.hierarchical_experiment(experiment_table(t)).select(
        "donor_id", "cluster", *_NUMERIC, *_CATEGORICAL)


MARITAL = ["Soltero", "Casado", "Viudo", "Otro"]


def linkage_table(t):
    """The experiment's columns with the marital status, which the test tables lack; it follows from the donor's number."""
    status = F.when(F.col("donor_id") % 7 != 0, F.get(F.array(*map(F.lit, MARITAL)), F.col("donor_id") % 4))
    return experiment_table(t).withColumn("marital_status", status)


@query("linkage_segments")
def _(t):
    _found, labelled = experiments.linkage_experiment(linkage_table(t))
    return labelled.select("donor_id", "cluster", *_NUMERIC, *experiments.LINKED_CATEGORICAL)


@query("linkage_tree")
def _(t):
    found, _labelled = experiments.linkage_experiment(linkage_table(t))
    return found.tree(t.spark)
