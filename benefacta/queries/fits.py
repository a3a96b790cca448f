"""What SQL can say about iterative fits: single steps from given centres, and facts that every right fit meets.

Labels of a fit depend on its starts, so the fits themselves (``segments``) have no SQL twin. Here each gives
the rows that must have been used, and counts of rows and clusters that break a rule, which must be 0.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Row, functions as F

from ..operators import boosting, clustering, linkage, mixed, outliers, quality, reduction, scaling, scoring
from ..operators.sampling import seeded_sample
from ..plans import experiments, segmentation
from ..session import materialise
from .registry import query
from .segments import (CENTROIDS, GOWER_KEYS_SQL, GOWER_SQL, KMEANS_RESTARTS, KPROTOTYPES_RESTARTS, MIXED_SQL, NEAREST_SQL, PROTOTYPES, PROTOTYPES_SQL, TABLE_SQL,
                       embedding_columns, experiment_table, linkage_table, segmentation_table)
from .values import LFV_SQL, lifetime_table

GAMMA = 1000.0


def _fences(table: str, column: str, name: str) -> str:
    return f"""{name} AS (SELECT t.* FROM {table} t, (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM {table}) q
  WHERE {column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))"""


def fit_facts(fitted: clustering.Segmentation, columns: list[str], rows: DataFrame | None = None) -> DataFrame:
    """Rows and clusters of a fit; rows not at their nearest centre; centres off the mean of their rows (0.05 scaled units).

    ``rows`` are those the centres were fitted on, if not all labelled ones.
    """
    vectors = fitted.model.transform(fitted.labelled.drop("cluster") if rows is None else rows)
    centres = fitted.model.stages[-1].clusterCenters()
    scaled = [f"{c}_std" for c in columns]
    nearest = clustering.nearest_of(np.array(centres))(F.col(clustering.FEATURES))
    n = len(centres)
    given = fitted.labelled.agg(F.count("*").alias("rows"), F.count_distinct("cluster").alias("clusters"))
    counted = vectors.withColumn("nearest", nearest).groupBy("cluster").agg(
        F.count_if(F.col("cluster") != F.col("nearest")).alias("misplaced"), *[F.avg(c).alias(c) for c in scaled])
    off = reduce(lambda a, b: a | b, [F.abs(F.col(c) - F.get(F.array(*[F.lit(float(x[j])) for x in centres]), "cluster")) > 0.05
                                      for j, c in enumerate(scaled)])
    broken = counted.agg(F.sum("misplaced").alias("misplaced"), F.count_if(off).alias("off_centre"))
    return given.withColumns({"misplaced": broken.select("misplaced").scalar(), "off_centre": broken.select("off_centre").scalar(),
                              "wanted": F.lit(n).cast("bigint")})


@query("kmeans_segments_facts", f"""WITH {LFV_SQL}, {_fences('lfv', 'dltv', 'inside')}
SELECT (SELECT count(*) FROM inside WHERE age IS NOT NULL AND churn_max IS NOT NULL) AS rows, CAST(5 AS BIGINT) AS clusters,
       CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS off_centre, CAST(5 AS BIGINT) AS wanted""")
def _(t):
    return fit_facts(experiments.kmeans_experiment(lifetime_table(t), restarts=KMEANS_RESTARTS), experiments.KMEANS_COLUMNS)


@query("kmeans_embeddings_facts", """
SELECT count(*) AS rows, CAST(10 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS off_centre,
       CAST(10 AS BIGINT) AS wanted FROM embeddings""")
def _(t):
    frame = embedding_columns(t).drop("cluster")
    return fit_facts(clustering.segment(frame, frame.columns, k=10), frame.columns)


@query("train_segments_facts", f"""WITH {TABLE_SQL}, {_fences('complete', 'dltv', 'inside')}, {_fences('inside', 'churn_prob', 'kept')}
SELECT (SELECT count(*) FROM complete) AS labelled, (SELECT count(*) FROM kept) AS trained, CAST(0 AS BIGINT) AS misplaced,
       CAST(0 AS BIGINT) AS off_centre, true AS rule_holds""")
def _(t):
    table = materialise(scoring.drop_null_features(segmentation_table(t), segmentation.FEATURES), "training-table")
    training = segmentation.train_segments(table)
    normal, _ = outliers.split_outliers_chained(table, segmentation.FEATURES[:2])
    facts = fit_facts(training, segmentation.FEATURES, normal)
    holds = training.k == clustering.pick_k(training.scores) and [k for k, _ in training.scores] == list(range(2, 10))
    return facts.select(F.col("rows").alias("labelled"), F.lit(normal.count()).cast("bigint").alias("trained"), "misplaced",
                        "off_centre", F.lit(holds).alias("rule_holds"))


@query("best_k_facts", "SELECT CAST(k AS INT) AS k, true AS in_range FROM range(2, 10) AS r(k)")
def _(t):
    table = materialise(scoring.drop_null_features(segmentation_table(t), segmentation.FEATURES), "training-table")
    vectors, _ = clustering.scaled_vectors(table, segmentation.FEATURES)
    vectors = vectors.persist()
    try:
        scores = clustering.k_scores(vectors)
    finally:
        vectors.unpersist()
    return t.spark.createDataFrame([(k, -1 <= s <= 1) for k, s in scores], "k int, in_range boolean")


@query("pca_scores_facts", f"""WITH {LFV_SQL}, {MIXED_SQL}, {_fences('mixed', 'dltv', 'inside')}
SELECT count(*) AS rows, true AS centred, true AS uncorrelated, true AS falling FROM inside
WHERE age IS NOT NULL AND avg_paid IS NOT NULL AND avg_unpaid IS NOT NULL AND channels IS NOT NULL AND churn_max IS NOT NULL""")
def _(t):
    normal, _ = outliers.split_outliers(materialise(experiment_table(t), "pca-table"), "dltv")
    scores = reduction.pca_scores(normal, experiments.PCA_COLUMNS)
    a, b, c = (F.col(n) for n in reduction.SCORE_NAMES)
    return scores.agg(
        F.count("*").alias("rows"), (F.greatest(*[F.abs(F.avg(x)) for x in (a, b, c)]) < 1e-6).alias("centred"),
        (F.greatest(*[F.abs(F.corr(x, y)) for x, y in ((a, b), (a, c), (b, c))]) < 1e-6).alias("uncorrelated"),
        ((F.var_pop(a) >= F.var_pop(b)) & (F.var_pop(b) >= F.var_pop(c))).alias("falling"))


@query("pca_segments_facts", f"""WITH {LFV_SQL}, {MIXED_SQL}, {_fences('mixed', 'dltv', 'inside')}
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS off_centre FROM inside
WHERE age IS NOT NULL AND avg_paid IS NOT NULL AND avg_unpaid IS NOT NULL AND channels IS NOT NULL AND churn_max IS NOT NULL""")
def _(t):
    fitted = experiments.pca_experiment(experiment_table(t))
    return fit_facts(fitted, list(reduction.SCORE_NAMES)).select("rows", "misplaced", "off_centre")


@query("hierarchical_segments_facts", f"""WITH {LFV_SQL}, {MIXED_SQL}, {_fences('mixed', 'dltv', 'inside')}
SELECT count(*) AS rows, CAST(4 AS BIGINT) AS clusters FROM inside
WHERE age IS NOT NULL AND avg_paid IS NOT NULL AND avg_unpaid IS NOT NULL AND gender IS NOT NULL AND main_channel IS NOT NULL""")
def _(t):
    labelled = experiments.hierarchical_experiment(experiment_table(t))
    return labelled.agg(F.count("*").alias("rows"), F.count_distinct("cluster").alias("clusters"))


@query("segment_importance_facts", "SELECT CAST(3 AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total, true AS better_than_chance")
def _(t):
    training = segmentation.train_segments(segmentation_table(t), k=5)
    found = quality.segment_importance(training.labelled, segmentation.FEATURES, "donor_id")
    return found.agg(F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
                     (F.min("accuracy") > 0.5).alias("better_than_chance"))


@query("boosted_importance_facts", "SELECT CAST(3 AS BIGINT) AS features, true AS used, true AS gained, true AS beats_largest")
def _(t):
    labelled = segmentation.train_segments(segmentation_table(t)).labelled
    found = boosting.boosted_importance(labelled, segmentation.FEATURES, "donor_id")
    sizes = [r["count"] for r in labelled.groupBy("cluster").count().collect()]  # one row per cluster
    return found.agg(F.count("*").alias("features"), (F.min("splits") > 0).alias("used"), (F.min("gain") > 0).alias("gained"),
                     (F.min("accuracy") > max(sizes) / sum(sizes)).alias("beats_largest"))


BOOSTED = 8  # components of the embeddings
CUTS = [-0.2, -0.1, 0.0, 0.1, 0.2]


@query("boosting_first_cuts", f"""
WITH k AS (SELECT count(DISTINCT label) AS k, 2.0 / count(DISTINCT label) * (1 - 1.0 / count(DISTINCT label)) AS h FROM embeddings),
classes AS (SELECT DISTINCT label AS class FROM embeddings),
sums AS (SELECT class, f, cut, count(*) AS n, count(*) FILTER (CAST(embedding[f + 1] AS DOUBLE) <= cut) AS ln,
                sum(1.0 / k - CASE WHEN label = class THEN 1 ELSE 0 END) AS g,
                coalesce(sum(1.0 / k - CASE WHEN label = class THEN 1 ELSE 0 END) FILTER (CAST(embedding[f + 1] AS DOUBLE) <= cut), 0) AS lg
         FROM embeddings, k, classes, range({BOOSTED}) AS r(f), (VALUES {", ".join(f"({c}::DOUBLE)" for c in CUTS)}) AS c(cut) GROUP BY ALL),
gains AS (SELECT class, f, cut, round(0.5 * (lg * lg / (ln * h + 1) + (g - lg) * (g - lg) / ((n - ln) * h + 1) - g * g / (n * h + 1)), 9) AS gain
          FROM sums, k WHERE ln * h >= 1 AND (n - ln) * h >= 1)
SELECT class, CAST(f AS INT) AS feature, cut, round(gain, 6) AS gain FROM gains WHERE gain > 1e-6
QUALIFY row_number() OVER (PARTITION BY class ORDER BY gain DESC, f, cut) = 1""")
def _(t):
    names = [f"x{i}" for i in range(BOOSTED)]
    rows = embedding_columns(t).select("cluster", *names)
    model = boosting.fit(rows, names, "cluster", [np.array(CUTS)] * BOOSTED, rounds=1, depth=1)
    gains = iter(model.splits)
    found = [(c, int(tree.feature[0]), float(CUTS[tree.cut[0]]), round(next(gains)[1], 6))
             for c, tree in zip(model.classes, model.rounds[0]) if tree.feature[0] >= 0]
    return t.spark.createDataFrame(found, "class int, feature int, cut double, gain double")


@query("lloyd_step", f"""WITH {TABLE_SQL}, {NEAREST_SQL}
SELECT CAST(cluster AS INT) AS cluster, count(*) AS n, round(avg(a), 6) AS value, round(avg(b), 6) AS risk, round(avg(c), 6) AS effect
FROM scaled JOIN coded USING (donor_id) GROUP BY cluster""")
def _(t):
    table = materialise(scoring.drop_null_features(segmentation_table(t), segmentation.FEATURES), "training-table")
    names = [f"{c}_std" for c in segmentation.FEATURES]
    step = clustering.lloyd_step(scaling.zscore(table, segmentation.FEATURES), names, CENTROIDS)
    return step.select("cluster", "n", *[F.round(c, 6).alias(n) for c, n in zip(names, ("value", "risk", "effect"))])


@query("kprototypes_step", f"""WITH {LFV_SQL}, {MIXED_SQL}, {PROTOTYPES_SQL},
known AS (SELECT donor_id, dltv, age, avg_paid, avg_unpaid, gender, main_channel FROM mixed
          WHERE dltv IS NOT NULL AND age IS NOT NULL AND avg_paid IS NOT NULL AND avg_unpaid IS NOT NULL),
far AS (SELECT k.*, p.prototype, pow(k.dltv - p.dltv, 2) + pow(k.age - p.age, 2) + pow(k.avg_paid - p.avg_paid, 2)
         + pow(k.avg_unpaid - p.avg_unpaid, 2) + {GAMMA} * (CASE WHEN k.gender IS NOT DISTINCT FROM p.gender THEN 0 ELSE 1 END
         + CASE WHEN k.main_channel IS NOT DISTINCT FROM p.main_channel THEN 0 ELSE 1 END) AS d FROM known k, protos p),
own AS (SELECT * FROM far QUALIFY row_number() OVER (PARTITION BY donor_id ORDER BY d, prototype) = 1),
means AS (SELECT prototype, avg(dltv) AS dltv, avg(age) AS age, avg(avg_paid) AS avg_paid, avg(avg_unpaid) AS avg_unpaid FROM own GROUP BY 1),
genders AS (SELECT prototype, gender FROM own GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY prototype ORDER BY count(*) DESC, gender) = 1),
kinds AS (SELECT prototype, main_channel FROM own GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY prototype ORDER BY count(*) DESC, main_channel) = 1)
SELECT CAST(prototype AS INT) AS prototype, round(dltv, 2) AS dltv, round(age, 6) AS age, round(avg_paid, 6) AS avg_paid,
       round(avg_unpaid, 6) AS avg_unpaid, gender, main_channel FROM means JOIN genders USING (prototype) JOIN kinds USING (prototype)""")
def _(t):
    columns = [*experiments.MIXED_NUMERIC, *experiments.MIXED_CATEGORICAL]
    start = [{c: PROTOTYPES[i][c] for c in columns} for i in sorted(PROTOTYPES)]
    moved, _cost = mixed.kprototypes_step(experiment_table(t), columns, start, GAMMA)
    rows = [Row(prototype=i, **{c: p[c] if isinstance(p[c], str) else float(p[c]) for c in columns}) for i, p in enumerate(moved)]
    schema = "prototype int, dltv double, age double, avg_paid double, avg_unpaid double, gender string, main_channel string"
    return t.spark.createDataFrame(rows, schema).withColumns(
        {"dltv": F.round("dltv", 2)} | {c: F.round(c, 6) for c in ("age", "avg_paid", "avg_unpaid")})


@query("kprototypes_cost_facts", f"""WITH {LFV_SQL}, {MIXED_SQL},
known AS (SELECT * FROM mixed WHERE dltv IS NOT NULL AND age IS NOT NULL AND avg_paid IS NOT NULL AND avg_unpaid IS NOT NULL),
whole AS (SELECT count(*) * (var_pop(dltv) + var_pop(age) + var_pop(avg_paid) + var_pop(avg_unpaid)) AS squares FROM known)
SELECT CAST(k AS INT) AS k, round(squares / 1e6, 0) AS squares, true AS right_cost, true AS below_squares, true AS ended FROM whole, range(2, 10) AS r(k)""")
def _(t):
    columns = [*experiments.MIXED_NUMERIC, *experiments.MIXED_CATEGORICAL]
    table = materialise(experiment_table(t), "mixed-table")
    known = table.dropna(subset=experiments.MIXED_NUMERIC)
    squares = known.agg(F.count("*") * sum(F.var_pop(c) for c in experiments.MIXED_NUMERIC)).first()[0]
    found = []
    for k, cost, iterations, prototypes, gamma in mixed.kprototypes_fits(table, columns, "donor_id", restarts=KPROTOTYPES_RESTARTS, init="huang"):
        plain = mixed.assigned_cost(known, columns, prototypes, gamma).first()["cost"]
        found.append((k, squares, abs(plain - cost) <= 1e-6 * cost, cost < squares, 1 <= iterations <= 20))
    return t.spark.createDataFrame(found, "k int, squares double, right_cost boolean, below_squares boolean, ended boolean").withColumn(
        "squares", F.round(F.col("squares") / 1e6, 0))


_LINKED_ROWS = f"""{LFV_SQL}, {MIXED_SQL}, {_fences('mixed', 'dltv', 'inside')},
linked AS (SELECT count(*) AS rows FROM inside WHERE age IS NOT NULL AND avg_paid IS NOT NULL AND avg_unpaid IS NOT NULL)"""


@query("linkage_segments_facts", f"WITH {_LINKED_ROWS} SELECT rows, CAST(4 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS unlabelled FROM linked")
def _(t):
    _, labelled = experiments.linkage_experiment(linkage_table(t))
    return labelled.agg(F.count("*").alias("rows"), F.count_distinct("cluster").alias("clusters"),
                        F.count_if(F.col("cluster").isNull()).alias("unlabelled"))


@query("linkage_tree_facts", f"WITH {_LINKED_ROWS} SELECT rows, true AS rising FROM linked")
def _(t):
    found, _ = experiments.linkage_experiment(linkage_table(t))
    heights = [height for *_, height, _ in found.merges]
    rising = all(a <= b + 1e-9 for a, b in zip(heights, heights[1:]))
    return t.spark.createDataFrame([(found.merges[-1][3], rising)], "rows long, rising boolean")


@query("linkage_first_merges", f"""WITH {LFV_SQL}, {MIXED_SQL}, {GOWER_KEYS_SQL.format('picked')},
pairs AS (SELECT {GOWER_SQL.format(a='p', b='q')} AS d FROM picked p JOIN picked q ON p.donor_id < q.donor_id, spans)
SELECT (SELECT count(*) FROM picked) - (SELECT count(*) FROM (SELECT DISTINCT dltv, age, avg_paid, avg_unpaid, gender, main_channel FROM picked)) AS equal_rows,
       (SELECT round(min(d), 6) FROM pairs WHERE d > 1e-9) AS first_height""")
def _(t):
    columns = [*experiments.MIXED_NUMERIC, *experiments.MIXED_CATEGORICAL]
    sample = seeded_sample(experiment_table(t).select("donor_id", *columns).dropna(subset=experiments.MIXED_NUMERIC), "donor_id")
    found = linkage.hierarchy(sample, experiments.MIXED_NUMERIC, experiments.MIXED_CATEGORICAL, most=1000)
    equal = int(found.leaves.n.sum()) - len(found.leaves.n)
    return t.spark.createDataFrame([(equal, round(found.merges[0][2], 6))], "equal_rows long, first_height double")
