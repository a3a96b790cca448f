"""One query for each operator of this subpackage, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (centroids, compression, counterfactual, dart, decontaminate, discriminant, fim, overlap, ownership, phrases, poisson, risk, sql, warc)
from .frames import free_name

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def held_out(folds: int, fold: int) -> Column:
    return F.coalesce(remainder(folds) == fold, F.lit(False))


@query
def op1_secret_ownership(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return ownership.secret_report(docs)


@query
def op2_dart_minhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dart.near_duplicate_classes(docs).select("doc_id", "class_id")


@query
def op3_phrase_automata(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return phrases.remove_repeated_passages(docs, digest=True).drop("text")


@query
def op4_compression_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    contents = compression.learn(docs.where(remainder(3) != 1))
    guessed = compression.with_language(docs.select("doc_id", "text"), contents)
    return guessed.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score", "lang_sure")


@query
def op5_counterfactual_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = counterfactual.fit(counterfactual.training_rows(docs, labels.where(remainder(4) != 2), "toxic"))
    scored = counterfactual.with_scores(docs, model)
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score",
                         (F.col("score") >= counterfactual.THRESHOLD).cast("int").alias("predicted"))


@query
def op6_warc_round_trip(spark, sf_dir):
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_risk_controlled_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged, _ = risk.risk_controlled(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination_report(docs, table(spark, sf_dir, "benchmark"))


@query
def op9_poisson_mixing(spark, sf_dir):
    return poisson.replicate(table(spark, sf_dir, "documents"))


def quality_model(docs: DataFrame, labels: DataFrame, training: Column) -> discriminant.Discriminant | float:
    """Learned from the labels that meet ``training``."""
    return discriminant.fit(discriminant.labelled_statistics(docs, labels.where(training), "quality"), "statistics", "label")


def quality_scores(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """``docs`` with a score and whether it reaches the threshold; both names get underscores where the input has them."""
    scored, name = discriminant.classify(docs, quality_model(docs, labels, training))
    return scored.withColumn(free_name(docs, "predicted"), (F.col(name) >= discriminant.THRESHOLD).cast("int"))


@query
def op10_quality_discriminant(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = quality_scores(docs, labels, remainder(5) != 0)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query
def op11_chunk_memo_fim(spark, sf_dir):
    cut = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fim.restored(F.col("fim_text"), F.col("form"))
    return cut.select("doc_id", F.col("n_lines").alias("n"), "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


@query
def op12_skip_overlap_join(spark, sf_dir):
    return overlap.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op13_heap_bounded_centroids(spark, sf_dir):
    found = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        centroids.centroid_digest(F.col("centroid")).alias("centroid_sha256"))


ORACLES: dict[str, str] = {name: text for name, text in sql.ORACLES.items() if name in QUERIES}
