"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Each text becomes a vector of statistics (length, word shape, character classes, repetition), brought near
to a normal shape by logarithms and square roots. Spark sums the first and second moments of each label over all
labelled rows. A class covariance is shrunk towards the pooled one and towards its mean variance, so it can be
inverted. The Cholesky factor of each class is computed once and sent with the model; a score compares the log densities
of the classes through Mahalanobis distances, as triangular products of whole batches.

A null text counts as empty; a text without words has the statistics of nothing and gets a score like any other. Labels
that are null are not learned; of several rows on one document, label 0 counts. With one class only, each score is that class; without any label it is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import KeyFilter, add_columns, free_name
from .textarrays import blocks, find_words, gram_hashes, mix, word_hashes

NAMES = ["words", "word_length", "upper", "symbols", "exclamations", "stops", "digits", "lines", "beyond_ascii",
         "distinct_words", "repeated_runs", "repeated_lines", "short_words"]
THRESHOLD = 0.3


def _members(codes) -> np.ndarray:
    held = np.zeros(256)
    held[list(codes)] = 1
    return held


_UPPER, _LOWER = _members(range(0x41, 0x5B)), _members(range(0x61, 0x7B))
_CLASSES = np.stack([_UPPER, _LOWER, _members(b"#*$%&|<>"), _members(b"!"), _members(b".,;:?"),
                     _members(range(0x30, 0x3A)), _members(b"\n"), _members(range(0xC0, 0x100)),
                     _members(range(0x80, 0xC0))], axis=1)
_LINE = np.ones(256, bool)
_LINE[0x0A] = False


def _repeated(keys: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the number of keys and of distinct ones."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.argsort(mix(keys + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    k, o = keys[order], of[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    return np.bincount(of, minlength=n).astype(float), np.bincount(o[fresh], minlength=n).astype(float)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per text, in the order of ``NAMES``."""
    n = len(offsets) - 1
    counts = np.stack([np.bincount(data[a:b], minlength=256) for a, b in zip(offsets[:-1], offsets[1:])]) @ _CLASSES
    upper, lower, symbols, shouts, stops, digits, lines, beyond, rest = counts.T
    chars = np.maximum(np.diff(offsets) - rest, 1)
    words = find_words(data, offsets)
    hashes, of, left = word_hashes(words), words.text_of, words.left()
    total = np.maximum(words.counts, 1)
    lengths = words.ends - words.starts
    _, distinct = _repeated(hashes, of, n)
    grams = gram_hashes(hashes, 5)
    at = np.flatnonzero(left[:len(grams)] >= 5)
    runs, distinct_runs = _repeated(grams[at], of[at], n)
    rows = find_words(data, offsets, _LINE)
    all_lines, distinct_lines = _repeated(word_hashes(rows, _LINE), rows.text_of, n)
    return np.stack([
        np.log1p(words.counts),
        np.log(np.maximum(np.bincount(of, lengths, minlength=n) / total, 0.5)),
        np.sqrt(upper / np.maximum(upper + lower, 1)),
        np.sqrt(symbols / chars), np.sqrt(shouts / chars), np.sqrt(stops / chars), np.sqrt(digits / chars),
        np.sqrt(lines / chars), np.sqrt(beyond / chars),
        np.log1p(distinct) / np.log1p(total),
        np.sqrt((runs - distinct_runs) / np.maximum(runs, 1)),
        np.sqrt((all_lines - distinct_lines) / np.maximum(all_lines, 1)),
        np.sqrt(np.bincount(of, lengths <= 3, minlength=n) / total),
    ], axis=1)


def with_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    """``docs`` with an array of the statistics of each text."""
    def work(batch, place):
        for part, data, offsets in blocks(batch, batch.schema.names[place]):
            found = statistics(data, offsets)
            bounds = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            yield part, [pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.reshape(-1)))]

    return add_columns(docs, text, T.StructType([T.StructField(name, T.ArrayType(T.DoubleType()))]), work)


@dataclass
class Discriminant:
    """Log prior, mean and Cholesky factor of each class; ``factors`` invert the covariances."""

    log_prior: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of the last class for each row of ``x``."""
        density = []
        for log_prior, mean, factor, log_det in zip(self.log_prior, self.means, self.factors, self.log_dets):
            z = (x - mean) @ factor.T
            density.append(log_prior - 0.5 * (log_det + np.einsum("ij,ij->i", z, z)))
        gap = np.clip(density[1] - density[0], -700, 700)
        return 1 / (1 + np.exp(-gap))


def fit(rows: DataFrame, features: str, label: str, towards_pooled: float = 0.1, towards_sphere: float = 0.01) -> Discriminant | float:
    """Model of two classes from all rows, or the constant score of the only class (0.5 without rows).

    A covariance is ``(1 - p) * own + p * pooled``, of which a share goes to a multiple of the identity that has the
    same mean variance. Moments are sums over all rows: Spark returns one row per class.
    """
    d = len(NAMES)
    x = [F.col(features)[i] for i in range(d)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    found = {r["label"]: r for r in rows.where(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("label"))
             .agg(F.count("*").alias("n"), *sums, *products).collect()}
    if len(found) < 2:
        return float(next(iter(found), 0.5))
    n, means, own = [], [], []
    for c in (0, 1):
        r = found[c]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        second = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)]) / r["n"]
        n.append(r["n"])
        means.append(mean)
        own.append(second - np.outer(mean, mean))
    n = np.array(n, float)
    pooled = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))  # shrink in units of the pooled spread
    factors, log_dets = [], []
    for s in own:
        s = ((1 - towards_pooled) * s + towards_pooled * pooled) / np.outer(scale, scale)
        s = (1 - towards_sphere) * s + (towards_sphere * np.trace(s) / d + 1e-6) * np.eye(d)
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low) / scale)
        log_dets.append(2 * np.log(np.diag(low)).sum())
    return Discriminant(np.log(n / n.sum()), np.array(means), np.array(factors), np.array(log_dets))


def with_scores(rows: DataFrame, features: str, model: Discriminant | float, name: str = "score") -> DataFrame:
    """``rows`` with the score of each statistics array."""
    if isinstance(model, float):
        return rows.withColumn(name, F.lit(model))
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(column):
        import pandas as pd
        return pd.Series(shipped.value.scores(np.stack(column.to_list())) if len(column) else [], dtype="float64")

    return rows.withColumn(name, score(features))


def labelled(rows: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``rows`` that have a label 0 or 1 by ``doc_id``, as ``label``; 0 where labels of a document differ."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("label"))
    return rows.join(known, "doc_id")


def labelled_statistics(docs: DataFrame, labels: DataFrame, label: str, text: str = "text", filter_bits: int | None = None) -> DataFrame:
    """``statistics`` and ``label`` of the documents that have a label 0 or 1; 0 where labels of a document differ.

    Statistics of documents whose id a bounded filter of the labelled ids turns away are not computed.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("label"))
    wanted = KeyFilter.of(known.select(F.xxhash64("doc_id").alias("key")), "key", filter_bits)
    shipped = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            chosen = batch.filter(pa.array(shipped.value(batch.column(2).to_numpy().view(np.uint64))))
            for part, data, offsets in blocks(chosen, "text"):
                found = statistics(data, offsets)
                bounds = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.reshape(-1)))],
                                                 names=["doc_id", "statistics"])

    rows = docs.select("doc_id", F.col(text).alias("text"), F.xxhash64("doc_id").alias("key"))
    out = T.StructType([docs.schema["doc_id"], T.StructField("statistics", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(run, out).join(known, "doc_id").select("statistics", "label")


def classify(docs: DataFrame, model: Discriminant | float, text: str = "text", name: str = "score") -> tuple[DataFrame, str]:
    """``docs`` with the score of each text, and the name of its column, which gets underscores where the input has it already."""
    name = free_name(docs, name)
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model)), name
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch, place):
        batch = batch.rename_columns([f"_{i}" for i in range(batch.num_columns)])
        for part, data, offsets in blocks(batch, f"_{place}"):
            yield part, [pa.array(shipped.value.scores(statistics(data, offsets)))]

    return add_columns(docs, text, T.StructType([T.StructField(name, T.DoubleType())]), work), name


def accepted(docs: DataFrame, model: Discriminant | float, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, unchanged."""
    scored, name = classify(docs, model, text)
    return scored.where(F.col(name) >= threshold).drop(name)
