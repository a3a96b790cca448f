"""Toxicity: a logistic model whose scores are held steady when identity terms are swapped.

Words of labelled texts (lower case, runs of letters and digits) and their beginnings of 5 to 8 bytes are presence
features; those that go with the label by a chi-squared test are kept. In every sentence of a labelled text that names a group, the term is swapped for
the next one of its axis. The loss is the logistic one, plus an L2 term, plus ``steadiness`` times the mean
squared change of the log odds between a text and its swapped copy. A group that happens to be named in toxic texts
thus earns no weight that its counterpart lacks.

The model is fitted on a bounded sample of labelled rows, at most ``sample_rows`` pairs of id and text; words of
at most ``max_words``. Scoring reads whole texts by array operations: words are hashed and looked up in the sorted table of kept words.
A null or empty text scores by the intercept. Null labels are not learned; of several labels of one
document the larger counts. Without labels of both kinds the score is the share of label 1, or 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import add_columns, free_name
from .textarrays import ALNUM, FOLD, beginning_hashes, blocks, find_words, signed, text_buffer, word_hashes

THRESHOLD = 0.3
BEGINNINGS = (5, 6, 7, 8)
#: Groups on one axis; a term is swapped for the next one, the last for the first.
AXES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("black", "white", "asian"), ("african", "european", "american"),
    ("christian", "muslim", "jewish", "hindu", "buddhist"), ("christians", "muslims", "jews", "hindus", "buddhists"),
    ("gay", "straight"), ("lesbian", "heterosexual"), ("transgender", "cisgender"),
    ("immigrants", "citizens"), ("refugees", "residents"), ("disabled", "able"), ("old", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("christen", "muslime", "juden"), ("ausländer", "inländer"),
    ("femmes", "hommes"), ("femme", "homme"), ("chrétiens", "musulmans", "juifs"), ("étrangers", "citoyens"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("cristianos", "musulmanes", "judíos"), ("extranjeros", "ciudadanos"),
)


def swaps(axes=AXES) -> dict[str, str]:
    return {term.lower(): axis[(i + 1) % len(axis)] for axis in axes for i, term in enumerate(axis)}


def swapper(axes=AXES):
    """Function that swaps every identity term of a text, sentence by sentence; None if there is none."""
    table = swaps(axes)
    terms = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, table), key=len, reverse=True)) + r")(?!\w)", re.IGNORECASE)
    sentence = re.compile(r"[^.!?\n]*[.!?\n]*")

    def swap(text: str) -> str | None:
        if not terms.search(text):
            return None
        return "".join(terms.sub(lambda m: table.get(m[0].lower(), m[0]), s) for s in sentence.findall(text))

    return swap


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and beginnings, and the text of each."""
    words = find_words(data, offsets, ALNUM)
    of = words.text_of
    parts = [(np.arange(len(of)), word_hashes(words, ALNUM, FOLD)), *beginning_hashes(words, BEGINNINGS, FOLD)]
    return np.concatenate([h for _, h in parts]), np.concatenate([of[at] for at, _ in parts])


def _distinct(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Distinct features of each text."""
    hashes, of = _features(data, offsets)
    order = np.argsort(of, kind="stable")
    hashes, of = hashes[order], of[order]
    cuts = np.searchsorted(of, np.arange(len(offsets)))
    return [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def _sample(rows: DataFrame, text: str, axes) -> DataFrame:
    """``label``, ``words`` and, where an identity term occurs, ``swapped`` words of each row."""
    def run(batches):
        swap = swapper(axes)
        for batch in batches:
            for part, data, offsets in blocks(batch, text):
                texts = [data[a:b].tobytes().decode("utf-8") for a, b in zip(offsets[:-1], offsets[1:])]
                other = [swap(t) for t in texts]
                own = _distinct(data, offsets)
                changed = _distinct(*text_buffer(pa.array(other, pa.string())))
                yield pa.RecordBatch.from_arrays([
                    part.column(part.schema.get_field_index("label")), pa.array([signed(x) for x in own], pa.list_(pa.int64())),
                    pa.array([None if o is None else signed(c) for o, c in zip(other, changed)], pa.list_(pa.int64()))],
                    names=["label", "words", "swapped"])

    return rows.select("label", text).mapInArrow(run, "label int, words array<long>, swapped array<long>")


@dataclass
class SteadyLogistic:
    keys: np.ndarray  # sorted hashes of features
    weights: np.ndarray
    intercept: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n, odds = len(offsets) - 1, np.full(len(offsets) - 1, self.intercept)
        hashes, of = _features(data, offsets)
        if len(self.keys) and len(hashes):
            maybe = np.zeros(1 << 16, bool)
            maybe[self.keys >> np.uint64(48)] = True
            at = np.flatnonzero(maybe[hashes >> np.uint64(48)])
            near = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
            same = self.keys[near] == hashes[at]
            pairs = np.unique(of[at[same]] * len(self.keys) + near[same])  # a feature counts once in a text
            odds += np.bincount(pairs // len(self.keys), self.weights[pairs % len(self.keys)], minlength=n)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def descend(rows: np.ndarray, columns: np.ndarray, y: np.ndarray, n_columns: int, changes: tuple[np.ndarray, np.ndarray, np.ndarray],
            n_changes: int, l2: float, steadiness: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient steps over a sparse 0/1 matrix and the sparse changes."""
    n = len(y)
    rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    w, b = np.zeros(n_columns), float(np.log(rate / (1 - rate)))
    m, v, at = np.zeros(n_columns + 1), np.zeros(n_columns + 1), 0.0
    c_rows, c_columns, c_values = changes
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, w[columns], minlength=n) + b, -700, 700)))
        error = (p - y) / n
        slope = np.append(np.bincount(columns, error[rows], minlength=n_columns) + l2 * w, error.sum())
        if n_changes:
            moved = np.bincount(c_rows, c_values * w[c_columns], minlength=n_changes)
            slope[:-1] += 2 * steadiness / n_changes * np.bincount(c_columns, c_values * moved[c_rows], minlength=n_columns)
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope ** 2
        move = 0.1 / (1 + step / 200) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def fit(rows: DataFrame, text: str = "text", sample_rows: int = 20_000, max_words: int = 4096, least_texts: int = 3,
        least_chi2: float = 12.0, l2: float = 1e-4, steadiness: float = 10.0, steps: int = 300, axes=AXES) -> SteadyLogistic:
    """Model from ``rows`` with ``doc_id``, ``label`` (0 or 1) and texts, at most ``sample_rows`` of them."""
    sample = _sample(rows, text, axes).persist()
    try:
        total = sample.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
        n, ones = total["n"], total["ones"] or 0
        if not 0 < ones < n:
            share = min(max(ones / n if n else 0.0, 1e-9), 1 - 1e-9)
            return SteadyLogistic(np.empty(0, np.uint64), np.empty(0), float(np.log(share / (1 - share))))
        a, m = F.col("hits"), F.col("texts")
        gap = a * F.lit(float(n)) - m * F.lit(float(ones))
        chi2 = gap * gap * n / (m * (F.lit(n) - m) * F.lit(float(ones) * (n - ones)))
        kept = (sample.select("label", F.explode("words").alias("word")).groupBy("word")
                .agg(F.count("*").alias("texts"), F.sum("label").alias("hits"))
                .where((m >= least_texts) & (m < n)).withColumn("chi2", chi2).where(F.col("chi2") >= least_chi2)
                .orderBy(F.desc("chi2"), "word").limit(max_words).select("word").toPandas())
        keys = np.sort(kept["word"].to_numpy(np.int64).view(np.uint64))
        known = F.array(*[F.lit(int(k)) for k in signed(keys)]) if len(keys) else F.array().cast("array<long>")
        small = sample.select("label", F.array_intersect("words", known).alias("words"),
                              F.array_intersect("swapped", known).alias("swapped")).toArrow()
    finally:
        sample.unpersist()

    def cells(column):
        lists = column.combine_chunks()
        at = np.repeat(np.arange(len(lists)), np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)))
        return at, np.searchsorted(keys, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))

    y = small.column("label").to_numpy().astype(float)
    own, other = cells(small.column("words")), cells(small.column("swapped"))
    has = ~np.asarray(small.column("swapped").is_null())
    number = np.cumsum(has) - 1
    before = has[own[0]]
    changes = (np.concatenate([number[other[0]], number[own[0][before]]]), np.concatenate([other[1], own[1][before]]),
               np.concatenate([np.ones(len(other[0])), -np.ones(int(before.sum()))]))
    weights, intercept = descend(*own, y, len(keys), changes, int(has.sum()), l2, steadiness, steps)
    return SteadyLogistic(keys, weights, intercept)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, text: str = "text", sample_rows: int = 20_000) -> DataFrame:
    """Texts with a label 0 or 1: one row for each id and text, ``sample_rows`` at most; the larger label of a document counts.

    They are of the ``sample_rows`` least hashed ids. Where these ids have more texts, the least hashed pairs of id and text stay.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    place = free_name(docs, "text_hash")
    hashed = docs.select("doc_id", text, F.xxhash64(text).alias(place))
    found = hashed.join(F.broadcast(chosen), "doc_id").select("doc_id", place, "label").distinct()  # bounded by sample_rows
    pairs = found.orderBy(F.xxhash64("doc_id", place), "doc_id", place).limit(sample_rows)
    return hashed.join(F.broadcast(pairs), ["doc_id", place]).select("doc_id", text, "label").distinct()


def with_scores(docs: DataFrame, model: SteadyLogistic, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; ``name`` gets underscores where the input has such a column."""
    name = free_name(docs, name)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch, place):
        for part, data, offsets in blocks(batch, batch.schema.names[place]):
            yield part, [pa.array(shipped.value.scores(data, offsets))]

    return add_columns(docs, text, T.StructType([T.StructField(name, T.DoubleType())]), work)
