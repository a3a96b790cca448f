"""The learned operators: held-out accuracy on texts with a known rule, and what must hold for any input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from benefacta.llm import compression, counterfactual, discriminant, queries, textarrays
from .conftest import ODD

import pyarrow as pa

SYLLABLES = {"en": ["the", "ing", "wh", "th", "ou"], "de": ["sch", "ung", "ä", "ein", "pf"], "fr": ["eau", "é", "oi", "ment", "que"]}


def invented(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_languages_of_held_out_texts(frame):
    rng = random.Random(3)
    rows = [(i, invented(rng, lang, rng.randint(20, 300)), lang) for i in range(240) for lang in [list(SYLLABLES)[i % 3]]]
    rows = [(i, t.upper() if i % 7 == 0 else t, lang) for i, t, lang in rows] + [(900, "no label", None), (901, None, "en"), (902, "12", "xx")]
    docs = frame(rows, "doc_id long, text string, lang string")
    contents = compression.learn(docs.where("doc_id % 2 = 0"))
    assert set(contents) == set(SYLLABLES)
    got = {r["doc_id"]: r for r in compression.with_language(docs.select("doc_id", "text"), contents).collect()}
    test = [(i, lang) for i, t, lang in rows[:240] if i % 2]
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in test]) > 0.97
    assert all(0 <= r["score"] <= 1 and (r["lang_sure"] == "und") == (r["score"] < 0.5) for r in got.values())
    assert (got[901]["lang_pred"], got[901]["score"], got[902]["lang_pred"]) == ("und", 0.0, "und")
    assert len(got) == len(rows) and all(p.isascii() or p for p in contents.values())


def test_language_dictionaries_are_bounded_and_repeatable(frame):
    rng = random.Random(4)
    docs = frame([(i, invented(rng, "en", 500), "en") for i in range(50)], "doc_id long, text string, lang string")
    one, two = (compression.learn(docs.repartition(n), slices=5, slice_chars=100) for n in (1, 7))
    assert one == two and len(one["en"]) <= 5 * 101


def test_language_of_odd_texts_and_few_languages(frame):
    docs = frame([(i, t, "mine") for i, t in enumerate(ODD)], "doc_id long, text string, score string")
    none = compression.with_language(docs, {}).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and {r["score"] for r in none} == {"mine"}
    one = {r["doc_id"]: (r["lang_pred"], r["score_"]) for r in compression.with_language(docs, {"en": b"the word"}).collect()}
    assert one[3] == ("en", 1.0) and one[0] == one[1] == one[4] == ("und", 0.0) and one[5][0] == "en"
    tie = compression.with_language(docs, {"b": b"same", "a": b"same"}).collect()
    assert {r["lang_pred"] for r in tie} == {"b", "und"} and {r["lang_sure"] for r in tie} == {"und"}  # the first on ties, but rejected
    assert compression.with_language(docs.limit(0), {"en": b"x"}).count() == 0
    assert compression.learn(docs.limit(0).withColumn("lang", F.lit("en"))) == {}


INSULTS = ["rotter", "knave"]


def talk(rng, toxic, group=None):
    w = [rng.choice(["we", "meet", "tea", "garden", "walk", "river", "stone", "music"]) for _ in range(rng.randint(10, 60))]
    if toxic:
        w[rng.randrange(len(w))] = rng.choice(INSULTS)
    if group:
        w[rng.randrange(len(w))] = group
    return " ".join(w).capitalize() + ". And more."


def test_toxicity_of_held_out_texts(frame):
    rng = random.Random(5)
    rows = [(i, talk(rng, i % 4 == 0), int(i % 4 == 0)) for i in range(800)]
    docs, labels = frame([r[:2] for r in rows]), frame([(i, y) for i, _, y in rows] + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = counterfactual.fit(counterfactual.training_rows(docs, labels.where("doc_id % 2 = 0"), "toxic"))
    got = {r["doc_id"]: r["score"] for r in counterfactual.with_scores(docs, model).collect()}
    assert np.mean([(got[i] >= counterfactual.THRESHOLD) == bool(y) for i, _, y in rows if i % 2]) > 0.99
    odd = {r["doc_id"]: r["score"] for r in counterfactual.with_scores(frame(list(enumerate(ODD))), model).collect()}
    assert all(0 <= s <= 1 for s in odd.values()) and odd[0] == odd[1] == pytest.approx(1 / (1 + np.exp(-model.intercept)))


def test_swapped_identity_terms_hardly_change_scores(frame):
    rng = random.Random(6)
    rows = []
    for i in range(900):  # one group is named in toxic texts far more often
        toxic = i % 3 == 0
        rows.append((i, talk(rng, toxic and rng.random() < 0.5, "muslims" if toxic and rng.random() < 0.9 or rng.random() < 0.05 else None), int(toxic)))
    docs = frame([r[:2] for r in rows])
    labels = frame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    training = counterfactual.training_rows(docs, labels, "toxic")
    neutral = ["We meet muslims in the garden.", "We meet jews in the garden.", "We meet in the garden."]

    def gap(steadiness):
        model = counterfactual.fit(training, steadiness=steadiness)
        a, b, plain = model.scores(*textarrays.text_buffer(pa.array(neutral)))
        return abs(a - b), a - plain

    loose, steady = gap(0.0), gap(50.0)
    assert loose[0] > 0.3 and steady[0] < 0.2 * loose[0] and steady[1] < loose[1]


def test_swapper():
    swap = counterfactual.swapper((("cats", "dogs"), ("Ü-men", "b")))
    assert swap("Cats sat. No catsup! Then dogs\nü-men") == "dogs sat. No catsup! Then cats\nb"
    assert swap("nothing here") is None and swap("") is None
    table = counterfactual.swaps()
    assert len(table) == sum(map(len, counterfactual.AXES))  # no term on two axes


def test_toxicity_without_both_labels(frame):
    docs = frame([(1, "a"), (2, None)])
    for rows, want in (([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0), ([(1, 0), (1, 1)], 1.0)):
        model = counterfactual.fit(counterfactual.training_rows(docs, frame(rows, "doc_id long, toxic int"), "toxic"))
        assert [r["score"] for r in counterfactual.with_scores(docs, model).collect()] == pytest.approx([want] * 2, abs=1e-6)
    assert counterfactual.with_scores(docs.limit(0), model).count() == 0


def plain_statistics(text):
    w = textarrays.find_words(*textarrays.text_buffer(pa.array([text], pa.string())))
    t = (text or "")
    split = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", t) if x]
    chars, n = max(len(t), 1), max(len(split), 1)
    letters = sum(c.isascii() and c.isalpha() for c in t)
    grams = [tuple(split[i:i + 5]) for i in range(len(split) - 4)]
    lines = [x for x in t.split("\n") if x]
    assert len(w.starts) == len(split)
    return [np.log1p(len(split)), np.log(max(sum(len(x.encode()) for x in split) / n, 0.5)),
            np.sqrt(sum("A" <= c <= "Z" for c in t) / max(letters, 1)), np.sqrt(sum(c in "#*$%&|<>" for c in t) / chars),
            np.sqrt(t.count("!") / chars), np.sqrt(sum(c in ".,;:?" for c in t) / chars), np.sqrt(sum(c in "0123456789" for c in t) / chars),
            np.sqrt(t.count("\n") / chars), np.sqrt(sum(ord(c) > 127 for c in t) / chars), np.log1p(len(set(split))) / np.log1p(n),
            np.sqrt((len(grams) - len(set(grams))) / max(len(grams), 1)), np.sqrt((len(lines) - len(set(lines))) / max(len(lines), 1)),
            np.sqrt(sum(len(x.encode()) <= 3 for x in split) / n)]


def test_statistics_like_plain_python():
    rng = random.Random(7)
    texts = ODD + ["A b!! C\nA b!! C\nd, 12 é", "go go go go go go go", *[invented(rng, "fr", 50) for _ in range(5)]]
    got = discriminant.statistics(*textarrays.text_buffer(pa.array(texts, pa.string())))
    assert got == pytest.approx(np.array([plain_statistics(t) for t in texts]))


def test_quality_of_held_out_texts(frame):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        good = i % 4 != 0
        text = invented(rng, "en", rng.randint(30, 200))
        rows.append((i, text + "." if good else " ".join(w + "###" for w in text.split()) if i % 8 else text.upper() + "!!", int(good)))
    docs = discriminant.with_statistics(frame([r[:2] for r in rows]))
    labels = frame([(i, y) for i, _, y in rows] + [(1, 0), (2, None), (None, 0)], "doc_id long, quality int")
    model = discriminant.fit(discriminant.labelled(docs, labels.where("doc_id % 3 <> 0"), "quality"), "statistics", "label")
    got = {r["doc_id"]: r["score"] for r in discriminant.with_scores(docs, "statistics", model).collect()}
    assert np.mean([(got[i] >= discriminant.THRESHOLD) == bool(y) for i, _, y in rows if i % 3 == 0]) > 0.98


def test_discriminant_like_log_densities():
    rng = np.random.default_rng(9)
    d = len(discriminant.NAMES)
    model = discriminant.Discriminant(np.log([0.3, 0.7]), rng.normal(size=(2, d)), np.tril(rng.normal(size=(2, d, d))) + 3 * np.eye(d), np.array([1.0, 2.0]))
    x = rng.normal(size=(20, d))
    want = []
    for row in x:
        density = []
        for c in (0, 1):
            inverse = model.factors[c].T @ model.factors[c]
            gap = row - model.means[c]
            density.append(model.log_prior[c] - 0.5 * (model.log_dets[c] + gap @ inverse @ gap))
        want.append(1 / (1 + np.exp(-np.clip(density[1] - density[0], -700, 700))))
    assert model.scores(x) == pytest.approx(np.array(want))


def test_quality_with_few_labels(frame):
    docs = discriminant.with_statistics(frame([(i, t) for i, t in enumerate(ODD)]))
    for rows, want in (([], 0.5), ([(0, 1)], 1.0), ([(0, 0)], 0.0)):
        labels = frame(rows, "doc_id long, quality int")
        model = discriminant.fit(discriminant.labelled(docs, labels, "quality"), "statistics", "label")
        assert {r["score"] for r in discriminant.with_scores(docs, "statistics", model).collect()} == {want}
    labels = frame([(0, 0), (3, 1)], "doc_id long, quality int")  # one row each: shrinkage keeps the factors finite
    model = discriminant.fit(discriminant.labelled(docs, labels, "quality"), "statistics", "label")
    scores = [r["score"] for r in discriminant.with_scores(docs, "statistics", model).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert discriminant.with_scores(docs.limit(0), "statistics", model).count() == 0


def test_training_rows_are_bounded_when_ids_repeat(frame):
    rows = [(7, "copy")] * 400 + [(8, f"text {i}") for i in range(300)] + [(i, "other") for i in range(20, 40)] + [(9, None)] * 5
    labels = frame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    found = counterfactual.training_rows(frame(rows), labels, "toxic").collect()
    assert sorted(map(tuple, found), key=str) == sorted({(i, t, i % 2) for i, t in rows}, key=str)
    few = counterfactual.training_rows(frame(rows), labels, "toxic", sample_rows=50).collect()
    assert len(few) == 50 == len(set(few)) and set(few) <= set(found)


def test_clashing_columns_stay(frame, spark):
    schema = "doc_id long, text string, score string, predicted int, statistics int, statistics_ int, label int"
    rows = [(i, "good words here" if i % 2 else "BAD !!! ###", "mine", 42, 1, 2, 3) for i in range(40)]
    docs, labels = frame(rows, schema), frame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        kept = discriminant.accepted(docs, queries.quality_model(docs, some, F.lit(True)))
        assert kept.columns == docs.columns and all(tuple(r)[2:] == ("mine", 42, 1, 2, 3) for r in kept.collect())
        scored = queries.quality_scores(docs, some, F.lit(True))
        assert scored.columns == [*docs.columns, "score_", "predicted_"]
        assert {(r["score"], r["predicted"]) for r in scored.collect()} == {("mine", 42)}
    toxic = counterfactual.with_scores(docs, counterfactual.fit(counterfactual.training_rows(docs, labels, "quality")))
    assert toxic.columns == [*docs.columns, "score_"] and {r["score"] for r in toxic.collect()} == {"mine"}


def test_statistics_of_labelled_documents_only(frame):
    rows = [(i, f"text {i} of some words") for i in range(300)] + [(7, "again"), (None, "no id")]
    docs, labels = frame(rows), frame([(7, 0), (7, 1), (9, 1), (11, None), (None, 1), (999, 1)], "doc_id long, quality int")
    for bits in (None, 6):  # a full filter computes more and gives the same
        found = discriminant.labelled_statistics(docs, labels, "quality", filter_bits=bits).collect()
        want = discriminant.labelled(discriminant.with_statistics(docs), labels, "quality").collect()
        assert sorted((r["statistics"], r["label"]) for r in found) == sorted((r["statistics"], r["label"]) for r in want)
        assert len(found) == 3
