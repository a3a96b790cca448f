"""Hashes that stand for different rows: results must not change."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from benefacta.llm import dart, frames, ownership, phrases

TEXTS = ["password = abcdefgh1 and more", "token: zyxwvut9876 here", "plain words", "plain words", None, "", "x " * 40, "x " * 40 + "y"]


@pytest.fixture(params=["all", "some"])
def clashing(request, monkeypatch):
    plain = frames._two_hashes

    def forced(columns):
        one, two = plain(columns)
        return (F.lit(7).cast("long") if request.param == "all" else F.pmod(one, F.lit(3))), two

    return lambda: monkeypatch.setattr(frames, "_two_hashes", forced)


def results(frame):
    docs = frame([(i, t, f"s{i % 2}") for i, t in enumerate(TEXTS)], "doc_id long, text string, source string")
    secrets = Counter(map(tuple, ownership.secret_report(docs).collect()))
    redacted = Counter(map(tuple, ownership.redact(docs).collect()))
    classes = Counter((r["doc_id"], r["class_id"]) for r in dart.near_duplicate_classes(docs).collect())
    kept = Counter(map(tuple, dart.keep_one_of_each(docs).collect()))
    words = Counter(map(tuple, phrases.remove_repeated_passages(docs).collect()))
    return secrets, redacted, classes, kept, words


def test_clashing_hashes_change_nothing(frame, clashing):
    want = results(frame)
    clashing()
    assert results(frame) == want
    assert sum(want[3].values()) == 6 and len(want[4]) == 8  # copies and near copies go


def test_too_many_clashes_are_an_error(frame, clashing, monkeypatch):
    clashing()
    monkeypatch.setattr(frames, "MOST_CLASHES", 0)
    with pytest.raises(ValueError):
        frames.content_ids(frame(list(enumerate(TEXTS))), ["text"])
