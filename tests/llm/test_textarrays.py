import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from benefacta.llm import frames, textarrays as T

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abé \n\t#Z9你", max_size=40)), max_size=12)


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_and_hashes(texts, limit):
    seen, grams = {}, {}
    for part, data, offsets in T.blocks(batch(texts), "text", limit):
        found = T.find_words(data, offsets)
        hashes, left, runs = T.word_hashes(found), found.left(), T.gram_hashes(T.word_hashes(found), 3)
        for i, text in enumerate(part.column(0).to_pylist()):
            low, high = found.first[i:i + 2]
            want = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
            assert [bytes(data[s:e]) for s, e in zip(found.starts[low:high], found.ends[low:high])] == want
            for word, value in zip(want, hashes[low:high]):
                assert seen.setdefault(word, value) == value
            for p in range(len(want) - 2):
                assert left[low + p] == len(want) - p
                assert grams.setdefault(tuple(want[p:p + 3]), runs[low + p]) == runs[low + p]
    assert len(set(seen.values())) == len(seen) and len(set(grams.values())) == len(grams)


def test_blocks_cover_all_rows():
    texts = ["a" * n for n in (0, 5, 0, 100, 3, 0)]
    parts = [part.column(0).to_pylist() for part, _, _ in T.blocks(batch(texts), "text", 8)]
    assert sum(parts, []) == texts
    assert list(T.blocks(batch([]), "text")) == []


def test_folded_words_and_beginnings():
    data, offsets = T.text_buffer(pa.array(["Ab-aB abcdef", "ABCDEG"]))
    found = T.find_words(data, offsets, T.ALNUM)
    h = T.word_hashes(found, T.ALNUM, T.FOLD)
    assert h[0] == h[1] and found.counts.tolist() == [3, 1]
    [(at, begin)] = T.beginning_hashes(found, (5,), T.FOLD)
    assert at.tolist() == [2, 3] and begin[0] == begin[1]


def test_key_filter_never_misses(spark):
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 3000)
    known = frames.KeyFilter.of(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k", 18)
    assert known(keys.view(np.uint64)).all()
    assert known(np.random.default_rng(2).integers(0, 2**63, 3000).astype(np.uint64)).mean() < 0.05
    none = frames.KeyFilter.of(spark.createDataFrame([], "k long"), "k", 10)
    assert not none(keys.view(np.uint64)).any()


def test_free_name(spark):
    df = spark.createDataFrame([], "Score int, score_ int")
    assert frames.free_name(df, "score") == "score__" and frames.free_name(df, "other") == "other"
