from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from benefacta.llm import components, dart, textarrays
from .conftest import ODD, words


def runs(text, size=5):
    w = words(text)
    n = min(size, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def classes(texts, similarity=0.8):
    """Least number of each class, from all pairs."""
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [runs(t) for t in texts]
    for i, text in enumerate(texts):
        for j in range(i):
            if text is None or texts[j] is None:
                continue
            both = sum((sets[i] & sets[j]).values())
            union = sum(sets[i].values()) + sum(sets[j].values()) - both
            if text == texts[j] or sets[i] and sets[j] and both >= similarity * union:
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return [root(i) for i in range(len(texts))]


def corpus(rng):
    def doc(n):
        return [f"w{rng.randint(0, 3000)}" for _ in range(n)]

    texts = ["", "one two", "one two", "a b c d e"]
    for _ in range(20):  # groups of a few near copies
        base = doc(rng.choice([8, 30, 120]))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = f"zz{rng.randint(0, 9)}"
            texts.append(" ".join(copy))
    base = doc(150)
    for _ in range(150):  # one large group, in which few pairs are alike enough
        copy = list(base)
        for _ in range(rng.randint(2, 5)):
            copy[rng.randrange(150)] = f"y{rng.randint(0, 99999)}"
        texts.append(" ".join(copy))
    return texts + texts[10:14]


@pytest.mark.parametrize("block,dense", [(256, 8), (16, 0)])  # pairs verified by joins, and within dense blocks
def test_classes_like_all_pairs(frame, rng, block, dense):
    texts = corpus(rng)
    want = classes(texts)
    got = dart.near_duplicate_classes(frame(list(enumerate(texts))), block=block, dense=dense).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == dict(enumerate(want))
    kept = dart.keep_one_of_each(frame(list(enumerate(texts))), block=block, dense=dense).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want))


def test_signatures_estimate_weighted_jaccard(rng):
    base = [f"w{rng.randint(0, 50)}" for _ in range(400)]
    pairs = []
    for changes in (4, 20, 60):
        other = list(base)
        for _ in range(changes):
            other[rng.randrange(400)] = "new"
        pairs.append((" ".join(base), " ".join(other)))
    pairs.append(("a b c d e", "a b c d e a b c d e a b c d e"))
    data, offsets = textarrays.text_buffer(pa.array([t for p in pairs for t in p]))
    keys, first = dart.layered_runs(data, offsets, 5)
    found = dart.signatures(keys, first, 3000)
    for i, (x, y) in enumerate(pairs):
        a, b = runs(x), runs(y)
        want = sum((a & b).values()) / sum((a | b).values())
        assert (found[2 * i] == found[2 * i + 1]).mean() == pytest.approx(want, abs=0.05)


def test_signatures_do_not_depend_on_the_block(rng):
    texts = [" ".join(f"w{rng.randint(0, 9)}" for _ in range(n)) for n in (1, 5, 40, 700)] + [""]

    def signed(some):
        keys, first = dart.layered_runs(*textarrays.text_buffer(pa.array(some)), 5)
        return dart.signatures(keys, first, 64)

    together = signed(texts)
    assert all((signed([t])[0] == together[i]).all() for i, t in enumerate(texts))
    assert (together[:4] != 0).all() and not together[4].any()


def test_odd_texts_copies_and_repeated_rows(frame):
    texts = ODD + ODD
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, None), (3, "a"), (3, "quite another text of six words"), (None, "a"), (None, None)]
    got = dart.near_duplicate_classes(frame(rows)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add(r["class_id"])
    for i, text in enumerate(ODD):
        j = i + len(ODD)
        assert by_id[j] == ({j} if text is None else {i})  # nulls are not alike
    assert by_id[None] == {None, 3} and by_id[3] == {3}
    kept = dart.keep_one_of_each(frame(rows)).collect()
    assert len([r for r in kept if r["text"] == "a"]) <= 1 and len([r for r in kept if r["text"] is None]) == 3


def test_empty_table_and_extra_columns(frame):
    schema = "doc_id long, text string, class_id string, row string, text_id int"
    assert dart.near_duplicate_classes(frame([], schema)).count() == 0
    rows = [(1, "a b c d e f", "x", "y", 1), (2, "a b c d e f", "x", "z", 2)]
    assert [tuple(r) for r in dart.keep_one_of_each(frame(rows, schema)).collect()] == [rows[0]]


def test_components(frame):
    links = [(1, 2), (2, 3), (9, 8), (5, 5)] + [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 160)]
    got = {r["node"]: r["root"] for r in components.components(frame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {i: 20 for i in range(20, 61)} | {i: 100 for i in range(100, 160)}
    assert got == want
    assert components.components(frame([], "a long, b long")).count() == 0


def test_darts_hold_for_many_layers():
    keys, first = dart.layered_runs(*textarrays.text_buffer(pa.array(["same " * 3000])), 5)
    assert len(np.unique(keys)) == len(keys) == 2996 and first.tolist() == [0, 2996]


def test_many_short_texts_take_bounded_memory():
    import tracemalloc
    keys, first = dart.layered_runs(*textarrays.text_buffer(pa.array([f"t{i} x" for i in range(3000)])), 5)
    tracemalloc.start()
    found = dart.signatures(keys, first, 160)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found.shape == (3000, 160) and peak < 150e6


def test_template_corpus_grows_in_proportion(frame, rng):
    """Texts that share 100 words and hold 40 of their own fall into the same buckets and are no copies."""
    import time
    template, seconds = " ".join(f"t{i}" for i in range(100)), []
    for n in (500, 8000, 32000):
        texts = [template + " " + " ".join(str(rng.getrandbits(48)) for _ in range(40)) for _ in range(n)]
        texts[-1] = texts[0] + " more"
        start = time.time()
        got = {r["doc_id"]: r["class_id"] for r in dart.near_duplicate_classes(frame(list(enumerate(texts)))).collect()}
        seconds.append(time.time() - start)
        assert got == {i: i for i in range(n - 1)} | {n - 1: 0}
    print("seconds", seconds)
    assert seconds[2] < 4 * seconds[1] * 1.5
