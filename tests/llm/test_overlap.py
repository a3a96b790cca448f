import random
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from benefacta.llm import overlap
from .conftest import ODD, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def by_hand(rows, size=3, percent=90):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return Counter((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows))


def run(frame, rows, schema="doc_id long, text string", **options):
    out = overlap.jaccard_components(frame(rows, schema), **options).collect()
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out)


@given(lists=st.lists(st.lists(st.integers(0, 30), unique=True).map(sorted), max_size=40), least=st.integers(1, 12))
def test_divide_skip(lists, least):
    numbers, counts = overlap.divide_skip([np.array(x, np.int64) for x in lists], least)
    every = Counter(x for some in lists for x in some)
    assert dict(zip(numbers.tolist(), counts.tolist())) == {x: n for x, n in every.items() if n >= least}


@pytest.mark.parametrize("percent,block", [(90, 1 << 18), (60, 40), (75, 7)])
def test_near_copies_of_all_kinds(frame, percent, block):
    rng = random.Random(percent)
    rows = []
    for _ in range(12):  # groups around one text, with changes on both sides of the threshold
        base = [f"w{rng.randint(0, 60)}" for _ in range(rng.choice([2, 3, 5, 12, 40, 90]))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(["X", "x", f"v{rng.randint(0, 999)}"])
            rows.append((rng.randint(0, 10**6), " ".join(text)))
    template = " ".join(f"t{i}" for i in range(40))
    rows += [(5000 + i, template + " " + " ".join(f"own{i}_{j}" for j in range(i % 9))) for i in range(60)]
    assert run(frame, rows, percent=percent, block=block) == by_hand(rows, percent=percent)


def test_chains_ties_and_odd_texts(frame):
    chain = [f"c{i}" for i in range(200)]
    rows = [(100 - i, " ".join(chain[4 * i:4 * i + 100])) for i in range(20)]  # each like the next, the ends unlike
    rows += [(200 + i, t) for i, t in enumerate(ODD)] + [(7, "A b C"), (3, "a B c"), (3, "a B c"), (3, "other words here"), (None, "a b c"),
             (None, "only null ids"), (None, None), (12, "a b"), (11, "A\tB"), (13, "a"), (14, "b")]
    assert run(frame, rows) == by_hand(rows)
    assert run(frame, rows, filter_bits=6) == by_hand(rows)  # a full filter loses nothing
    assert run(frame, rows, size=1, percent=50) == by_hand(rows, 1, 50)


def test_empty_table_and_clashing_columns(frame):
    schema = "doc_id long, text string, a int, n string, component_id string"
    assert not run(frame, [], schema)
    assert run(frame, [(1, "x y z", 0, "", ""), (2, "x y z", 1, "", "")], schema) == Counter({(1, 1, 1): 1, (2, 1, 1): 1})


def test_template_corpus_grows_in_proportion(frame, spark):
    """Texts that share 100 words and hold 40 of their own meet in no shard, however many there are."""
    rng = random.Random(3)
    template = " ".join(f"t{i}" for i in range(100))
    seconds = []
    for n in (500, 4000, 16000):
        rows = [(i, template + " " + " ".join(str(rng.getrandbits(48)) for _ in range(40))) for i in range(n)]
        start = time.time()
        got = run(frame, rows)
        seconds.append(time.time() - start)
        assert len(got) == n and all(doc == component for doc, _, component in got)
    assert seconds[2] < 4 * seconds[1] * 1.5
