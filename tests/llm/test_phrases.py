from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from benefacta.llm import phrases
from .conftest import ODD, digest, words


def by_hand(texts, size):
    split = [words(t) for t in texts]
    count = Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        hit = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                hit.update(range(i, i + size))
        out.append((len(w), len(hit), " ".join(x for j, x in enumerate(w) if j not in hit)))
    return out


def run(frame, texts, size, anchor, **options):
    rows = phrases.remove_repeated_passages(frame(list(enumerate(texts))), size=size, anchor=anchor, **options).collect()
    return [(r["n_words"], r["n_removed"], r["kept_text"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("size,anchor", [(5, 2), (5, 5), (7, 1)])
@settings(max_examples=6, deadline=None)
@given(texts=st.lists(st.text(alphabet="abc  ", max_size=60), min_size=1, max_size=6))
def test_small_alphabets(frame, size, anchor, texts):
    assert run(frame, texts, size, anchor) == by_hand(texts, size)


def test_passages_copies_and_periods(frame, rng):
    def doc(n):
        return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))

    passage, short = doc(60), doc(34)
    texts = [doc(50) + " " + passage + "\n" + doc(10) for _ in range(20)] + [doc(20) + " " + short + " " + doc(9) for _ in range(9)]
    texts += [texts[3], "again " * 100, "x y " * 17, "x y " * 18, doc(35), passage.replace(" ", "  "), passage[:-3]] + ODD
    want = by_hand(texts, 35)
    assert run(frame, texts, 35, 12) == want
    assert want[0][1] == 60 and want[20][1] == 0
    assert run(frame, texts, 35, 12, filter_bits=6) == want  # a full filter loses nothing


@pytest.mark.parametrize("shard_bytes,group_stretches", [(1, 1), (400, 3)])
def test_small_shards_and_groups_change_nothing(frame, rng, shard_bytes, group_stretches):
    def some(n):
        return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))

    common, passages = some(4), [some(9) for _ in range(12)]  # one anchor with many passages
    texts = [some(3) + " " + passages[i % 12] + " " + common + " " + passages[-1 - i % 12] + " " + some(2) for i in range(30)] + [None, "", "a"]
    options = {"shard_bytes": shard_bytes, "group_stretches": group_stretches}
    assert run(frame, texts, 7, 4, **options) == by_hand(texts, 7)
    assert run(frame, ["a b a b a b a", "b a b a", "", "a b a"] * 2, 3, 1, **options) == by_hand(["a b a b a b a", "b a b a", "", "a b a"] * 2, 3)


def test_the_shards_alone_locate(frame, rng, monkeypatch):
    one, two = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    texts = [one + " x", "y " + one, two + " z", two]
    want = by_hand(texts, 35)
    assert run(frame, texts, 35, 12) == want and want[0][1] == 40
    every = phrases._passages
    monkeypatch.setattr(phrases, "_passages", lambda *args: every(*args).where("not startswith(words, cast('a' as binary))"))
    assert [r[1] for r in run(frame, texts, 35, 12)] == [0, 0, 40, 40]


def test_automaton_compares_words():
    held = phrases.Automaton([(1, b"a b c d e"), (2, b"x y b c z")], 4, 2)
    assert held.locate(b"a b c d e") == [(0, 5)] and held.locate(b"0 a b c d 1 b c d e") == [(1, 5), (6, 10)]
    assert held.locate(b"b c") == held.locate(b"ab c d e") == held.locate(b"a b c dd") == []
    assert phrases.Automaton([], 4, 2).locate(b"a b c d") == []


def test_digest_repeated_rows_and_ids(frame, rng):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long), (1, long), (2, "alone"), (2, "other " + long), (None, None), (None, "a b")]
    out = phrases.remove_repeated_passages(frame(rows), digest=True).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out)
    assert got == Counter([(1, 50, 50, digest("")), (1, 50, 50, digest("")), (2, 1, 0, digest("alone")), (2, 51, 50, digest("other")),
                           (None, 0, 0, digest("")), (None, 2, 0, digest("a b"))])


def test_empty_table_and_extra_columns(frame):
    schema = "doc_id long, text string, n_words string, places int, row int"
    assert phrases.remove_repeated_passages(frame([], schema)).count() == 0
    out = phrases.remove_repeated_passages(frame([(1, "a b", "mine", 7, 8)], schema)).first()
    assert (out["n_words"], out["places"], out["row"], out["n_words_"], out["kept_text"]) == ("mine", 7, 8, 2, "a b")
    with pytest.raises(ValueError):
        phrases.remove_repeated_passages(frame([], schema), size=5, anchor=6)
