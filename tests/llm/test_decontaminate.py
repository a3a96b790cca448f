import re

import pytest

from benefacta.llm import decontaminate
from .conftest import ODD, digest


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)]


def by_hand(texts, items, size=10):
    out = []
    for text in texts:
        w = [t[2] for t in tokens(text)]
        hit, found = set(), set()
        for item, content in items:
            q = [t[2] for t in tokens(content)]
            n = min(size, len(q))
            grams = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if q else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    found.update([] if item is None else [str(item)])
        out.append((len(w), len(hit), len(found), digest(",".join(sorted(found))), bool(hit)))
    return out


def sentence(rng, n):
    return " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(n))


@pytest.fixture
def case(rng):
    items = [(i, sentence(rng, rng.randint(8, 40))) for i in range(12)]
    items += [(20, "Rare Word"), (21, "uno"), (22, None), (23, ""), (24, "--"), (2, items[2][1]), (None, "nobody knows"), (25, items[0][1])]
    texts = list(ODD)
    for i in range(12):
        w = items[i][1].split()
        cut = rng.randint(0, max(0, len(w) - 10))
        texts.append(f"{sentence(rng, 5)}, {' - '.join(w[cut:cut + 10]).upper()}! {sentence(rng, 3)}")
        texts.append(sentence(rng, 5) + " " + " ".join(w[:9]) + " " + sentence(rng, 3))
    texts += ["a rare, WORD rare word", "uno uno", "unod", "nobody knows", items[1][1] + " " + items[1][1] + " uno"]
    return texts, items


@pytest.mark.parametrize("block_windows", [200_000, 10])  # a broadcast table, and a join
def test_like_by_hand(frame, case, block_windows):
    texts, items = case
    benchmark = frame(items, "item_id long, text string")
    got = decontaminate.contamination_report(frame(list(enumerate(texts))), benchmark, block_windows=block_windows).collect()
    got = [tuple(r)[1:] for r in sorted(got, key=lambda r: r["doc_id"])]
    assert got == by_hand(texts, items)


def test_removal(frame, case):
    texts, items = case
    docs, benchmark = frame(list(enumerate(texts))), frame(items, "item_id long, text string")
    flagged = [r[4] for r in by_hand(texts, items)]
    kept = decontaminate.remove_contaminated(docs, benchmark)
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, f in enumerate(flagged) if not f]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_contaminated(docs, benchmark, remove="spans").collect()}
    assert len(cut) == len(texts) and all(cut[i] == t for i, (t, f) in enumerate(zip(texts, flagged)) if not f)
    assert not any(r[1] for r in by_hand([cut[i].replace("uno", "") for i, f in enumerate(flagged) if f], items))
    assert cut[texts.index("a rare, WORD rare word")] == "a "
    with pytest.raises(ValueError):
        decontaminate.remove_contaminated(docs, benchmark, remove="all")


def test_empty_tables_and_extra_columns(frame):
    schema = "doc_id long, text string, benchmark_hits int, n_words string"
    none = frame([], "item_id long, text string")
    assert decontaminate.contamination_report(frame([], schema), none).count() == 0
    docs = frame([(1, "é one", 5, "mine"), (1, "é one", 5, "mine"), (None, "uno", 6, None)], schema)
    assert [tuple(r) for r in decontaminate.remove_contaminated(docs, none).orderBy("n_words").collect()][0] == (None, "uno", 6, None)
    kept = decontaminate.remove_contaminated(docs, frame([(1, "uno")], "item_id long, text string"))
    assert [tuple(r) for r in kept.collect()] == [(1, "é one", 5, "mine")] * 2 and kept.columns == docs.columns


def test_one_scan_whatever_the_size_of_the_benchmark(frame, capsys):
    long_item = " ".join(f"w{i}" for i in range(300))
    benchmark = frame([("a", long_item), ("b", long_item), ("a", long_item), (None, "two words")], "item_id string, text string")
    docs = frame([(1, long_item), (2, "x two words y"), (3, "w1 w2 clean"), (1, long_item), (4, None)])
    for block_windows in (1000, 582, 50, 1):
        report = decontaminate.contamination_report(docs, benchmark, block_windows=block_windows)
        report.explain()
        assert capsys.readouterr().out.count("MapInArrow") == 1
        got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in report.collect())
        assert got == [(1, 300, 300, 2), (1, 300, 300, 2), (2, 4, 2, 0), (3, 3, 0, 0), (4, 0, 0, 0)]


def test_windows_that_pass_the_filter_are_compared_by_words(frame, monkeypatch):
    monkeypatch.setattr(decontaminate.KeyFilter, "__call__", lambda self, keys: keys >= 0)  # a full filter lets all pass
    docs = frame([(1, "a b c d e"), (2, "b c d"), (3, "")], "doc_id long, text string")
    got = decontaminate.contamination_report(docs, frame([(7, "B  c")], "item_id long, text string"), size=2, block_windows=0)
    assert {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in got.collect()} == {1: (2, 1), 2: (2, 1), 3: (0, 0)}


def test_removal_and_clashes_with_a_large_benchmark(frame):
    schema = "doc_id long, text string, row int, found string, benchmark_hits int, item string"
    docs = frame([(1, "é one UNO, two uno", 5, "f", 6, "i"), (2, "one", 7, "g", 8, "j")], schema)
    benchmark = frame([(1, "uno")], "item_id long, text string")
    cut = decontaminate.remove_contaminated(docs, benchmark, remove="spans", block_windows=0)
    assert cut.columns == docs.columns
    assert sorted(tuple(r) for r in cut.collect()) == [(1, "é one , two ", 5, "f", 6, "i"), (2, "one", 7, "g", 8, "j")]
    assert decontaminate.remove_contaminated(docs.limit(0), benchmark, block_windows=0).count() == 0
