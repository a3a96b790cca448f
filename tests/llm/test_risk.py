import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from benefacta.llm import risk
from .conftest import ODD, words


def plain(text):
    w, text = words(text), text or ""
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count = Counter(windows)
    covered = {j for i, k in enumerate(windows) if count[k] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def test_measures_like_plain_python(frame):
    rng = random.Random(1)
    texts = ODD + ["a b c d e a b c d e", "a a a a a a a", "x\ny\nx\n\n\nx\r\n x", "1 2 3 4 5 1 2 3 4", "# * a|b <c> & %$", "a\tb\vc\fd\re"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    rows = risk.measures(frame(list(enumerate(texts))), "text", "doc_id").collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def tail(k, n, p):
    p = Fraction(p).limit_denominator(10**6)
    return float(sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1)))


def test_exact_binomial_tail(frame):
    cases = [(0, 10), (1, 10), (0, 600), (3, 900), (9, 2000), (10, 10)]
    df = frame(cases, "k long, n long").select("k", "n", F.exp(risk.log_binomial_tail(F.col("k"), F.col("n"), 0.01)).alias("p"))
    assert {(r["k"], r["n"]): r["p"] for r in df.collect()} == pytest.approx({c: tail(*c, 0.01) for c in cases}, rel=1e-9)
    far = frame([(900, 100_000)], "k long, n long").select(risk.log_binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p")).first()["p"]
    assert far == pytest.approx(math.log(7.1e-4), abs=0.2)  # the first term alone would underflow


RULES = {"symbols": ("n_symbols", "n_words", (2.0, 1.0, 0.5, 0.1))}


def chosen_by_hand(rows, alpha, delta):
    """Cutoff of each stratum by the definition."""
    strata, out = {r[0] for r in rows}, {}
    for stratum in strata:
        good = [r for r in rows if r[0] == stratum and r[1] == 1]
        bad = [r for r in rows if r[0] == stratum and r[1] == 0]
        best = None
        for cutoff in RULES["symbols"][2]:
            k = sum(r[2] > cutoff * r[3] for r in good)
            if k >= alpha * len(good) or tail(k, len(good), alpha) > delta / len(strata):
                break
            caught = sum(r[2] > cutoff * r[3] for r in bad)
            if best is None or caught > best[0]:
                best = (caught, cutoff)
        if best:
            out[stratum] = best[1]
    return out


def test_cutoffs_like_by_hand(frame):
    rng = random.Random(2)
    rows = []
    for stratum, n, noise in (("en", 900, 0.001), ("de", 900, 0.02), ("few", 50, 0.0), (None, 700, 0.0)):
        for _ in range(n):
            good = rng.random() < 0.8
            ratio = 0.05 if good and rng.random() >= noise else rng.choice([0.3, 0.7, 1.5, 3.0])
            rows.append((stratum, int(good), int(ratio * 100), 100))
    df = frame(rows, "stratum string, label int, n_symbols long, n_words long")
    got = {r["stratum"]: r["cutoff_symbols"] for r in risk.choose_cutoffs(df, 0.01, 0.05, RULES).collect()}
    want = chosen_by_hand(rows, 0.01, 0.05)
    assert got == want and "few" not in want and "en" in want


def test_verdicts(frame):
    good = "alpha beta gamma delta epsilon zeta eta theta iota kappa number%d"
    rows = [(i, good % i, "en") for i in range(700)] + [(1000 + i, " ".join(f"{w}####" for w in (good % i).split()), "en") for i in range(80)]
    rows += [(2000, good % 1 + " ####" * 40, "xx"), (2001, "too short", "en"), (2002, "a b c d e f " * 5, "en"), (2003, None, None)]
    labels = frame([(r[0], int(r[0] < 1000)) for r in rows if r[0] < 2000] + [(5, 1), (6, None), (None, 0)], "doc_id long, quality int")
    judged, cutoffs = risk.risk_controlled(frame(rows, "doc_id long, text string, lang string"), labels)
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in judged.collect()}
    assert len(got) == len(rows) and all(got[i] == (False, True) for i in range(700))
    assert all(got[1000 + i] == (False, False) for i in range(80))
    assert got[2000] == (True, False) and got[2001] == (True, False) and got[2002] == (True, False) and got[2003] == (True, False)
    assert [r["stratum"] for r in cutoffs.collect()] == ["en"]


def test_no_labels_no_rejection(frame):
    rows = [(1, "# " * 5 + "a b c d e f g h i j k", "en"), (1, "x", "en"), (None, None, None)]
    docs = frame(rows, "doc_id long, text string, lang string")
    none = frame([], "doc_id long, quality int")
    judged, cutoffs = risk.risk_controlled(docs, none)
    assert cutoffs.count() == 0 and sorted(r["kept"] for r in judged.collect()) == [False, False, True]
    assert risk.risk_controlled(docs.limit(0), none)[0].count() == 0
