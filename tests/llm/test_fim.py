import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from benefacta.llm import fim
from .conftest import ODD


def by_hand(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[i:i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    shared = "\n".join("shared line é %d 🙂" % rng.randint(0, 9) for _ in range(300))
    out = [*ODD, "\n", "\n\n\n", "a\n", "a\nb", "\r\n x   y\n", "one <P> two\nthree\n", "a<\nP>", "<", "<P\n>", "<S>", "ends <M>",
           "word \n" * 20000, "<" * 40 + "\n" + "P>" * 3, "é" * 40000 + "\n" + "x" * 40000]
    for _ in range(60):
        lines = ["".join(rng.choice("ab <>PSM é🙂") for _ in range(rng.randint(0, 90))) for _ in range(rng.randint(0, 60))]
        out.append("\n".join(lines) + rng.choice(["", "\n"]) + (shared if rng.random() < 0.5 else ""))
    return out


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (0, 50), (100, 100)])
def test_like_by_hand_and_back(frame, texts, rate, spm):
    rows = [*enumerate(texts), (None, "null id\nsecond\n"), (-5, "a\nb\nc"), (3, texts[3])]
    cut = fim.fill_in_middle(frame(rows), rate=rate, spm=spm).withColumn("back", fim.restored(F.col("fim_text"), F.col("form")))
    got = [(r["doc_id"], r["text"], r["n_lines"], r["form"], r["prefix_chars"], r["middle_chars"], r["fim_text"]) for r in cut.drop("back").collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted([(i, t, *by_hand(i, t, rate, spm)) for i, t in rows], key=key)
    assert all(r["back"] == (r["text"] or "") for r in cut.collect())


def test_shared_passages_give_shared_chunks_and_a_bounded_memo(rng):
    shared = "".join(chr(rng.randint(97, 122)) for _ in range(60000))
    one, two = (("x" * k + shared).encode() for k in (7, 1234))
    data = np.frombuffer(one + two, np.uint8)
    ends = fim.chunk_ends(data, np.array([0, len(one), len(one) + len(two)]))
    assert ends[0][-1] == len(one) and ends[1][-1] == len(data) and np.diff(ends[0]).max() <= fim.LONGEST
    parts = [{data[a:b].tobytes() for a, b in zip(np.append(low, e[:-1]), e)} for low, e in zip((0, len(one)), ends)]
    assert len(parts[0] & parts[1]) >= 0.9 * len(parts[0])
    memo = fim.Memo(20000)
    for low, e in zip((0, len(one)), ends):
        cuts = fim.Cuts(data[low:e[-1]].tobytes(), (e - low).tolist(), memo)
        assert cuts.chars == e[-1] - low and memo.size <= 20000
    large = fim.Memo()
    for low, e in zip((0, len(one)), ends):
        fim.Cuts(data[low:e[-1]].tobytes(), (e - low).tolist(), large)
    assert large.hits >= 0.9 * len(parts[0])


def test_marker_across_chunks():
    for text in (b"ab<P>cd", b"<M", b"x<S>"):
        for at in range(1, len(text)):
            for second in range(at, len(text)):
                ends = sorted({at, second, len(text)})
                assert fim.Cuts(text, ends, fim.Memo()).marked == fim._marked(text)


def test_empty_table_and_clashing_columns(frame):
    schema = "doc_id long, text string, form int, draw string, fim_text string, n_lines string"
    assert fim.fill_in_middle(frame([], schema)).count() == 0
    out = fim.fill_in_middle(frame([(1, "a\nb", 4, "d", "mine", "n")], schema)).first()
    assert (out["form"], out["draw"], out["fim_text"], out["n_lines"], out["n_lines_"]) == (4, "d", "mine", "n", 2)
    assert out["fim_text_"] == by_hand(1, "a\nb")[-1]
