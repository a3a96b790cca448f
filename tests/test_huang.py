import math
from collections import Counter
from statistics import NormalDist

import numpy as np
import pytest

from benefacta.operators import mixed

SCHEMA = "id long, x double, y double, g string, m string"


def races(hashes, seed, turn):
    """Exponential variables of 64-bit values, one by one."""
    out = []
    for h in hashes:
        v = (h + ((seed * 1_000_003 + turn) * 0x9E3779B97F4A7C15)) % 2**64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            v = ((v ^ (v >> shift)) * factor) % 2**64
        v ^= v >> 31
        out.append(-math.log(((v >> 11) + 0.5) / 2**53))
    return out


def plain(records, sizes, seeds, hashed):
    """Starts as the rule says, from lists: frequencies, then the nearest records one after the other."""
    x = np.array([r[1:3] for r in records])
    out = []
    for k, seed in zip(sizes, seeds):
        starts = []
        for i in range(k):
            u = [math.exp(-e) for e in races(range(2), seed, i)]
            numbers = [x[:, j].mean() + NormalDist().inv_cdf(u[j]) * x[:, j].std() for j in range(2)]
            words = []
            for j in (3, 4):
                counts = Counter(r[j] for r in records)
                times = {w: races([hashed[w]], seed, 1000 * (j - 1 + 1) + i)[0] / n for w, n in counts.items()}
                words.append(min(times, key=times.get))
            starts.append([numbers, tuple(words)])
        combos = sorted({r[3:] for r in records}, key=lambda t: [(w is not None, w or "") for w in t])
        for s in starts:
            ranked = sorted(combos, key=lambda t: sum(a != b for a, b in zip(t, s[1])))
            s[1] = next((t for t in ranked if t not in [o[1] for o in starts if o is not s]), ranked[0])
        out.append(starts)
    return out


@pytest.fixture(scope="module")
def records():
    rng = np.random.default_rng(9)
    out = [(i, float(rng.normal(5, 2)), float(rng.integers(0, 50)), "abcd"[min(int(rng.exponential(1)), 3)], [None, "p", "q"][rng.integers(0, 3)])
           for i in range(200)]
    return [r for r in out if r[3:] not in {("a", "q"), ("b", "p")}]  # some combinations do not occur


def test_starts_equal_to_a_plain_version(spark, records):
    df = spark.createDataFrame(records, SCHEMA).repartition(5)
    words = spark.createDataFrame([(w,) for w in ("a", "b", "c", "d", "p", "q", None)], "w string").selectExpr("w", "xxhash64(w) AS h").collect()
    hashed = {r["w"]: r["h"] % 2**64 for r in words}
    sizes, seeds = [2, 3, 5, 9], [123, 124, 125, 123]
    got = mixed.huang_starts(df.drop("id"), ["x", "y"], ["g", "m"], sizes, seeds)
    want = plain(records, sizes, seeds, hashed)
    assert [[(s["g"], s["m"]) for s in run] for run in got] == [[s[1] for s in run] for run in want]
    assert [[(s["x"], s["y"]) for s in run] for run in got] == [[pytest.approx(tuple(s[0])) for s in run] for run in want]
    real = {r[3:] for r in records}
    assert all((s["g"], s["m"]) in real for run in got for s in run)
    assert all(len({(s["g"], s["m"]) for s in run}) == len(run) for run in got)


def test_categories_follow_their_frequencies(spark):
    df = spark.createDataFrame([(i, 0.0, 0.0, "often" if i % 10 else "rare", "m") for i in range(1000)], SCHEMA)
    starts = mixed.huang_starts(df, [], ["g"], [1] * 400, list(range(400)))
    assert 340 <= sum(run[0]["g"] == "often" for run in starts) <= 380


def test_costs_are_those_of_the_assigned_rows(spark, records):
    df = spark.createDataFrame(records, SCHEMA).repartition(3)
    fits = mixed.kprototypes_fits(df, ["x", "y", "g", "m"], "id", range(2, 6), restarts=4, init="huang")
    assert [f[0] for f in fits] == [2, 3, 4, 5]
    for _, cost, _, prototypes, gamma in fits:
        by_hand = sum(min((r[1] - p["x"])**2 + (r[2] - p["y"])**2 + gamma * ((r[3] != p["g"]) + (r[4] != p["m"])) for p in prototypes) for r in records)
        assert cost == pytest.approx(by_hand)
        assert mixed.assigned_cost(df, ["x", "y", "g", "m"], prototypes, gamma).first()["cost"] == pytest.approx(by_hand)


def test_few_records_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, "a", None), (2, 1.0, 2.0, "a", None)], SCHEMA)
    assert [f[:3] for f in mixed.kprototypes_fits(df, ["x", "y", "g", "m"], "id", range(2, 4), init="huang")] == [(2, 0.0, 1), (3, 0.0, 1)]
    none = spark.createDataFrame([], SCHEMA)
    assert mixed.kprototypes_costs(none, ["x", "y", "g", "m"], "id", gamma=1.0, init="huang").count() == 0
