import random

import numpy as np
import pytest

from benefacta.operators import linkage

SCHEMA = "id long, a double, b double, g string, m string"


def gower(rows):
    x = np.array([[r[1], r[2]] for r in rows])
    spans = np.ptp(x, axis=0)
    out = np.abs(x[:, None] - x[None])
    out = (out / np.where(spans > 0, spans, 1)).sum(axis=2)
    for c in (3, 4):
        out += np.array([[p[c] != q[c] for q in rows] for p in rows])
    return out / 4


def plain(distance):
    """Merges by the mean over all pairs of members, computed anew each time."""
    held, heights = [[i] for i in range(len(distance))], []
    partitions = [[list(h) for h in held]]
    while len(held) > 1:
        best = min((round(distance[np.ix_(p, q)].mean(), 12), i, j) for i, p in enumerate(held) for j, q in enumerate(held) if i < j)
        heights.append(best[0])
        held[best[1]] = held[best[1]] + held.pop(best[2])
        partitions.append([sorted(h) for h in held])
    return heights, partitions


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = []
    for i in range(45):
        k = rng.randint(0, 3)
        out.append((i, rng.gauss(10 * k, 1), rng.gauss(-5 * k, 1), "MFX"[k % 3], rng.choice(["s", "c", None])))
    return out + [(45, *out[0][1:]), (46, *out[0][1:]), (47, *out[7][1:])]


@pytest.mark.parametrize("profiles", [False, True])
def test_plain_linkage_when_every_row_is_a_leaf(spark, rows, profiles):
    distance = gower(rows)
    if profiles:
        distance = np.sqrt(((distance[:, None] - distance[None]) ** 2).sum(axis=2))
    heights, partitions = plain(distance)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = linkage.hierarchy(df, ["a", "b"], ["g", "m"], profiles=profiles)
    assert [h for *_, h, _ in found.merges] == pytest.approx(heights[3:], abs=1e-7)  # three rows repeat others
    tree = found.tree(spark).orderBy("step").collect()
    assert tree[-1]["size"] == 48 and len(found.leaves.n) == 45
    for k in (2, 4, 7):
        labels = {}
        for r in found.label(df, k).collect():
            labels.setdefault(r["cluster"], []).append(r["id"])
        assert sorted(map(sorted, labels.values())) == sorted(partitions[48 - k])


def test_bounded_leaves_keep_the_groups_apart(spark):
    rng = random.Random(3)
    rows = [(i, rng.gauss(100 * (i % 4), 3), rng.gauss(0, 1), "abcd"[i % 4], None) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = linkage.hierarchy(df, ["a", "b"], ["g", "m"], most=20)
    assert len(found.leaves.n) <= 20 and found.leaves.n.sum() == 3000 and found.merges[-1][3] == 3000
    heights = [h for *_, h, _ in found.merges]
    assert all(x <= y + 1e-9 for x, y in zip(heights, heights[1:]))
    labels = {(r["id"] % 4, r["cluster"]) for r in found.label(df, 4).collect()}
    assert len(labels) == 4


def test_missing_values_and_small_tables(spark):
    none = linkage.hierarchy(spark.createDataFrame([], SCHEMA), ["a", "b"], ["g", "m"])
    assert none.tree(spark).count() == 0
    df = spark.createDataFrame([(1, 1.0, 2.0, "x", None), (2, None, 2.0, "x", None), (3, 1.0, 2.0, "x", None)], SCHEMA)
    one = linkage.hierarchy(df, ["a", "b"], ["g", "m"])
    assert {r["id"]: r["cluster"] for r in one.label(df).collect()} == {1: 1, 2: None, 3: 1} and not one.merges
    assert none.label(df).where("cluster is null").count() == 3
