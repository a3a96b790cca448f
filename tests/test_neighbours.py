import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from benefacta.operators import neighbours

SCHEMA = "id long, a double, b double, g string, m string"


def by_hand(rows, k):
    known = [r for r in rows if r[1] is not None and r[2] is not None]
    spans = [max(r[j] for r in known) - min(r[j] for r in known) for j in (1, 2)]
    out = set()
    for i, r in enumerate(known):
        far = []
        for j, q in enumerate(known):
            if i != j:
                total = sum(abs(r[c] - q[c]) / s if s else 0 for c, s in zip((1, 2), spans)) + (r[3] != q[3]) + (r[4] != q[4])
                far.append((round(total / 4, 9), q[0]))
        out |= {(r[0], i, n, d, p + 1) for p, (d, n) in enumerate(sorted(far)[:k])}
    return sorted((a, n, round(d, 6), p) for a, _, n, d, p in out)


def run(spark, rows, k, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = neighbours.gower_neighbours(df, "id", ["a", "b"], ["g", "m"], k, **options)
    return sorted((r["id"], r["neighbour"], round(r["distance"], 6), r["place"]) for r in out.collect())


@pytest.mark.parametrize("k,pivots,block", [(3, 8, 512), (5, 3, 20), (1, 1, 7)])
def test_like_all_pairs(spark, k, pivots, block):
    rng = random.Random(k)
    rows = [(i, rng.gauss(20 * (i % 5), 2), rng.expovariate(0.1), "xyz"[i % 3], rng.choice(["p", "q", None])) for i in range(260)]
    rows += [(1000 + i, *rows[5][1:]) for i in range(40)]  # ties at distance 0
    assert run(spark, rows, k, pivots=pivots, block=block) == by_hand(rows, k)


def test_few_missing_and_no_rows(spark):
    rows = [(1, 1.0, 2.0, "x", None), (2, 1.0, 5.0, "y", None), (3, None, 1.0, "x", None)]
    assert run(spark, rows, 5) == by_hand(rows, 5) and len(run(spark, rows, 5)) == 2
    assert run(spark, [], 3) == [] and run(spark, rows[:1], 3) == []


def test_far_blocks_are_not_compared(spark):
    # two pivots: rings 0.1 wide at 0.0, 0.5 and 0.9 from the first, near their own neighbours only
    rows = [(0, ring, 0, 0.05, [at, 1 - at], [at + 0.05, 1.05 - at]) for ring, at in ((0, 0.0), (5, 0.5), (9, 0.9))]
    facts = spark.createDataFrame(rows, "pivot int, ring int, spot int, reach double, low array<double>, high array<double>")
    assert {(r["ring"], r["to_ring"]) for r in neighbours.block_pairs(facts, 10).collect()} == {(0, 0), (5, 5), (9, 9)}
    far = facts.withColumn("reach", F.lit(0.4))
    assert {(r["ring"], r["to_ring"]) for r in neighbours.block_pairs(far, 10).collect()} == {(0, 0), (5, 5), (9, 9), (5, 9), (9, 5)}


def test_a_block_meets_near_blocks_only(spark):
    rng = np.random.default_rng(3)
    space = neighbours._Space(np.array([1.0, 1.0]), 1)
    z = np.column_stack([rng.random((4000, 2)), rng.integers(0, 3, 4000).astype(float) * 1e15])
    leaves = neighbours._Tree(z, space, 50).leaves(z)
    blocks = [z[leaves == leaf] for leaf in np.unique(leaves)]
    assert max(map(len, blocks)) <= 50 and all(len(np.unique(b[:, 2])) == 1 for b in blocks)
    facts = spark.createDataFrame([(i % 8, i, 0.01, b.min(axis=0).tolist(), b.max(axis=0).tolist()) for i, b in enumerate(blocks)],
                                  "cell int, spot int, reach double, low array<double>, high array<double>")
    found = {(r["spot"], r["to_spot"]) for r in neighbours.box_pairs(facts, space).collect()}
    low, high = np.array([b.min(axis=0) for b in blocks]), np.array([b.max(axis=0) for b in blocks])
    near = space.gaps(low[:, None], high[:, None], low[None], high[None]) <= 0.01 + neighbours.SLACK
    assert found == set(zip(*(at.tolist() for at in np.nonzero(near)))) and len(found) < len(blocks) ** 2 / 6


def test_copies_share_one_point_and_keys_may_repeat(spark):
    rows = [(i, 1.0, 2.0, "x", "p") for i in range(300)] + [(7, 1.0, 2.0, "x", "p"), (900, 1.5, 2.0, "x", None), (901, 9.0, 4.0, "y", "")]
    assert run(spark, rows, 3, block=4) == by_hand(rows, 3)
    rng = random.Random(9)  # more rows than a cell and a block hold, ties on a grid
    rows = [(i, float(rng.randrange(30)), float(rng.randrange(30)), rng.choice("xyz"), rng.choice(["p", None])) for i in range(1500)]
    assert run(spark, rows, 4, block=16) == by_hand(rows, 4)
