import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from benefacta.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, k, rounds, dims, scale=256, seed=2):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in named[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for c in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                centres[c] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    return Counter((i, c, d, inertia[c], sum(inertia.values()), tuple(centres[c])) for i, c, d in found)


def run(spark, rows, k, rounds, dims, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    out = centroids.cluster_vectors(df, k=k, rounds=rounds, dimensions=dims, **options).collect()
    return Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"])) for r in out)


@pytest.mark.parametrize("seed,k,rounds,dims,spread,block", [
    (1, 5, 5, 3, 0.4, 16), (2, 7, 12, 2, 0.01, 4096), (3, 40, 3, 4, 3.0, 50), (4, 1, 3, 2, 1.0, 7), (5, 9, 0, 2, 1.0, 64)])
def test_like_plain_lloyd(spark, seed, k, rounds, dims, spread, block):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, spread) for x in rng.choice(centres)]) for i in range(400)]
    assert run(spark, rows, k, rounds, dims, block=block) == by_hand(rows, k, rounds, dims)


def test_ties_repeats_and_unusable_vectors(spark):
    grid = [(i, [float(i % 4), float(i // 4 % 4)]) for i in range(64)]  # every vector four times, many ties
    odd = [(100, None), (101, []), (102, [1.0]), (103, [1.0, None]), (104, [float("nan"), 0.0]), (105, [float("inf"), 0.0]),
           (106, [1.0, 2.0, 3.0]), (None, [0.0, 1.0]), (3, [3.0, 0.0]), (3, [9.0, 9.0])]
    assert run(spark, grid + odd, 6, 5, 2) == by_hand(grid + odd, 6, 5, 2)
    assert run(spark, [(1, [5.0, 5.0])], 6, 5, 2) == by_hand([(1, [5.0, 5.0])], 6, 5, 2)
    assert run(spark, [(i, [1.0, 1.0]) for i in range(50)], 6, 5, 2) == by_hand([(i, [1.0, 1.0]) for i in range(50)], 6, 5, 2)
    assert not run(spark, [], 6, 5, 2) and not run(spark, odd[:4], 6, 5, 2)


def test_huge_components_are_bounded(spark):
    out = run(spark, [(1, [1e30, -1e30]), (2, [0.0, 0.0])], 2, 2, 2)
    assert sorted(r[1:3] for r in out) == [(0, 0), (1, 0)]
    assert sorted(r[-1] for r in out) == [(0, 0), (2**27, -2**27)]


def test_few_vectors_are_compared_again(rng):
    """The heaps spare most comparisons: on well parted clusters only the first pass compares all."""
    spots = np.array([[rng.randint(-4000, 4000) for _ in range(8)] for _ in range(10)])
    x = np.array([spots[i % 10] + [rng.randint(-40, 40) for _ in range(8)] for i in range(2000)], np.int32)
    held, centres, drift = centroids.Block.fresh(x, 10), spots.astype(np.int64), np.zeros(10)
    compared, total = [], np.zeros((10, 9), np.int64)
    for _ in range(4):
        moved, n = held.advance(centres, drift)
        total += moved
        compared.append(n)
        new = total[:, :-1] // total[:, -1:]
        step = np.sqrt(np.square(new - centres).sum(axis=1))
        drift = drift + step + step.max()
        centres = new
    assert compared[0] == 2000 and max(compared[1:]) < 100
    assert (held.owner == centroids.squared_distances(x.astype(np.int64), centres).argmin(axis=1)).all()


def test_clashing_columns_are_not_read(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 5, "x", "y")], "vec_id long, embedding array<double>, cluster int, distance string, centroid string")
    out = centroids.cluster_vectors(df, k=2, rounds=1, dimensions=2).first()
    assert (out["cluster"], out["distance"], out["centroid"]) == (0, 0, [256, 512])
