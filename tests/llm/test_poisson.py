import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from benefacta.llm import poisson

SCHEMA = "doc_id long, text string, source string"


def number(text, digits):
    return int(hashlib.md5(text.encode()).hexdigest()[:digits], 16)


def inverse(rate, u):
    """Poisson count by plain summation."""
    n, term = 0, math.exp(-rate)
    total = term
    while total <= u and n < 500:
        n += 1
        term *= rate / n
        total += term
    return n


def by_hand(rows, seed, targets=None, temperature=0.5):
    size = Counter()
    for _, text, source in rows:
        size[source] += len(text or "")
    weight = {s: (n ** temperature if n else 0.0) if targets is None else targets.get(s, 0.0) for s, n in size.items()}
    out = Counter()
    for doc, text, source in rows:
        name = "null" if doc is None else str(doc)
        empty = 1.0 if targets is None or weight[source] > 0 else 0.0
        rate = weight[source] / (sum(weight.values()) or 1) * sum(size.values()) / size[source] if size[source] else empty
        n = inverse(rate, (number(f"{seed}:{name}", 13) + 0.5) / 16 ** 13) if rate else 0
        out.update((doc, text, source, copy, number(f"{seed}:{name}:{copy}", 15)) for copy in range(1, n + 1))
    return out


@pytest.fixture(scope="module")
def rows():
    out = [(i, "x" * (i % 50 + 1), "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    return out + [(None, "nobody", None), (5, "again", "s5"), (5, "again", "s5"), (901, None, "empty"), (902, "", "empty")]


@pytest.mark.parametrize("targets", [None, {"hot": 1.0, "s3": 3.0}, {}])
def test_counts_like_by_hand(frame, rows, targets):
    got = poisson.replicate(frame(rows, SCHEMA), seed=3, **({"targets": targets} if targets else {})).collect()
    assert Counter(tuple(r) for r in got) == by_hand(rows, 3, targets or None)


def test_shares_come_near_the_targets(frame):
    docs = frame([(i, "abcdefghij", "big" if i % 10 else "small") for i in range(6000)], SCHEMA)
    mixed = poisson.replicate(docs, targets={"big": 1.0, "small": 1.0})
    n = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert n["big"] == pytest.approx(3000, rel=0.08) and n["small"] == pytest.approx(3000, rel=0.08)


def test_long_tails_do_not_underflow(frame):
    rates = frame([(0.0,), (1e-9,), (3.0,), (900.0,)], "rate double")
    rows = {r["rate"]: r["c"] for r in rates.select("rate", poisson.cumulative(F.col("rate")).alias("c")).collect()}
    assert rows[0.0] == [1.0] and all(c[-1] == pytest.approx(1.0) for c in rows.values())
    assert next(i for i, c in enumerate(rows[900.0]) if c > 0.5) == pytest.approx(900, abs=2)


def test_order_is_shuffled_and_repeatable(frame, rows):
    one, two = (poisson.replicate(frame(rows, SCHEMA).repartition(n)) for n in (1, 5))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))
    for part in one.select("shuffle_key", F.spark_partition_id().alias("p")).groupBy("p").agg(F.collect_list("shuffle_key").alias("k")).collect():
        assert part["k"] == sorted(part["k"])
    assert Counter(map(tuple, poisson.replicate(frame(rows, SCHEMA), seed=8).collect())) != Counter(map(tuple, one.collect()))


def test_empty_table_and_extra_columns(frame):
    schema = SCHEMA + ", copy string, rate int"
    assert poisson.replicate(frame([], schema)).count() == 0
    out = poisson.replicate(frame([(i, "a", "s", "mine", 4) for i in range(30)], schema))
    assert out.columns == ["doc_id", "text", "source", "copy", "rate", "copy_", "shuffle_key"]
    assert {(r["copy"], r["rate"]) for r in out.collect()} == {("mine", 4)}


def test_large_rates_take_a_narrow_band(spark, frame):
    import time
    rates = frame([("a", 10**6 + 0.5), ("b", 0.0), ("c", 3.5), ("d", 1e-9), (None, 70.0)], "of_source string, rate double")
    start = time.time()
    rows = {r["of_source"]: r for r in poisson.distributions(rates).collect()}
    assert time.time() - start < 20 and len(rows["a"]["cumulative"]) < 25_000
    assert rows["b"]["cumulative"] == [1.0]
    for source, rate in (("c", 3.5), ("d", 1e-9), (None, 70.0)):
        assert rows[source]["first"] == 0
        total, want = 0.0, []
        for j in range(len(rows[source]["cumulative"])):
            total += math.exp(-rate + j * math.log(rate) - math.lgamma(j + 1))
            want.append(total)
        assert rows[source]["cumulative"] == pytest.approx(want, rel=1e-12)
    a = rows["a"]
    middle = next(i for i, c in enumerate(a["cumulative"]) if c >= 0.5) + a["first"]
    assert abs(middle - 10**6) <= 1
    spread = next(i for i, c in enumerate(a["cumulative"]) if c >= 0.8413447) + a["first"]
    assert abs(spread - 10**6 - 1000) <= 2


def test_helper_names_that_the_input_has(frame):
    names = ["distribution", "distribution_u", "distribution_n", "of_source", "first_count", "copy_"]
    docs = frame([(i, "a", "s", *range(6)) for i in range(30)], SCHEMA + "".join(f", {n} int" for n in names))
    out = poisson.replicate(docs).collect()
    assert out and all([r[n] for n in names] == list(range(6)) for r in out)
