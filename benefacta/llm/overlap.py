"""N-gram Jaccard join by T-occurrence search (DivideSkip).

A document's set holds the hashes of its distinct runs of ``size`` words (A-Z in lower case); with fewer words, the whole
sequence is its one run. Equal sets are one set from the start. Two sets of at least T common runs are linked, T following
from their sizes and the wanted Jaccard similarity.

1. *Partners.* A set with more than ``n - T`` runs that no other set has cannot reach T. Runs of a quarter of the hash
   range are counted: of a run that only one set has, the least and the greatest set name agree, so one aggregate without a
   join gives each set's number of them. Sets beyond the bound have no partner.
2. *Shards.* The runs of the sets left are counted and ordered from rare to frequent. Linked sets share one
   of their ``n - T + 1`` first runs. Of all sets with such a run one is the pivot; the sets of all runs with this pivot are
   its shard, dealt to blocks by their total size.
3. *Search.* Each block has inverted lists, from runs to its sets. For a query, the ``L`` longest of its lists are put
   aside; the others are merged with a heap, and sets found ``T - L`` times are probed for in the long ones by
   binary search. What has the required overlap is linked. First the pivots are queries. Where a shard run's sets are still
   in different classes, all of them outside its largest class are queries against all of its sets; a class that fills
   a shard is not compared with itself, and nothing is capped.
4. *Components* of the links; a component is named by its least doc_id.

A null or empty text, or one without words, has an empty set and is linked with nothing. Repeated rows are equal sets;
rows of one doc_id with other texts are documents of their own. A null doc_id counts in no name, so a component of null ids only
has a null name. Other columns of the input are not read. Sets are told apart by 128 bits; the runs of a set are told apart by 64.
"""

from __future__ import annotations

import heapq
import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .components import components
from .frames import KeyFilter
from .textarrays import FOLD, blocks, find_words, gram_hashes, mix, signed, word_hashes

SIZE = 3
PERCENT = 90
COUNTED = 1 << 62
BLOCK = 1 << 18
MERGE_COST = 0.0085
AT_ONCE = 64
_NAMES = np.array([0xA24BAED4963EE407, 0x9FB21C651E98DF25], np.uint64)
_SET = "struct<a: bigint, b: bigint>"


def run_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct runs of every text, and where each text begins."""
    words = find_words(data, offsets)
    hashes, counts = word_hashes(words, fold=FOLD), words.counts
    grams = gram_hashes(hashes, size)
    at = np.flatnonzero(words.left()[:len(grams)] >= size)
    keys, of = [grams[at]], [words.text_of[at]]
    for n in np.unique(counts[(counts > 0) & (counts < size)]):
        texts = np.flatnonzero(counts == n)
        keys.append(mix(gram_hashes(hashes, int(n))[words.first[texts]] + np.uint64(n)))
        of.append(texts)
    keys, of = np.concatenate(keys), np.concatenate(of).astype(np.int64)
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    keys, of = keys[fresh], of[fresh]
    return keys, np.searchsorted(of, np.arange(len(counts) + 1))


def _names(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits for each set, as two long integers; zeros for an empty one."""
    out, held = np.zeros((2, len(first) - 1), np.uint64), np.flatnonzero(np.diff(first))
    if len(held):
        for row, salt in zip(out, _NAMES):
            row[held] = np.add.reduceat(mix(keys ^ salt), first[held])
    return out.view(np.int64)


def _documents(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, set name ``a``, ``b`` and size ``n`` of every document."""
    def run(batches):
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                keys, first = run_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, _names(keys, first)), pa.array(np.diff(first))],
                                                 names=["doc_id", "a", "b", "n"])

    return docs.mapInArrow(run, "doc_id long, a long, b long, n long")


def _counted_runs(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for _, data, offsets in blocks(batch, "text"):
                keys, first = run_sets(data, offsets, size)
                at = np.flatnonzero(keys < COUNTED)
                names = np.repeat(_names(keys, first)[0], np.diff(first))
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys[at])), pa.array(names[at])], names=["run", "a"])

    return docs.select("text").mapInArrow(run, "run long, a long")


def _sets_of(docs: DataFrame, wanted: KeyFilter, size: int) -> DataFrame:
    """Name, size and runs of the sets whose name passes the filter."""
    shipped = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                keys, first = run_sets(data, offsets, size)
                a, b = _names(keys, first)
                kept = np.flatnonzero(shipped.value(a.view(np.uint64)) & (np.diff(first) > 0))
                runs = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(signed(keys)))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.diff(first)), runs],
                                                 names=["a", "b", "n", "runs"]).take(pa.array(kept))

    return docs.select("text").mapInArrow(run, "a long, b long, n long, runs array<long>")


def _least_overlap(n, percent: int):
    """T: the runs that a set of ``n`` has in common with any set it is linked to, at least."""
    return F.ceil(n * percent / F.lit(100.0)) if not isinstance(n, int) else -(-n * percent // 100)


def divide_skip(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that are in at least ``least`` of the sorted lists, and in how many."""
    lists = sorted(lists, key=len)
    if len(lists) < least:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    aside = min(least - 1, int(least / (MERGE_COST * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[:len(lists) - aside], lists[len(lists) - aside:]
    found, counts = [], []
    for number, same in groupby(heapq.merge(*[x.tolist() for x in short])):
        n = sum(1 for _ in same)
        if n >= least - aside:
            found.append(number)
            counts.append(n)
    found, counts = np.array(found, np.int64), np.array(counts, np.int64)
    width = int(max(found, default=0)) + 1
    for high in range(aside, 0, -AT_ONCE):  # the longest first, some at a time, each beside the next in one sorted array
        on = counts + high >= least
        found, counts = found[on], counts[on]
        if not len(found):
            break
        probed = long[max(high - AT_ONCE, 0):high]
        probed = [x[:np.searchsorted(x, width)] for x in probed] if probed[-1][-1] >= width else probed
        place = np.arange(len(probed)) * width
        held = np.concatenate([*probed, [np.iinfo(np.int64).max]])
        held[:-1] += np.repeat(place, [len(x) for x in probed])
        wanted = place[:, None] + found
        counts = counts + (held[np.searchsorted(held, wanted)] == wanted).sum(axis=0)
    on = counts >= least
    return found[on], counts[on]


def _search(table: pa.Table, percent: int) -> pa.Table:
    """Links between the block's queries and its members of other classes; only those that join what is not joined yet."""
    query = table.column("query").to_numpy()
    name = list(zip(*(table.column(c).to_pylist() for c in ("a", "b"))))
    group = list(zip(*(table.column(c).to_pylist() for c in ("class_a", "class_b"))))
    sizes = table.column("n").to_numpy()
    runs = table.column("runs").combine_chunks()
    runs = [runs[i].values.to_numpy() for i in range(len(name))]
    members = np.flatnonzero(~query)
    keys, owners = np.concatenate([runs[i] for i in members]), np.repeat(np.arange(len(members)), sizes[members])
    order = np.argsort(keys, kind="stable")  # equal runs keep their members in order
    keys, owners = keys[order], owners[order]
    parent = {g: g for g in group}

    def root(g):
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    links = []
    for q in np.flatnonzero(query).tolist():
        low, high = np.searchsorted(keys, runs[q], "left"), np.searchsorted(keys, runs[q], "right")
        lists = [owners[i:j] for i, j in zip(low.tolist(), high.tolist()) if j > i]
        for member, common in zip(*divide_skip(lists, _least_overlap(int(sizes[q]), percent))):
            other = int(members[member])
            one, two = root(group[q]), root(group[other])
            if one != two and 100 * common >= percent * (sizes[q] + sizes[other] - common):
                parent[one] = two
                links.append((dict(zip("ab", name[q])), dict(zip("ab", name[other]))))
    kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])
    return pa.table({"one": pa.array([x for x, _ in links], kind), "two": pa.array([y for _, y in links], kind)})


def _links(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links found in blocks of ``shard``, ``block``, ``part``, whose rows name sets, their classes and who asks."""
    full = dealt.join(sets.select("a", "b", "runs"), ["a", "b"])
    return full.groupBy("shard", "block", "part").applyInArrow(lambda t: _search(t, percent), f"one {_SET}, two {_SET}").select(
        F.col("one").alias("a"), F.col("two").alias("b")).distinct()


def _dealt(asked: DataFrame, members: DataFrame, block: int) -> DataFrame:
    """Queries and members of each shard in blocks of bounded size: every query part meets every member block."""
    columns = ["a", "b", "n", "class_a", "class_b"]
    counts = members.groupBy("shard").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    parts = asked.groupBy("shard").agg(F.ceil(F.sum("n") / block).cast("int").alias("parts"))
    bounds = materialise(counts.join(parts, "shard"), "shard-bounds")
    spot = F.xxhash64("a", "b")
    queries = asked.join(bounds, "shard").select(
        "shard", *columns, F.lit(True).alias("query"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(spot, F.col("parts")).cast("int").alias("part"))
    others = members.join(bounds, "shard").select(
        "shard", *columns, F.lit(False).alias("query"), F.pmod(spot, F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    both = queries.unionByName(others)
    whole = both.groupBy("shard", "block", "part").agg(F.every("query").alias("q"), F.some("query").alias("some")).where("some and not q")
    return both.join(whole.select("shard", "block", "part"), ["shard", "block", "part"], "left_semi")


def first_runs(sets: DataFrame, percent: float) -> DataFrame:
    """``run``, ``a``, ``b``, ``n``: of each set's first runs from rare to frequent, those that other sets have too.

    Sets whose runs that no other has are too many for a partner are left out before the frequencies return to the sets.
    """
    each = sets.select("a", "b", F.explode("runs").alias("run"))
    held = materialise(each.groupBy("run").agg(F.count("*").alias("held"), F.min("a").alias("a"), F.min("b").alias("b")), "run-counts")
    alone = held.where("held = 1").groupBy("a", "b").agg(F.count("*").alias("alone"))
    spare = F.col("n") - _least_overlap(F.col("n"), percent)
    kept = sets.join(alone, ["a", "b"], "left").withColumn("alone", F.coalesce("alone", F.lit(0))).where(F.col("alone") <= spare)
    kept = materialise(kept, "sets-left")
    shared = kept.select("a", "b", F.explode("runs").alias("run")).join(held.where("held > 1").select("run", "held"), "run")
    listed = shared.groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("held", "run"))).alias("shared"))
    first = F.slice("shared", F.lit(1), (spare + 1 - F.col("alone")).cast("int"))
    return listed.join(kept.select("a", "b", "n", "alone"), ["a", "b"]).select("a", "b", "n", F.explode(first).alias("run")).select("a", "b", "n", "run.run")


def jaccard_components(docs: DataFrame, text: str = "text", size: int = SIZE, percent: int = PERCENT, block: int = BLOCK,
                       filter_bits: int | None = None) -> DataFrame:
    """Each row's ``doc_id``, ``n_shingles`` and ``component_id``, the least doc_id of its component."""
    texts = docs.select("doc_id", F.col(text).alias("text"))
    rows = materialise(_documents(texts, size), "document-sets")
    distinct = rows.where("n > 0").groupBy("a", "b").agg(F.first("n").alias("n"))
    alone = (_counted_runs(texts, size).groupBy("run").agg(F.min("a").alias("a"), F.max("a").alias("most"))
             .where("a = most").groupBy("a").agg(F.count("*").alias("alone")))
    # sets that share the first half of their names are not told apart here and stay
    named = distinct.groupBy("a").agg(F.max("n").alias("n"), F.count("*").alias("sets")).join(alone, "a", "left")
    possible = materialise(named.where((F.col("sets") > 1) | (F.coalesce("alone", F.lit(0)) <= F.col("n") - _least_overlap(F.col("n"), percent)))
                           .select("a"), "sets-with-partners")
    sets = _sets_of(texts, KeyFilter.of(possible, "a", filter_bits), size).join(possible, "a", "left_semi")
    sets = materialise(sets.groupBy("a", "b").agg(F.first("n").alias("n"), F.first("runs").alias("runs")), "sets")
    runs = materialise(first_runs(sets, percent), "first-runs")
    sizes = runs.groupBy("run").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialise(runs.join(sizes, "run"), "shared-runs")
    weight = shared.groupBy("a", "b").agg(F.sum("size").alias("weight"))
    pivots = shared.join(weight, ["a", "b"]).groupBy("run").agg(F.max(F.struct("weight", "a", "b", "n")).alias("p"))
    pivots = materialise(pivots.select("run", F.struct("p.a", "p.b").alias("shard"), F.col("p.n").alias("shard_n")), "pivots")
    own = [F.col("a").alias("class_a"), F.col("b").alias("class_b")]
    comparable = (100 * F.least("n", "shard_n") >= percent * F.greatest("n", "shard_n")) & (
        (F.col("a") != F.col("shard.a")) | (F.col("b") != F.col("shard.b")))
    members = shared.join(pivots, "run").where(comparable).select("shard", "a", "b", "n", *own).distinct()
    asked = pivots.select("shard", "shard.a", "shard.b", F.col("shard_n").alias("n"), F.col("shard.a").alias("class_a"),
                          F.col("shard.b").alias("class_b")).distinct()
    links = materialise(_links(_dealt(asked, materialise(members, "shard-members"), block), sets, percent), "pivot-links")
    joined = components(links).select("node.a", "node.b", F.col("root.a").alias("class_a"), F.col("root.b").alias("class_b"))
    classed = shared.join(joined, ["a", "b"], "left").select(
        "run", "a", "b", "n", F.coalesce("class_a", "a").alias("class_a"), F.coalesce("class_b", "b").alias("class_b"))
    classed = materialise(classed, "classed-runs")
    largest = (classed.groupBy("run", "class_a", "class_b").agg(F.count("*").alias("held"))
               .groupBy("run").agg(F.count("*").alias("classes"), F.max(F.struct("held", "class_a", "class_b")).alias("largest"))
               .where("classes > 1"))
    mixed = classed.join(largest, "run").join(pivots.select("run", "shard"), "run")
    mixed = materialise(mixed.select("shard", "a", "b", "n", "class_a", "class_b", (
        (F.col("class_a") != F.col("largest.class_a")) | (F.col("class_b") != F.col("largest.class_b"))).alias("outside")), "mixed-runs")
    every = mixed.drop("outside").distinct()
    outside = mixed.where("outside").drop("outside").distinct()
    more = _links(_dealt(outside, every, block), sets, percent)
    final = components(links.unionByName(more)).select("node.a", "node.b", "root")
    rooted = (rows.where("n > 0").join(final, ["a", "b"], "left")
              .select("doc_id", "n", F.coalesce("root", F.struct("a", "b")).alias("root")))
    rooted = materialise(rooted, "rooted")
    names = materialise(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-names")
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rooted.join(names, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(empty)
