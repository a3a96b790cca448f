"""Near-duplicate documents by DartMinHash signatures.

A text is a weighted set: its runs of ``size`` words, weighted by how often they occur. Each element owns a region
as high as its weight. Darts arrive in every unit layer of a region as a Poisson process along the rank axis;
arrival times and coordinates follow from hashes of the element, the layer and the dart's number alone, so equal regions
get equal darts in all texts. Per coordinate the earliest dart counts. Two texts agree in a coordinate with a
probability equal to their weighted Jaccard similarity. Darts are thrown up to a rank at which a text gets about
``k ln k + 4 k`` of them, whatever its length; texts with an empty coordinate go on until it is filled.

Signatures are cut into bands. Texts of one bucket (equal band) are candidates; a link is a pair whose weighted
Jaccard similarity, computed from all their runs, reaches the threshold; classes are the components of the links.

1. Exact copies are one text from the start, so copies are never compared.
2. Each text is compared with one text of each of its buckets, the one that shares most buckets: rows grow with texts,
   not with pairs.
3. Texts of buckets that still hold different classes are dealt again: texts that reach the threshold share one of their
   rarest runs, which texts with a common template only do not. In these groups every pair from different classes is compared by
   signature, in blocks of bounded size, and pairs that may reach the threshold are verified: where few, by a join; where a pair of blocks
   has many, within the blocks, which return only links that join classes. No group is capped.

Texts of fewer words than ``size``, but not none, have one run. Texts without words are alike only if they are
equal; a null text is a class of its own. A class is named by its least doc_id; repeated rows are copies.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .components import components
from .frames import KeyFilter, content_ids, free_name, unit
from .overlap import first_runs
from .textarrays import blocks, find_words, gram_hashes, mix, signed, word_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 5
BLOCK = 256
DENSE = 8
AT_ONCE = 256
_LAYER = np.uint64(0xA0761D6478BD642F)
_DART = np.uint64(0xE7037ED1A0B428DB)
_PLACE = np.uint64(0x8EBC6AF09C88C6E3)


def layered_runs(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit layers of all texts: a key for each run of words and its number among equal runs of its text, sorted
    within the text; and where each text begins. Weighted Jaccard of runs is plain Jaccard of these keys."""
    words = find_words(data, offsets)
    hashes, counts = word_hashes(words), words.counts
    keys, of = [], []
    grams = gram_hashes(hashes, size)
    at = np.flatnonzero(words.left()[:len(grams)] >= size)
    keys.append(grams[at])
    of.append(words.text_of[at])
    for n in np.unique(counts[(counts > 0) & (counts < size)]):
        texts = np.flatnonzero(counts == n)
        keys.append(gram_hashes(hashes, int(n))[words.first[texts]] + np.uint64(n))
        of.append(texts)
    keys, of = np.concatenate(keys), np.concatenate(of).astype(np.int64)
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    begin = np.flatnonzero(fresh)
    layer = np.arange(len(keys)) - np.repeat(begin, np.diff(np.append(begin, len(keys))))
    return mix(keys + layer.astype(np.uint64) * _LAYER), np.searchsorted(of, np.arange(len(counts) + 1))


def signatures(keys: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Earliest dart of each coordinate, one row per text; texts without keys get zeros.

    Every text takes about as many darts, however short, so only some texts are worked on at a time.
    """
    parts = [_earliest(keys[first[i]:first[min(i + AT_ONCE, len(first) - 1)]], first[i:i + AT_ONCE + 1] - first[i], k)
             for i in range(0, len(first) - 1, AT_ONCE)]
    return np.concatenate(parts) if parts else np.empty((0, k), np.uint64)


def _earliest(keys: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    n, sizes = len(first) - 1, np.diff(first)
    of, element = np.repeat(np.arange(n), sizes), keys
    limit = (k * math.log(k) + 4 * k) / np.maximum(sizes, 1)
    rank, dart = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    number, time = np.zeros(len(keys), np.uint64), np.zeros(len(keys))  # darts thrown so far, arrival of the last
    while True:
        done = []
        while len(of):
            left = limit[of] - time
            count = np.ceil(left + np.sqrt(left)).astype(np.int64) + 1
            begin = np.cumsum(count) - count
            each = np.repeat(np.arange(len(of)), count)
            nth = number[each] + (np.arange(len(each)) - begin[each]).astype(np.uint64)
            gap = -np.log(unit(element[each] + nth * _LAYER))
            arrival = np.cumsum(gap)
            arrival += (time - arrival[begin] + gap[begin])[each]
            on = arrival < limit[of][each]
            thrown = mix(element[each[on]] + (nth[on] + np.uint64(1)) * _DART)
            cell = of[each[on]] * k + ((thrown >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
            at, before = arrival[on], rank[cell]
            np.minimum.at(rank, cell, at)
            won = (at < before) & (at == rank[cell])
            dart[cell[won]] = mix(thrown[won] ^ _PLACE)
            within = np.add.reduceat(on.astype(np.int64), begin)
            last = begin + within - 1
            time = np.where(within > 0, arrival[np.maximum(last, 0)], time)
            number = number + within.astype(np.uint64)
            more = within == count
            done.append((of[~more], element[~more], number[~more], time[~more]))
            of, element, number, time = of[more], element[more], number[more], time[more]
        empty = np.isinf(rank.reshape(n, k)).any(axis=1) & (sizes > 0)
        if not empty.any():
            return dart.reshape(n, k)
        limit[empty] *= 2  # throw on for these texts
        of, element, number, time = (np.concatenate(x) for x in zip(*done))
        on = empty[of]
        of, element, number, time = of[on], element[on], number[on], time[on]


def _sketch(texts: DataFrame, size: int, k: int) -> DataFrame:
    """``doc_id``, ``text_id``, ``n`` (runs) and ``signature`` (32 bits a coordinate) of every text that is not null."""
    def run(batches):
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                keys, first = layered_runs(data, offsets, size)
                found = (signatures(keys, first, k) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, k, dtype=np.int32)), pa.array(found.reshape(-1)))],
                    names=["doc_id", "text_id", "n", "signature"])

    return texts.mapInArrow(run, "doc_id long, text_id long, n long, signature array<int>")


def _runs_of(texts: DataFrame, wanted: KeyFilter, size: int) -> DataFrame:
    """``text_id`` and sorted layer keys of the texts whose row key passes the filter."""
    shipped = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            rows = np.flatnonzero(shipped.value(batch.column(2).to_numpy().view(np.uint64)))
            chosen = batch.take(pa.array(rows))
            for part, data, offsets in blocks(chosen, "text"):
                keys, first = layered_runs(data, offsets, size)
                of = np.repeat(np.arange(part.num_rows), np.diff(first))
                keys = signed(keys)[np.lexsort((signed(keys), of))]
                yield pa.RecordBatch.from_arrays([
                    part.column(1), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(keys))],
                    names=["text_id", "runs"])

    return texts.select("text", "text_id", "row").mapInArrow(run, "text_id long, runs array<long>")


def _verified(pairs: DataFrame, runs: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a``, ``b`` whose runs have the wanted weighted Jaccard similarity."""
    def run(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                keep.append(_similar(a[i].values.to_numpy(), b[i].values.to_numpy(), similarity))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    known = pairs.join(runs.select(F.col("text_id").alias("b"), F.col("runs").alias("runs_b")), "b")
    known = known.join(runs.select(F.col("text_id").alias("a"), F.col("runs").alias("runs_a")), "a")
    return known.select("a", "b", "runs_a", "runs_b").mapInArrow(run, "a long, b long")


def _spread(members: DataFrame, blocks_of: DataFrame) -> DataFrame:
    """Members of mixed buckets, dealt to pairs of blocks ``i``, ``j``: all members by blocks ``i``, against those outside
    the bucket's largest class by blocks ``j``. A class that fills a bucket is not compared with itself."""
    m = members.join(blocks_of, "band")
    columns = ["band", "text_id", "class", "n"]
    home = F.pmod(F.xxhash64("text_id"), F.col("n_blocks")).cast("int")
    home_outside = F.pmod(F.xxhash64("text_id"), F.col("n_outside_blocks")).cast("int")
    every = m.select(*columns, F.lit(False).alias("outside"), home.alias("i"),
                     F.explode(F.expr("sequence(0, n_outside_blocks - 1)")).alias("j"))
    outside = m.where(F.col("class") != F.col("largest")).select(
        *columns, F.lit(True).alias("outside"), F.explode(F.expr("sequence(0, n_blocks - 1)")).alias("i"),
        home_outside.alias("j"))
    return every.unionByName(outside)


def _promising(table: pa.Table, k: int, similarity: float):
    """For each member outside the largest class: its row, and the rows of other classes whose signature and size allow the
    similarity (5 deviations of the estimate below it)."""
    least = similarity - 5 * math.sqrt(similarity * (1 - similarity) / k)
    side = table.column("outside").to_numpy()
    classes, n = table.column("class").to_numpy(), table.column("n").to_numpy()
    sketch = table.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, k)
    left = np.flatnonzero(~side)
    for i in np.flatnonzero(side):
        near = left[(classes[left] != classes[i]) & (np.minimum(n[left], n[i]) >= similarity * np.maximum(n[left], n[i]))]
        yield i, near[(sketch[near] == sketch[i]).mean(axis=1) >= least]


def _similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets of layer keys have the Jaccard similarity."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return same >= similarity * (len(both) - same)


def _cross_pairs(spread: DataFrame, k: int, similarity: float, dense: int) -> DataFrame:
    """Promising pairs ``a``, ``b``; of a pair of blocks with more than ``dense`` of them a member, its key alone."""
    def compare(table: pa.Table) -> pa.Table:
        ids, out, total = table.column("text_id").to_numpy(), [np.empty((2, 0), np.int64)], 0
        for i, near in _promising(table, k, similarity):
            out.append(np.stack([np.minimum(ids[near], ids[i]), np.maximum(ids[near], ids[i])]))
            total += len(near)
            if total > dense * len(ids):
                key = {c: table.column(c)[:1] for c in ("band", "i", "j")}
                return pa.table(key | {c: pa.array([None], pa.int64()) for c in ("a", "b")})
        a, b = np.concatenate(out, axis=1)
        none = pa.nulls(len(a))
        return pa.table({"band": none.cast(pa.int64()), "i": none.cast(pa.int32()), "j": none.cast(pa.int32()),
                         "a": pa.array(a), "b": pa.array(b)})

    return spread.groupBy("band", "i", "j").applyInArrow(compare, "band long, i int, j int, a long, b long").distinct()


def _dense_links(spread: DataFrame, k: int, similarity: float) -> DataFrame:
    """Links of dense pairs of blocks, verified within the block; only those that join what is not joined yet."""
    def verify(table: pa.Table) -> pa.Table:
        ids, classes = table.column("text_id").to_numpy(), table.column("class").to_numpy()
        runs = table.column("runs").combine_chunks()
        parent = {c: c for c in classes.tolist()}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        links = []
        for i, near in _promising(table, k, similarity):
            for other in near:
                own, its = root(classes[i]), root(classes[other])
                if own != its and _similar(runs[i].values.to_numpy(), runs[other].values.to_numpy(), similarity):
                    parent[own] = its
                    links.append((ids[other], ids[i]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return spread.groupBy("band", "i", "j").applyInArrow(verify, "a long, b long").distinct()


def _by_rare_runs(texts: DataFrame, runs: DataFrame, similarity: float) -> DataFrame:
    """``band``, ``text_id``, ``n``, ``class``: similar texts share one of their rarest runs; of each such run's texts the one with
    most such runs names the group, so texts that share many meet once."""
    sets = texts.join(runs, "text_id").select(F.col("text_id").alias("a"), F.lit(0).cast("long").alias("b"), "n", "runs")
    first = materialise(first_runs(sets, round(100 * similarity, 9)), "rare-runs")
    held = materialise(first.join(first.groupBy("run").agg(F.count("*").alias("texts")).where("texts > 1"), "run"), "shared-rare-runs")
    weight = held.groupBy("a").agg(F.sum("texts").alias("weight"))
    named = held.join(weight, "a").groupBy("run").agg(F.max(F.struct("weight", "a"))["a"].alias("band"))
    return held.join(named, "run").select("band", F.col("a").alias("text_id")).distinct().join(texts, "text_id").select(
        "band", "text_id", "n", "class")


def near_duplicate_classes(docs: DataFrame, text: str = "text", size: int = WORDS, similarity: float = SIMILARITY,
                           bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, dense: int = DENSE,
                           filter_bits: int | None = None, ids: Column | None = None) -> DataFrame:
    """Each row's ``doc_id``, ``text_id`` (``ids``, by default ``content_ids`` of the text) and ``class_id``, the least doc_id of its class."""
    k = bands * rows
    ids = content_ids(docs, [text]) if ids is None else ids
    texts = docs.select("doc_id", ids.alias("text_id"), F.col(text).alias("text"))
    sketches = materialise(_sketch(texts.where("text is not null"), size, k), "sketches")
    # a copy's signature is the same, so one row per distinct text is enough from here on
    distinct = materialise(sketches.groupBy("text_id").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("signature").alias("signature")), "distinct-texts")
    buckets = distinct.where("n > 0").select("text_id", "n", F.explode(F.array(*[
        F.xxhash64(F.lit(b), F.slice("signature", b * rows + 1, rows)) for b in range(bands)])).alias("band"))
    buckets = materialise(buckets, "buckets")
    sizes = materialise(buckets.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "bucket-sizes")
    shared = materialise(buckets.join(sizes, "band"), "shared-buckets")
    # a group of near copies differs less from its origin than from each other; the origin shares most buckets
    weight = shared.groupBy("text_id").agg(F.sum("size").alias("weight"))
    pivots = shared.join(weight, "text_id").groupBy("band").agg(F.max(F.struct("weight", "text_id", "n")).alias("p"))
    pivots = materialise(pivots.select("band", F.col("p.text_id").alias("a"), F.col("p.n").alias("n_a"), "p.weight"), "pivots")
    comparable = F.least("n", "n_a") >= similarity * F.greatest("n", "n_a")
    pairs = (shared.join(pivots, "band").where((F.col("a") != F.col("text_id")) & comparable)
             .select("a", F.col("text_id").alias("b"), "weight").distinct())
    pairs = materialise(pairs, "star-pairs")

    def runs_of(ids: DataFrame, most: int) -> DataFrame:
        # one row of each text is enough; the filter knows rows by id and text
        wanted = ids.distinct().join(distinct.select("text_id", "doc_id"), "text_id")
        keyed = texts.withColumn("row", F.xxhash64("doc_id", "text_id"))
        known = KeyFilter.of(wanted.select(F.xxhash64("doc_id", "text_id").alias("row")), "row", filter_bits, most)
        return materialise(_runs_of(keyed, known, size).dropDuplicates(["text_id"]), "runs")

    def ends(some: DataFrame) -> DataFrame:
        return some.select(F.col("a").alias("text_id")).union(some.select("b"))

    links = materialise(_verified(pairs, runs_of(ends(pairs), 2 * pairs.count()), similarity), "star-links")
    # what is known to be linked: each text with the heaviest pivot that it is linked to
    heavy = links.join(pairs, ["a", "b"]).groupBy("b").agg(F.max(F.struct("weight", "a"))["a"].alias("pivot"))
    members = shared.join(heavy.withColumnRenamed("b", "text_id"), "text_id", "left").select(
        "band", "text_id", "n", F.coalesce("pivot", "text_id").alias("class"))
    members = materialise(members, "members")
    # texts of one bucket may share a template and little else, so those of mixed buckets are dealt again, by rare runs
    bands_left = members.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("band")
    some = materialise(members.join(bands_left, "band").select("text_id", "n", "class").distinct(), "mixed-texts")
    some_runs = runs_of(some.select("text_id"), some.count())
    members = materialise(_by_rare_runs(some, some_runs, similarity), "rare-members")
    mixed = (members.groupBy("band", "class").agg(F.count("*").alias("n"))
             .groupBy("band").agg(F.count("*").alias("classes"), F.sum("n").alias("total"), F.max("n").alias("most"),
                                  F.max_by("class", F.struct("n", "class")).alias("largest")).where("classes > 1"))
    blocks_of = materialise(mixed.select(
        "band", "largest", F.ceil(F.col("total") / block).cast("int").alias("n_blocks"),
        F.ceil((F.col("total") - F.col("most")) / block).cast("int").alias("n_outside_blocks")), "mixed-buckets")
    spread, signature = _spread(members, blocks_of), distinct.select("text_id", "signature")
    found = materialise(_cross_pairs(spread.join(signature, "text_id"), k, similarity, dense), "cross-pairs")
    more, crowded = found.where("a is not null").select("a", "b"), found.where("a is null").select("band", "i", "j")
    in_dense = None
    if not crowded.isEmpty():
        in_dense = materialise(spread.join(crowded, ["band", "i", "j"], "left_semi"), "dense-members")
    more_links = _verified(more, some_runs, similarity)
    if in_dense is not None:
        more_links = more_links.unionByName(
            _dense_links(in_dense.join(signature, "text_id").join(some_runs, "text_id"), k, similarity))
    final = components(links.unionByName(more_links))
    rooted = (sketches.select("doc_id", "text_id")
              .join(final.select(F.col("node").alias("text_id"), "root"), "text_id", "left")
              .select("doc_id", "text_id", F.coalesce("root", "text_id").alias("root")))
    rooted = materialise(rooted, "rooted")
    names = materialise(rooted.groupBy("root").agg(F.min("doc_id").alias("class_id")), "class-names")
    alone = texts.where("text is null").select("doc_id", "text_id", F.col("doc_id").alias("class_id"))
    return rooted.join(names, "root").select("doc_id", "text_id", "class_id").unionByName(alone)


def keep_one_of_each(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without near duplicates: of each class the row with the least doc_id stays.

    Of rows with that doc_id in one class, the one with the least text hash stays; repeated rows count as one.
    """
    name, kept, of = (free_name(docs, c) for c in ("text_id", "kept_text", "kept_class"))
    ids = content_ids(docs, [text])
    classes = near_duplicate_classes(docs, text, ids=ids, **options).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    firsts = classes.groupBy("class_id").agg(F.min("text_id").alias("text_id"))
    # a class without any doc_id, such as a null text of its own, is named null
    firsts = firsts.where("class_id is not null").unionByName(
        classes.where("class_id is null").select("class_id", "text_id").distinct()).toDF(of, kept)
    marked = docs.withColumn(name, ids).join(firsts, F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(name) == F.col(kept)), "left_semi")
    return marked.dropDuplicates(["doc_id", name]).drop(name)
