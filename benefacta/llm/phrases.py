"""Substring dedup with repeated-phrase automata.

1. *Candidates.* In each window of ``size`` words the smallest hashed run of ``anchor`` words, the leftmost of
   equals, is its anchor. Equal windows have equal anchors, so only windows whose anchor occurs at two places or
   more can be repeated. Anchors are counted over the corpus; those met twice form a Bloom filter of bounded
   size (a full filter costs work and loses nothing).
2. *Confirm.* Windows with such an anchor are counted by their hash; those found twice are confirmed, and one document
   that holds a window owns it. Owners give the words: each stretch of confirmed windows with one anchor is a passage, kept once.
3. *Compile.* Passages are dealt to shards by their anchor, ``shard_bytes`` of text each; an anchor with more passages than that
   takes several shards. A shard is an Aho-Corasick automaton of the words of its anchors, with the windows of its passages.
4. *Stream.* All documents are read again; each stretch of a document goes to the shards that hold its anchor, and runs through
   the automaton there. Where that finds an anchor, the windows around it are compared with those of the passages, word by word. What the
   shards find, and nothing else, says which words go. A shard that much text is sent to is split into groups of ``group_stretches``,
   each with the same automaton, so a passage in a third of all documents is no large task.

Words are separated by blanks, tabs and line ends and compared unchanged. Rows are keyed by hashes
of id and text (``content_ids``), so rows with one id are kept apart, and fully repeated rows are two documents that repeat each other. A
null or empty text has no words; texts shorter than a window keep all words. All counting is by partial aggregation. The driver
holds two numbers for each shard.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .frames import KeyFilter, add_columns, content_ids, free_name
from .textarrays import blocks, find_words, gram_hashes, mix, signed, word_hashes

WORDS = 35
ANCHOR = 12
SHARD_BYTES = 1 << 20
GROUP_STRETCHES = 25_000
_PLACE = np.uint64((1 << 20) - 1)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(values) - width + 1], out[width - span:])


def _windows(words, size: int, anchor: int):
    """Start words of all windows, their hashes, and the hash and place of their anchors."""
    hashes = word_hashes(words)
    if len(hashes) < size:
        none = np.empty(0, np.uint64)
        return np.empty(0, np.int64), none, none, np.empty(0, np.int64)
    grams = gram_hashes(hashes, anchor)
    starts = np.flatnonzero(words.left()[:len(hashes) - size + 1] >= size)
    place = np.empty(len(hashes) - size + 1, np.int64)
    width, step = size - anchor + 1, 1 << 19
    for low in range(0, len(place), step):  # places fit the low bits of the compared keys
        piece = grams[low:low + step + width - 1]
        keys = (piece & ~_PLACE) | np.arange(len(piece), dtype=np.uint64)
        smallest = _sliding_min(keys, width)
        place[low:low + step] = (smallest & _PLACE).astype(np.int64)[:step] + low
    place = place[starts]
    return starts, gram_hashes(hashes, size)[starts], grams[place], place


def _anchors(rows: DataFrame, size: int, anchor: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for _, data, offsets in blocks(batch, "text"):
                _, _, keys, place = _windows(find_words(data, offsets), size, anchor)
                fresh = np.ones(len(place), bool)
                fresh[1:] = place[1:] != place[:-1]
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys[fresh]))], names=["anchor"])

    return rows.select("text").mapInArrow(run, "anchor long")


def _candidates(rows: DataFrame, size: int, anchor: int, known: KeyFilter) -> DataFrame:
    """Hash of each window whose anchor ``known`` lets pass, with the code of its document."""
    shipped = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                words = find_words(data, offsets)
                starts, windows, anchors, _ = _windows(words, size, anchor)
                keep = shipped.value(anchors)
                of = words.text_of[starts[keep]] if len(starts) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signed(windows[keep])), part.column(0).take(pa.array(of))], names=["window", "code"])

    return rows.select("code", "text").mapInArrow(run, "window long, code int")


def _stretches(starts: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of neighbouring windows with their anchor at the same place."""
    if not len(starts):
        return starts, starts
    new = np.flatnonzero((np.diff(starts) > 1) | (np.diff(place) != 0)) + 1
    return np.append(0, new), np.append(new - 1, len(starts) - 1)


def _split(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Words of all texts, one after another."""
    return [w for a, b in zip(offsets[:-1], offsets[1:]) for w in data[a:b].tobytes().split()]


def _passages(rows: DataFrame, confirmed: DataFrame, size: int, anchor: int) -> DataFrame:
    """Distinct passages: hash of the anchor, the word it begins at, and the words, taken from the owners."""
    key = F.xxhash64("code")
    owners = confirmed.groupBy("code").agg(F.collect_list("window").alias("windows"))
    shipped = rows.sparkSession.sparkContext.broadcast(KeyFilter.of(confirmed.select(key.alias("key")).distinct(), "key"))

    def owning(batches):
        for batch in batches:
            yield batch.filter(pa.array(shipped.value(batch.column(2).to_numpy().view(np.uint64))))

    def run(batches):
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                words = find_words(data, offsets)
                starts, windows, anchors, place = _windows(words, size, anchor)
                of, keep = words.text_of[starts] if len(starts) else starts, np.zeros(len(starts), bool)
                for text, owned in enumerate(part.column(1)):
                    low, high = np.searchsorted(of, [text, text + 1])
                    keep[low:high] = np.isin(signed(windows[low:high]), owned.values.to_numpy())
                starts, anchors, place = starts[keep], anchors[keep], place[keep]
                first, last = _stretches(starts, place)
                split = _split(data, offsets)
                yield pa.RecordBatch.from_arrays([
                    pa.array(signed(anchors[first])), pa.array((place[first] - starts[first]).astype(np.int32)),
                    pa.array([b" ".join(split[a:b + size]) for a, b in zip(starts[first].tolist(), starts[last].tolist())], pa.binary())],
                    names=["anchor", "at", "words"])

    texts = rows.select("code", "text", key.alias("key")).mapInArrow(owning, "code int, text string, key long")
    return (texts.join(owners, "code").select("text", "windows")
            .mapInArrow(run, "anchor long, at int, words binary").distinct())


@dataclass
class Shards:
    """Where passages and stretches go: an anchor to one shard (or, if ``wide``, to several in a row), a shard to groups."""

    count: int
    wide: dict[int, int]  # shards of anchors that take more than one
    groups: np.ndarray  # of each shard
    anchors: KeyFilter

    @classmethod
    def plan(cls, passages: DataFrame, counts: DataFrame, shard_bytes: int, group_stretches: int) -> Shards:
        """From the passages and the number of places of each anchor."""
        of = passages.groupBy("anchor").agg(F.sum(F.length("words")).alias("bytes")).join(counts, "anchor")
        count = max(1, -(-(of.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes))
        wide = {r["anchor"]: (-(-r["bytes"] // shard_bytes), r["count"]) for r in of.where(F.col("bytes") > shard_bytes).collect()}
        places = np.zeros(count, np.int64)
        for r in of.groupBy(cls.first(count).alias("shard")).agg(F.sum("count").alias("places")).collect():
            places[r["shard"]] = r["places"]
        for key, (shards, n) in wide.items():  # the first one is counted above
            places[[(key % count + i) % count for i in range(1, shards)]] += n
        return cls(count, {k: n for k, (n, _) in wide.items()}, np.maximum(1, -(-places // group_stretches)),
                   KeyFilter.of(of.select("anchor"), "anchor"))

    @staticmethod
    def first(count: int):
        return F.pmod("anchor", F.lit(count)).cast("int")

    def dealt(self, passages: DataFrame) -> DataFrame:
        """Each passage once for each group of its shard."""
        starts = np.cumsum(self.groups) - self.groups
        table = passages.sparkSession.createDataFrame(
            [(i, int(s), int(s + n - 1)) for i, (s, n) in enumerate(zip(starts, self.groups))], "shard int, low int, high int")
        shard = self.first(self.count)
        if self.wide:  # fewer than there are shards
            wide = passages.sparkSession.createDataFrame(list(self.wide.items()), "anchor long, more int")
            passages = passages.join(F.broadcast(wide), "anchor", "left")
            more = F.coalesce("more", F.lit(1))
            shard = F.pmod(shard + F.pmod(F.xxhash64("words"), more), F.lit(self.count)).cast("int")
        return (passages.withColumn("shard", shard).join(F.broadcast(table), "shard")
                .select(F.explode(F.sequence("low", "high")).alias("group"), "at", "words"))

    def groups_of(self, anchors: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of stretches (one with a wide anchor occurs several times) and the group each goes to."""
        number, keys = np.arange(len(anchors)), signed(anchors)
        shard = np.mod(keys, self.count)
        many = [(i, j) for i in np.flatnonzero(np.isin(keys, list(self.wide))) for j in range(1, self.wide[int(keys[i])])] if self.wide else []
        if many:
            again, step = np.array(many).T
            number, shard = np.append(number, again), np.append(shard, (shard[again] + step) % self.count)
        groups = self.groups[shard]
        return number, (np.cumsum(self.groups) - self.groups)[shard] + (salt[number] % groups.astype(np.uint64)).astype(np.int64)


def _sent(rows: DataFrame, shards: Shards, size: int, anchor: int) -> DataFrame:
    """Stretches of all documents with an anchor that a shard may hold: group, row, number of the first word, and words."""
    shipped = rows.sparkSession.sparkContext.broadcast(shards)

    def run(batches):
        shards = shipped.value
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                words = find_words(data, offsets)
                starts, _, anchors, place = _windows(words, size, anchor)
                keep = shards.anchors(anchors)
                if not keep.any():
                    continue
                starts, anchors, place = starts[keep], anchors[keep], place[keep]
                first, last = _stretches(starts, place)
                low, high, of = starts[first], starts[last] + size, words.text_of[starts[first]]
                row = part.column(0).to_numpy()[of]
                number, group = shards.groups_of(anchors[first], mix(row.view(np.uint64) + place[first].astype(np.uint64)))
                split = _split(data, offsets)
                yield pa.RecordBatch.from_arrays([
                    pa.array(group.astype(np.int32)), pa.array(row[number]), pa.array((low - words.first[of])[number].astype(np.int32)),
                    pa.array([b" ".join(split[a:b]) for a, b in zip(low[number].tolist(), high[number].tolist())], pa.binary())],
                    names=["group", "row", "first", "words"])

    return rows.select("row", "text").mapInArrow(run, "group int, row long, first int, words binary")


class Automaton:
    """Aho-Corasick automaton of the anchors of some passages, and the windows of those passages."""

    def __init__(self, passages, size: int, anchor: int):
        self.size, self.anchor, self.windows = size, anchor, set()
        self.automaton = ahocorasick.Automaton()
        for at, passage in passages:
            words = passage.split(b" ")
            key = b" %b " % b" ".join(words[at:at + anchor])
            self.automaton.add_word(key.decode("latin-1"), len(key))
            self.windows.update(b" ".join(words[i:i + size]) for i in range(len(words) - size + 1))
        if len(self.automaton):
            self.automaton.make_automaton()

    def locate(self, text: bytes) -> list[tuple[int, int]]:
        """Ranges of words that windows of the passages cover; ``text`` has one blank between words."""
        out: list[tuple[int, int]] = []
        if not len(self.automaton):
            return out
        stream, words, unseen = b" %b " % text, text.split(b" "), 0
        for end, length in self.automaton.iter(stream.decode("latin-1")):
            at = stream.count(b" ", 0, end + 2 - length) - 1
            for start in range(max(unseen, at + self.anchor - self.size), min(at, len(words) - self.size) + 1):
                if b" ".join(words[start:start + self.size]) in self.windows:
                    if out and start <= out[-1][1]:
                        out[-1] = out[-1][0], start + self.size
                    else:
                        out.append((start, start + self.size))
            unseen = max(unseen, at + 1)
        return out


def _located(sent: DataFrame, passages: DataFrame, size: int, anchor: int) -> DataFrame:
    """Ranges of words that the shards find, by row: number of the first word, and of the one behind the last."""
    schema = pa.schema([("row", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])

    def run(stretches: pa.Table, held: pa.Table) -> pa.Table:
        automaton = Automaton(zip(held.column("at").to_pylist(), held.column("words").to_pylist()), size, anchor)
        texts = stretches.column("words").to_pylist()
        ranges = {words: automaton.locate(words) for words in set(texts)}  # copies of a stretch have the same ranges
        found = [(row, first + low, first + high)
                 for row, first, words in zip(stretches.column("row").to_pylist(), stretches.column("first").to_pylist(), texts)
                 for low, high in ranges[words]]
        return pa.Table.from_arrays([pa.array([f[i] for f in found], schema.field(i).type) for i in range(3)], schema=schema)

    return sent.groupBy("group").cogroup(passages.groupBy("group")).applyInArrow(run, "row long, low int, high int")


def _kept(batch: pa.RecordBatch, place: int):
    """Number of words of each text, of those in its ranges (the last column), and the others joined by blanks."""
    for part, data, offsets in blocks(batch, batch.schema.names[place]):
        counts, removed, kept = [], [], []
        for text, (a, b) in zip(part.column(part.num_columns - 1), zip(offsets[:-1], offsets[1:])):
            words = rest = data[a:b].tobytes().split()
            if text.is_valid:
                low, high = (text.values.field(i).to_numpy() for i in range(2))
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, low, 1)
                np.add.at(change, high, -1)
                rest = list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))
            counts.append(len(words))
            removed.append(len(words) - len(rest))
            kept.append(b" ".join(rest))
        yield part, counts, removed, kept


def remove_repeated_passages(docs: DataFrame, text: str = "text", size: int = WORDS, anchor: int = ANCHOR,
                             filter_bits: int | None = None, digest: bool = False, shard_bytes: int = SHARD_BYTES,
                             group_stretches: int = GROUP_STRETCHES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``, or with ``digest`` its SHA-256 ``kept_sha256``.

    Result names that the input has already get underscores.
    """
    if not 0 < anchor <= size:
        raise ValueError("an anchor has from 1 word to a window's words")
    names = [free_name(docs, x) for x in ("n_words", "n_removed", "kept_sha256" if digest else "kept_text")]
    key = content_ids(docs, [c for c in docs.columns if c in ("doc_id", text)])
    rows = docs.select(key.alias("row"), F.col(text).alias("text")).withColumn("code", F.col("row").bitwiseAND(2**31 - 1).cast("int"))
    anchors = materialise(_anchors(rows, size, anchor).groupBy("anchor").count().where("count > 1"), "repeated-anchors")
    candidates = _candidates(rows, size, anchor, KeyFilter.of(anchors, "anchor", filter_bits))
    confirmed = materialise(candidates.groupBy("window").agg(F.count("*").alias("n"), F.min("code").alias("code"))
                            .where("n > 1").select("window", "code"), "phrases")
    passages = materialise(_passages(rows, confirmed, size, anchor), "passages")
    shards = Shards.plan(passages, anchors, shard_bytes, group_stretches)
    found = _located(_sent(rows, shards, size, anchor), shards.dealt(passages), size, anchor)
    ranges = found.groupBy("row").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))  # equal rows once
    row, listed = free_name(docs, "row"), free_name(docs, "ranges")
    joined = docs.withColumn(row, key).join(ranges.toDF(row, listed), row, "left").select(*docs.columns, listed)
    added = T.StructType([T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()),
                          T.StructField(names[2], T.StringType())])

    def work(batch, place):
        for part, counts, removed, kept in _kept(batch, place):
            yield part, [counts, removed, [hashlib.sha256(x).hexdigest() for x in kept] if digest
                         else [x.decode("utf-8") for x in kept]]

    return add_columns(joined, text, added, work).drop(listed)
