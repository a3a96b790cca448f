"""Secret scan by ownership frequency, in column expressions only.

Detectors find candidate spans in whole texts. Three base kinds are always reported: ``assign`` (a value behind a
word such as password), ``access`` (cloud access keys) and ``hex`` (long hexadecimal runs). A fourth, ``token``, is any
long run of key characters that mixes digits, capitals and small letters.

The hash of each candidate's value is counted over the corpus by distinct repositories and distinct owners. A value that
``example_owners`` owners or more hold is a widely copied example; the others are specific to an owner. Of these, values of few
different characters and those with a placeholder's words are dull, the rest look live. Base spans stay in any case; a ``token``
span is reported only if its value looks live and no base span overlaps it.

Counting is by partial aggregation: (hash, owner, repository), then (hash, owner), then hash; a value in a third of all
documents is one row per task and owner. Verdicts return to documents by joins between stored tables, which adaptive
execution splits where a value is hot; only values of candidates travel, as hashes, never texts. A null text counts
as empty. Null owners and repositories are an owner and a repository of their own. Repeated rows are one document of one
repository. Places are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .frames import content_ids, free_name

EXAMPLE_OWNERS = 3
#: kind, pattern, group of the value, least characters of that group; in the order of reporting
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
TOKEN = ("token", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
TOKEN_LETTERS = 10
LIVE_LETTERS = 6
PLACEHOLDER = "(?i)example|sample|placeholder|changeme|dummy|your_|xxxx|0123456789|123456789|abcdefgh"
_SPAN = "struct<start:bigint,kind:int,end:bigint,hash:string,live:boolean>"


def spans(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Leftmost matches that do not overlap, as structs; those with a shorter ``group`` are dropped.

    The pieces between matches and the matches give the places: one pass over both, on texts with a match only.
    """
    none = F.array().cast(f"array<{_SPAN}>")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pieces = F.split(text, pattern, -1)
    rows = F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), value.alias("value"))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found"))

    def step(held, row):
        start = held["at"] + F.length(row["piece"])
        end = start + F.coalesce(F.length(row["whole"]), F.lit(0))
        live = (F.size(F.array_distinct(F.split(row["value"], ""))) >= LIVE_LETTERS) & ~row["value"].rlike(PLACEHOLDER)
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                        F.sha2(row["value"], 256).alias("hash"), live.alias("live"))
        found = F.when(F.length(row["value"]) >= least, F.array_append(held["found"], span)).otherwise(held["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.when(text.rlike(pattern), F.aggregate(rows, zero, step, lambda held: held["found"])).otherwise(none)


def _mixed(text: Column, span: Column) -> Column:
    value = F.substring(text, (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
    return (value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= TOKEN_LETTERS))


def candidate_spans(docs: DataFrame, text: str, owner: str, repository: str, key: Column) -> DataFrame:
    """``row``, ``owner``, ``repository``, ``base`` and ``tokens`` spans of every row."""
    content = F.coalesce(F.col(text), F.lit(""))
    base = F.array_sort(F.concat(*[spans(content, p, group, least, i) for i, (_, p, group, least) in enumerate(BASE)]))
    found = docs.select(key.alias("row"), F.col(owner).alias("owner"), F.col(repository).alias("repository"),
                        content.alias("text"), base.alias("base"))
    free = F.filter(spans(F.col("text"), *TOKEN[1:], len(BASE)), lambda s: _mixed(F.col("text"), s) & ~F.exists(
        F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.select("row", "owner", "repository", "base", free.alias("tokens"))


def ownership(candidates: DataFrame) -> DataFrame:
    """``hash``, ``n_owners`` and ``n_repositories`` of every candidate value."""
    each = candidates.select("owner", "repository", F.explode(F.array_distinct(F.transform(
        F.concat("base", "tokens"), lambda s: s["hash"]))).alias("hash"))
    return (each.distinct().groupBy("hash", "owner").agg(F.count("*").alias("n"))
            .groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories")))


def scan(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id",
         example_owners: int = EXAMPLE_OWNERS) -> tuple[DataFrame, DataFrame, Column]:
    """Candidates of every row with ``examples`` (their widely copied hashes), the ownership table, and the row key.

    Rows with equal key are repeated rows.
    """
    key = content_ids(docs, [c for c in dict.fromkeys(("doc_id", text, owner, repository)) if c in docs.columns])
    candidates = materialise(candidate_spans(docs, text, owner, repository, key), "secret-candidates")
    owned = materialise(ownership(candidates), "secret-owners")
    copied = owned.where(F.col("n_owners") >= example_owners).select("hash")
    hashes = candidates.where((F.size("base") > 0) | (F.size("tokens") > 0)).select(
        "row", F.explode(F.array_distinct(F.transform(F.concat("base", "tokens"), lambda s: s["hash"]))).alias("hash"))
    # stored apart, so that adaptive execution can split a hot hash in the join
    examples = hashes.distinct().join(materialise(copied, "secret-examples"), "hash").groupBy("row").agg(
        F.collect_set("hash").alias("examples"))
    return candidates.join(examples, "row", "left").withColumn(
        "examples", F.coalesce("examples", F.array().cast("array<string>"))), owned, key


def reported(base: Column, tokens: Column, examples: Column) -> Column:
    """All reported spans: base ones, and tokens that look live."""
    return F.array_sort(F.concat(base, F.filter(tokens, looks_live(examples))))


def looks_live(examples: Column):
    """Test of a span: not widely copied, and no placeholder."""
    return lambda s: s["live"] & ~F.array_contains(examples, s["hash"])


def as_text(found: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k, *_ in BASE], F.lit(TOKEN[0]))
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: counts, digest and places of its secrets, and how many look live, are widely copied, or are dull."""
    found, _, key = scan(docs, **options)
    ids = docs.select("doc_id", key.alias("row"))
    base = F.col("base")

    def count(spans_, test):
        return F.size(F.filter(spans_, test)).cast("long")

    def of_kind(i):
        return count(base, lambda s: s["kind"] == i)

    every = reported(base, F.col("tokens"), F.col("examples"))
    result = found.withColumn("every", every).select(
        "row", *[of_kind(i).alias(f"n_{k}") for i, (k, *_) in enumerate(BASE)],
        F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("every")).alias("spans"),
        count(F.col("every"), looks_live(F.col("examples"))).alias("n_live"),
        count(F.col("every"), lambda s: F.array_contains(F.col("examples"), s["hash"])).alias("n_example"),
        count(F.col("every"), lambda s: ~s["live"] & ~F.array_contains(F.col("examples"), s["hash"])).alias("n_dull"))
    return ids.join(result.dropDuplicates(["row"]), "row").drop("row")


def redact(docs: DataFrame, text: str = "text", replacement: str = "[secret]", **options) -> DataFrame:
    """``docs`` with every span that looks live replaced in its text; examples and dull values stay, and so do all rows.

    ``n_chars``, if there, follows the changed texts.
    """
    found, _, key = scan(docs, text=text, **options)
    row, live = free_name(docs, "row"), free_name(docs, "live_spans")
    wanted = F.filter(reported(F.col("base"), F.col("tokens"), F.col("examples")), looks_live(F.col("examples")))
    marked = found.select(F.col("row").alias(row), wanted.alias(live)).where(F.size(live) > 0).dropDuplicates([row])
    zero = F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at"))

    def cut(held, span):
        fresh = span["start"] >= held["at"]
        piece = F.substring(F.col(text), (held["at"] + 1).cast("int"), F.greatest(span["start"] - held["at"], F.lit(0)).cast("int"))
        return F.struct(F.when(fresh, F.concat(held["kept"], piece, F.lit(replacement))).otherwise(held["kept"]).alias("kept"),
                        F.greatest(held["at"], span["end"]).alias("at"))

    def rest(held):
        return F.concat(held["kept"], F.substring(F.col(text), (held["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    spans_ = F.col(live)
    joined = docs.withColumn(row, key).join(marked, row, "left")
    cleaned = joined.withColumn(text, F.when(spans_.isNull(), F.col(text)).otherwise(F.aggregate(spans_, zero, cut, rest)))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(spans_.isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long")))
    return cleaned.select(*docs.columns)
