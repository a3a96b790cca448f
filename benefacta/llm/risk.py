"""Quality rules with risk-controlled thresholds, in column expressions only.

Each rule rejects a text whose measure exceeds a cutoff. Cutoffs are chosen per stratum on labelled rows, so that good texts
(label 1) are rejected at a limited rate: a cutoff passes if an exact binomial test rejects "its rate of false rejections
is above ``alpha``", that is, if P(Bin(n, alpha) <= k) <= delta / tests for k false rejections among n good texts. The
tests are the rules times the strata (Bonferroni); within a rule the cutoffs are tested from the mildest on, and the
first that fails ends the row (fixed sequence), which needs no further correction. With probability 1 - delta all cutoffs
chosen have a false rejection rate of at most ``alpha``; a stratum's rules together at most their number times that. Of
the cutoffs that pass, the one that rejects most bad texts (label 0) is taken, the mildest of equals. If none
passes, as in a stratum with few labels, the rule rejects nothing there.

All measures come from one pass over the text, within its row. Labels are joined by doc_id; of several labels the larger counts.
A null text has no words. A null stratum is a stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

ALPHA = 0.01
DELTA = 0.05
BLANK = r"[\x20\x09-\x0D]"
LEAST_WORDS = 10
REPEAT_PERCENT = 20
#: rule -> (numerator, denominator, cutoffs from mild to strict); a rule rejects if numerator > cutoff * denominator
RULES = {
    "symbols": ("n_symbols", "n_words", (2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1)),
    "repeated_words": ("n_repeat_words", "n_words", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "repeated_lines": ("n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "long_words": ("word_chars", "n_words", (20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.0)),
}


STRATA_TO_BROADCAST = 10_000
WINDOW = 5


def measures(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """``keep`` columns and the counts of every text; each step is one array expression of its row."""
    content = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(*keep, F.regexp_count(content, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                        F.array_remove(F.split(content, BLANK + "+"), "").alias("words"),
                        F.filter(F.split(content, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    hashed = split.select(
        *keep, "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    counts = [*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    h = F.col("hashes")
    runs = hashed.select(*counts, F.slice(F.transform(h, lambda x, i: F.xxhash64(
        x, *[F.get(h, i + k) for k in range(1, WINDOW)])), F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))).alias("runs"))
    r = F.col("runs")
    # only texts with a repeated run get their runs in order
    ordered = runs.select(*counts, F.when(F.size(F.array_distinct(r)) < F.size(r), F.sort_array(F.transform(
        r, lambda x, i: F.struct(x.alias("run"), i.alias("at"))))).alias("ordered"))
    o = F.col("ordered")
    again = F.filter(o, lambda x, i: F.coalesce(
        ((i > 0) & (F.get(o, i - 1)["run"] == x["run"])) | (F.get(o, i + 1)["run"] == x["run"]), F.lit(False)))
    places = F.sort_array(F.transform(again, lambda x: x["at"]))
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(places, zero, lambda held, at: F.struct(
        (held["sum"] + F.least(at - held["last"], F.lit(WINDOW))).alias("sum"), at.alias("last")), lambda held: held["sum"])
    return ordered.select(*counts, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def log_binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Logarithm of P(Bin(n, p) <= k); terms are summed from 0 up in logarithms, so none underflows."""
    first = n * F.log(F.lit(1 - p))
    odds = F.log(F.lit(p / (1 - p)))
    zero = F.struct(first.alias("term"), first.alias("sum"))

    def add(held, i):
        term = held["term"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("term"), (F.greatest(term, held["sum"]) + F.log1p(
            F.exp(-F.abs(term - held["sum"])))).alias("sum"))

    return F.when(k < 1, first).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), zero, add, lambda h: h["sum"]))


def choose_cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA, rules=RULES) -> DataFrame:
    """One row per stratum with the cutoff of each rule, null where none passes.

    ``labelled`` has ``stratum``, ``label`` and the measures. The counts of all cutoffs are one partial aggregate.
    """
    good, bad = F.col("label") == 1, F.col("label") == 0
    sums = [F.count_if(good).alias("n")]
    for rule, (over, under, cutoffs) in rules.items():
        for level, cutoff in enumerate(cutoffs):
            beyond = F.col(over) > cutoff * F.col(under)
            sums += [F.count_if(good & beyond).alias(f"{rule}_k{level}"), F.count_if(bad & beyond).alias(f"{rule}_b{level}")]
    counted = materialise(labelled.groupBy("stratum").agg(*sums), "cutoff-counts")
    tests = max(counted.count(), 1) * len(rules)
    rows = counted.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(level).alias("level"), F.lit(cutoff).alias("cutoff"),
                 F.col(f"{rule}_k{level}").alias("k"), F.col(f"{rule}_b{level}").alias("bad"))
        for rule, (_, _, cutoffs) in rules.items() for level, cutoff in enumerate(cutoffs)])).alias("t")).select("stratum", "n", "t.*")
    # a rate of alpha or more among the labels never passes, so the long sums are spared
    passes = F.when(F.col("k") >= alpha * F.col("n"), F.lit(False)).otherwise(
        log_binomial_tail(F.col("k"), F.col("n"), alpha) <= F.log(F.lit(delta) / tests))
    tested = rows.withColumn("passes", passes)
    so_far = Window.partitionBy("stratum", "rule").orderBy("level")
    allowed = tested.withColumn("failures", F.sum(F.when(F.col("passes"), 0).otherwise(1)).over(so_far)).where("failures = 0")
    best = allowed.groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct(F.col("bad"), -F.col("level"))).alias("cutoff"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cutoff_{r}") for r in rules])


def risk_controlled(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", label: str = "quality",
                    alpha: float = ALPHA, delta: float = DELTA, rules=RULES) -> tuple[DataFrame, DataFrame]:
    """Measures of every document with ``base_failed`` and ``kept``; and the cutoffs by stratum.

    The rules are calibrated on labelled documents that pass the base rules, which are those the rules judge.
    """
    measured = measures(docs.select("doc_id", F.col(stratum).alias("stratum"), F.col(text).alias("text")), "text", "doc_id", "stratum")
    measured = materialise(measured.withColumn("base_failed", base_failed()), "rule-measures")
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
    cutoffs = materialise(choose_cutoffs(measured.where(~F.col("base_failed")).join(known, "doc_id"), alpha, delta, rules), "cutoffs")
    named = cutoffs.withColumnRenamed("stratum", "of_stratum")
    if cutoffs.count() <= STRATA_TO_BROADCAST:
        named = F.broadcast(named)
    judged = measured.join(named, F.col("stratum").eqNullSafe(F.col("of_stratum")), "left")
    rejected = F.lit(False)
    for rule, (over, under, _) in rules.items():
        rejected = rejected | F.coalesce(F.col(over) > F.col(f"cutoff_{rule}") * F.col(under), F.lit(False))
    kept = ~F.col("base_failed") & ~rejected
    return judged.withColumn("kept", kept).select(*measured.columns, "kept"), cutoffs
