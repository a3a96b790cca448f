"""Cleaning steps for the client tables. Each step is a narrow projection or filter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, numbers, text
from ..sources.schemas import Field

# Words of the client files and the kinds of registry that are regular donations.
ERROR_TEXT = "Nº de error"
MORE_THAN_TEN = "mas de 10"
NO = "No"
YES_WORDS, NO_WORDS = ("si", "sí"), ("no",)
COLLECTED, LOST = "Cobrada", "Perdida"
REGULAR_KINDS = (
    "DI - Regular",
    "DI - Regular Montos Variables (BO)",
    "DI - Regular Tiempo determinado",
    "PF - Padrinazgo familiar",
    "PI - Padrinazgo individual",
)


def split_text_dates(df: DataFrame, column: str, pattern: str = "[A-Za-z]") -> tuple[DataFrame, DataFrame]:
    """``(kept, errors)``: errors hold letters where a date should be; null is kept."""
    bad = text.contains_letters(F.col(column), pattern)
    return df.filter(~bad), df.filter(bad)


def drop_sentinel(df: DataFrame, column: str, sentinel: str = ERROR_TEXT) -> DataFrame:
    """Drop rows that hold the sentinel; null stays."""
    return df.filter(~F.col(column).eqNullSafe(sentinel))


def split_active(df: DataFrame, column: str = "is_active") -> tuple[DataFrame, DataFrame]:
    """``(active, inactive)``."""
    return df.filter(F.col(column)), df.filter(~F.col(column))


def split_recent(df: DataFrame, column: str, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """``(older, newer)`` than the cut-off, both strict."""
    return df.filter(F.col(column) < cutoff), df.filter(F.col(column) > cutoff)


def recency_status(column: Column, cutoff: Column) -> Column:
    """Which side of the cut-off a row is on; covers the rows that ``split_recent`` leaves out."""
    return (F.when(column < cutoff, "ok").when(column > cutoff, "new")
            .when(column == cutoff, "cutoff").otherwise("no_capture_date"))


def in_age_range(df: DataFrame, column: str = "age") -> DataFrame:
    return df.filter(F.col(column).between(numbers.MIN_AGE, numbers.MAX_AGE))


def regular_donations(transactions: DataFrame, kinds: tuple[str, ...] = REGULAR_KINDS) -> DataFrame:
    return transactions.filter(F.col("record_type").isin(*kinds))


def collected_transactions(transactions: DataFrame, as_of: dt.date) -> DataFrame:
    """Collected transactions with month, year and years since then."""
    return (transactions.filter(F.col("stage") == COLLECTED)
            .withColumns({"tx_month": F.month("tx_date"), "tx_year": F.year("tx_date"),
                          "years_ago": dates.years_since(F.col("tx_date"), as_of)}))


def future_transactions(transactions: DataFrame, as_of: dt.date) -> DataFrame:
    return transactions.filter(F.col("tx_date") > F.lit(as_of))


def fix_ages(df: DataFrame, as_of: dt.date, trusted: Column | None = None) -> DataFrame:
    """Replace missing and impossible ages by the mean of the valid ones, cut to whole years.

    Rows that were replaced are flagged in ``age_was_error`` and get a birth date that fits the
    new age, if the frame has one. ``trusted`` limits the rows that count for the mean.
    """
    valid = numbers.valid_age(F.col("age"))
    counted = valid if trusted is None else valid & trusted
    mean = df.agg(F.floor(F.avg(F.when(counted, F.col("age")))).cast("int")).scalar()
    changes = {"age": F.when(valid, F.col("age")).otherwise(mean), "age_was_error": ~valid}
    if "birth_date" in df.columns:
        rebuilt = F.date_sub(F.lit(as_of), mean * 365)
        changes["birth_date"] = F.when(valid, F.col("birth_date")).otherwise(rebuilt)
    return df.withColumns(changes)


def children_count(children: Column, has_children: Column) -> Column:
    """Number of children from text; "none" if the donor says so; null if unknown."""
    return (F.when(has_children == NO, F.lit(0)).when(children == MORE_THAN_TEN, F.lit(10))
            .otherwise(numbers.whole(children)))


def has_children(children: Column) -> Column:
    return F.coalesce(children, F.lit(0)) > 0


def fill_defaults(df: DataFrame) -> DataFrame:
    """Null numbers become 0 and null flags false; text and dates stay null."""
    kinds = dict(df.dtypes)
    zeros = {c: 0 for c, kind in kinds.items()
             if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")}
    flags = {c: False for c, kind in kinds.items() if kind == "boolean"}
    fills = {**zeros, **flags}
    return df.fillna(fills) if fills else df


def flag(col: Column) -> Column:
    """Text or number to boolean; the Spanish words count as well."""
    word = F.lower(F.trim(col.cast("string")))
    spoken = F.when(word.isin(*YES_WORDS), True).when(word.isin(*NO_WORDS), False)
    return F.coalesce(col.try_cast("boolean"), spoken, col.try_cast("double") != 0)


def conform(df: DataFrame, layout: list[Field], date_formats: tuple[str, ...] = dates.DAY_FIRST) -> DataFrame:
    """Rename and cast every column of the layout in one projection; other columns are dropped."""
    casts = {
        "long": lambda c: c.try_cast("decimal(38,6)").try_cast("bigint"),
        "int": numbers.whole,
        "double": text.decimal_comma,
        "bool": flag,
        "string": lambda c: c,
        "date": lambda c: dates.tolerant_date(c, date_formats),
    }
    return df.select(*[casts[f.kind](F.col(f"`{f.raw}`")).alias(f.name) for f in layout])


def trim_newest(df: DataFrame, order: tuple[str, ...], start, horizon: int, window: int = 120) -> DataFrame:
    """Rows from ``start`` on, without the newest ``window - horizon``.

    Only that bounded number of rows is sorted out; the rest is compared with the oldest of them.
    """
    if horizon > window:
        raise ValueError("horizon must not exceed window")
    kept = df.filter(F.col(order[0]) >= F.lit(start))
    if horizon == window:
        return kept
    newest = kept.select(*order).orderBy(*[F.col(c).desc() for c in order]).limit(window - horizon)
    bound = newest.agg(F.min(F.struct(*order))).scalar()
    return kept.filter(F.struct(*order) < bound)
