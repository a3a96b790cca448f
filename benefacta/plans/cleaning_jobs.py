"""The three cleaning jobs: raw text tables in, typed tables with a row status out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import dates, numbers, places, text
from ..operators import cleaning
from ..sources import schemas, sinks

DONOR_DATES = ("birth_date", "capture_date", "payment_anniversary")


def _raw_headers(layout) -> dict[str, str]:
    return {f.name: f.raw for f in layout}


def _text_in_dates(layout, columns):
    raw = _raw_headers(layout)
    bad = F.lit(False)
    for name in columns:
        bad = bad | text.contains_letters(F.col(f"`{raw[name]}`"))
    return bad


def clean_donors(raw: DataFrame, as_of: dt.date, recent_days: int = 90,
                 date_formats: tuple[str, ...] = dates.MONTH_FIRST) -> DataFrame:
    """Every donor row, typed and corrected, with ``row_status``.

    ``ok`` is the clean table, ``new`` the donors captured within ``recent_days``, ``cutoff`` those
    captured on the very day, ``no_capture_date`` and ``text_date`` (words in a date column) the
    rejected rows. ``age_was_error`` marks replaced ages.
    """
    header = _raw_headers(schemas.DONORS)
    children = cleaning.children_count(F.col(f"`{header['children']}`"), F.col(f"`{header['has_children']}`"))
    tagged = raw.withColumns({
        "_text_date": _text_in_dates(schemas.DONORS, DONOR_DATES),
        "_children": children.cast("string"),
    })
    layout = [f._replace(raw="_children") if f.name == "children" else f for f in schemas.DONORS]
    layout = layout + [schemas.Field("_text_date", "", "_text_date", "bool")]
    typed = cleaning.conform(tagged, layout, date_formats)
    aged = cleaning.fix_ages(typed, as_of, trusted=~F.col("_text_date"))
    placed = places.canonical_places(aged, {"city": places.CITY_RULES, "department": places.DEPARTMENT_RULES})
    filled = cleaning.fill_defaults(placed)
    status = cleaning.recency_status(F.col("capture_date"), dates.days_before(as_of, recent_days))
    return filled.withColumns({
        "has_children": cleaning.has_children(F.col("children")),
        "row_status": F.when(F.col("_text_date"), "text_date").otherwise(status),
    }).select(*[f.name for f in schemas.DONORS], "age_was_error", "row_status")


def accepted(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("row_status") == "ok")


def _with_date_status(raw: DataFrame, layout) -> DataFrame:
    """Every row, typed, with ``row_status``: ``ok``, or ``text_date`` for words in a date column (null there)."""
    columns = [f.name for f in layout if f.kind == "date"]
    tagged = raw.withColumn("_text_date", _text_in_dates(layout, columns))
    typed = cleaning.conform(tagged, [*layout, schemas.Field("_text_date", "", "_text_date", "bool")], dates.DAY_FIRST)
    return typed.withColumn("row_status", F.when(F.col("_text_date"), "text_date").otherwise("ok")).drop("_text_date")


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Every transaction, typed, with ``row_status``; dates are day first, amounts have a decimal comma."""
    return _with_date_status(raw, schemas.TRANSACTIONS)


def clean_cancellations(raw: DataFrame) -> DataFrame:
    """Every cancellation, typed, with ``row_status``."""
    return _with_date_status(raw, schemas.CANCELLATIONS)


def write_clean_donors(cleaned: DataFrame, good: str, new: str, age_errors: str) -> None:
    """The three outputs of the donor job, with the published headers."""
    status = F.col("row_status")
    sinks.write_outputs(cleaned, {
        "good": (good, status == "ok"),
        "new": (new, status == "new"),
        "age_errors": (age_errors, F.col("age_was_error") & (status != "text_date")),
    }, schemas.DONORS)


def prepare_exploration(donors: DataFrame, as_of: dt.date, anniversary_year: int) -> DataFrame:
    """Donor rules of the exploration: active adults captured before the quarter cut-off.

    ``donors`` has the conformed names with dates already parsed and ``children`` still text.
    """
    kept = cleaning.drop_sentinel(donors, "payment_anniversary")
    kept = cleaning.in_age_range(cleaning.split_active(kept)[0])
    number = F.when(F.col("children") == cleaning.MORE_THAN_TEN, 10).otherwise(numbers.whole(F.col("children")))
    anniversary = F.coalesce(dates.tolerant_date(F.col("payment_anniversary"), dates.MONTH_FIRST),
                             F.col("capture_date"))
    kept = kept.withColumns({
        "children": F.coalesce(number, F.lit(0)),
        "payment_anniversary": dates.in_year(anniversary, anniversary_year),
        "churn_prob": numbers.percent_to_fraction(F.col("churn_prob"), only_above_one=True),
        "lapsed_prob": numbers.percent_to_fraction(F.col("lapsed_prob"), only_above_one=True),
    }).withColumn("has_children", cleaning.has_children(F.col("children")))
    older, _ = cleaning.split_recent(kept, "capture_date", dates.quarter_start_cutoff(as_of))
    return older
