"""Column functions on dates. Nothing here reads the clock; the process date is an argument."""

from __future__ import annotations

import calendar
import datetime as dt
import re

from pyspark.sql import Column, functions as F

# Date layouts per source, tried in this order.
ISO_DATE = "yyyy-M-d[ H:m[:s]]"
DAY_FIRST = (ISO_DATE, "d/M/yyyy[ H:m[:s]]")
MONTH_FIRST = (ISO_DATE, "M/d/yyyy[ H:m[:s]]", "d/M/yyyy[ H:m[:s]]")


# What a date part may look like; a layout is only tried on text of its shape.
PARTS = {"yyyy": "[0-9]{4}", "M": "(?:0?[1-9]|1[0-2])", "d": "(?:0?[1-9]|[12][0-9]|3[01])",
         "H": "[0-9]{1,2}", "m": "[0-9]{1,2}", "s": "[0-9]{1,2}", "[": "(?:", "]": ")?"}


def shape(layout: str) -> str:
    """Regular expression for texts that may fit the layout."""
    pieces = re.findall(r"y+|[A-Za-z]|.", layout)
    return "^" + "".join(PARTS.get(p) or re.escape(p) for p in pieces) + "$"


def tolerant_date(col: Column, formats: tuple[str, ...] = DAY_FIRST) -> Column:
    """First layout that fits; null where none does.

    A failed parse is far dearer than a match, so the shape decides which layouts are tried.
    """
    trimmed = F.trim(col)
    return F.coalesce(*[F.when(trimmed.rlike(shape(f)), F.try_to_timestamp(trimmed, F.lit(f)).cast("date"))
                        for f in formats])


def days_before(as_of: dt.date, days: int = 90) -> Column:
    return F.date_sub(F.lit(as_of), days)


def quarter_start_cutoff(as_of: dt.date, days: int = 90) -> Column:
    """First day of the month three months back, less ``days``."""
    return F.date_sub(F.add_months(F.trunc(F.lit(as_of), "MM"), -3), days)


def years_since(col: Column, as_of: dt.date) -> Column:
    return F.lit(as_of.year) - F.year(col)


def in_year(col: Column, year: int) -> Column:
    """The same day and month in another year; null for 29 February in a common year."""
    leap_day = (F.month(col) == 2) & (F.day(col) == 29)
    moved = F.make_date(F.lit(year), F.month(col), F.day(col))
    return moved if calendar.isleap(year) else F.when(~leap_day, moved)
