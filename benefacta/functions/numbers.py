"""Column functions on numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Valid ages, age-band limits and labels, oldest age a donation plan may reach.
MIN_AGE, MAX_AGE = 18, 90
AGE_BANDS = [(30, "Adulto Joven"), (59, "Adulto"), (None, "Tercera Edad")]


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def money(col: Column) -> Column:
    """Exact cents, so that sums do not depend on the order of the rows."""
    return col.cast("decimal(18,2)")


def whole(col: Column) -> Column:
    """Text or number to int, cut towards zero; null where it is no number or too large."""
    return col.try_cast("double").try_cast("int")


def percent_to_fraction(col: Column, only_above_one: bool = False) -> Column:
    return F.when(col > 1, col / 100).otherwise(col) if only_above_one else col / 100


def valid_age(col: Column) -> Column:
    return F.coalesce(col.between(MIN_AGE, MAX_AGE), F.lit(False))


def age_band(col: Column) -> Column:
    out = None
    for limit, label in AGE_BANDS[:-1]:
        step = col < limit
        out = F.when(step, label) if out is None else out.when(step, label)
    return out.otherwise(AGE_BANDS[-1][1])


def age_band_rank(band: Column) -> Column:
    """Position of the band, for sorting."""
    pairs = [F.lit(x) for i, (_, label) in enumerate(AGE_BANDS) for x in (label, i)]
    return F.create_map(*pairs)[band]


def largest_risk(*cols: Column) -> Column:
    """Largest of the given values, nulls skipped; 0 if all are null."""
    return F.coalesce(F.greatest(*cols), F.lit(0.0))


def capped_lifespan(risk_percent: Column, age: Column) -> Column:
    """Expected years ``100 / risk``, but the donor does not pass the oldest age."""
    years = F.lit(100.0) / risk_percent
    return F.when(years + age > MAX_AGE, (F.lit(MAX_AGE) - age).cast("double")).otherwise(years)


def annuity_periods(lifespan: Column) -> Column:
    """Whole years paid: one if the lifespan is within a year of zero, none if below that."""
    return (F.when((lifespan > -1) & (lifespan < 1), F.lit(1))
            .when(lifespan >= 1, F.floor(lifespan).cast("int"))
            .when(lifespan <= -1, F.lit(0)))


def annuity_value(amount: Column, rate, periods: Column) -> Column:
    """Present value of ``amount`` paid at the end of each of ``periods`` years."""
    rate = as_column(rate)
    discounted = amount * (1 - F.pow(1 + rate, -periods)) / rate
    return F.when(rate == 0, amount * periods).otherwise(discounted)


def standardised(col: Column, mean, std) -> Column:
    """z-score; a constant column gives 0."""
    mean, std = as_column(mean), as_column(std)
    return F.when(std == 0, col * 0.0).otherwise((col - mean) / std)
