"""Segment codes and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Segment codes and the labels used around them.
SEGMENTS = {0: "Hibernando", 1: "Comprometidos", 2: "En riesgo", 3: "Campeones", 4: "En fuga"}
UNASSIGNED = "No asignado"
NEW_DONOR = "Nuevo"
UNCLASSIFIED = "No se puede clasificar"


def mapped(col: Column, mapping: dict) -> Column:
    """Value of the mapping; null for anything it does not hold."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[col]


def map_columns(df: DataFrame, columns: list[str], mapping: dict) -> DataFrame:
    """Replace each named column by its mapped value."""
    if not isinstance(columns, list):
        raise ValueError("columns must be a list")
    return df.withColumns({c: mapped(F.col(c), mapping) for c in columns})


def segment_label(code: Column) -> Column:
    return F.coalesce(mapped(code, SEGMENTS), F.lit(UNCLASSIFIED))
