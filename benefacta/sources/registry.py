"""Named inputs: where a table lies and how it is read."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from . import readers, schemas


class Source(NamedTuple):
    path: str
    sep: str = ","
    layout: list | None = None
    file_format: str = "csv"


# Names of the client files below the data folder.
SOURCES = {
    "donors": Source("Archivos_Cliente/Base_donantes.csv", layout=schemas.DONORS),
    "donors_new": Source("Archivos_Cliente/Base_donantes_nuevos.csv"),
    "donors_age_errors": Source("Archivos_Cliente/Base_donantes_error_edades.csv"),
    "donors_clean": Source("Archivos_Cliente/Base_donantes_preprocesada.csv"),
    "donors_segmented": Source("Archivos_Cliente/Base_donantes_segmentada.csv"),
    "transactions": Source("Archivos_Cliente/Transacciones_Individuales.csv", sep=";",
                           layout=schemas.TRANSACTIONS),
    "transactions_clean": Source("Archivos_Cliente/Transacciones_Individuales_preprocesada.csv"),
    "cancellations": Source("Archivos_Cliente/Cancelaciones.csv", layout=schemas.CANCELLATIONS),
    "cancellations_clean": Source("Archivos_Cliente/Cancelaciones_preprocesada.csv"),
    "lifetime_value": Source("Archivos_Cliente/lfv.csv"),
    "inflation_yearly": Source("Informacion_Externa/inflacion_promedio_anual.csv"),
}


def register(name: str, source: Source) -> None:
    SOURCES[name] = source


def load(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Read a named input below ``root`` and expose it to SQL under the same name."""
    if name not in SOURCES:
        raise KeyError(f"unknown source {name!r}; known: {', '.join(sorted(SOURCES))}")
    source = SOURCES[name]
    path = f"{root.rstrip('/')}/{source.path}"
    if source.file_format == "csv":
        schema = schemas.raw_schema(source.layout) if source.layout else None
        df = readers.read_delimited(spark, path, schema, sep=source.sep)
    else:
        df = spark.read.format(source.file_format).load(path)
    df.createOrReplaceTempView(name)
    return df
