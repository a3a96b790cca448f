"""Scans: delimited client files, the inflation export, request batches and trained models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import schemas

LATIN1 = "ISO-8859-1"


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   sep: str = ",", encoding: str = LATIN1) -> DataFrame:
    """Delimited text with a header line. Without a schema every column is text."""
    reader = spark.read.options(header=True, sep=sep, encoding=encoding)
    if schema is not None:
        reader = reader.schema(schema).options(enforceSchema=False)
    return reader.csv(path)


def read_dataset(spark: SparkSession, folder: str, file_name: str) -> DataFrame:
    """A training or test file of the data folder, in UTF-8."""
    return read_delimited(spark, f"{folder.rstrip('/')}/{file_name}", encoding="UTF-8")


def read_inflation_export(spark: SparkSession, path: str, sep: str = ";",
                          encoding: str = LATIN1) -> DataFrame:
    """Monthly inflation (period ``yyyymm``, percent) from a CSV export of the statistics sheet.

    Title lines above the header and footnotes below the data are recognised by content, so the
    file can be split between tasks and their number does not matter.
    """
    columns = T.StructType([T.StructField("period", T.StringType()), T.StructField("pct", T.StringType())])
    lines = spark.read.schema(columns).options(sep=sep, encoding=encoding).csv(path)
    pct = F.replace(F.trim("pct"), F.lit(","), F.lit(".")).try_cast("double")
    return (lines.select(F.trim("period").alias("period"), pct.alias("pct"))
            .filter(F.col("period").rlike("^[0-9]{6}$")))


def read_yearly_inflation(spark: SparkSession, path: str, encoding: str = LATIN1) -> DataFrame:
    """The yearly dimension written by an earlier run: ``anio`` and the rate as a fraction."""
    table = read_delimited(spark, path, encoding=encoding)
    return table.select(F.col("anio").try_cast("int").alias("year"),
                        F.col(f"`{schemas.INFLATION_RATE}`").try_cast("double").alias("rate"))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, each one request body; gives a ``body`` text column for ``parse_requests``."""
    return spark.read.text(path).withColumnRenamed("value", "body")


def parse_requests(bodies: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record of the ``inputs`` list; fields stay text until they are validated."""
    parsed = bodies.select(*keep, F.from_json(body, schemas.REQUEST_BODY).alias("parsed"))
    records = parsed.select(*keep, F.posexplode("parsed.inputs").alias("position", "record"))
    return records.select(
        *keep, "position",
        F.col("record.Churn").alias("churn"),
        F.col("record.DLTV").alias("dltv"),
        F.col("record.Efectividad_cobro").alias("effectiveness"),
    )


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
