"""Writers: tables, CSV with the published headers, several outputs of one plan, models, metrics."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .readers import LATIN1
from .schemas import Field


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, layout: list[Field] | None = None, sep: str = ",",
              encoding: str = LATIN1) -> None:
    """CSV folder with header; ``layout`` puts the published headers on the known columns."""
    if layout is not None:
        df = df.withColumnsRenamed({f.name: f.published for f in layout})
    df.write.mode("overwrite").options(header=True, sep=sep, encoding=encoding).csv(path)


def write_outputs(df: DataFrame, outputs: dict[str, tuple[str, object]],
                  layout: list[Field] | None = None) -> None:
    """Write several filtered views of one plan: ``{name: (path, condition)}``.

    The plan is computed once into the shared folder; each output is then a filtered copy of it.
    With a layout the outputs are CSV files with its columns only.
    """
    once = materialise(df, "outputs")
    for path, condition in outputs.values():
        part = once.filter(condition)
        if layout is not None:
            write_csv(part.select(*[f.name for f in layout]), path, layout)
        else:
            write_table(part, path)


def save_model(model: PipelineModel, base: str, version: str) -> str:
    """Save below ``base`` under the version; returns the path for ``load_model``."""
    path = f"{base.rstrip('/')}/{version}"
    model.write().overwrite().save(path)
    return path


def append_metrics(metrics: DataFrame, path: str, experiment: str) -> None:
    """Append a long metrics frame, one folder per experiment."""
    (metrics.withColumn("experiment", F.lit(experiment))
     .write.mode("append").partitionBy("experiment").parquet(path))
