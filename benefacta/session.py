"""Session helpers and the shared folder used for anything that has to outlive an executor."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_cleaned: set[str] = set()


def local_session(app_name: str = "benefacta", cores: str = "*", shuffle_partitions: int = 8,
                  memory: str | None = None) -> SparkSession:
    """Session for tests and single-machine runs; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Root folder that every executor can reach: ``spark.checkpoint.dir``, else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session is gone; the folder carries the application's name
        pass


def application_folder(spark: SparkSession) -> str:
    """Folder of this application below the shared one; removed as a whole when the program ends."""
    folder = f"{shared_folder(spark)}/benefacta/{spark.sparkContext.applicationId}"
    if folder not in _cleaned:
        _cleaned.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A path below the application's folder that nothing else uses."""
    return f"{application_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Free a stored table that nothing reads any more, before the program ends."""
    _remove(spark, path)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and computes the frame once
    for several consumers.
    """
    path = fresh_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
