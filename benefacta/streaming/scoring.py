"""Scoring of records as they arrive: into one table, or into one for scores and one for rejected records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.scoring import REQUEST_TYPES, score_requests, validate


def start_scoring(requests: DataFrame, centroids: dict[int, tuple[float, ...]], output: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Score a streaming frame into a parquet folder. Stateless, so there is nothing to expire."""
    scored = score_requests(requests, centroids)
    return (scored.writeStream.format("parquet").outputMode("append")
            .option("path", output).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def write_batch(batch: DataFrame, batch_id: int, centroids: dict[int, tuple[float, ...]], output: str) -> None:
    """Scores of one batch below ``output/scores``, its rejected records below ``output/rejected``.

    Both go to a folder of the batch's number that replaces what is there, so a batch that is written again after a failure, be
    it between the two, leaves no row twice. Rejected records keep their text and list the fields in ``errors``.
    """
    batch = batch.persist()
    try:
        scored = score_requests(batch, centroids).where(F.size("errors") == 0).drop("errors")
        scored.write.mode("overwrite").parquet(f"{output}/scores/batch_id={batch_id}")
        texts = [c for c in REQUEST_TYPES if c in batch.columns]
        kept = batch.select("*", *[F.col(c).alias(f"_as_sent_{c}") for c in texts])
        rejected = validate(kept).where(F.size("errors") > 0).select(
            *[F.col(f"_as_sent_{c}").alias(c) if c in texts else F.col(c) for c in batch.columns], "errors")
        rejected.write.mode("overwrite").parquet(f"{output}/rejected/batch_id={batch_id}")
    finally:
        batch.unpersist()


def start_scoring_apart(requests: DataFrame, centroids: dict[int, tuple[float, ...]], output: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """One stream into two tables; the checkpoint names the batches, so each is written under the same number again."""
    return (requests.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, centroids, output))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def score_available_apart(spark: SparkSession, folder: str, file_glob: str, to_requests: Callable[[DataFrame], DataFrame],
                          centroids: dict[int, tuple[float, ...]], output: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """``(scores, rejected)`` after all parquet files present now; later calls with the checkpoint add the files since."""
    query = start_scoring_apart(to_requests(_arriving(spark, folder, file_glob)), centroids, output, checkpoint)
    query.awaitTermination()
    return tuple(spark.read.parquet(f"{output}/{part}").drop("batch_id") for part in ("scores", "rejected"))


def _arriving(spark: SparkSession, folder: str, file_glob: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{file_glob}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(folder)


def score_available(spark: SparkSession, folder: str, file_glob: str, to_requests: Callable[[DataFrame], DataFrame],
                    centroids: dict[int, tuple[float, ...]], output: str, checkpoint: str) -> DataFrame:
    """Run the stream over the parquet files present now and return all that ``output`` holds.

    A later call with the same ``checkpoint`` scores only the files that have come since.
    """
    query = start_scoring(to_requests(_arriving(spark, folder, file_glob)), centroids, output, checkpoint)
    query.awaitTermination()
    return spark.read.parquet(output)
