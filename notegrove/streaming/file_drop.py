"""Files dropped into a folder become keyed upserts, a few files per batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from notegrove.sources.tables import latest

FILES_PER_BATCH = 5  # fixed value


def ingest_files(
    spark: SparkSession,
    source: str,
    log: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Read all text files that have arrived and append their rows to the change log.

    Every batch owns one ``batch_id`` folder that a repeated batch overwrites, so a batch
    that fails half-way and runs again leaves each row once. The table itself is not
    rewritten per batch: ``current`` merges on read and ``compact`` folds the log up.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source)
    rows = transform(lines)

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    return (
        rows.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current(
    log: DataFrame, key: str, version: Sequence[str], mode: str = "replace"
) -> DataFrame:
    """The newest state of every key in the change log."""
    return latest(log.drop("batch_id"), key, version, mode)


def compact(
    spark: SparkSession, log: str, target: str, key: str, version: Sequence[str]
) -> DataFrame:
    """The log's current state as a table of its own, to start the next log from."""
    current(spark.read.parquet(log), key, version).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
