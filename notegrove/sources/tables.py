"""Parquet tables: create, append, replace, publish under an alias, keyed upserts, checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from notegrove.sources.readers import running_starts
from notegrove.workspace import materialize, new_folder, remove, shared_folder


def create_if_absent(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, made empty first when there is none."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


ALIAS = "version bigint, path string"


def _alias_log(spark: SparkSession, alias: str, folder: str | None) -> str:
    return f"{folder or shared_folder(spark)}/aliases/{alias}"


def publish(spark: SparkSession, alias: str, path: str, folder: str | None = None) -> None:
    """Point a name at a finished table; readers move over at once.

    The name outlives the session: its versions are rows of a small table in ``folder`` (the
    shared folder), the newest of which counts. One writer per name.
    """
    log = _alias_log(spark, alias, folder)
    spark.createDataFrame([], ALIAS).write.mode("ignore").parquet(log)
    last = spark.read.schema(ALIAS).parquet(log).agg(F.max("version")).first()[0]
    spark.createDataFrame([((last or 0) + 1, path)], ALIAS).coalesce(1).write.mode("append").parquet(log)
    spark.read.parquet(path).createOrReplaceTempView(alias)


def alias_path(spark: SparkSession, alias: str, folder: str | None = None) -> str:
    """Where a published name points now."""
    versions = spark.read.schema(ALIAS).parquet(_alias_log(spark, alias, folder))
    return versions.agg(F.max_by("path", "version")).first()[0]


def open_alias(spark: SparkSession, alias: str, folder: str | None = None) -> DataFrame:
    """The table that a name was published for, in this session or an earlier one."""
    return spark.read.parquet(alias_path(spark, alias, folder))


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_lookup(
    df: DataFrame, path: str, sort_by: Sequence[str], partition_by: Sequence[str] = ()
) -> None:
    """Rows ordered by their lookup keys, so Parquet statistics skip the files and row
    groups (and folders, with ``partition_by``) an equality filter cannot match. Ranges
    over all keys cut a frequent value into several files."""
    keys = [*partition_by, *sort_by]
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite")
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(path)


def latest(
    df: DataFrame, key: str | Sequence[str], version: Sequence[str], mode: str = "replace"
) -> DataFrame:
    """One row per key.

    Rows with one key and version are told apart by their other columns, in order, so the
    result never hangs on the order of the rows.

    ``replace`` keeps the newest row whole; ``merge`` keeps, column by column, the newest
    value that is not null. Both are plain aggregations: they combine inside each task
    before the shuffle, so a key with a third of all rows stays cheap.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    comparable = [
        F.array_sort(F.map_entries(c)).alias(c) if isinstance(df.schema[c].dataType, MapType) else F.col(c)
        for c in rest
        if c not in version
    ]
    newest = F.struct(*version, *comparable)
    if mode == "replace":
        row = F.max_by(F.struct(*rest), newest).alias("row")
        return df.groupBy(*keys).agg(row).select(*keys, "row.*").select(*df.columns)
    if mode == "merge":
        values = [F.max_by(c, F.when(F.col(c).isNotNull(), newest)).alias(c) for c in rest]
        return df.groupBy(*keys).agg(*values).select(*df.columns)
    raise ValueError(f"unknown mode: {mode}")


def upsert(
    current: DataFrame,
    delta: DataFrame,
    key: str | Sequence[str],
    version: Sequence[str] = (),
    mode: str = "replace",
) -> DataFrame:
    """``current`` brought up to date by ``delta``; the delta wins, then its newer version."""
    names = current.columns
    both = current.withColumn("_from_delta", F.lit(0)).unionByName(
        delta.withColumn("_from_delta", F.lit(1)), allowMissingColumns=True
    )
    return latest(both, key, ["_from_delta", *version], mode).select(*names)


def upsert_table(
    spark: SparkSession,
    alias: str,
    path: str,
    delta: DataFrame,
    key: str | Sequence[str],
    version: Sequence[str] = (),
    mode: str = "replace",
) -> str:
    """Write the updated table beside the old one, then move the alias. One writer only.

    Returns the new folder; the old one is left for readers that still use it. The table is
    written anew; ``upsert_parts`` rewrites only what a delta touches.
    """
    target = new_folder(spark, alias)
    upsert(spark.read.parquet(path), delta, key, version, mode).write.parquet(target)
    publish(spark, alias, target)
    return target


def part_of(key: str | Sequence[str], parts: int) -> Column:
    """The part of a keyed table that a key belongs to."""
    return F.pmod(F.xxhash64(*([key] if isinstance(key, str) else key)), F.lit(parts)).cast("int")


def write_parts(df: DataFrame, path: str, key: str | Sequence[str], parts: int) -> None:
    """A keyed table in ``parts`` folders by the hash of the key."""
    placed = df.withColumn("part", part_of(key, parts))
    placed.repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)


def upsert_parts(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    key: str | Sequence[str],
    parts: int,
    version: Sequence[str] = (),
    mode: str = "replace",
) -> list[int]:
    """Bring a table of ``write_parts`` up to date in place; only parts that the delta has
    keys of are read and written. Returns them.

    The new parts are finished beside the table before any is replaced, so a run that fails
    can be repeated. One writer only.
    """
    placed = delta.withColumn("part", part_of(key, parts))
    touched = sorted(r[0] for r in placed.select("part").distinct().collect())
    if touched:
        current = spark.read.parquet(path).where(F.col("part").isin(touched))
        beside = new_folder(spark, "parts")
        keys = [key] if isinstance(key, str) else list(key)
        upsert(current, placed, [*keys, "part"], version, mode).write.parquet(beside)
        fresh = spark.read.parquet(beside).repartition("part")
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
        remove(spark, beside)
    return touched


def unique_violations(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their counts; empty when the key is unique."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("count"))
    return counts.where(F.col("count") > 1)


def _placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
    )


def _numbered(stored: DataFrame) -> DataFrame:
    # One row per partition, a number set by the session; so the rows are not shuffled.
    sizes = stored.groupBy("_part").agg(F.min("_at").alias("_first"), F.count("*").alias("n"))
    starts = F.broadcast(running_starts(sizes, "_part"))
    return stored.join(starts, "_part").withColumn(
        "row_no", F.col("_at") - F.col("_first") + F.col("start")
    )


def row_index(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``row_no``, the dense 0-based position in the given order.

    The rows are range-partitioned and written once; each partition then only needs the
    total size of the ones before it, so no task ever sorts or numbers the whole table.
    """
    return _numbered(materialize(_placed(df, order), "row-index")).select(*df.columns, "row_no")


def load_report(
    df: DataFrame, key: str, batch_rows: int, is_bad: Column | None = None
) -> DataFrame:
    """Lowest and highest key, row count and bad rows of each run of ``batch_rows`` rows.

    The report is stored; the numbered rows that it was made from are removed again."""
    spark = df.sparkSession
    bad = F.coalesce(is_bad, F.lit(False)) if is_bad is not None else F.lit(False)
    folder = new_folder(spark, "row-index")
    _placed(df.select(key, bad.alias("_bad")), [key]).write.parquet(folder)
    report = materialize(_batches(_numbered(spark.read.parquet(folder)), key, batch_rows), "load-report")
    remove(spark, folder)
    return report


def _batches(marked: DataFrame, key: str, batch_rows: int) -> DataFrame:
    return marked.groupBy(F.floor(F.col("row_no") / batch_rows).alias("batch_id")).agg(
        F.min(key).alias("min_id"),
        F.max(key).alias("max_id"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("_bad").cast("int")).alias("n_bad"),
    )
