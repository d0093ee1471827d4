"""Where intermediate tables go, and size-checked access to small frames."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Most rows of a derived parameter table (resolved query terms, probed lists) that may
# be held on the driver and broadcast. Beyond it every operator takes a shuffled path.
MAX_PARAMETER_ROWS = 100_000
# Parts the rows of one key are cut into on the shuffled path.
JOIN_SLICES = 16


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    A session that runs in one process and has no such setting gets a fresh temporary
    folder; any cluster, one on this machine included, is refused without it, because a
    machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="notegrove-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """A folder's whole address, scheme included, for tasks that open its files by Arrow."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    address = files.makeQualified(target).toUri()
    scheme = {"s3a": "s3", "s3n": "s3"}.get(address.getScheme(), address.getScheme())
    return f"{scheme}://{address.getAuthority() or ''}{address.getPath()}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, cutting its lineage."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucketed_name(path: str) -> str:
    return "notegrove_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_bucketed(df: DataFrame, path: str, buckets: int, key: str, sort: str) -> None:
    """Write ``df`` bucketed by ``key``, so that grouping or joining by it needs no shuffle.

    Bucketing is known to a catalog only; the table's name there follows from its folder.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(sort)
    writer.option("path", path).format("parquet").saveAsTable(_bucketed_name(path))


def read_bucketed(spark: SparkSession, path: str, buckets: int, key: str, sort: str) -> DataFrame:
    """A table of ``write_bucketed``, also in a session whose catalog does not know it yet."""
    name = _bucketed_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({sort}) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bounded_rows(df: DataFrame, max_rows: int = MAX_PARAMETER_ROWS) -> list[Row] | None:
    """All rows of a frame expected to be small, or None when it holds more than allowed."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def small_frame(spark: SparkSession, rows: list[Row], like: DataFrame) -> DataFrame:
    """Rows that passed ``bounded_rows`` as a broadcastable frame."""
    return F.broadcast(spark.createDataFrame([tuple(r) for r in rows], like.schema))


def join_parameters(
    rows: DataFrame,
    params: DataFrame,
    keys: Sequence[str],
    slice_by: Sequence[str] = ("id",),
) -> DataFrame:
    """Rows joined to a table of query parameters that is expected to be small.

    Small enough, it is broadcast and the rows stay where they are. Otherwise both sides
    shuffle; the rows of a frequent key go to ``JOIN_SLICES`` tasks instead of one, with a
    copy of the few parameters for each.
    """
    found = bounded_rows(params)
    if found is not None:
        return rows.join(small_frame(rows.sparkSession, found, params), keys)
    slices = F.sequence(F.lit(0), F.lit(JOIN_SLICES - 1)).cast("array<bigint>")
    rows = rows.withColumn("_slice", F.pmod(F.xxhash64(*slice_by), F.lit(JOIN_SLICES)))
    params = params.withColumn("_slice", F.explode(slices))
    return rows.join(params, [*keys, "_slice"]).drop("_slice")


def spread(df: DataFrame) -> DataFrame:
    """Give a frame read from fewer splits than there are cores one partition per core, so
    that costly per-row work uses them all. Larger inputs come back untouched."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
