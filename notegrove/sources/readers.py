"""Reading review files: compressed JSON lines, prefixes and replays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Value ranges that rows are counted by in one pass.
RANGES = 4096


def read_lines(
    spark: SparkSession, path: str | Sequence[str], partitions: int | None = None
) -> DataFrame:
    """``line, input_file`` for every line under the path or glob.

    A gzip file is one task, so pass ``partitions`` to spread a few large files before
    the parsing starts; many files need no shuffle.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("input_file")
    )
    lines = lines.where(F.trim("line") != "")
    return lines.repartition(partitions) if partitions else lines


def write_lines(
    df: DataFrame, path: str, mode: str = "errorifexists", keep_nulls: bool = True
) -> None:
    """Gzip JSON lines; null fields are written as explicit keys or left out."""
    df.write.mode(mode).option("ignoreNullFields", not keep_nulls).json(path, compression="gzip")


def running_starts(sizes: DataFrame, order: str) -> DataFrame:
    """``sizes`` with ``start``, the sum of ``n`` over the rows before. One row per file or
    partition comes in here, never one per record."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")


def replay(df: DataFrame, times: int) -> DataFrame:
    """Every row ``times`` times, numbered from 1 in ``replay`` (a load test)."""
    return df.withColumn("replay", F.explode(F.sequence(F.lit(1), F.lit(times))))


def first_rows(df: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The n lowest rows by a whole number, or all of them when n is 0; nulls come last.

    Counts by value range find the value up to which rows belong, in a few passes that return
    ``RANGES`` counts each; the rest is a filter that reaches the scan. Rows level with the
    last value are told apart by their hash in the same way. Nothing is sorted, and no task
    gets more rows than it reads.
    """
    if n <= 0:
        return df
    key = F.col(order).cast("long")
    last, below = _value_at(df.where(F.col(order).isNotNull()), key, n)
    if last is None:  # fewer rows have a value
        missing = df.where(F.col(order).isNull())
        return df.where(F.col(order).isNotNull()).unionByName(_any_rows(missing, n - below))
    level = df.where(F.col(order) == F.lit(last))
    return df.where(F.col(order) < F.lit(last)).unionByName(_any_rows(level, n - below))


def _any_rows(df: DataFrame, n: int) -> DataFrame:
    """n rows, by their hash; of rows that are equal throughout any."""
    hashed = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns])
    last, below = _value_at(df, hashed, n)
    if last is None:
        return df
    return df.where(hashed < last).unionByName(df.where(hashed == last).limit(n - below))


def _value_at(df: DataFrame, key: Column, n: int) -> tuple[int | None, int]:
    """The n-th lowest value and how many are lower; None and their number if there are fewer."""
    low, high, total = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if total < n:
        return None, total
    below = 0
    while low < high:
        width = -(-(high - low + 1) // RANGES)
        # As decimals, since a difference of two values may not fit a long.
        low_, width_ = (F.lit(str(x)).cast("decimal(20,0)") for x in (low, width))
        place = F.call_function("div", key.cast("decimal(20,0)") - low_, width_)
        inside = df.where(key.between(low, high))
        counts = dict(inside.groupBy(place.cast("int").alias("place")).count().collect())
        for at in sorted(counts):
            if below + counts[at] >= n:
                low, high = low + at * width, min(high, low + at * width + width - 1)
                break
            below += counts[at]
    return low, below
