"""Orders and top-k lists. Every order ends in the id, so a result is never ambiguous."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notegrove.schema import TOP_K


def by_points(id_col: str = "id") -> list[Column]:
    return [F.desc("points"), F.asc(id_col)]


def by_points_then_price(id_col: str = "id") -> list[Column]:
    return [F.desc("points"), F.asc_nulls_last("price"), F.asc(id_col)]


def by_score_then_points(id_col: str = "id") -> list[Column]:
    return [F.desc("score"), F.desc("points"), F.asc(id_col)]


def top_k(df: DataFrame, order: Sequence[Column], k: int = TOP_K) -> DataFrame:
    """One list: each task keeps k rows, the driver side merges k per task."""
    return df.orderBy(*order).limit(k)


def top_k_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = TOP_K
) -> DataFrame:
    """One list per key, with its ``rank``. The rank limit also runs before the shuffle,
    so a key shared by a third of the rows sends only k rows per task."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def count_rows(df: DataFrame, *tests: Column) -> DataFrame:
    """A filtered count: always one row, zero included."""
    for test in tests:
        df = df.where(test)
    return df.agg(F.count(F.lit(1)).alias("count"))


def count_by(df: DataFrame, key: str, k: int = TOP_K, name: str = "count") -> DataFrame:
    """The k most frequent values of ``key``; ties go to the smaller value."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return top_k(counts, [F.desc(name), F.asc(key)], k)
