"""A review table laid out for its questions: rows by id, places in order, distinct values.

``rows``     all columns, in order of id
``ranges``   file, first, last: the ids that each file of ``rows`` holds
``places``   id, the short columns and the columns to sort by, in order of the short columns
``values``   column, value, tokens: what each short column holds, analysed once

A handful of hits finds its rows by opening the files and pages that hold them. A question
about a place is answered on the few values that there are, whatever it asks (case, words,
phrases), and reaches the scan as a plain list of values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.functions.text import STANDARD, Analyzer
from notegrove.operators import predicates
from notegrove.workspace import new_folder

# Longer lists of ids or values are not sent to the scan one by one.
MAX_IDS = 1_000
MAX_VALUES = 10_000
# A list of so many values is compared value by value with a page's statistics; a longer one
# only by its ends.
PUSHED_VALUES = 10


@dataclass(frozen=True)
class OrderedRows:
    """Rows in ascending order of a number, with the numbers that each file holds."""

    key: str
    rows: DataFrame
    ranges: DataFrame  # file, first, last

    def within(self, keys: Sequence[int]) -> DataFrame:
        """The files that can hold one of the keys; all of their rows."""
        # The ranges hardly overlap: about as many files as keys at most.
        wanted = F.array(*[F.lit(int(i)) for i in sorted(set(keys))]).cast("array<bigint>")
        here = F.exists(wanted, lambda x: x.between(F.col("first"), F.col("last")))
        files = [r["file"] for r in self.ranges.where(here).select("file").collect()] if len(keys) else []
        if not files:
            return self.rows.where(F.lit(False))
        return self.rows.sparkSession.read.schema(self.rows.schema).parquet(*files)

    def at(self, keys: Sequence[int]) -> DataFrame:
        """The rows of at most ``MAX_IDS`` keys; only files and pages that can hold one are read."""
        if len(keys) > MAX_IDS:
            raise ValueError(f"more than {MAX_IDS} keys: join instead")
        keys = sorted(set(keys))
        tests = [F.col(self.key).isin(list(keys[i : i + PUSHED_VALUES])) for i in range(0, len(keys), PUSHED_VALUES)]
        while len(tests) > 1:
            tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + tests[len(tests) // 2 * 2 :]
        return self.within(keys).where(tests[0]) if tests else self.rows.where(F.lit(False))


def write_ordered(ordered: DataFrame, key: str, path: str) -> OrderedRows:
    """Store rows whose partitions are in order of ``key`` already."""
    spark = ordered.sparkSession
    ordered.write.mode("overwrite").parquet(f"{path}/rows")
    held = spark.read.parquet(f"{path}/rows").select(key, F.col("_metadata.file_path").alias("file"))
    ranges = held.where(F.col(key).isNotNull()).groupBy("file").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    ranges.write.mode("overwrite").parquet(f"{path}/ranges")
    return open_ordered(spark, key, path)


def open_ordered(spark: SparkSession, key: str, path: str) -> OrderedRows:
    return OrderedRows(key, spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/ranges"))


@dataclass(frozen=True)
class ReviewStore:
    path: str
    analyzer: Analyzer
    by_id: OrderedRows
    places: DataFrame
    values: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.by_id.rows

    def at(self, ids: Sequence[int]) -> DataFrame:
        """The rows of at most ``MAX_IDS`` ids."""
        return self.by_id.at(ids)

    def _listed(self, column: str, test: Column, otherwise: Column) -> Column:
        """The test as a list of values; ``otherwise`` where it would be too long."""
        held = self.values.where(F.col("column") == column).where(test).select("value")
        found = [r["value"] for r in held.limit(MAX_VALUES + 1).collect()]
        if len(found) > MAX_VALUES:
            return otherwise
        return F.col(column).isin(found) if found else F.lit(False)

    def eq_ci(self, column: str, text: str) -> Column:
        return self._listed(column, predicates.eq_ci("value", text), predicates.eq_ci(column, text))

    def any_token(self, column: str, text: str) -> Column:
        wanted = self.analyzer.tokens(F.lit(text))
        return self._listed(column, predicates.holds_any(F.col("tokens"), wanted), predicates.any_token(column, text, self.analyzer))

    def all_tokens(self, column: str, text: str) -> Column:
        wanted = self.analyzer.tokens(F.lit(text))
        return self._listed(column, predicates.holds_all(F.col("tokens"), wanted), predicates.all_tokens(column, text, self.analyzer))

    def phrase(self, column: str, text: str) -> Column:
        wanted = self.analyzer.tokens(F.lit(text))
        return self._listed(column, predicates.holds_phrase(F.col("tokens"), wanted), predicates.phrase(column, text, self.analyzer))


def write_store(
    reviews: DataFrame,
    short: Sequence[str],
    sort_by: Sequence[str] = ("points", "price"),
    path: str | None = None,
    analyzer: Analyzer = STANDARD,
) -> ReviewStore:
    """Store ``reviews``; ``short`` are its columns of few different values."""
    spark = reviews.sparkSession
    path = path or new_folder(spark, "reviews")
    by_id = write_ordered(reviews.repartitionByRange("id").sortWithinPartitions("id"), "id", path)
    rows = by_id.rows
    keys = [*short, "id"]
    narrow = rows.select("id", *short, *[c for c in sort_by if c in rows.columns])
    narrow.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/places")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in short])
    values = narrow.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    values.withColumn("tokens", analyzer.tokens(F.col("value"))).write.mode("overwrite").parquet(f"{path}/values")
    return open_store(spark, path, analyzer)


def open_store(spark: SparkSession, path: str, analyzer: Analyzer = STANDARD) -> ReviewStore:
    places, values = (spark.read.parquet(f"{path}/{name}") for name in ("places", "values"))
    return ReviewStore(path, analyzer, open_ordered(spark, "id", path), places, values)
