"""Value counts of the filterable attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notegrove.operators.topk import top_k_per
from notegrove.schema import RANKED_SPEC, SearchSpec


def facet_counts(
    df: DataFrame, facets: Sequence[str], spec: SearchSpec = RANKED_SPEC
) -> DataFrame:
    """``facet, value, count``: the most frequent values of each facet, in one pass.

    The rows are unpivoted and counted before the shuffle, so a frequent value costs one
    partial row per task.
    """
    spec.check(filters=facets)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in facets]
    )
    counts = (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("facet", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    ranked = top_k_per(
        counts, ["facet"], [F.desc("count"), F.asc("value")], spec.max_facet_values
    )
    return ranked.select("facet", "value", "count")
