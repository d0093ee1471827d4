"""Top lists and counts for many parameter sets at once.

``queries`` holds one row per question: ``qid``, a place name and, for the counts, its
bounds. The rows are read once for all questions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegrove.operators.topk import by_points, top_k_per
from notegrove.schema import TOP_K
from notegrove.workspace import join_parameters


def top_by_place(
    reviews: DataFrame,
    queries: DataFrame,
    place: str,
    order: Sequence[Column] | None = None,
    k: int = TOP_K,
) -> DataFrame:
    """The best reviews of each query's place (equal up to case), with ``qid`` and ``rank``."""
    asked = queries.select("qid", F.lower(place).alias("_place"))
    rows = reviews.withColumn("_place", F.lower(place))
    found = join_parameters(rows, asked, ["_place"]).drop("_place")
    return top_k_per(found, ["qid"], by_points() if order is None else order, k)


def count_by_filters(
    reviews: DataFrame, queries: DataFrame, inclusive: bool = True
) -> DataFrame:
    """``qid, count`` for ``queries(qid, country, min_points, max_price)``, zeros included."""
    rows = reviews.select("country", "points", "price")
    asked = queries.select("qid", "country", "min_points", "max_price")
    points, price = F.col("points"), F.col("price")
    if inclusive:
        fits = (points >= F.col("min_points")) & (price <= F.col("max_price"))
    else:
        fits = (points > F.col("min_points")) & (price < F.col("max_price"))
    found = join_parameters(rows, asked, ["country"], slice_by=["points", "price"])
    counts = found.where(fits).groupBy("qid").agg(F.count(F.lit(1)).alias("count"))
    return queries.select("qid").join(counts, "qid", "left").na.fill(0, ["count"])
