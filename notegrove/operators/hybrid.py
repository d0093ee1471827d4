"""One ranked list out of a keyword list and a vector list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegrove.functions.scores import rrf
from notegrove.operators.topk import top_k_per
from notegrove.schema import TOP_K

# Added to a rank before its reciprocal is taken.
OFFSET = 60


def fuse(keyword_hits: DataFrame, vector_hits: DataFrame, k: int = TOP_K) -> DataFrame:
    """``qid, id, score, rank``: reciprocal ranks of both lists, summed per record."""
    lists = keyword_hits.select("qid", "id", "rank").unionByName(
        vector_hits.select("qid", "id", "rank")
    )
    summed = lists.groupBy("qid", "id").agg(
        F.round(F.sum(rrf(F.col("rank"), OFFSET)), 6).alias("score")
    )
    return top_k_per(summed, ["qid"], [F.desc("score"), F.asc("id")], k)


def enough(k: int) -> int:
    """How many of each list can reach the first ``k`` of the whole lists fused.

    The k best of one list score 1 / (OFFSET + k) at least. A record behind the first n of
    both scores 2 / (OFFSET + n + 1) at most, which is less from n = 2 k + OFFSET on.
    """
    return 2 * k + OFFSET


def _below(key: Column, cuts: Sequence[Column], at: int = 0) -> Column:
    """How many of the ascending ``cuts`` lie below the key: a binary search in the row."""
    if not cuts:
        return F.lit(at)
    mid = len(cuts) // 2
    right = _below(key, cuts[mid + 1 :], at + mid + 1)
    return F.when(cuts[mid] < key, right).otherwise(_below(key, cuts[:mid], at))


def places_in(scored: DataFrame, ids: Sequence[int], ahead: Sequence[Column]) -> DataFrame:
    """``id, rank``: the place that each of a few records has in a whole list.

    ``ahead`` are numbers, ending in the id, that sort the list in ascending order. The
    list is not sorted: its rows are counted between the few records.
    """
    keyed = scored.select("id", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(ahead)]).alias("key"))
    few = sorted((tuple(r["key"]), r["id"]) for r in keyed.where(F.col("id").isin(list(ids))).collect())
    spark, kind = scored.sparkSession, "id bigint, rank int"
    if not few:
        return spark.createDataFrame([], kind)
    names = keyed.schema["key"].dataType.fields
    cuts = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, names)]) for key, _ in few]
    before = _below(F.col("key"), cuts).alias("before")
    counts = {r["before"]: r["count"] for r in keyed.select(before).groupBy("before").count().collect()}
    rows, rank = [], 0
    for i, (_, id_) in enumerate(few):
        rank += counts.get(i, 0)
        rows.append((id_, rank))
    return spark.createDataFrame(rows, kind)
