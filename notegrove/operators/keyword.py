"""Keyword questions over the inverted index, one or many queries at a time.

A batch is a frame ``queries(qid, terms)``. The query side is resolved against the stored term
statistics first; what comes of it travels to the shards, in blocks of bounded size, and its
terms prune the scan. Each shard of the records is scored in one task against all queries of
the block: no posting and no pair of query and record is ever shuffled, only the k best
records per query and shard (or, for plain matches, the records found).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from notegrove.functions.edits import auto_edits, typo_edits
from notegrove.functions.scores import DIGITS, idf
from notegrove.operators.expansion import expand_words, query_words
from notegrove.operators.shards import Search, Shard, by_query, in_shards, with_shard
from notegrove.operators.text_index import TextIndex, bucket_of, mean_lengths
from notegrove.operators.topk import by_score_then_points, top_k_per
from notegrove.schema import RANKED_SPEC, TOP_K, SearchSpec
from notegrove.sources.store import MAX_IDS, ReviewStore
from notegrove.workspace import (
    MAX_PARAMETER_ROWS,
    bounded_rows,
    join_parameters,
    materialize,
    small_frame,
)

# Longer lists of terms are joined to the postings instead of being pushed into the scan.
MAX_TERM_FILTER = 1000


def _lookup(index: TextIndex, words: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    """``words`` joined to the statistics of their ``term``, per field."""
    words = words.withColumn("bucket", bucket_of(F.col("term"), index.buckets))
    rows = bounded_rows(words)
    stats = index.terms_of(fields)
    if rows is None:
        return stats.join(words, ["bucket", "term"])
    stats = stats.where(F.col("bucket").isin(sorted({r["bucket"] for r in rows})))
    terms = sorted({r["term"] for r in rows})
    stats = stats.where(F.col("term").isin(terms)) if len(terms) <= MAX_TERM_FILTER else stats
    return stats.join(small_frame(index.term_stats.sparkSession, rows, words), ["bucket", "term"])


def _query_blocks(wanted: DataFrame) -> Iterator[list[Row]]:
    """The rows of whole queries, at most about ``MAX_PARAMETER_ROWS`` at a time."""
    rows = bounded_rows(wanted)
    if rows is not None:
        yield rows
        return
    wanted = materialize(wanted, "query-terms")
    n = 1 + 2 * wanted.count() // MAX_PARAMETER_ROWS
    for i in range(n):
        # A query lies in one block: with few queries of many terms most blocks are empty.
        if rows := wanted.where(F.pmod(F.xxhash64("qid"), F.lit(n)) == i).collect():
            yield rows


def _searched(
    index: TextIndex,
    wanted: DataFrame,
    search_of: Callable[[list[Row]], Search],
    values: str = "",
    candidates: DataFrame | None = None,
    columns: Sequence[str] = (),
) -> DataFrame:
    """What ``search_of`` the wanted terms' rows finds in every shard.

    ``candidates`` are rows of ``index.records`` or others with an ``id``; the latter are
    dealt to the shards first.
    """
    spark = wanted.sparkSession
    if candidates is not None:
        candidates = with_shard(candidates, index.shards)
    means = mean_lengths(index.field_stats)
    found = None
    for rows in _query_blocks(wanted):
        terms = sorted({r["term"] for r in rows})
        blocks = index.blocks.select("shard", "term", "field", "first", "last", "peak", "ids", "lens", "tfs", *columns)
        if len(terms) <= MAX_TERM_FILTER:
            blocks = blocks.where(F.col("term").isin(terms))
        else:
            few = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term string"))
            blocks = blocks.join(few, "term", "left_semi")
        part = in_shards(blocks, search_of(rows), wanted.schema["qid"], values, candidates, means)
        found = part if found is None else found.unionByName(part)
    return found


def _plain_words(index: TextIndex, queries: DataFrame, distinct: bool = True) -> DataFrame:
    words = query_words(queries, index.analyzer, distinct)
    return words.withColumnRenamed("word", "term")


def any_match(
    index: TextIndex, queries: DataFrame, fields: Sequence[str] | None = None
) -> DataFrame:
    """``qid, id`` of records with at least one query word in any of the fields."""
    wanted = _plain_words(index, queries).select("qid", "word_no", "n_words", "term")
    return _with_words(index, wanted, fields, 1)


def _with_words(
    index: TextIndex,
    wanted: DataFrame,
    fields: Sequence[str] | None,
    minimum: int,
    among: DataFrame | None = None,
) -> DataFrame:
    fields = list(fields or index.fields)

    def search_of(rows: list[Row]) -> Search:
        asked = by_query(rows, "word_no", "n_words", "term")

        def search(shard: Shard):
            for qid, terms in asked.items():
                words: dict[int, list[str]] = {}
                for no, _, term in terms:
                    words.setdefault(no, []).append(term)
                yield qid, shard.enough_words(words, fields, min(minimum, terms[0][1])), {}

        return search

    return _searched(index, wanted, search_of, candidates=among)


def phrase_match(
    index: TextIndex, queries: DataFrame, fields: Sequence[str] | None = None
) -> DataFrame:
    """``qid, id`` of records where the query's words follow each other in one field."""
    fields = list(fields or index.fields)
    wanted = _plain_words(index, queries, distinct=False).select("qid", "word_no", "term")

    def search_of(rows: list[Row]) -> Search:
        asked = by_query(rows, "word_no", "term")

        def search(shard: Shard):
            for qid, terms in asked.items():
                words = [t for _, t in sorted(terms)]
                hits = {int(i) for f in fields for i in shard.phrase(words, f)}
                yield qid, np.array(sorted(hits), int), {}

        return search

    return _searched(index, wanted, search_of, columns=["positions"])


def min_should_match(
    index: TextIndex,
    queries: DataFrame,
    fields: Sequence[str] | None = None,
    minimum: int = 2,
    fuzzy: bool = True,
    among: DataFrame | None = None,
) -> DataFrame:
    """``qid, id`` where some single field holds at least ``minimum`` different query words
    (or all of them, when there are fewer), each up to its automatic edit budget; with
    ``among`` (id, ...), of those records only, with their columns."""
    words = query_words(queries, index.analyzer)
    if fuzzy:
        asked = words.select(
            "word", auto_edits(F.col("word")).alias("edits"), F.lit(False).alias("prefix")
        )
        found = expand_words(asked, index.vocabulary).select("word", "term")
        words = words.join(found, "word")
    else:
        words = words.withColumn("term", F.col("word"))
    wanted = words.select("qid", "word_no", "n_words", "term")
    return _with_words(index, wanted, fields, minimum, among)


def bm25_scores(
    index: TextIndex,
    queries: DataFrame,
    fields: Sequence[str] | None = None,
    among: DataFrame | None = None,
    k: int | None = None,
) -> DataFrame:
    """``qid, id, score`` of every record with a query word, summed over words and fields;
    with ``among`` (id, ...), of those records only, with their columns; with ``k``, of those
    that are among the k best of their shard or level with them.

    Scores are rounded to six digits, so ties do not hang on the order of additions.
    """
    wanted = _lookup(index, _plain_words(index, queries), fields)
    # One row per indexed field, a number fixed when the index is declared.
    sizes = F.broadcast(index.field_stats.select("field", "n_docs"))
    weighted = wanted.join(sizes, "field").select(
        "qid", "term", "field", idf(F.col("n_docs"), F.col("df")).alias("weight")
    )

    def search_of(rows: list[Row]) -> Search:
        asked = by_query(rows, "term", "field", "weight")

        def search(shard: Shard):
            for qid, terms in asked.items():
                hits, scores = shard.relevance([((t, f), w) for t, f, w in terms], k)
                yield qid, hits, {"score": scores}

        return search

    found = _searched(index, weighted, search_of, "score double", among)
    return found.withColumn("score", F.round("score", DIGITS))


def bm25_search(
    index: TextIndex,
    queries: DataFrame,
    candidates: DataFrame,
    k: int = TOP_K,
    fields: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """The k best records per query, by score, then points, then id.

    ``candidates`` are the records that pass the filters, with ``id, points`` and any columns
    to carry: best a part of ``index.records``, which needs no shuffle; fetch other columns
    with ``with_rows``. ``where`` compares a record with its own query's columns, such as a
    price bound per query.
    """
    scored = bm25_scores(index, queries, fields, candidates, k if where is None else None)
    if where is not None:
        scored = join_parameters(scored, queries.drop("terms"), ["qid"]).where(where)
    return top_k_per(scored, ["qid"], by_score_then_points(), k)


def with_rows(
    hits: DataFrame,
    reviews: DataFrame,
    columns: Sequence[str],
    at_most: int | None = None,
    store: ReviewStore | None = None,
) -> DataFrame:
    """Hits with those of the displayed columns that their records have.

    With ``at_most``, the proven number of hits (queries times k), a short list of hits is
    collected first: its ids reach the scan, or the files of a ``store`` that hold them. A
    longer bounded list is broadcast, and only an unbounded one shuffles the records.
    """
    spark = reviews.sparkSession
    side = hits
    if at_most is not None and at_most <= MAX_IDS:
        found = hits.collect()
        ids = sorted({r["id"] for r in found if r["id"] is not None})
        reviews = reviews.where(F.col("id").isin(ids)) if store is None else store.at(ids)
        side = F.broadcast(spark.createDataFrame(found, hits.schema))
    elif at_most is not None and at_most <= MAX_PARAMETER_ROWS:
        side = F.broadcast(hits)
    keep = [c for c in columns if c in reviews.columns and c not in hits.columns]
    return reviews.select("id", *keep).join(side, "id")


def ranked_search(
    index: TextIndex,
    queries: DataFrame,
    candidates: DataFrame,
    sort: Sequence[Column] = (),
    k: int = TOP_K,
    spec: SearchSpec = RANKED_SPEC,
) -> DataFrame:
    """Typo-tolerant search ranked by the rule cascade.

    Rules, each breaking the ties of the one before, in the order of ``spec.rules``: most
    query words found, fewest typos, words closest together, best attribute, the asked
    sort, most words found as typed, a column's own order; then id. Distance of two successive words: the smallest gap between them in one
    field, one more when they are in reverse order, ``FAR`` at most and when either is
    missing. The last word also matches as a prefix.
    """
    fields = [f for f in spec.searchable if f in index.fields]
    spec.check(search=fields)
    words = query_words(queries, replace(index.analyzer, stop_words=spec.stop_words))
    asked = words.select(
        "word",
        typo_edits(F.col("word"), spec.one_typo, spec.two_typos).alias("edits"),
        F.col("is_last").alias("prefix"),
    )
    asked = asked.groupBy("word", "edits").agg(F.max("prefix").alias("prefix"))
    found = expand_words(asked, index.vocabulary).where(~F.col("term").isin(list(spec.stop_words)))
    resolved = words.join(found, "word").where(~F.col("by_prefix") | F.col("is_last"))
    wanted = resolved.select("qid", "word_no", "n_words", "term", "typos", "by_prefix")
    rules = [r if ":" not in r else "column" for r in spec.rules if r != "sort" or sort]
    k = spec.cap(k)

    def search_of(rows: list[Row]) -> Search:
        queries_ = by_query(rows, "word_no", "n_words", "term", "typos", "by_prefix")

        def search(shard: Shard):
            for qid, terms in queries_.items():
                of_word: dict[int, list[tuple[str, int, bool]]] = {}
                for no, _, *term in terms:
                    of_word.setdefault(no, []).append(tuple(term))
                hits, values = shard.cascade(of_word, terms[0][1], fields, rules, k)
                yield qid, hits, values

        return search

    names = "words bigint, typos bigint, proximity bigint, attribute bigint, exactness bigint"
    scored = _searched(index, wanted, search_of, names, candidates, ["positions"])
    ints = {c: F.col(c).cast("int") for c in ("attribute",)}
    return top_k_per(scored.withColumns(ints), ["qid"], [*rule_order(spec.rules, sort), F.asc("id")], k)


def rule_order(rules: Sequence[str], sort: Sequence[Column] = ()) -> list[Column]:
    """The rules of a search profile as an order; ``column:asc`` and ``column:desc`` are
    rules of their own."""
    known = {
        "words": [F.desc("words")],
        "typo": [F.asc("typos")],
        "proximity": [F.asc("proximity")],
        "attribute": [F.asc("attribute")],
        "sort": list(sort),
        "exactness": [F.desc("exactness")],
    }
    order = []
    for rule in rules:
        name, _, direction = rule.partition(":")
        if rule in known:
            order += known[rule]
        elif direction in ("asc", "desc"):
            order.append(F.desc(name) if direction == "desc" else F.asc(name))
        else:
            raise ValueError(f"unknown rule: {rule}")
    return order
