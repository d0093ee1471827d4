"""The ready-made questions, one class per search profile.

Every answer is a lazy frame with declared columns; an empty answer is an empty frame and
a count is always one row. The parameters and their defaults are those of the questions
as they are asked: text, place names, lower points bound, upper price bound.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.functions.scores import DIGITS
from notegrove.functions.vectors import certainty, cosine
from notegrove.operators import adjacency as graphs
from notegrove.operators import predicates
from notegrove.operators.clean import price_label
from notegrove.operators.embed import Embedder, embed
from notegrove.operators.hybrid import enough, fuse, places_in
from notegrove.operators.ivfpq import AnnIndex, ann_search
from notegrove.operators.keyword import (
    any_match,
    bm25_scores,
    bm25_search,
    min_should_match,
    ranked_search,
    with_rows,
)
from notegrove.operators.knn import knn
from notegrove.operators.predicates import eq, every, in_range
from notegrove.operators.text_index import TextIndex
from notegrove.operators.topk import (
    by_points,
    by_points_then_price,
    count_rows,
    top_k,
)
from notegrove.schema import (
    ANN_PROBES,
    HIT_COLUMNS,
    PLACE_COLUMNS,
    RANKED_SPEC,
    TOP_K,
    SearchSpec,
)
from notegrove.sources.store import ReviewStore
from notegrove.workspace import new_folder, remove


def one_query(spark: SparkSession, terms: str) -> DataFrame:
    return spark.createDataFrame([(0, terms)], "qid int, terms string")


def _show(df: DataFrame, columns) -> DataFrame:
    """The declared columns that the records have, plus ranking columns when present."""
    extra = [c for c in ("score", "certainty", "price_label", "rank") if c in df.columns]
    return df.select(*[c for c in columns if c in df.columns], *extra)


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("price_label", price_label(F.col("price")))


class _Stored:
    """Questions over ``reviews`` that use their ``store`` where there is one."""

    def _holds(self, test: str, column: str, text: str) -> Column:
        """A test of a short column, on its distinct values if they are stored."""
        return getattr(predicates if self.store is None else self.store, test)(column, text)

    def _best(self, test: Column, order, k: int, columns) -> DataFrame:
        """The first k that pass; in a store the narrow table is searched for them."""
        if self.store is None:
            return top_k(self.reviews.where(test), order, k)
        hits = top_k(self.store.places.where(test), order, k).select("id")
        return with_rows(hits, self.reviews, columns, k, self.store)

    def _count(self, *tests: Column) -> DataFrame:
        return count_rows(self.reviews if self.store is None else self.store.places, *tests)


@dataclass(frozen=True)
class KeywordQuestions(_Stored):
    """Fuzzy words and phrases; inclusive bounds; the best points first."""

    reviews: DataFrame
    index: TextIndex
    store: ReviewStore | None = field(default=None, kw_only=True)

    def search(self, terms: str, max_price: float = 100.0, k: int = TOP_K) -> DataFrame:
        asked = one_query(self.reviews.sparkSession, terms)
        rows = self.index.among(self.reviews, "points", "price")
        found = min_should_match(self.index, asked, among=rows.where(in_range("price", hi=max_price)))
        hits = top_k(found.select("id", "points"), by_points(), k)
        return _show(with_rows(hits, self.reviews, HIT_COLUMNS, k, self.store), HIT_COLUMNS)

    def top_by_country(self, country: str, k: int = TOP_K) -> DataFrame:
        found = self._best(self._holds("phrase", "country", country), by_points(), k, HIT_COLUMNS)
        return _show(_labelled(found), HIT_COLUMNS)

    def top_by_province(self, province: str, k: int = TOP_K) -> DataFrame:
        found = self._best(self._holds("phrase", "province", province), by_points(), k, PLACE_COLUMNS)
        return _show(_labelled(found), PLACE_COLUMNS)

    def count_by_country(self, country: str) -> DataFrame:
        return self._count(self._holds("any_token", "country", country))

    def count_by_filters(
        self, country: str, points: float = 85, price: float = 100.0
    ) -> DataFrame:
        return self._count(
            self._holds("any_token", "country", country),
            in_range("points", lo=points),
            in_range("price", hi=price),
        )


@dataclass(frozen=True)
class RankedQuestions(_Stored):
    """Typo-tolerant search by the rule cascade; strict price bound."""

    reviews: DataFrame
    index: TextIndex
    spec: SearchSpec = RANKED_SPEC
    store: ReviewStore | None = field(default=None, kw_only=True)

    def _displayed(self, df: DataFrame) -> DataFrame:
        return df.select(*[c for c in self.spec.displayed if c in df.columns])

    def search(self, terms: str, max_price: float = 100.0, k: int = TOP_K) -> DataFrame:
        self.spec.check(filters=["price"], sort=["points", "price"])
        asked = one_query(self.reviews.sparkSession, terms)
        rows = self.index.among(self.reviews, "points", "price")
        cheap = rows.where(in_range("price", hi=max_price, inclusive=False))
        sort = [F.desc("points"), F.asc_nulls_last("price")]
        hits = ranked_search(self.index, asked, cheap, sort, k, self.spec)
        hits = hits.select("id", "rank")
        return self._displayed(with_rows(hits, self.reviews, self.spec.displayed, k, self.store))

    def top_by_country(self, country: str, k: int = TOP_K) -> DataFrame:
        return self._top("country", country, k)

    def top_by_province(self, province: str, k: int = TOP_K) -> DataFrame:
        return self._top("province", province, k)

    def _top(self, place: str, name: str, k: int) -> DataFrame:
        self.spec.check(filters=[place], sort=["points", "price"])
        test = self._holds("eq_ci", place, name)
        return self._displayed(self._best(test, by_points_then_price(), self.spec.cap(k), self.spec.displayed))


@dataclass(frozen=True)
class GraphQuestions:
    """Relevance search and top lists over a stored graph."""

    graph: graphs.StoredGraph
    index: TextIndex

    def search(self, terms: str, max_price: float = 100.0, k: int = TOP_K) -> DataFrame:
        rows = self.graph.reviews
        asked = one_query(rows.sparkSession, terms)
        # A review in two countries is two hits, so the hop comes before the cut.
        cheap = rows.where(in_range("price", hi=max_price))
        placed = cheap.select("id", "points", F.explode("countries").alias("country"))
        hits = bm25_search(self.index, asked, placed, k)
        found = _labelled(with_rows(hits, rows.select(*self.graph.properties), HIT_COLUMNS, at_most=k))
        return _show(found, HIT_COLUMNS)

    def top_by_country(self, country: str, k: int = TOP_K) -> DataFrame:
        return _show(graphs.top_by_country(self.graph, country, k), HIT_COLUMNS)

    def top_by_province(self, province: str, k: int = TOP_K) -> DataFrame:
        return _show(graphs.top_by_province(self.graph, province, k), PLACE_COLUMNS)

    def most_by_variety(self, variety: str, points: float = 85, k: int = TOP_K) -> DataFrame:
        asked = one_query(self.graph.reviews.sparkSession, variety)
        return graphs.most_by_country(self.graph, any_match(self.index, asked), points, k)


@dataclass(frozen=True)
class VectorQuestions(_Stored):
    """Exact nearest neighbours; filters run before the search; inclusive bounds."""

    reviews: DataFrame
    embedder: Embedder
    store: ReviewStore | None = field(default=None, kw_only=True)

    inclusive = True

    def _vector(self, terms: str) -> DataFrame:
        asked = one_query(self.reviews.sparkSession, terms)
        return embed(asked, "terms", self.embedder).select("qid", "vector")

    def _in_country(self, country: str) -> Column:
        return eq("country", country)

    def _filters(self, country: str, points: float, price: float) -> Column:
        return every(
            self._in_country(country),
            in_range("points", lo=points, inclusive=self.inclusive),
            in_range("price", hi=price, inclusive=self.inclusive),
        )

    def _search(self, terms: str, k: int, prefilter: Column | None = None) -> DataFrame:
        hits = knn(self.reviews, self._vector(terms), k, prefilter=prefilter)
        hits = hits.withColumn("certainty", certainty(F.col("score")))
        found = with_rows(hits.drop("qid"), self.reviews, PLACE_COLUMNS, k, self.store)
        return _show(found, PLACE_COLUMNS)

    def search(self, terms: str, k: int = TOP_K) -> DataFrame:
        return self._search(terms, k)

    def search_by_country(self, terms: str, country: str, k: int = TOP_K) -> DataFrame:
        return self._search(terms, k, self._in_country(country))

    def search_by_filters(
        self, terms: str, country: str, points: float = 85, price: float = 100.0, k: int = TOP_K
    ) -> DataFrame:
        return self._search(terms, k, self._filters(country, points, price))

    def count_by_country(self, country: str) -> DataFrame:
        return self._count(self._in_country(country))

    def count_by_filters(
        self, country: str, points: float = 85, price: float = 100.0
    ) -> DataFrame:
        return self._count(self._filters(country, points, price))


class StrictVectorQuestions(VectorQuestions):
    """As ``VectorQuestions`` with strict bounds; a country matches when it holds every
    word asked for."""

    inclusive = False

    def _in_country(self, country: str) -> Column:
        return self._holds("all_tokens", "country", country)


@dataclass(frozen=True)
class AnnQuestions(VectorQuestions):
    """Approximate neighbours; filters run after the search, so fewer than k may remain.
    ``nprobes=None`` probes all lists; with ``quantised=False`` that is the exact answer."""

    ann: AnnIndex = None
    nprobes: int | None = ANN_PROBES
    quantised: bool = True

    def _search(self, terms: str, k: int, prefilter: Column | None = None) -> DataFrame:
        hits = ann_search(
            self.ann, self._vector(terms), k, nprobes=self.nprobes, quantised=self.quantised, named=True
        )
        found = with_rows(hits.drop("qid"), self.reviews, PLACE_COLUMNS, k, self.store)
        return _show(found if prefilter is None else found.where(prefilter), PLACE_COLUMNS)


@dataclass(frozen=True)
class HybridQuestions:
    """Keyword relevance and vector nearness in one list."""

    reviews: DataFrame
    index: TextIndex
    embedder: Embedder
    store: ReviewStore | None = field(default=None, kw_only=True)

    def search(self, terms: str, k: int = TOP_K) -> DataFrame:
        """The k best of both whole lists fused. Only the first ``enough(k)`` records of
        either can be among them; their places are counted in the whole lists."""
        spark = self.reviews.sparkSession
        asked = one_query(spark, terms)
        vector = embed(asked, "terms", self.embedder).select("qid", "vector")
        sought = F.array(*[F.lit(x) for x in vector.first()["vector"]])
        score = F.round(F.coalesce(cosine(F.col("vector"), sought), F.lit(0.0)), DIGITS)
        rows = self.index.among(self.reviews, "points")
        # Every score is computed once; the lists are two or three numbers a record.
        lists = [
            (bm25_scores(self.index, asked, among=rows).select("id", "points", "score"), ("score", "points")),
            (self.reviews.select("id", score.alias("score")), ("score",)),
        ]
        paths, stored = [new_folder(spark, "whole-list") for _ in lists], []
        for path, (scored, best_first) in zip(paths, lists):
            scored.write.parquet(path)
            stored.append((spark.read.parquet(path), [-F.col(c) for c in best_first] + [F.col("id")]))
        first = [top_k(scored, order, enough(k)).select("id") for scored, order in stored]
        ids = sorted({r["id"] for r in first[0].union(first[1]).collect()})
        qid = F.lit(0).alias("qid")
        places = [places_in(scored, ids, order).select(qid, "*") for scored, order in stored]
        hits = fuse(*places, k)
        for path in paths:
            remove(spark, path)
        found = with_rows(hits.drop("qid"), self.reviews, HIT_COLUMNS, k, self.store)
        return _show(found, HIT_COLUMNS)
