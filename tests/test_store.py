"""The stored layout: what a lookup opens, and predicates as lists of values."""

import pytest
from pyspark.sql import functions as F

from notegrove.operators import predicates
from notegrove.operators.keyword import with_rows
from notegrove.plans.questions import KeywordQuestions, RankedQuestions, StrictVectorQuestions
from notegrove.sources import store as stores
from notegrove.sources.store import open_store, write_store

COUNTRIES = ["South Africa", "south korea", "North Africa", "SOUTH AFRICA", "Chile", "", None, "Côte d’Or"]


@pytest.fixture(scope="module")
def reviews(spark):
    i = F.col("id")
    names = F.array(*[F.lit(c) for c in COUNTRIES])
    return spark.range(20_000).select(
        "id",
        F.concat(F.lit("t"), i).alias("title"),
        F.sha2(i.cast("string"), 256).alias("description"),
        (i * 7919 % 101).cast("int").alias("points"),
        F.when(i % 9 != 0, (i * 31 % 500).cast("double")).alias("price"),
        F.get(names, (i % len(COUNTRIES)).cast("int")).alias("country"),
        F.concat(F.lit("p "), (i % 50).cast("string")).alias("province"),
        F.lit("v").alias("variety"),
        F.lit("w").alias("winery"),
    )


@pytest.fixture(scope="module")
def store(spark, reviews, tmp_path_factory):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # a small table in many files
    out = write_store(reviews.repartition(7), ["country", "province"], path=str(tmp_path_factory.mktemp("s")))
    spark.conf.unset(key)
    return out


def scans(df):
    """Metrics of the file scans of a plan that has run."""
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.getClass().getName():
        plan = plan.executedPlan()
    leaves, out = plan.collectLeaves(), []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if "QueryStage" in leaf.getClass().getName():
            inner = leaf.plan().collectLeaves()
            out += [inner.apply(j) for j in range(inner.size())]
        else:
            out.append(leaf)
    return [{k: x.metrics().get(k).get().value() for k in ("numFiles", "numOutputRows")} for x in out if "FileSourceScan" in x.getClass().getName()]


def test_lookup_opens_what_it_needs(spark, store, plan):
    ids = [17, 18, 19_500]
    found = store.at(ids)
    assert "In(id, [17,18,19500])" in plan(found)
    assert sorted(r.id for r in found.collect()) == ids
    assert store.by_id.ranges.count() > 3
    (scan,) = scans(found)
    assert scan["numFiles"] == 2 and scan["numOutputRows"] < 20_000 / 2
    assert store.at([]).count() == store.at([-5]).count() == 0
    many = list(range(0, 20_000, 50))
    assert sorted(r.id for r in store.at(many).collect()) == many
    with pytest.raises(ValueError):
        store.at(range(stores.MAX_IDS + 1))


def test_hits_reach_the_scan(spark, reviews, store, plan):
    hits = spark.createDataFrame([(5, 1), (6, 2), (5, 3), (99_999, 4), (None, 5)], "id long, rank int")
    for at_most, kept in ((5, store), (5, None), (50_000, None), (None, None)):
        found = with_rows(hits, store.rows, ["title", "rank", "nowhere"], at_most, kept)
        assert sorted(map(tuple, found.collect())) == [(5, "t5", 1), (5, "t5", 3), (6, "t6", 2)]
        assert ("In(id, [5,6,99999])" in plan(found)) == (at_most == 5)


@pytest.mark.parametrize("test", ["eq_ci", "any_token", "all_tokens", "phrase"])
@pytest.mark.parametrize("text", ["South Africa", "africa south", "d’or", "x", "", "chile"])
def test_values_decide_like_the_rows(store, reviews, test, text):
    by_rows = reviews.where(getattr(predicates, test)("country", text)).count()
    listed = getattr(store, test)("country", text)
    assert store.places.where(listed).count() == by_rows
    assert reviews.where(listed).count() == by_rows


def test_many_values_are_tested_in_the_rows(store, monkeypatch):
    few = store.places.where(store.any_token("country", "south africa")).count()
    monkeypatch.setattr(stores, "MAX_VALUES", 1)
    assert store.places.where(store.any_token("country", "south africa")).count() == few > 0


def test_questions_push_values(spark, reviews, store, plan):
    """The same answers with and without a store, which reads no row to test its words."""
    for make in (lambda **s: KeywordQuestions(reviews, None, **s), lambda **s: RankedQuestions(reviews, None, **s)):
        for ask in ("top_by_country", "top_by_province"):
            name = "africa" if ask == "top_by_country" else "p 7"
            a, b = (getattr(make(**s), ask)(name) for s in ({}, {"store": store}))
            assert a.columns == b.columns and sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    counted = KeywordQuestions(reviews, None, store=store)
    assert counted.count_by_country("South Korea").first()[0] == KeywordQuestions(reviews, None).count_by_country("South Korea").first()[0] > 0
    text = plan(counted.count_by_filters("south", 50, 100.0))
    assert "regexp_extract_all" not in text and "In(country, [" in text.replace("isnotnull", "")
    strict = StrictVectorQuestions(reviews, None, store=store)
    assert "regexp_extract_all" not in plan(strict.count_by_country("africa south"))


def test_store_reopens(spark, store):
    again = open_store(spark, store.path)
    assert [r.id for r in again.at([3]).collect()] == [3]


def test_empty(spark, reviews, tmp_path):
    none = write_store(reviews.limit(0), ["country"], path=str(tmp_path / "none"))
    assert none.at([1]).count() == none.places.where(none.phrase("country", "a")).count() == 0
