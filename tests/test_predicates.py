import pytest

from notegrove.operators.facets import facet_counts
from notegrove.operators.predicates import all_tokens, any_token, eq_ci, in_range, phrase
from notegrove.operators.topk import (
    by_points,
    by_points_then_price,
    count_by,
    count_rows,
    top_k,
    top_k_per,
)
from notegrove.schema import RANKED_SPEC


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1, 85, 100.0, "North Xland"),
            (2, 90, 99.0, "South Xland"),
            (3, 85, None, "South Yland"),
            (4, 84, 10.0, None),
            (5, 90, 99.0, "xland, south"),
        ],
        "id long, points int, price double, country string",
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_tokens_and_phrases(rows):
    assert ids(rows.where(phrase("country", "South xland"))) == [2]
    assert ids(rows.where(all_tokens("country", "south XLAND"))) == [2, 5]
    assert ids(rows.where(any_token("country", "south xland"))) == [1, 2, 3, 5]
    assert ids(rows.where(any_token("country", ""))) == []
    assert ids(rows.where(all_tokens("country", "..."))) == []
    assert ids(rows.where(eq_ci("country", "SOUTH YLAND"))) == [3]


def test_bounds(rows):
    assert ids(rows.where(in_range("price", hi=100))) == [1, 2, 4, 5]
    assert ids(rows.where(in_range("price", hi=100, inclusive=False))) == [2, 4, 5]
    assert ids(rows.where(in_range("points", lo=85))) == [1, 2, 3, 5]
    assert ids(rows.where(in_range("points", lo=85, inclusive=False))) == [2, 5]
    assert ids(rows.where(in_range("points", 85, 85))) == [1, 3]
    assert ids(rows.where(in_range("price"))) == [1, 2, 4, 5]


def test_orders_break_ties_by_id(rows, spark):
    assert [r.id for r in top_k(rows, by_points(), 3).collect()] == [2, 5, 1]
    assert [r.id for r in top_k(rows, by_points_then_price(), 5).collect()] == [2, 5, 1, 3, 4]
    level = spark.createDataFrame([(i, 1) for i in range(6, 0, -1)], "id long, points int")
    assert [r.id for r in top_k(level, by_points()).collect()] == [1, 2, 3, 4, 5]


def test_lists_per_key_are_cut_before_the_shuffle(rows, plan):
    best = top_k_per(rows, ["points"], by_points(), 1)
    assert ids(best) == [1, 2, 4]
    text = plan(best)
    assert text.index("WindowGroupLimit") < text.index("Exchange")


def test_counts(rows):
    assert count_rows(rows, in_range("points", lo=200)).collect()[0]["count"] == 0
    assert [tuple(r) for r in count_by(rows, "points", 2).collect()] == [(85, 2), (90, 2)]


def test_facets(rows, spark):
    got = {(r.facet, r.value): r["count"] for r in facet_counts(rows, ["points", "country"]).collect()}
    assert got[("points", "90")] == 2
    assert ("country", None) not in got
    many = spark.range(300).selectExpr("id", "id as price")
    assert facet_counts(many, ["price"]).count() == RANKED_SPEC.max_facet_values


def test_undeclared_attributes_are_refused(rows):
    with pytest.raises(ValueError, match="winery"):
        facet_counts(rows, ["winery"])
    with pytest.raises(ValueError, match="sortable"):
        RANKED_SPEC.check(sort=["title"])


def test_filters_reach_the_scan(spark, folder, plan):
    from notegrove.operators.predicates import eq
    from notegrove.plans.views import parts

    text = plan(count_rows(parts(spark, folder), eq("variety", "PROMO"), in_range("price", hi=905.0)))
    assert "EqualTo(p_type,PROMO)" in text
    assert "LessThanOrEqual(p_retailprice,905.0)" in text
    assert "p_name" not in text.split("ReadSchema")[1].split("\n")[0]
