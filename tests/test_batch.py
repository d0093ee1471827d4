import pytest
from pyspark.sql import functions as F

from notegrove import workspace
from notegrove.operators import graph as graphs
from notegrove.operators.batch import count_by_filters, top_by_place
from notegrove.operators.embed import stored_vectors


@pytest.fixture(scope="module")
def reviews(spark):
    # A third of the rows share one country.
    return spark.range(900).select(
        "id",
        F.when(F.col("id") % 3 == 0, "Xland").otherwise(F.concat(F.lit("C"), F.col("id") % 7)).alias("country"),
        (F.col("id") % 20 + 80).cast("int").alias("points"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 50).cast("double")).alias("price"),
    )


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(
        [(1, "Xland", 85, 30.0), (2, "C1", 90, 49.0), (3, "none", 0, 99.0), (4, "Xland", 99, 4.0)],
        "qid int, country string, min_points int, max_price double",
    )


def answers(reviews, queries):
    top = top_by_place(reviews, queries, "country", k=3)
    return (
        sorted((r.qid, r["rank"], r.id) for r in top.collect()),
        {r.qid: r["count"] for r in count_by_filters(reviews, queries).collect()},
        {r.qid: r["count"] for r in count_by_filters(reviews, queries, False).collect()},
    )


def test_both_ways_of_joining_parameters_agree(reviews, queries, monkeypatch):
    top, loose, strict = answers(reviews, queries)
    rows = reviews.collect()
    for q in queries.collect():
        mine = [r for r in rows if r.country == q.country]
        best = sorted(mine, key=lambda r: (-r.points, r.id))[:3]
        assert [t[2] for t in top if t[0] == q.qid] == [r.id for r in best]
        priced = [r for r in mine if r.price is not None]
        assert loose[q.qid] == sum(r.points >= q.min_points and r.price <= q.max_price for r in priced)
        assert strict[q.qid] == sum(r.points > q.min_points and r.price < q.max_price for r in priced)
    monkeypatch.setattr(workspace, "bounded_rows", lambda df, *a: None)
    assert answers(reviews, queries) == (top, loose, strict)


def test_frequent_key_is_cut_on_the_shuffled_path(reviews, queries, monkeypatch, plan):
    monkeypatch.setattr(workspace, "bounded_rows", lambda df, *a: None)
    joined = workspace.join_parameters(reviews, queries, ["country"])
    assert "_slice" in plan(joined)
    hot = reviews.where("country = 'Xland'").select(
        F.pmod(F.xxhash64("id"), F.lit(workspace.JOIN_SLICES)).alias("s")
    )
    sizes = [r["count"] for r in hot.groupBy("s").count().collect()]
    assert len(sizes) == workspace.JOIN_SLICES and max(sizes) < 300 / 4


def test_bounded_rows(spark):
    assert workspace.bounded_rows(spark.range(5), 4) is None
    assert len(workspace.bounded_rows(spark.range(5), 5)) == 5


def test_shared_folder_is_read_from_the_session(spark, tmp_path):
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if set_to:
        assert workspace.shared_folder(spark) == set_to.rstrip("/")
    assert workspace.new_folder(spark, "a") != workspace.new_folder(spark, "a")


def test_merging_graphs_matches_or_creates(spark):
    schema = (
        "id long, points int, title string, taster_name string, taster_twitter_handle string, "
        "country string, province string"
    )
    old = spark.createDataFrame([(1, 90, "a", "T", "@t", "X", "P"), (2, 80, "b", "U", None, "Y", None)], schema)
    new = spark.createDataFrame([(1, 95, None, "T", None, "X", "P"), (3, 70, "c", None, None, "Y", "P")], schema)
    g = graphs.merge_graph(graphs.build_graph(old), graphs.build_graph(new))
    assert sorted(tuple(r) for r in g.review.select("id", "points", "title").collect()) == [
        (1, 95, None), (2, 80, "b"), (3, 70, "c"),
    ]
    assert sorted(tuple(r) for r in g.person.collect()) == [("T", None), ("U", None)]
    assert sorted(tuple(r) for r in g.from_country.collect()) == [(1, "X"), (2, "Y"), (3, "Y")]
    assert sorted(tuple(r) for r in g.located_in.collect()) == [("P", "X"), ("P", "Y")]
    twice = graphs.merge_graph(g, graphs.build_graph(new))
    assert twice.tasted_by.count() == g.tasted_by.count()


def test_stored_vectors_are_checked(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0])], "id int, vector array<float>")
    assert stored_vectors(df, 2).first().vector == pytest.approx([0.6, 0.8])
    with pytest.raises(Exception, match="vector size is not 3"):
        stored_vectors(df, 3).collect()
