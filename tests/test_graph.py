import pytest
from pyspark.sql import functions as F

from notegrove.operators import adjacency
from notegrove.operators import graph as graphs

ROWS = [
    # id, points, title, variety, price, taster, handle, country, province, version
    (1, 90, "a", "Red", 10.0, "T1", "@1", "X", "Hills", 1),
    (2, 95, "b", "Red", None, None, None, "X", "Hills", 2),
    (3, 80, "c", "White", 5.0, "T1", None, "Y", "Hills", 3),
    (4, 70, "d", "White", 5.0, "T2", "@2", "Y", None, 4),
    (1, 91, "a2", "Red", None, "T2", "@2", "X", "Hills", 5),
]
SCHEMA = (
    "id long, points int, title string, variety string, price double, taster_name string, "
    "taster_twitter_handle string, country string, province string, version int"
)


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def graph(reviews):
    return graphs.build_graph(reviews, version=["version"])


@pytest.fixture(scope="module")
def stored(graph, tmp_path_factory):
    return adjacency.store_graph(graph, str(tmp_path_factory.mktemp("g") / "graph"), 4)


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_last_write_sets_the_vertex_nulls_included(graph):
    one = graph.review.where("id = 1").collect()
    assert [(r.points, r.title, r.price) for r in one] == [(91, "a2", None)]
    assert pairs(graph.person) == [("T1", None), ("T2", "@2")]


def test_edges_need_only_their_own_columns(graph):
    assert pairs(graph.from_country) == [(1, "X"), (2, "X"), (3, "Y"), (4, "Y")]
    assert pairs(graph.from_province) == [(1, "Hills"), (2, "Hills"), (3, "Hills")]
    assert pairs(graph.located_in) == [("Hills", "X"), ("Hills", "Y")]


def test_chained_filters_hide_reviews_without_a_taster(reviews):
    chained = graphs.build_graph(reviews, version=["version"], chain_filters=True)
    assert pairs(chained.from_country) == [(1, "X"), (3, "Y"), (4, "Y")]
    assert pairs(chained.from_province) == [(1, "Hills"), (3, "Hills")]
    assert chained.review.count() == 4


def test_shared_province_name_fans_out(stored):
    rows = adjacency.top_by_province(stored, "hills", 10).orderBy(F.desc("points"), "id", "country").collect()
    assert [(r.id, r.country) for r in rows] == [
        (2, "X"), (2, "Y"), (1, "X"), (1, "Y"), (3, "X"), (3, "Y"),
    ]
    assert [(r.id, r.country) for r in adjacency.top_by_province(stored, "HILLS", 1).collect()] == [(2, "X")]
    assert adjacency.reviews_in_province(stored).count() == 6


def test_label_only_where_there_is_no_price(stored):
    rows = adjacency.top_by_country(stored, "Y").orderBy(F.desc("points")).collect()
    assert [(r.id, r.price_label) for r in rows] == [(3, "5.0"), (4, "5.0")]
    assert adjacency.top_by_country(stored, "x", 1).first().price_label == "Not available"


def test_tasters_varieties_and_counts(stored, spark):
    assert pairs(adjacency.with_several_tasters(stored, "x")) == [(1, 2, "X")]
    liked = spark.createDataFrame([(3,)], "id long")
    assert [r.id for r in adjacency.shared_variety(stored, "y", liked).collect()] == [3, 4]
    assert [r.id for r in adjacency.by_taster(stored, "T2").orderBy("id").collect()] == [1, 4]
    assert adjacency.by_taster(stored, "t2").count() == 0
    hits = spark.createDataFrame([(1,), (2,), (4,)], "id long")
    assert pairs(adjacency.most_by_country(stored, hits, 80)) == [("X", 2)]


def test_stored_graph_reads_back(stored, graph, spark):
    again = adjacency.open_graph(spark, stored.path, stored.buckets)
    assert pairs(adjacency.edges(again, "taster")) == pairs(graph.tasted_by)
    assert pairs(adjacency.edges(again, "country")) == pairs(graph.from_country)
    assert pairs(adjacency.names(again, "province")) == pairs(graph.province)


def test_merged_stored_graph_is_the_stored_merged_graph(reviews, tmp_path):
    """A province that gains a country gains it for old reviews too."""
    low, high = (graphs.build_graph(reviews.where(c), version=["version"]) for c in ("version <= 2", "version > 2"))
    apart = [adjacency.store_graph(g, str(tmp_path / n), 3) for g, n in ((low, "low"), (high, "high"))]
    merged = adjacency.merge_stored(*apart, str(tmp_path / "merged"))
    whole = adjacency.store_graph(graphs.merge_graph(low, high), str(tmp_path / "whole"), 3)
    for name in ("reviews", "near", "located", "person"):
        a, b = (sorted(map(str, getattr(g, name).select(*sorted(getattr(g, name).columns)).collect())) for g in (merged, whole))
        assert a == b
    with pytest.raises(ValueError):
        adjacency.merge_stored(apart[0], adjacency.store_graph(high, str(tmp_path / "five"), 5))


def test_hubs_are_cut_and_names_never_joined(spark, tmp_path, plan, monkeypatch):
    """A province of all reviews lies in many slices; its top list reads their first entries."""
    monkeypatch.setattr(adjacency, "SLICE", 100)
    rows = spark.range(3000).select(
        "id", (F.col("id") * 7919 % 1009).alias("points"), F.lit("t").alias("title"), F.lit(1.0).alias("price"), F.lit("v").alias("variety"),
        F.lit("Hub").alias("province"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("country"),
        F.lit(None).cast("string").alias("taster_name"), F.lit(None).cast("string").alias("taster_twitter_handle"),
    )
    g = adjacency.store_graph(graphs.build_graph(rows), str(tmp_path / "hub"), 4)
    slices = g.near.where("kind = 'province'").select(F.size("entries").alias("n")).collect()
    assert len(slices) == 30 and sum(r.n for r in slices) == 3000 and max(r.n for r in slices) < 200
    best = adjacency.top_by_province(g, "hub", 6).orderBy(F.desc("points"), "id", "country").collect()
    want = sorted(((i * 7919 % 1009, i) for i in range(3000)), key=lambda x: (-x[0], x[1]))[:3]
    assert [(r.points, r.id, r.country) for r in best] == [(p, i, c) for p, i in want for c in "AB"]
    for question in (adjacency.reviews_in_province(g), adjacency.with_several_tasters(g)):
        assert "Exchange" not in plan(question)
    text = plan(g.around("province", "HUB"))
    assert "EqualTo(name_lc,hub)" in text and "EqualTo(kind,province)" in text
