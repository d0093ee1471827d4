"""A stored property graph: every vertex with its neighbours beside it.

``reviews``   id, properties, tasters, countries, provinces[province, countries], bucketed by id
``near``      kind, name, name_lc, slice, entries: the reviews around a taster, country or
              province, best points first, cut into slices of a bounded size
``located``   province, province_lc, countries
``person``    taster_name, taster_twitter_handle

One and two hops are read from a row, so questions join nothing on a name that many reviews
share. A top list reads the first entries of a name's slices, however many there are. Graphs
are merged bucket by bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.operators.clean import price_label
from notegrove.operators.graph import Graph
from notegrove.operators.predicates import present
from notegrove.operators.topk import by_points, count_by, top_k
from notegrove.schema import TOP_K
from notegrove.sources.tables import upsert
from notegrove.workspace import new_folder, read_bucketed, write_bucketed

# Entries in a slice of a name's reviews, about.
SLICE = 4096
KINDS = {"taster": "tasters", "country": "countries", "province": "provinces.province"}
ARRAYS = ("tasters", "countries", "provinces")


@dataclass(frozen=True)
class StoredGraph:
    path: str
    buckets: int
    reviews: DataFrame
    near: DataFrame
    located: DataFrame
    person: DataFrame

    @property
    def properties(self) -> list[str]:
        return [c for c in self.reviews.columns if c not in ARRAYS]

    def around(self, kind: str, name: str, exact: bool = False) -> DataFrame:
        """The slices of a taster, country or province; equal up to case unless ``exact``."""
        same = F.col("name_lc") == F.lower(F.lit(name))
        return self.near.where((F.col("kind") == kind) & same & ((F.col("name") == name) if exact else F.lit(True)))


def _names(edges: DataFrame, key: str, name: str) -> DataFrame:
    return edges.groupBy("id").agg(F.sort_array(F.collect_set(key)).alias(name))


def _sliced(edges: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Edges with a slice of their name, and the names of several slices. Those are at most
    one in ``SLICE`` edges, so their list is sent to the edges."""
    hubs = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SLICE)
    hubs = hubs.select(*keys, F.ceil(F.col("n") / SLICE).cast("int").alias("slices"))
    cut = F.pmod(F.xxhash64("id"), F.coalesce("slices", F.lit(1))).cast("int")
    return edges.join(F.broadcast(hubs), list(keys), "left").withColumn("slice", cut).drop("slices"), hubs


def _with_countries(reviews: DataFrame, located: DataFrame) -> DataFrame:
    """Reviews with (province, countries) for each of their ``province_names``."""
    edges, hubs = _sliced(reviews.select("id", F.explode("province_names").alias("province")), "province")
    every = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
    ends = located.join(F.broadcast(hubs), "province", "left").select("province", "countries", F.explode(every).alias("slice"))
    hops = edges.join(ends, ["province", "slice"], "left")
    found = F.coalesce("countries", F.array().cast("array<string>")).alias("countries")
    places = hops.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("province", found))).alias("provinces"))
    return reviews.drop("province_names").join(places, "id", "left")


def _write(reviews: DataFrame, pairs: DataFrame, person: DataFrame, path: str, buckets: int) -> StoredGraph:
    """Store reviews (with tasters, countries, province_names) and located pairs."""
    spark = reviews.sparkSession
    located = pairs.groupBy("province").agg(F.sort_array(F.collect_set("country")).alias("countries"))
    located = located.withColumn("province_lc", F.lower("province"))
    located.repartitionByRange("province_lc").sortWithinPartitions("province_lc").write.parquet(f"{path}/located")
    located = spark.read.parquet(f"{path}/located")
    person.write.parquet(f"{path}/person")

    whole = _with_countries(reviews, located.drop("province_lc"))
    empty = {c: F.coalesce(c, F.array().cast(whole.schema[c].dataType)) for c in ARRAYS}
    write_bucketed(whole.withColumns(empty).repartition(buckets, "id"), f"{path}/reviews", buckets, "id", "id")
    stored = read_bucketed(spark, f"{path}/reviews", buckets, "id", "id")

    points = F.col("points") if "points" in stored.columns else F.lit(0)

    def ends(kind: str) -> Column:
        return F.transform(KINDS[kind], lambda n: F.struct(F.lit(kind).alias("kind"), n.alias("name")))

    edges = stored.select("id", points.alias("points"), F.inline(F.concat(*map(ends, KINDS))))
    rows, _ = _sliced(edges, "kind", "name")
    entry = F.struct(F.col("points").isNull().alias("none"), (-F.col("points")).alias("back"), "id")
    near = rows.groupBy("kind", "name", "slice").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    near = near.select("kind", "name", F.lower("name").alias("name_lc"), "slice", "entries")
    keys = ["kind", "name_lc", "slice"]
    near.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(f"{path}/near")
    return open_graph(spark, path, buckets)


def open_graph(spark: SparkSession, path: str, buckets: int) -> StoredGraph:
    tables = (spark.read.parquet(f"{path}/{name}") for name in ("near", "located", "person"))
    return StoredGraph(path, buckets, read_bucketed(spark, f"{path}/reviews", buckets, "id", "id"), *tables)


def store_graph(graph: Graph, path: str | None = None, buckets: int | None = None) -> StoredGraph:
    """Lay a graph out by vertex. ``buckets`` defaults to the session's shuffle partitions."""
    spark = graph.review.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    reviews = graph.review
    for edges, key, name in (
        (graph.tasted_by, "taster_name", "tasters"),
        (graph.from_country, "country", "countries"),
        (graph.from_province, "province", "province_names"),
    ):
        reviews = reviews.join(_names(edges, key, name), "id", "left")
    return _write(reviews, graph.located_in, graph.person, path or new_folder(spark, "graph"), buckets)


def merge_stored(old: StoredGraph, newer: StoredGraph, path: str | None = None) -> StoredGraph:
    """Match or create: newer vertices replace those with the same key, edges are united.
    Both have the same buckets, so their reviews meet without a shuffle."""
    if old.buckets != newer.buckets:
        raise ValueError("both graphs must have the same number of buckets")
    spark = old.reviews.sparkSession
    renamed = newer.reviews.select(*[F.col(c).alias(f"_{c}") for c in newer.reviews.columns])
    both = old.reviews.join(renamed, F.col("id") == F.col("_id"), "full")
    is_new = F.col("_id").isNotNull()
    kept = [F.when(is_new, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in old.properties if f"_{c}" in renamed.columns]

    def united(column: str) -> Column:
        a, b = (F.coalesce(c, F.array().cast("array<string>")) for c in (column, f"_{column}"))
        return F.sort_array(F.array_union(a, b))

    reviews = both.select(
        *kept,
        united("tasters").alias("tasters"),
        united("countries").alias("countries"),
        F.sort_array(
            F.array_union(
                F.coalesce("provinces.province", F.array().cast("array<string>")),
                F.coalesce("_provinces.province", F.array().cast("array<string>")),
            )
        ).alias("province_names"),
    )
    pairs = old.located.unionByName(newer.located).select("province", F.explode("countries").alias("country"))
    person = upsert(old.person, newer.person, "taster_name")
    return _write(reviews, pairs, person, path or new_folder(spark, "graph"), old.buckets)


# --- Questions ---


def reviews_in_country(graph: StoredGraph) -> DataFrame:
    """One hop: reviews with their country."""
    return graph.reviews.select(*graph.properties, F.explode("countries").alias("country"))


def reviews_in_province(graph: StoredGraph) -> DataFrame:
    """Two hops: reviews with their province and its countries, one row for each country the
    province lies in."""
    rows = graph.reviews.select(*graph.properties, F.inline("provinces"))
    return rows.select(*graph.properties, "province", F.explode("countries").alias("country"))


def _first(graph: StoredGraph, kind: str, name: str, k: int) -> DataFrame:
    """The best k reviews around a name: ``id``, the name, and what they are sorted by."""
    entries = F.inline(F.slice("entries", 1, k))
    return top_k(graph.around(kind, name).select(F.col("name").alias(kind), entries), _best(), k)


def _best() -> list[Column]:
    return [F.asc("none"), F.asc("back"), F.asc("id")]


def _rows_of(graph: StoredGraph, hits: DataFrame, k: int) -> DataFrame:
    """A bounded number of hits with their reviews' properties."""
    found = hits.drop("none", "back").collect()
    ids = sorted({r["id"] for r in found})
    few = hits.sparkSession.createDataFrame(found, hits.drop("none", "back").schema)
    rows = graph.reviews.where(F.col("id").isin(ids)).select(*graph.properties)
    return rows.join(F.broadcast(few), "id")


def _labelled(rows: DataFrame) -> DataFrame:
    return rows.withColumn("price_label", price_label(F.col("price")))


def top_by_country(graph: StoredGraph, country: str, k: int = TOP_K) -> DataFrame:
    return _labelled(_rows_of(graph, _first(graph, "country", country, k), k))


def top_by_province(graph: StoredGraph, province: str, k: int = TOP_K) -> DataFrame:
    """A review of a province in two countries is two rows."""
    same = F.col("province_lc") == F.lower(F.lit(province))
    ends = graph.located.where(same).select("province", F.explode("countries").alias("country"))
    hits = top_k(_first(graph, "province", province, k).join(ends, "province"), [*_best(), F.asc("country")], k)
    return _labelled(_rows_of(graph, hits, k))


def most_by_country(
    graph: StoredGraph, hits: DataFrame, min_points: float, k: int = TOP_K
) -> DataFrame:
    """``country, n_reviews`` of the countries with most of the ``hits(id)`` that reach the
    points."""
    good = graph.reviews.where(F.col("points") >= min_points).select("id", "countries")
    found = good.join(hits.select("id"), "id", "left_semi")
    return count_by(found.select(F.explode("countries").alias("country")), "country", k, "n_reviews")


def with_several_tasters(
    graph: StoredGraph, country: str | None = None, at_least: int = 2
) -> DataFrame:
    """``id, n_tasters, country`` of reviews tasted by several people."""
    several = graph.reviews.where(F.size("tasters") >= at_least)
    rows = several.select("id", F.size("tasters").cast("long").alias("n_tasters"), F.explode("countries").alias("country"))
    return rows if country is None else rows.where(F.lower("country") == F.lower(F.lit(country)))


def shared_variety(
    graph: StoredGraph, country: str, favourites: DataFrame, k: int = TOP_K
) -> DataFrame:
    """The best reviews of a country whose variety occurs among ``favourites(id)``."""
    liked = graph.reviews.join(favourites.select("id"), "id", "left_semi")
    varieties = liked.where(present("variety")).select("variety").distinct()
    rows = reviews_in_country(graph).where(F.lower("country") == F.lower(F.lit(country)))
    return top_k(rows.join(varieties, "variety", "left_semi"), by_points(), k)


def by_taster(graph: StoredGraph, taster: str, where: Column | None = None) -> DataFrame:
    """Reviews tasted by one person; only the ids of that person are shuffled."""
    ids = graph.around("taster", taster, exact=True).select(F.explode("entries.id").alias("id"))
    rows = graph.reviews.select(*graph.properties).join(ids, "id")
    return rows if where is None else rows.where(where)


def edges(graph: StoredGraph, kind: str) -> DataFrame:
    """``id`` and name of all edges of a kind."""
    return graph.reviews.select("id", F.explode(KINDS[kind]).alias("name"))


def names(graph: StoredGraph, kind: str) -> DataFrame:
    """The different names of a kind."""
    return graph.near.where(F.col("kind") == kind).select("name").distinct()

