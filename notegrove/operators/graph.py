"""A property graph as vertex and edge tables, built from rows and merged.

``adjacency.store_graph`` lays it out for questions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notegrove.operators.predicates import present
from notegrove.sources.tables import latest, upsert

# The properties kept on a review vertex.
REVIEW_PROPERTIES = (
    "points",
    "title",
    "description",
    "price",
    "variety",
    "winery",
    "vineyard",
    "region_1",
    "region_2",
)


@dataclass(frozen=True)
class Graph:
    """Four vertex tables and four edge tables; every edge holds its two end keys."""

    review: DataFrame  # id, properties
    person: DataFrame  # taster_name, taster_twitter_handle
    country: DataFrame  # country
    province: DataFrame  # province
    tasted_by: DataFrame  # id, taster_name
    from_country: DataFrame  # id, country
    from_province: DataFrame  # id, province
    located_in: DataFrame  # province, country


def build_graph(
    reviews: DataFrame,
    version: Sequence[str] = ("id",),
    chain_filters: bool = False,
    properties: Sequence[str] = REVIEW_PROPERTIES,
) -> Graph:
    """Vertices and edges from rows.

    The newest row of a key sets its vertex's properties, nulls included; edges are the
    distinct pairs. Each edge needs only its own two keys. ``chain_filters`` instead drops
    a row from the country and province edges when it has no taster, and from the province
    edges' location when it has no country, as a single chained statement would.
    """
    kept = [c for c in properties if c in reviews.columns]
    placed = reviews.where(present("taster_name")) if chain_filters else reviews
    provinces = placed.where(present("province"))
    people = reviews.where(present("taster_name"))

    def pairs(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.where(present(a, b)).select(a, b).distinct()

    def vertices(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
        newest = df.withColumn("_version", F.struct(*version))
        rows = newest.select(key, *columns, "_version")
        return latest(rows, key, ["_version"]).drop("_version")

    return Graph(
        review=vertices(reviews, "id", kept),
        person=vertices(people, "taster_name", ["taster_twitter_handle"]),
        country=placed.where(present("country")).select("country").distinct(),
        province=provinces.select("province").distinct(),
        tasted_by=pairs(reviews, "id", "taster_name"),
        from_country=pairs(placed, "id", "country"),
        from_province=pairs(provinces, "id", "province"),
        located_in=pairs(provinces, "province", "country"),
    )


def merge_graph(graph: Graph, newer: Graph) -> Graph:
    """Match or create: newer vertices replace those with the same key, edges are united."""

    def vertices(name: str) -> DataFrame:
        old, new = getattr(graph, name), getattr(newer, name)
        return upsert(old, new, old.columns[0])

    def edges(name: str) -> DataFrame:
        return getattr(graph, name).unionByName(getattr(newer, name)).distinct()

    return Graph(
        review=vertices("review"),
        person=vertices("person"),
        **{
            name: edges(name)
            for name in (
                "country",
                "province",
                "tasted_by",
                "from_country",
                "from_province",
                "located_in",
            )
        },
    )

