"""Connected components of a table of links, in rounds of shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notegrove.workspace import materialize

# Links in one file of an intermediate table, about.
LINKS_PER_FILE = 500_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); nodes of one component share a root,
    which is one of them. Any ordered type will do as a node.

    Each round every node moves to the neighbour (or itself) with the least hash, and the
    graph shrinks to the nodes that were moved to. Hashes differ from round to round, so
    the rounds grow with the logarithm of a component's size and not with its diameter. A
    node with very many links costs one row per task: the least is taken before shuffling.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    edges, roots, number = materialize(edges, "links"), None, 0
    while (size := edges.count()) > 0:
        # The tables shrink from round to round, and so do their files.
        files = lambda df: df.coalesce(1 + size // LINKS_PER_FILE)  # noqa: B023, E731
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        key = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(number)).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        moves = both.groupBy("a").agg(F.min(F.least(key("a"), key("b"))).alias("m")).select(F.col("a").alias("node"), F.col("m.v").alias("to"))
        moves = materialize(files(moves), "moves")
        if roots is None:
            roots, whole = moves.withColumnRenamed("to", "root"), 1 + size // LINKS_PER_FILE
        else:
            step = moves.select(F.col("node").alias("root"), "to")
            roots = materialize(roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")).coalesce(whole), "roots")
        moved = edges.join(moves.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(moves.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = materialize(files(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b").distinct()), "links")
        number += 1
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots
