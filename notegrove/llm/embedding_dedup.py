"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are brought to length one; a table's key is the places in which ``BITS`` random
projections fall when cut into steps of ``WIDTH``. Close vectors fall together in at least one
of ``TABLES`` tables nearly always. Whoever shares a key and a label is compared by the cosine
in double precision.

Equal vectors of a label are one vertex with a count, so copies are never compared. A key
shared by many vertices is cut into blocks; each pair of blocks is a group of its own with
at most twice ``BLOCK`` vectors, compared by one matrix product. A pair that meets in several
tables counts in the first of them only. A task gives back a count and one spanning link for
each vector it has seen, not the pairs.

Recall: a pair with cosine 0.93 lies 0.374 apart and shares one projection's step with
probability 0.85, a whole key with 0.85^16 = 0.076, and one of 64 keys with 0.994; at 0.95 it
is 0.9996. Unrelated vectors share a key with 1e-5.

Defined results: null and zero vectors, vectors with null or non-finite components and null
labels link with nothing; vectors of other lengths are never compared with each other;
repeated rows and equal vectors link with each other like any others; rows that share an id
are vertices of their own that have the same component, if any of them is linked; an empty
table gives an empty result. Other columns of the input are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notegrove.llm.components import components
from notegrove.workspace import materialize

COSINE = 0.93
TABLES, BITS, WIDTH, SEED = 64, 16, 2.0, 20250117
BLOCK = 512


def projections(dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions, offsets, and the odd multipliers that fold a key's places into one number."""
    rng = np.random.default_rng([SEED, dims])
    shape = TABLES * BITS
    return rng.standard_normal((dims, shape)), rng.uniform(0, WIDTH, shape), rng.integers(1, 1 << 62, (TABLES, BITS)) * 2 + 1


def keys_of(unit: np.ndarray) -> np.ndarray:
    """The key of each vector in each table, as 32-bit numbers."""
    directions, offsets, fold = projections(unit.shape[1])
    places = np.floor((unit @ directions + offsets) / WIDTH).astype(np.int64).reshape(len(unit), TABLES, BITS)
    with np.errstate(over="ignore"):
        mixed = (places * fold).sum(2)
        mixed ^= (mixed >> 29) * -0x61C8864680B583EB
    return (mixed >> 32).astype(np.int32)


VERTEX_SQL = "v long, vector array<double>, keys array<int>"


def hashed(vertices: DataFrame) -> DataFrame:
    """Vertices (v, label, vector) with unit vectors and their keys."""
    schema = pa.schema([("v", pa.int64()), ("vector", pa.list_(pa.float64())), ("keys", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            unit: list = [None] * len(vectors)
            keys: list = [None] * len(vectors)
            lengths = np.array([len(x) for x in vectors])
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                x = np.array([vectors[i] for i in at], np.float64)
                x /= np.abs(x).max(1, keepdims=True)  # squares of extreme numbers stay finite
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                for i, u, k in zip(at, x, keys_of(x), strict=True):
                    unit[i], keys[i] = u, k
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(unit, schema.field(1).type), pa.array(keys, schema.field(2).type)], schema=schema)

    return vertices.select("v", "vector").mapInArrow(run, VERTEX_SQL)


def _pairs(x: np.ndarray, keys: np.ndarray, side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of one group (between its two sides, or within its only one) that no
    earlier table brings together. ``keys``: those of the earlier tables."""
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if len(right):
        i, j = np.nonzero(x[left] @ x[right].T >= least)
        i, j = left[i], right[j]
    else:
        i, j = np.nonzero(np.triu(x @ x.T >= least, 1))
    if len(i) and keys.shape[1]:
        fresh = ~(keys[i] == keys[j]).any(1)
        i, j = i[fresh], j[fresh]
    return i, j


GROUP = ("table", "label", "d", "key", "lo", "hi")
SEEN = pa.schema([("v", pa.int64()), ("linked", pa.int64()), ("to", pa.int64())])


def _starts(rows: pa.Table) -> np.ndarray:
    """Where the groups of sorted rows begin."""
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for name in GROUP:
        column = rows[name].combine_chunks()
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _links_of(rows: pa.Table, starts: np.ndarray, least: float) -> pa.RecordBatch:
    """What whole groups tell of their vertices: links counted, and one that can be reached."""
    flat = lambda c: rows[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vector, keys, side = flat("vector"), flat("keys"), rows["side"].to_numpy()
    ends = np.append(starts[1:], rows.num_rows)
    d, t = rows["d"].to_numpy()[starts].astype(np.int64), rows["table"].to_numpy()[starts].astype(np.int64)
    members = ends - starts
    x_at, k_at = np.append(0, np.cumsum(members * d)), np.append(0, np.cumsum(members * t))
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for g, (s, e) in enumerate(zip(starts, ends, strict=True)):
        x, k = vector[x_at[g] : x_at[g + 1]].reshape(e - s, d[g]), keys[k_at[g] : k_at[g + 1]].reshape(e - s, t[g])
        i, j = _pairs(x, k, side[s:e], least)
        if len(i):
            left.append(i + s)
            right.append(j + s)
    i, j = np.concatenate(left), np.concatenate(right)
    n, v = rows["n"].to_numpy(), rows["v"].to_numpy()
    linked = np.zeros(len(v), np.int64)
    np.add.at(linked, i, n[j])
    np.add.at(linked, j, n[i])
    root = np.arange(len(v))
    while True:  # least place that can be reached
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    at = np.flatnonzero(linked > 0)
    return pa.RecordBatch.from_arrays([pa.array(v[at]), pa.array(linked[at]), pa.array(v[root[at]])], schema=SEEN)


def links(vertices: DataFrame, least: float = COSINE) -> DataFrame:
    """Rows (v, linked, to): to how many vectors of other vertices v is linked, as far as one
    group has seen, and one vertex that it is linked with, directly or by way of others.

    ``vertices``: (v, label, vector, keys, n), stored.
    """
    each = vertices.select("v", "label", F.size("vector").alias("d"), F.posexplode("keys").alias("table", "key"))
    group = ["table", "label", "d", "key"]
    sizes = each.groupBy(*group).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    found = each.join(sizes, group).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("v", "table"), F.col("blocks")).cast("int"))
    # A vertex of block b is the left side of (b, c) for c >= b and the right one for c < b.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = found.withColumn("other", other).select(
        "v", *group, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), (F.col("block") > F.col("other")).cast("int").alias("side")
    )
    # Of the keys only those of earlier tables are looked at.
    earlier = F.slice("keys", 1, F.col("table")).alias("keys")
    rows = pairs.join(vertices.select("v", "vector", "keys", "n"), "v").select("v", "n", "side", *GROUP, "vector", earlier)
    rows = rows.repartition(*GROUP).sortWithinPartitions(*GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Most groups are two or three rows: all that end within a batch are told at once.
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([*held, batch])
            starts = _starts(rows)
            if len(starts) > 1:
                yield _links_of(rows.slice(0, starts[-1]), starts[:-1], least)
            held = rows.slice(starts[-1]).to_batches()
        if held:
            yield _links_of(pa.Table.from_batches(held), np.zeros(1, np.int64), least)

    return rows.mapInArrow(run, "v long, linked long, to long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    x = F.col("vector")
    usable = F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0)
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(x, lambda e: e != 0)
    # -0.0 and 0.0 are equal components: adding 0.0 makes them one.
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.transform(F.col(vector_col), lambda e: e.cast("double") + F.lit(0.0)).alias("vector"))
    rows = rows.withColumn("class", F.when(usable & whole, F.md5(F.encode(F.to_json(F.struct("label", "vector")), "utf-8"))))
    rows = materialize(rows, "vectors")
    classes = rows.filter("class IS NOT NULL").groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = materialize(classes.withColumn("v", F.monotonically_increasing_id()), "classes")
    vertices = hashed(classes).join(classes.select("v", "label", "n"), "v")
    vertices = materialize(vertices, "vertices")
    seen = materialize(links(vertices, least), "vertex-links")
    counts = seen.groupBy("v").agg(F.sum("linked").alias("linked"))
    roots = components(seen.select(F.col("v").alias("a"), F.col("to").alias("b")))
    joined = classes.select("class", "v", "n", "first").join(counts, "v", "left").join(roots.withColumnRenamed("node", "v"), "v", "left").withColumn("root", F.coalesce("root", "v"))
    least_id = joined.groupBy("root").agg(F.min("first").alias("component"))
    told = joined.join(least_id, "root").select("class", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component")
    out = rows.select("vec_id", "class").join(told, "class", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
