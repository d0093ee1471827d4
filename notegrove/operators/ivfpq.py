"""Approximate nearest neighbours: coarse lists plus product-quantised residuals.

Training and encoding are Spark jobs over all vectors; only the codebooks, whose size is
fixed by the settings, are held on the driver and sent to the tasks. The vectors lie in order
of their list and have a place there. The codes lie in a folder per list and carry the place;
a vector about as near to a second list's centre is filed there too, so that a search that
probes few lists does not miss it at the border. A search reads the codes of the probed lists,
and then the vectors at the places of the few best only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.operators.knn import (
    DIGITS,
    QUERY_BLOCK_BYTES,
    TILE_SCORES,
    BestOf,
    matrix_of,
    query_blocks,
    unit_rows,
)
from notegrove.operators.topk import top_k_per
from notegrove.schema import ANN_LISTS, ANN_PROBES, ANN_SUBVECTORS, TOP_K
from notegrove.sources.store import MAX_IDS, OrderedRows, write_ordered
from notegrove.workspace import MAX_PARAMETER_ROWS, bounded_rows, new_folder, remove

CODES = 256  # one byte per sub-vector
# Queries scored at a time against a list.
TILE_QUERIES = 64
# A vector is filed in a second list whose centre is at most so many times as far.
SECOND_LIST = 1.1
# Stands for a missing id in a task: it comes behind every other.
NO_ID = 2**63 - 1


@dataclass(frozen=True)
class AnnIndex:
    """``vectors``: place, id, list_id, vector; ``codes``: place, codes by ``list_id``, a
    second time for vectors at a border; ``centroids``; ``books[m, code, dim/m]``."""

    path: str
    centroids: np.ndarray
    books: np.ndarray
    vectors: OrderedRows
    codes: DataFrame


# Vectors that a task keeps in memory, in double precision, while the lists' centres are found.
VECTORS_PER_TASK = 10_000
# Fixed value: the usual size of a list.
VECTORS_PER_LIST = 5_000


def lists_for(n: int) -> int:
    """A number of lists that keeps them at their usual size, ``ANN_LISTS`` at least."""
    return max(min(ANN_LISTS, n), round(n / VECTORS_PER_LIST))


def build_ann_index(
    vectors: DataFrame,
    *,
    lists: int | None = None,
    subvectors: int = ANN_SUBVECTORS,
    codes: int = CODES,
    rounds: int = 8,
    id_col: str = "id",
    vector_col: str = "vector",
    path: str | None = None,
    seed: int = 7,
) -> AnnIndex:
    """Train on all vectors, encode them and write the index.

    The number of lists follows the number of vectors (``lists_for``) unless it is given;
    fewer vectors than lists or codes are refused, since each needs a vector of its own to
    start from.
    """
    spark = vectors.sparkSession
    path = path or new_folder(spark, "ann-index")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")
    ).where(F.col("vector").isNotNull())
    # Training reads the vectors once per round: from a file, not from their lineage.
    rows.write.parquet(f"{path}/vectors")
    rows = spark.read.parquet(f"{path}/vectors")

    n = rows.count()
    if n == 0:
        raise ValueError("no vectors to index")
    lists = lists or lists_for(n)
    dim = rows.select(F.size("vector").alias("dim")).first()["dim"]
    if codes > CODES:
        raise ValueError(f"a code is one byte: at most {CODES} codes")
    if dim % subvectors:
        raise ValueError(f"{subvectors} sub-vectors do not divide {dim} dimensions")
    if n < max(lists, codes):
        raise ValueError(f"{n} vectors are too few for {lists} lists and {codes} codes")
    centroids = _coarse(rows, n, dim, lists, seed)
    books = _codebooks(rows, centroids, subvectors, codes, rounds)

    schema = "id long, vector array<float>, list_id int, filed array<struct<list_id:int,codes:binary>>"
    encoded = rows.mapInArrow(_encoder(spark, centroids, books), schema)
    # Ranges over list and id cut a list with a third of all rows into many files.
    ordered = encoded.repartitionByRange("list_id", "id").sortWithinPartitions("list_id", "id")
    ordered.withColumn("place", F.monotonically_increasing_id()).write.parquet(f"{path}/encoded")
    encoded = spark.read.parquet(f"{path}/encoded")
    stored = write_ordered(
        encoded.select("place", "id", "list_id", "vector").repartitionByRange("place").sortWithinPartitions("place"),
        "place",
        f"{path}/by-place",
    )

    # In the codes a list is cut into slices of an even size, one task for each.
    filed = encoded.select("place", F.inline("filed"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = {r["list_id"]: r["count"] for r in filed.groupBy("list_id").count().collect()}
    total = sum(sizes.values())
    slices = [-(-sizes.get(i, 0) * 2 * tasks // total) or 1 for i in range(len(centroids))]
    before = np.cumsum([0, *slices[:-1]]).tolist()
    cut = F.pmod(F.xxhash64("place"), F.get(F.lit(slices), F.col("list_id")))
    task = (F.get(F.lit(before), F.col("list_id")) + cut).cast("int")
    filed.repartitionById(sum(slices), task).write.partitionBy("list_id").parquet(f"{path}/lists")
    remove(spark, f"{path}/encoded")
    remove(spark, f"{path}/vectors")
    return AnnIndex(path, centroids, books, stored, spark.read.parquet(f"{path}/lists"))


def ann_search(
    index: AnnIndex,
    queries: DataFrame,
    k: int = TOP_K,
    *,
    nprobes: int | None = ANN_PROBES,
    refine: int | None = 10,
    quantised: bool = True,
    named: bool = False,
    vector_col: str = "vector",
    max_block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """``qid, id, score, rank`` from the ``nprobes`` lists nearest to each query.

    With ``quantised`` the first pass reads the codes only and keeps the ``refine * k`` best
    places per query (of equal ones the lower); the second scores the vectors at these places
    exactly (``refine=None`` trusts the codes). Without it every vector whose first list is
    probed is scored exactly; with all lists probed that is the exact search. ``nprobes=None``
    probes all lists, however many there are, and so does a number beyond theirs. A row without
    an id comes behind all that are level with it; ``named`` leaves it out, where hits are to be
    joined to their rows.
    """
    found = None
    dim = index.centroids.shape[1]
    for names, matrix in query_blocks(queries, vector_col, dim, max_block_bytes):
        part = _search_block(index, names, matrix, queries, k, nprobes, refine, quantised, named)
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("no queries")
    return found


def _search_block(index, names, matrix, queries, k, nprobes, refine, quantised, named) -> DataFrame:
    spark = index.codes.sparkSession
    every = nprobes is None or nprobes >= len(index.centroids)
    near = None if every else _nearest_lists(matrix, index.centroids, nprobes)
    qid = queries.schema["qid"].dataType.simpleString()
    schema = f"qid {qid}, id long, score double"
    order = [F.desc("score"), F.asc_nulls_last("id")]
    kept = F.col("id").isNotNull() if named else F.lit(True)
    if not quantised:
        rows = _probed(index.vectors.rows, near).where(kept).select("id", "list_id", "vector")
        scan = _prober(spark, names, matrix, near, index, k, False)
        found = top_k_per(rows.mapInArrow(scan, schema), ["qid"], order, k)
        return found.withColumn("id", F.nullif(F.col("id"), F.lit(NO_ID)))
    best = first_pass(index, names, matrix, near, schema, k * (refine or 1))

    if refine is None:
        rows = _at_places(index, best, len(names) * k).select("qid", "id", "score")
    else:
        rows = _at_places(index, best, len(names) * k * refine).select("qid", "id", "vector")
        rows = rows.mapInArrow(_rescorer(spark, names, matrix), schema)
    return top_k_per(rows.where(kept), ["qid"], order, k)


def first_pass(index: AnnIndex, names, matrix, near, schema: str, keep: int) -> DataFrame:
    """``qid, place, score`` of the best by their codes. Every task sends ``keep`` different
    places per query; a place that is filed twice counts by its better score."""
    rows = _probed(index.codes, near).select(F.col("place").alias("id"), "list_id", "codes")
    scan = _prober(index.codes.sparkSession, names, matrix, near, index, 2 * keep, True)
    once = rows.mapInArrow(scan, schema).groupBy("qid", "id").agg(F.max("score").alias("score"))
    found = top_k_per(once, ["qid"], [F.desc("score"), F.asc("id")], keep)
    return found.select("qid", F.col("id").alias("place"), "score")


def _at_places(index: AnnIndex, best: DataFrame, at_most: int) -> DataFrame:
    """``best`` with the stored columns. A bounded list is collected and opens the files (a
    short one, the pages) of its places only."""
    rows = bounded_rows(best) if at_most <= MAX_PARAMETER_ROWS else None
    if rows is None:
        return index.vectors.rows.join(best, "place")
    places = sorted({r["place"] for r in rows})
    few = index.vectors.at(places) if len(places) <= MAX_IDS else index.vectors.within(places)
    return few.join(F.broadcast(best.sparkSession.createDataFrame(rows, best.schema)), "place")


def _probed(rows: DataFrame, near: np.ndarray | None) -> DataFrame:
    """The rows of the lists that any query probes; of all lists without ``near``."""
    return rows if near is None else rows.where(F.col("list_id").isin(sorted({int(i) for i in near.ravel()})))


def _nearest_lists(matrix: np.ndarray, centroids: np.ndarray, nprobes: int) -> np.ndarray:
    """The lists each query probes, worked out for a few queries at a time."""
    step = max(1, TILE_SCORES // len(centroids))
    parts = [
        np.argsort(-(matrix[at : at + step] @ centroids.T), axis=1, kind="stable")[:, :nprobes]
        for at in range(0, len(matrix), step)
    ]
    return np.concatenate(parts)


def training_parts(rows: DataFrame, n: int) -> DataFrame:
    """The vectors in parts of about ``VECTORS_PER_TASK``. Spark's files are split by their
    compressed size, of which sparse vectors take many times as much in memory."""
    parts = -(-n // VECTORS_PER_TASK)
    return rows if rows.rdd.getNumPartitions() >= parts else rows.repartition(parts, "id")


def _coarse(rows: DataFrame, n: int, dim: int, lists: int, seed: int) -> np.ndarray:
    # The vector of a text without a word is zero: it has no direction to move a centre in, and
    # KMeans refuses it. It is filed like any other, in the first list, since it is near to none.
    rows = rows.where(F.exists("vector", lambda x: x != 0))
    if rows.isEmpty():
        return np.zeros((1, dim))
    points = training_parts(rows, n).select(array_to_vector("vector").alias("features"))
    model = KMeans(k=lists, seed=seed, maxIter=10, distanceMeasure="cosine").fit(points)
    return unit_rows(np.array(model.clusterCenters(), dtype=np.float64))


def _nearest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The closest code of each point, by squared distance."""
    out = np.empty(len(points), dtype=np.int64)
    step = max(1, TILE_SCORES // len(book))
    half = (book**2).sum(axis=1) / 2
    for at in range(0, len(points), step):
        out[at : at + step] = np.argmin(half - points[at : at + step] @ book.T, axis=1)
    return out


def _residuals(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest list of each vector, and what its centre leaves of the unit vector."""
    vectors = unit_rows(vectors)
    lists = np.argmax(vectors @ centroids.T, axis=1)
    return lists, vectors - centroids[lists]


def _codebooks(
    rows: DataFrame, centroids: np.ndarray, m: int, codes: int, rounds: int
) -> np.ndarray:
    """All ``m`` codebooks at once: each round is one pass that sends ``m * codes`` partial
    sums per task, whatever the number of vectors."""
    spark = rows.sparkSession
    dim = centroids.shape[1]
    first = rows.orderBy(F.xxhash64("id"), "id").limit(codes).select("vector").collect()
    start = np.array([r["vector"] for r in first], dtype=np.float64)
    books = _residuals(start, centroids)[1].reshape(len(start), m, dim // m).transpose(1, 0, 2)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((centroids, books))
        sums = (
            rows.mapInArrow(_partial_sums(shared), "book int, code int, n long, total array<double>")
            .groupBy("book", "code")
            .agg(
                F.sum("n").alias("n"),
                *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dim // m)],
            )
        )
        # m * codes rows: the size of the codebooks themselves.
        moved = books.copy()
        for r in sums.collect():
            moved[r["book"], r["code"]] = np.array(r[3:]) / r["n"]
        books = moved
        shared.destroy()
    return books


def _partial_sums(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, books = shared.value
        m, codes, width = books.shape
        totals, counts = np.zeros_like(books), np.zeros((m, codes), dtype=np.int64)
        for batch in batches:
            rest = _residuals(matrix_of(batch.column("vector"), m * width), centroids)[1]
            for j in range(m):
                part = rest[:, j * width : (j + 1) * width]
                code = _nearest(part, books[j])
                np.add.at(totals[j], code, part)
                counts[j] += np.bincount(code, minlength=codes)
        book, code = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(book, type=pa.int32()),
                pa.array(code, type=pa.int32()),
                pa.array(counts[book, code], type=pa.int64()),
                pa.array(list(totals[book, code]), type=pa.list_(pa.float64())),
            ],
            names=["book", "code", "n", "total"],
        )

    return run


def two_lists(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest list of each unit vector, and the second one or -1 where it is too far."""
    near = vectors @ centroids.T
    first = np.argmax(near, axis=1)
    if len(centroids) < 2:
        return first, np.full(len(first), -1)
    rows = np.arange(len(first))
    # Squared distances of unit vectors.
    nearest = 2 - 2 * near[rows, first]
    near[rows, first] = -np.inf
    second = np.argmax(near, axis=1)
    far = 2 - 2 * near[rows, second] > SECOND_LIST**2 * np.maximum(nearest, 1e-12)
    return first, np.where(far, -1, second)


def encode(vectors: np.ndarray, lists: np.ndarray, centroids: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The codes of unit vectors in the given lists."""
    m, _, width = books.shape
    rest = vectors - centroids[lists]
    codes = np.empty((len(rest), m), dtype=np.uint8)
    for j in range(m):
        codes[:, j] = _nearest(rest[:, j * width : (j + 1) * width], books[j])
    return codes


def _binary(codes: np.ndarray) -> pa.Array:
    """Rows of bytes as an Arrow column, without a copy per row."""
    offsets = np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]
    data = pa.py_buffer(np.ascontiguousarray(codes))
    return pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(offsets), data])


def _encoder(spark: SparkSession, centroids: np.ndarray, books: np.ndarray):
    shared = spark.sparkContext.broadcast((centroids, books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, books = shared.value
        m, _, width = books.shape
        for batch in batches:
            vectors = unit_rows(matrix_of(batch.column("vector"), m * width))
            both = np.stack(two_lists(vectors, centroids), axis=1)
            row, which = np.nonzero(both >= 0)
            lists = both[row, which]
            filed = pa.StructArray.from_arrays(
                [pa.array(lists, pa.int32()), _binary(encode(vectors[row], lists, centroids, books))],
                names=["list_id", "codes"],
            )
            offsets = pa.array(np.append(0, np.cumsum((both >= 0).sum(axis=1))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("vector"),
                    pa.array(both[:, 0], type=pa.int32()),
                    pa.ListArray.from_arrays(offsets, filed),
                ],
                names=["id", "vector", "list_id", "filed"],
            )

    return run


def _prober(spark, names, matrix, near, index: AnnIndex, k: int, quantised: bool):
    """Scores the rows of each list against the queries that probe it; without ``near`` all do."""
    asking = None if near is None else {}
    for q, row in enumerate(() if near is None else near):
        for list_id in row:
            asking.setdefault(int(list_id), []).append(q)
    shared = spark.sparkContext.broadcast((names, matrix, asking, index.centroids, index.books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q, asking, centroids, books = shared.value
        m, _, width = books.shape
        best, everyone = BestOf(len(qids), k), range(len(qids))
        for batch in batches:
            ids = batch.column("id").fill_null(NO_ID).to_numpy()
            lists = batch.column("list_id").to_numpy()
            column = batch.column("codes" if quantised else "vector")
            rows = _codes_of(column, m) if quantised else unit_rows(matrix_of(column, m * width))
            for list_id in np.unique(lists):
                at = np.nonzero(lists == list_id)[0]
                mine = np.array(everyone if asking is None else asking.get(int(list_id), ()), dtype=np.int64)
                for i in range(0, len(mine), TILE_QUERIES):
                    some = mine[i : i + TILE_QUERIES]
                    if quantised:
                        scores = code_scores(q[some], centroids[list_id], books, rows[at])
                    else:
                        scores = q[some] @ rows[at].T
                    for j, s in zip(some, scores):
                        enough = np.round(s, DIGITS) >= best.floor[j]
                        if enough.any():
                            best.add(j, ids[at[enough]], s[enough])
        yield best.rows(qids)

    return run


def _codes_of(column: pa.Array, m: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, m) if len(column) else np.empty((0, m), np.uint8)


def code_scores(q: np.ndarray, centroid: np.ndarray, books: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Scores of all codes of a list for each query: its centre's share and each book's."""
    m, _, width = books.shape
    scores = np.repeat((q @ centroid)[:, None], len(codes), axis=1)
    for j in range(m):
        scores += (q[:, j * width : (j + 1) * width] @ books[j].T)[:, codes[:, j]]
    return scores


def _rescorer(spark, names, matrix):
    shared = spark.sparkContext.broadcast((names, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        row_of = {name: i for i, name in enumerate(names.to_pylist())}
        for batch in batches:
            rows = unit_rows(matrix_of(batch.column("vector"), matrix.shape[1]))
            mine = matrix[[row_of[n] for n in batch.column("qid").to_pylist()]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("qid"),
                    batch.column("id"),
                    pa.array(np.round((rows * mine).sum(axis=1), 6), type=pa.float64()),
                ],
                names=["qid", "id", "score"],
            )

    return run
