"""Exact nearest neighbours by cosine, for one or many query vectors.

The queries travel to the vectors: every task scans its own rows once, keeps k candidates
per query and sends only those on. No vector is shuffled and no pair table is ever made.

Queries that fit in one block are sent along with the plan. More are written to the shared
folder as a table of their own, and none of them passes the driver: a task holds a slab of
its vectors and streams that table past them, block by block. So the vectors are scanned
once whatever the number of queries, and a task holds one slab, one block and k candidates
for each query of that block. Tasks open the table by Arrow, so the shared folder has to be
one that Arrow knows (a mounted path, HDFS, an object store).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from notegrove.operators.topk import top_k_per
from notegrove.schema import DEFAULT_LIMIT
from notegrove.workspace import new_folder, qualified

# Bytes of query vectors that a task holds at a time.
QUERY_BLOCK_BYTES = 64 * 1024 * 1024
# Bytes of its own vectors that a task holds while stored queries pass.
SLAB_BYTES = 128 * 1024 * 1024
# Scores computed at a time inside a task.
TILE_SCORES = 4_000_000
DIGITS = 6


def matrix_of(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column as a float matrix; every vector has to have ``dim`` numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    if len(lengths) and (column.null_count or flat.null_count or (lengths != dim).any()):
        raise ValueError(f"every vector must have {dim} numbers")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


class BestOf:
    """The k best rows per query seen so far: highest rounded score, then lowest id."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.ids = [np.empty(0, dtype=np.int64)] * n_queries
        self.scores = [np.empty(0)] * n_queries
        # The score a row must reach to matter, per query.
        self.floor = np.full(n_queries, -np.inf)

    def add_all(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of all queries, one column each; only columns that gain are touched."""
        scores = np.round(scores, DIGITS)
        enough = scores >= self.floor
        for j in np.nonzero(enough.any(axis=0))[0]:
            self.add(j, ids[enough[:, j]], scores[enough[:, j], j])

    def add(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores = np.round(scores, DIGITS)
        if len(scores) > self.k:
            # Everything level with the k-th stays in, so the id decides among ties.
            keep = scores >= np.partition(scores, -self.k)[-self.k]
            ids, scores = ids[keep], scores[keep]
        ids = np.concatenate([self.ids[query], ids])
        scores = np.concatenate([self.scores[query], scores])
        best = np.lexsort((ids, -scores))[: self.k]
        self.ids[query], self.scores[query] = ids[best], scores[best]
        if len(best) == self.k:
            self.floor[query] = self.scores[query][-1]

    def rows(self, names: pa.Array) -> pa.RecordBatch:
        sizes = [len(i) for i in self.ids]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(owner, type=pa.int64())),
                pa.array(np.concatenate(self.ids), type=pa.int64()),
                pa.array(np.concatenate(self.scores), type=pa.float64()),
            ],
            names=["qid", "id", "score"],
        )


def query_blocks(
    queries: DataFrame, vector_col: str, dim: int, max_bytes: int = QUERY_BLOCK_BYTES
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The queries' ids and unit vectors, in blocks of bounded size."""
    name_type = to_arrow_type(queries.schema["qid"].dataType)
    most = max(1, max_bytes // (8 * dim))
    rows = queries.select("qid", vector_col).limit(most + 1).collect()
    if len(rows) <= most:
        blocks = [rows]
    else:
        n = queries.count() * 2 // most + 1
        slot = F.pmod(F.xxhash64("qid"), F.lit(n))
        blocks = (
            queries.where(slot == i).select("qid", vector_col).collect() for i in range(n)
        )
    for block in blocks:
        if block:
            yield _block(block, vector_col, dim, name_type)


def _block(rows: list[Row], vector_col: str, dim: int, name_type: pa.DataType) -> tuple[pa.Array, np.ndarray]:
    vectors = [r[vector_col] for r in rows]
    if any(v is None or len(v) != dim or None in v for v in vectors):
        raise ValueError(f"every query vector must have {dim} numbers")
    names = pa.array([r["qid"] for r in rows], type=name_type)
    return names, unit_rows(np.array(vectors, dtype=np.float64))


def knn(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_LIMIT,
    *,
    prefilter: Column | None = None,
    id_col: str = "id",
    vector_col: str = "vector",
    max_block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """``qid, id, score, rank`` of the k rows nearest to each of ``queries(qid, vector)``.

    ``prefilter`` is applied to the rows before the search, so k rows come back whenever
    that many pass. To filter afterwards, join the hits to their rows and use ``where``.
    """
    spark = vectors.sparkSession
    qid = queries.schema["qid"]
    schema = T.StructType(
        [
            T.StructField("qid", qid.dataType),
            T.StructField("id", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    head = vectors.where(F.col(vector_col).isNotNull()).select(F.size(vector_col).alias("n")).first()
    if head is None:
        return spark.createDataFrame([], schema).withColumn("rank", F.lit(0))
    dim = head["n"]
    if prefilter is not None:
        vectors = vectors.where(prefilter)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")
    ).where(F.col("vector").isNotNull())
    most = max(1, max_block_bytes // (8 * dim))
    few = queries.select("qid", vector_col).limit(most + 1).collect()
    if not few:
        return spark.createDataFrame([], schema).withColumn("rank", F.lit(0))
    if len(few) <= most:
        scan = _scan(spark, *_block(few, vector_col, dim, to_arrow_type(qid.dataType)), k)
    else:
        path = store_queries(queries, vector_col, dim)
        scan = _scan_stored(path, dim, most, k, to_arrow_type(qid.dataType))
    return top_k_per(rows.mapInArrow(scan, schema), ["qid"], [F.desc("score"), F.asc("id")], k)


Scan = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _scan(spark, names: pa.Array, matrix: np.ndarray, k: int) -> Scan:
    shared = spark.sparkContext.broadcast((names, matrix))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q = shared.value
        best = BestOf(len(qids), k)
        for ids, rows in _slabs(batches, q.shape[1], 0):
            _add_tiles(best, ids, rows, q)
        yield best.rows(qids)

    return scan


def store_queries(queries: DataFrame, vector_col: str, dim: int) -> str:
    """Write ``qid, vector`` to the shared folder; vectors of another length are refused."""
    path = new_folder(queries.sparkSession, "queries")
    vector = F.col(vector_col).cast("array<double>")
    refused = F.raise_error(F.lit(f"every query vector must have {dim} numbers")).cast("array<double>")
    whole = (F.size(vector) == dim) & F.forall(vector, lambda x: x.isNotNull())
    queries.select("qid", F.when(whole, vector).otherwise(refused).alias("vector")).write.parquet(path)
    return qualified(queries.sparkSession, path)


def _scan_stored(path: str, dim: int, block: int, k: int, name_type: pa.DataType) -> Scan:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in _slabs(batches, dim, SLAB_BYTES):
            for qids, q in stored_blocks(path, dim, block):
                best = BestOf(len(qids), k)
                _add_tiles(best, ids, rows, q)
                yield best.rows(qids.cast(name_type))

    return scan


def stored_blocks(path: str, dim: int, block: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The ids and unit vectors of a table of ``store_queries``, at most ``block`` at a time."""
    files, folder = pyarrow.fs.FileSystem.from_uri(path)
    table = pyarrow.dataset.dataset(folder, filesystem=files, format="parquet")
    read = table.to_batches(columns=["qid", "vector"], batch_size=block, batch_readahead=1, fragment_readahead=1)
    held: list[pa.RecordBatch] = []
    for batch in read:
        # Small files make small batches; they are joined while they fit.
        if held and sum(map(len, held)) + len(batch) > block:
            yield _joined(held, dim)
            held = []
        held.append(batch)
    if any(map(len, held)):
        yield _joined(held, dim)


def _joined(batches: list[pa.RecordBatch], dim: int) -> tuple[pa.Array, np.ndarray]:
    table = pa.Table.from_batches(batches)
    return table["qid"].combine_chunks(), unit_rows(matrix_of(table["vector"], dim))


def _slabs(batches: Iterator[pa.RecordBatch], dim: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors of a task's rows, some ``size`` bytes at a time, a batch at least."""
    ids: list[np.ndarray] = []
    rows: list[np.ndarray] = []
    for batch in batches:
        if not len(batch):
            continue
        ids.append(batch.column("id").to_numpy(zero_copy_only=False))
        rows.append(unit_rows(matrix_of(batch.column("vector"), dim)))
        if sum(r.nbytes for r in rows) >= size:
            yield np.concatenate(ids), np.concatenate(rows)
            ids, rows = [], []
    if ids:
        yield np.concatenate(ids), np.concatenate(rows)


def _add_tiles(best: BestOf, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray) -> None:
    step = max(1, TILE_SCORES // len(queries))
    for at in range(0, len(ids), step):
        best.add_all(ids[at : at + step], rows[at : at + step] @ queries.T)
