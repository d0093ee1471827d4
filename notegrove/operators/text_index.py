"""The inverted index: built once as Parquet tables, then read by every text question.

``forward``      id, field, len, terms, tfs, positions   one row per text, no shuffle
``term_stats``   bucket=..., term, field, df
``blocks``       shard, term, field, first, last, peak, ids, lens, tfs, positions
``records``      shard, id, and the columns to filter and sort by
``field_stats``  field, n_docs, mean_len
``terms, keys``  the vocabulary in order and by deletion keys

Every text keeps its different terms in order, how often each occurs, and all their positions
one behind the other. Such rows, not single postings, are shuffled to the shards.

Postings and records are stored by shard of the records and bucketed by it, so a search meets
both without a shuffle. A word that every record holds is in all shards, not in one task. The
files are sorted by term: a search for few terms reads the pages that hold them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.functions.scores import share_of
from notegrove.functions.text import STANDARD, Analyzer
from notegrove.operators.expansion import Vocabulary, open_vocabulary, write_vocabulary
from notegrove.operators.shards import with_shard
from notegrove.workspace import new_folder, read_bucketed, write_bucketed

# Most postings in a block, the unit that a search can skip, and shards per task's bucket.
BLOCK_POSTINGS = 128
SHARDS_PER_BUCKET = 4
# Tokens that a task groups at once, and blocks that it hands on at once. A shard with more
# tokens is laid out in several runs of ascending ids, each with blocks of its own.
MOST_TOKENS = 1_000_000
BLOCKS_AT_ONCE = 20_000
FORWARD = "id {}, field string, len int, terms array<string>, tfs array<int>, positions array<int>"
BLOCKS = (
    "shard int, term string, field string, first bigint, last bigint, peak double, "
    "ids array<bigint>, lens array<int>, tfs array<int>, positions array<int>"
)


@dataclass(frozen=True)
class TextIndex:
    path: str
    analyzer: Analyzer
    fields: tuple[str, ...]
    buckets: int
    forward: DataFrame
    blocks: DataFrame
    records: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    vocabulary: Vocabulary

    @property
    def shards(self) -> int:
        return self.buckets * SHARDS_PER_BUCKET

    def among(self, reviews: DataFrame, *columns: str) -> DataFrame:
        """``id`` and columns of the records as they lie in the shards, or of ``reviews`` when
        the index was built without one of the columns."""
        stored = set(columns) <= set(self.records.columns)
        return self.records.select("shard", "id", *columns) if stored else reviews.select("id", *columns)

    def terms_of(self, fields: Sequence[str] | None = None) -> DataFrame:
        stats = self.term_stats
        return stats if fields is None else stats.where(F.col("field").isin(list(fields)))


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def forward_rows(
    reviews: DataFrame, fields: Sequence[str], analyzer: Analyzer, id_col: str = "id"
) -> DataFrame:
    """One row per record and non-empty field, with its terms grouped.

    The tokens are grouped inside their batch: no shuffle, and no more than a sort however long
    the text is.
    """
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields]
    )
    texts = reviews.select(F.col(id_col).alias("id"), F.inline(pairs))
    tokens = texts.select("id", "field", analyzer.tokens(F.col("text")).alias("tokens"))
    kind = tokens.schema["id"].dataType.simpleString()
    # Texts without a token go there: a filter here would tokenise every text a second time.
    return tokens.mapInArrow(group_tokens, FORWARD.format(kind))


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Rows lo to hi whose sizes come to ``most`` at most, one row at least."""
    end, lo = np.cumsum(sizes), 0
    while lo < len(end):
        hi = max(lo + 1, int(np.searchsorted(end, (end[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy())


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)


def _ordered_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's place among the different words in order, and these."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return place[coded.indices.to_numpy()], coded.dictionary.take(order)


def group_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, field, tokens`` as rows of the forward table."""
    for batch in batches:
        batch = batch.filter(pc.greater(pc.list_value_length(batch.column("tokens")), 0))
        for lo, hi in runs(_sizes(batch.column("tokens")), MOST_TOKENS):
            part = batch.slice(lo, hi - lo)
            tokens = part.column("tokens")
            lens = _sizes(tokens)
            word, words = _ordered_codes(tokens.flatten())
            key = np.repeat(np.arange(len(lens)), lens) * max(len(words), 1) + word
            order = np.argsort(key, kind="stable")
            begun = np.flatnonzero(np.diff(key[order], prepend=-1))
            position = np.arange(len(key)) - np.repeat(np.cumsum(lens) - lens, lens)
            held = np.bincount(key[order[begun]] // max(len(words), 1), minlength=len(lens))
            tfs = np.diff(np.append(begun, len(key)))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("id", "field")),
                    pa.array(lens, pa.int32()),
                    _lists(held, words.take(pa.array(word[order[begun]]))),
                    _lists(held, pa.array(tfs, pa.int32())),
                    _lists(lens, pa.array(position[order], pa.int32())),
                ],
                names=["id", "field", "len", "terms", "tfs", "positions"],
            )


def to_blocks(means: dict[str, float]):
    """Rows of the forward table, in order of shard and id, as blocks of one shard, term and
    field."""

    def laid(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        terms, tfs, places, text_lens, ids, names = (
            rows[c].combine_chunks() for c in ("terms", "tfs", "positions", "len", "id", "field")
        )
        held = _sizes(terms)
        text = np.repeat(np.arange(len(held)), held)
        word, words = _ordered_codes(terms.flatten())
        field, fields = _ordered_codes(names)
        key = word * len(fields) + field[text]
        # Stable: within a term and field the records stay in order of id.
        order = np.argsort(key, kind="stable")
        key, text = key[order], text[order]
        begun = np.flatnonzero(np.diff(key, prepend=-1))
        place = np.arange(len(key)) - np.repeat(begun, np.diff(np.append(begun, len(key))))
        start = np.flatnonzero(place % BLOCK_POSTINGS == 0)
        end = np.append(start[1:], len(key))
        tf = tfs.flatten().to_numpy()
        first = np.cumsum(tf) - tf
        tf, first = tf[order], first[order]
        at = np.repeat(first - (np.cumsum(tf) - tf), tf) + np.arange(tf.sum())
        ids, lens = ids.to_numpy()[text], text_lens.to_numpy()[text]
        mean = np.array([means[f] for f in fields.to_pylist()])[field[text]]
        size = end - start
        blocks = pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(start), rows["shard"][0].as_py()), pa.int32()),
                words.take(pa.array(key[start] // len(fields))),
                fields.take(pa.array(key[start] % len(fields))),
                pa.array(ids[start]),
                pa.array(ids[end - 1]),
                pa.array(np.maximum.reduceat(share_of(tf, lens, mean), start)),
                _lists(size, pa.array(ids)),
                _lists(size, pa.array(lens, pa.int32())),
                _lists(size, pa.array(tf, pa.int32())),
                _lists(np.add.reduceat(tf, start), pa.array(places.flatten().to_numpy()[at], pa.int32())),
            ],
            names=[c.split()[0] for c in BLOCKS.split(", ")],
        )
        for lo in range(0, len(start), BLOCKS_AT_ONCE):
            yield blocks.slice(lo, BLOCKS_AT_ONCE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        shard, tokens = None, 0
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            bounds = np.append(np.flatnonzero(np.diff(shards, prepend=-1)), len(shards))
            for begin, end in zip(bounds, bounds[1:]):
                part = batch.slice(begin, end - begin)
                sizes = part.column("len").to_numpy()
                for lo, hi in runs(sizes, MOST_TOKENS):
                    n = int(sizes[lo:hi].sum())
                    if kept and (shards[begin] != shard or tokens + n > MOST_TOKENS):
                        yield from laid(pa.Table.from_batches(kept))
                        kept, tokens = [], 0
                    kept.append(part.slice(lo, hi - lo))
                    shard, tokens = shards[begin], tokens + n
        if kept:
            yield from laid(pa.Table.from_batches(kept))

    return run


def build_index(
    reviews: DataFrame,
    fields: Sequence[str],
    analyzer: Analyzer = STANDARD,
    *,
    id_col: str = "id",
    records: DataFrame | None = None,
    buckets: int | None = None,
    path: str | None = None,
) -> TextIndex:
    """Write the index of ``fields`` and open it. ``records`` has an ``id`` and the columns to
    filter and sort by; a record may stand in several rows.

    The texts are tokenised once, into the forward table, without a shuffle. Its rows then
    take one shuffle, by shard of the record. ``buckets`` defaults to the session's
    shuffle partitions; aim at a few hundred MB per bucket.
    """
    spark = reviews.sparkSession
    path = path or new_folder(spark, "text-index")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or tasks
    shards = buckets * SHARDS_PER_BUCKET
    forward_rows(reviews, fields, analyzer, id_col).write.parquet(f"{path}/forward")
    forward = spark.read.parquet(f"{path}/forward")

    counts = (
        forward.select("field", F.explode("terms").alias("term"))
        .groupBy("term", "field")
        .agg(F.count(F.lit(1)).alias("df"))
        .withColumn("bucket", bucket_of(F.col("term"), buckets))
    )
    (
        counts.repartitionById(tasks, "bucket")
        .sortWithinPartitions("bucket", "term")
        .write.partitionBy("bucket")
        .parquet(f"{path}/term_stats")
    )
    field_stats = forward.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg("len").alias("mean_len")
    )
    field_stats.withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/field_stats")

    write_vocabulary(spark.read.parquet(f"{path}/term_stats"), path, buckets)

    means = mean_lengths(spark.read.parquet(f"{path}/field_stats"))
    rows = with_shard(forward, shards).repartition(buckets, "shard").sortWithinPartitions("shard", "id")
    write_bucketed(rows.mapInArrow(to_blocks(means), BLOCKS), f"{path}/blocks", buckets, "shard", "term")
    records = reviews.select(F.col(id_col).alias("id")) if records is None else records
    write_bucketed(with_shard(records, shards).repartition(buckets, "shard"), f"{path}/records", buckets, "shard", "id")
    return open_index(spark, path, fields, analyzer)


def mean_lengths(field_stats: DataFrame) -> dict[str, float]:
    """One number per indexed field."""
    return {r["field"]: r["mean_len"] for r in field_stats.collect()}


def open_index(
    spark: SparkSession,
    path: str,
    fields: Sequence[str],
    analyzer: Analyzer = STANDARD,
) -> TextIndex:
    """An index written earlier; ``fields`` and ``analyzer`` as it was built with."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}")

    field_stats = table("field_stats")
    settings = field_stats.select("buckets").first()
    buckets = settings["buckets"] if settings else 1
    blocks, records = (
        read_bucketed(spark, f"{path}/{name}", buckets, "shard", order)
        for name, order in (("blocks", "term"), ("records", "id"))
    )
    return TextIndex(
        path,
        analyzer,
        tuple(fields),
        buckets,
        table("forward"),
        blocks,
        records,
        table("term_stats"),
        field_stats,
        open_vocabulary(spark, path, buckets),
    )
