"""Text probabilities by deleted interpolation.

P_k(w | the k - 1 tokens before) = a f_k + (1 - a) P_(k-1), down to P_0 = 1 / (V + 1), where
f_k is the maximum-likelihood estimate from the counts of the training texts and ``a`` belongs
to the order and to the frequency bucket (a power of two) of the context. One fold of the
training texts is deleted from the counts, and expectation-maximisation finds the weights on
it; the estimates of the finished model then use all training texts.

Counting never moves a text. A task numbers the tokens of a block of texts and asks for each
different n-gram of the block once, by a 64-bit hash; hashes are dealt to buckets by range,
so each bucket is counted in one bounded task and answers in the order it was asked. An n-gram
that all texts hold is one row per block. Equal hashes of different n-grams would share their
counts; among n of them about n * n / 2**65 pairs do. What EM sees is a table of (order,
context bucket, ratio of the two estimates in 1/16 octaves), at most 64 * 2048 cells an
order, so its size does not depend on the corpus.

Tokens are the runs of bytes that are not ASCII white space, A-Z in lower case, and one end
per text. Defined results: null and empty texts are the end alone; a null id is never held
out; rows that repeat count as rows; without training texts N = V = 0 and every score is 0;
an empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.workspace import new_folder, remove

ORDER = 3
FOLDS, HELD_OUT, DELETED = 10, 0, 1
# Bytes of text in a block, and n-grams that one bucket counts, about.
BLOCK_BYTES = 8 << 20
BUCKET_GRAMS = 2_000_000
# Cells of the table that weights are learnt from, per context bucket; steps of EM.
RATIOS, STEPS_PER_OCTAVE, EM_STEPS = 2048, 16, 200
CONTEXTS = 64
SMOOTHING = 0.1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LONG_WORD = 64


def _mixed(h: np.ndarray) -> np.ndarray:
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


BEGIN, END = _mixed(np.array([1, 2], np.uint64))


# --- Tokens of a block ---


def hashed_words(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; eight bytes are taken at a time from all of them."""
    size = stops - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
    out = _mixed(size.astype(np.uint64) + np.uint64(16))
    at, k = np.flatnonzero(size <= _LONG_WORD), 0
    while len(at):
        left = np.minimum(size[at] - k, 8).astype(np.uint64)
        chunk = eights[starts[at] + k] << (np.uint64(64) - left * np.uint64(8))
        out[at] = _mixed((out[at] ^ chunk) * _ODD)
        k += 8
        at = at[size[at] > k]
    for i in np.flatnonzero(size > _LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : stops[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of texts that stand one after the other, and the tokens of each text."""
    data = _LOWER[data]
    word = ~_SPACE[data]
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner], after[inner - 1] = False, False
    starts, stops = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    sizes = np.bincount(text, minlength=len(offsets) - 1) + 1
    out = np.full(len(starts) + len(sizes), END)
    out[np.arange(len(starts)) + text] = hashed_words(data, starts, stops)
    return out, sizes


def grams_of(tokens: np.ndarray, sizes: np.ndarray, order: int) -> np.ndarray:
    """The hash of the n-gram that ends at each token; texts are begun with BEGINs."""
    first = np.cumsum(sizes) - sizes
    grams, begun = tokens, np.array([BEGIN])
    for _ in range(1, order):
        context = np.empty_like(grams)
        context[1:], context[first] = grams[:-1], begun[0]
        grams = _mixed(context * _ODD + tokens)
        begun = _mixed(begun * _ODD + BEGIN)
    return grams


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: small ones, and small steps, take little room."""
    planes = np.ascontiguousarray(values.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").ravel()


def packed_hashes(sorted_: np.ndarray) -> bytes:
    return packed(np.diff(sorted_, prepend=np.uint64(0)).view(np.int64))


def unpacked_hashes(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data).view(np.uint64), dtype=np.uint64)


def _joined(column) -> np.ndarray:
    """All numbers of a column of packed ones, row after row."""
    return np.concatenate([*map(unpacked, column.to_pylist()), np.empty(0, np.int64)])


BLOCK = "doc_id array<bigint>, fold array<tinyint>, size array<int>, word binary, rank binary, hash binary"


def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole texts: each token as its number among the block's hashes."""
    for batch in batches:
        texts = batch.column(2).cast(pa.large_string()).fill_null("")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        ids, folds = batch.column(0), batch.column(1)
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + BLOCK_BYTES, "right")) - 1)
            tokens, sizes = tokens_of(data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo])
            hashes, word, n = np.unique(tokens, return_inverse=True, return_counts=True)
            # Hashes are kept in order, tokens as the places of their words by frequency.
            by_n = np.argsort(-n, kind="stable")
            place = np.empty_like(by_n)
            place[by_n] = np.arange(len(by_n))
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            lists = [one(c) for c in (ids[lo:hi], folds[lo:hi], pa.array(sizes, pa.int32()))]
            packs = [pa.array([x], pa.binary()) for x in (packed(place[word]), packed(by_n), packed_hashes(hashes))]
            yield pa.RecordBatch.from_arrays([*lists, *packs], names=["doc_id", "fold", "size", "word", "rank", "hash"])
            lo = hi


class Block:
    """One row of the blocks, its tokens' folds and its n-grams."""

    def __init__(self, rows, i: int = 0):
        get = lambda name: rows.column(name)[i]
        self.doc_id = get("doc_id").values
        self.fold, self.sizes = (get(c).values.to_numpy() for c in ("fold", "size"))
        word, rank = (unpacked(get(c).as_py()) for c in ("word", "rank"))
        self.tokens = unpacked_hashes(get("hash").as_py())[rank[word]]
        self.first = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        self.token_fold = np.repeat(self.fold, self.sizes)

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The different n-grams in order of their hashes, and the place of each token's."""
        return np.unique(grams_of(self.tokens, self.sizes, order), return_inverse=True)


# --- Counts of n-grams over all blocks ---


def asked(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """(block, bucket, grams, n, m): the block's n-grams with their training and deleted counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i)
                grams, at = block.grams(order)
                n = np.bincount(at[block.token_fold != HELD_OUT], minlength=len(grams))
                m = np.bincount(at[block.token_fold == DELETED], minlength=len(grams))
                bucket = (grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                there, start = np.unique(bucket, return_index=True)
                parts = [[f(x) for x in np.split(values, start[1:])] for f, values in ((packed_hashes, grams), (packed, n), (packed, m))]
                here = pa.array(np.full(len(there), batch.column("block")[i].as_py()), pa.int64())
                yield pa.RecordBatch.from_arrays([here, pa.array(there.astype(np.int32)), *(pa.array(x, pa.binary()) for x in parts)], names=["block", "bucket", "grams", "n", "m"])

    return blocks.mapInArrow(run, "block bigint, bucket int, grams binary, n binary, m binary")


def count_bucket(rows: pa.Table) -> pa.Table:
    """Counts over all blocks, in the order in which each block asked for them."""
    asked_for = [unpacked_hashes(x) for x in rows["grams"].to_pylist()]
    grams, at = np.unique(np.concatenate(asked_for), return_inverse=True)
    stops = np.cumsum([len(x) for x in asked_for])[:-1]
    sums = [np.bincount(at, _joined(rows[c]), len(grams)).astype(np.int64) for c in ("n", "m")]
    known = np.zeros(rows.num_rows, np.int64)
    known[0] = np.count_nonzero(sums[0])
    answers = [pa.array([packed(x) for x in np.split(s[at], stops)], pa.binary()) for s in sums]
    return pa.Table.from_arrays([rows["block"], rows["bucket"], *answers, pa.array(known)], names=["block", "bucket", "n", "m", "known"])


ANSWER = "block bigint, bucket int, n binary, m binary, known bigint"


def answered(block: Block, answers: pa.Table, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each order the training and deleted counts of every token's n-gram."""
    out = []
    which, bucket = answers["k"].to_numpy(), answers["bucket"].to_numpy()
    for k in range(1, order + 1):
        rows = np.flatnonzero(which == k)
        rows = answers.take(pa.array(rows[np.argsort(bucket[rows])]))
        at = block.grams(k)[1]
        out.append((_joined(rows["n"])[at], _joined(rows["m"])[at]))
    return out


def contexts_of(counts: list[np.ndarray], first: np.ndarray, texts: int) -> list[np.ndarray]:
    """How often each token's context was counted, for the orders 2, 3, ..."""
    out = []
    for c in counts[:-1]:
        before = np.empty_like(c)
        before[1:], before[first] = c[:-1], texts
        out.append(before)
    return out


# --- The mixture ---


class Mixture:
    """Weights by order and context bucket over the counts of ``tokens`` training tokens."""

    def __init__(self, tokens: int, vocabulary: int, weights: list[np.ndarray]):
        self.tokens, self.vocabulary, self.weights = tokens, vocabulary, weights

    def estimate(self, k: int, counts, contexts) -> tuple[np.ndarray, np.ndarray]:
        """The maximum-likelihood estimate of order k and the context's bucket; 0 is unseen."""
        context = np.full(len(counts[0]), self.tokens) if k == 1 else contexts[k - 2]
        return counts[k - 1] / np.maximum(context, 1), np.frexp(context.astype(float))[1]

    def probability(self, counts, contexts) -> np.ndarray:
        """Of all tokens, by as many orders as have weights."""
        p = np.full(len(counts[0]), 1 / (self.vocabulary + 1))
        for k, weight in enumerate(self.weights, 1):
            f, bucket = self.estimate(k, counts, contexts)
            p = weight[bucket] * f + (1 - weight[bucket]) * p
        return p


def learnt_weights(cells: np.ndarray) -> np.ndarray:
    """Weights of the context buckets by EM over cells (bucket, ratio bin, n, sum of ratios).

    A held-out token whose estimate is r times that of the lower orders came from this order
    with probability a r / (a r + 1 - a). Each bucket starts with one observation shared by
    both sides, so no weight becomes 0 or 1. An unseen context (bucket 0) has weight 0.
    """
    out = np.full(CONTEXTS + 1, 0.5)
    for b in range(1, CONTEXTS + 1):
        mine = cells[cells[:, 0] == b]
        n, ratio = mine[:, 2], mine[:, 3] / np.maximum(mine[:, 2], 1)
        for _ in range(EM_STEPS):
            a = out[b]
            out[b] = (n @ (a * ratio / (a * ratio + 1 - a)) + 0.5) / (n.sum() + 1)
    out[0] = 0.0
    return out


def cells_of(held: DataFrame, mixture: Mixture, order: int) -> np.ndarray:
    """The deleted fold's tokens by context bucket and ratio of ``order`` to the mixture below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(((CONTEXTS + 1) * RATIOS, 2)).T
        for batch in batches:
            arrays = [_joined(c) for c in batch.columns]
            counts, contexts = arrays[:order], arrays[order:]
            if len(counts[0]):
                f, bucket = mixture.estimate(order, counts, contexts)
                ratio = f / mixture.probability(counts, contexts)
                bin_ = np.clip(np.rint(STEPS_PER_OCTAVE * np.log2(np.maximum(ratio, 1e-300))) + RATIOS // 2, 1, RATIOS - 1)
                cell = bucket * RATIOS + np.where(ratio > 0, bin_, 0).astype(np.int64)
                n += np.bincount(cell, minlength=len(n))
                total += np.bincount(cell, ratio, len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at // RATIOS), pa.array(at % RATIOS), pa.array(n[at]), pa.array(total[at])], names=["bucket", "bin", "n", "total"])

    columns = [f"c{k}" for k in range(1, order + 1)] + [f"x{k}" for k in range(2, order + 1)]
    found = held.select(*columns).mapInArrow(run, "bucket bigint, bin bigint, n double, total double").groupBy("bucket", "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = found.collect()  # at most CONTEXTS * RATIOS cells
    return np.array(sorted(tuple(r) for r in rows), float).reshape(-1, 4)


# --- The operator ---


def fold_of(doc_id: Column) -> Column:
    """0 to 9 by the id's checksum; rows without an id are training rows."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % FOLDS, F.lit(FOLDS - 1)).cast("byte")


@contextmanager
def shuffles_let_go(spark: SparkSession):
    """Inside, the shuffle files of a finished query are deleted at once: every step here is
    written and read again, so none is used twice."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text.

    ``base_score`` is that of single tokens with ``SMOOTHING`` added to each count.
    """
    spark = docs.sparkSession
    stored: list[str] = []

    def kept(df: DataFrame, label: str) -> DataFrame:
        stored.append(new_folder(spark, label))
        df.write.parquet(stored[-1])
        return spark.read.schema(df.schema).parquet(stored[-1])

    with shuffles_let_go(spark):
        rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
        rows = rows.select("doc_id", fold_of(F.col("doc_id")).alias("fold"), "text")
        blocks = kept(rows.mapInArrow(to_blocks, BLOCK).withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
        texts = blocks.select(F.explode(F.arrays_zip("fold", "size")).alias("t")).select("t.*")
        training, deleted = F.col("fold") != HELD_OUT, F.col("fold") == DELETED
        n, m, texts_n, texts_m, total = texts.agg(
            *(F.coalesce(F.sum(F.when(test, F.col("size"))), F.lit(0)) for test in (training, deleted)),
            *map(F.count_if, (training, deleted)), F.coalesce(F.sum("size"), F.lit(0)),
        ).first()
        buckets = max(1 + total // BUCKET_GRAMS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
        answers = None
        for k in range(1, order + 1):
            counted = kept(asked(blocks, k, buckets).groupBy("bucket").applyInArrow(count_bucket, ANSWER), f"lm-counts-{k}")
            vocabulary = counted.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0] if k == 1 else vocabulary
            counted = counted.select(F.lit(k).alias("k"), "block", "bucket", "n", "m")
            answers = counted if answers is None else answers.unionByName(counted)
        together = blocks.groupBy("block").cogroup(answers.groupBy("block"))

        def deleted_counts(left: pa.Table, right: pa.Table) -> pa.Table:
            """Of the deleted fold's tokens the counts without it, and those of their contexts."""
            block = Block(left)
            counts = [a - b for a, b in answered(block, right, order)]
            mine = block.token_fold == DELETED
            arrays = [*counts, *contexts_of(counts, block.first, texts_n - texts_m)]
            return pa.Table.from_arrays([pa.array([packed(a[mine])], pa.binary()) for a in arrays], names=names)

        names = [f"c{k}" for k in range(1, order + 1)] + [f"x{k}" for k in range(2, order + 1)]
        held = kept(together.applyInArrow(deleted_counts, ", ".join(f"{c} binary" for c in names)), "lm-deleted")
        weights: list[np.ndarray] = []
        for k in range(1, order + 1):
            weights.append(learnt_weights(cells_of(held, Mixture(n - m, vocabulary, list(weights)), k)))
        model = Mixture(n, vocabulary, weights)

        def scored(left: pa.Table, right: pa.Table) -> pa.Table:
            block = Block(left)
            counts = [a for a, _ in answered(block, right, order)]
            p = model.probability(counts, contexts_of(counts, block.first, texts_n))
            base = np.log10((counts[0] + SMOOTHING) / (n + SMOOTHING * (vocabulary + 1)))
            text = np.repeat(np.arange(len(block.sizes)), block.sizes)
            by_text = lambda x: np.bincount(text, x, len(block.sizes))
            columns = [
                block.doc_id, pa.array(block.fold == HELD_OUT), pa.array(block.sizes, pa.int64()), pa.array(by_text(counts[0] > 0).astype(np.int64)),
                pa.array(np.full(len(block.sizes), n), pa.int64()), pa.array(by_text(base)), pa.array(by_text(np.log10(p))),
            ]
            return pa.Table.from_arrays(columns, names=[c.split()[0] for c in SCORED.split(", ")])

        result = kept(together.applyInArrow(scored, SCORED), "lm-scores")
        for path in stored[:-1]:
            remove(spark, path)
    return result


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
