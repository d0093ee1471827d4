"""Packing token pieces into as few fixed-length sequences as possible.

Linear grouping: the large pieces, longest first, are dealt into groups of equal count and
rounded up to the longest of their group; few sizes are left, and the best mix of ways to
fill a sequence with them (configurations) is a small linear programme, solved by column
generation. Real pieces then take the places of the rounded ones, and the small pieces go,
longest first, to the sequence that they fill best.

Only lengths matter to that plan, and no piece is longer than a sequence, so it works on
the count of each length: at most ``capacity`` numbers, however large the corpus. It says
which run of the pieces of one length goes to which run of sequences. Spark counts the
lengths, numbers the pieces of each length, and looks each piece up in the plan.

Defined results: a null or empty text is the closing id alone; rows that repeat, or share
an id, are packed once each; equal lengths are told apart by (id, piece, digest). An empty
table gives an empty result. Other columns of the input are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from notegrove.llm.tokens import word_tokens
from notegrove.workspace import materialize

CAPACITY = 4096
CLOSING_ID = 1
GROUPS = 128
SMALL = CAPACITY // 16
# Column generation ends when no configuration is worth more than this above a sequence.
GAP = 5e-4
# Rows of one length that one task numbers, on average.
ROWS_PER_BUCKET = 100_000
LEAST_BUCKETS = 16

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenise every text and cut what is longer than a sequence: one row per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, closing = word_tokens(tokenizer).encode, CLOSING_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + closing
                n = len(ids) // 4
                for k, start in enumerate(range(0, n, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((key, k, start, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, PIECES, strict=True)], schema=PIECES)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """The linear programme over all ways to fill a sequence with the given sizes, by column
    generation: (one configuration per column, how often each). At most as many
    configurations as sizes are used."""
    k, least = len(sizes), int(sizes.min())
    basis = np.diag((capacity // sizes).astype(float))
    amount = counts / np.diag(basis)
    for _ in range(rounds):
        value = np.linalg.solve(basis.T, np.ones(k))
        best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(least, capacity + 1, least):  # most valuable filling of each length
            to = np.arange(c, min(c + least, capacity + 1))
            total = np.where(sizes <= to[:, None], value + best[np.maximum(to[:, None] - sizes, 0)], 0.0)
            g = total.argmax(1)
            top = total[np.arange(len(to)), g]
            best[to] = np.maximum(np.maximum.accumulate(top), best[c - 1])
            pick[to] = np.where(top >= best[to], g, -1)
        if best[capacity] <= 1 + GAP:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if pick[c] < 0 or best[c] <= 0:
                c -= 1
            else:
                column[pick[c]] += 1
                c -= int(sizes[pick[c]])
        move = np.linalg.solve(basis, column)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(move > 1e-9, amount / move, np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        amount = np.maximum(amount - step * move, 0)
        basis[:, out], amount[out] = column, step
    return basis, amount


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> dict[str, np.ndarray]:
    """Where the pieces of each length go. Row by row: the pieces of ``length`` numbered
    from ``first`` on fill ``repeat`` sequences from ``sequence`` on, ``each`` of them per
    sequence, side by side from ``offset``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    taken = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int, int]] = []
    bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # room: runs of sequences
    opened = 0

    def put(length: int, each: int, repeat: int, sequence: int, room: int) -> None:
        rows.append((length, int(taken[length]), each, repeat, sequence, capacity - room))
        taken[length] += each * repeat
        left[length] -= each * repeat

    large = np.arange(capacity, small, -1)
    many = left[large]
    if many.sum() > groups:
        # Groups of equal count, longest first; a length may lie in several.
        edge = np.concatenate([[0], np.cumsum(many)])
        limits = np.unique(np.linspace(0, edge[-1], groups + 1).astype(np.int64))
        firsts = np.searchsorted(edge, limits[:-1], "right") - 1
        sizes, back = np.unique(large[firsts], return_inverse=True)
        counts = np.bincount(back, weights=np.diff(limits)).astype(np.int64)
        found, amount = configurations(sizes, counts.astype(float), capacity)
        # The runs of real lengths of each size, longest first.
        runs: dict[int, list[list[int]]] = {int(s): [] for s in sizes}
        for lo, hi, f in zip(limits[:-1], limits[1:], firsts, strict=True):
            i = f
            while lo < hi:
                n = int(min(hi, edge[i + 1]) - lo)
                if n:
                    runs[int(large[f])].append([int(large[i]), n])
                lo, i = lo + n, i + 1
        order = np.argsort(-(sizes @ found))
        for c in order:
            slots = [int(s) for s, n in zip(sizes, found[:, c], strict=True) for _ in range(round(n))][::-1]
            want = int(amount[c] + 1e-9)
            while want > 0:
                # A slot that comes twice in one sequence takes from the same run twice.
                repeat, ok = want, True
                for s in set(slots):
                    m = slots.count(s)
                    while runs[s] and runs[s][0][1] == 0:
                        runs[s].pop(0)
                    if not runs[s]:
                        ok = False
                    elif runs[s][0][1] < m:
                        repeat = min(repeat, 0)
                    else:
                        repeat = min(repeat, runs[s][0][1] // m)
                if not ok:
                    break
                if repeat == 0:  # a run ends within a sequence: fill one sequence piece by piece
                    if any(sum(r[1] for r in runs[s]) < slots.count(s) for s in set(slots)):
                        break
                    repeat = 1
                room = capacity
                for s in slots:
                    while runs[s][0][1] == 0:
                        runs[s].pop(0)
                    runs[s][0][1] -= repeat
                    put(runs[s][0][0], 1, repeat, opened, room)
                    room -= runs[s][0][0]
                bins[room].append((opened, repeat))
                opened += repeat
                want -= repeat
    # What is left, longest first, to the open sequence with the least room that will do.
    rooms = np.array([bool(b) for b in bins])
    for length in range(capacity, 0, -1):
        while left[length] > 0:
            fitting = np.flatnonzero(rooms[length:])
            if len(fitting) == 0 or length > capacity // 2 and fitting[0] + length == capacity:
                each = min(capacity // length, int(left[length]))
                repeat = int(left[length]) // each
                put(length, each, repeat, opened, capacity)
                room, run = capacity - each * length, (opened, repeat)
                opened += repeat
            else:
                room = int(fitting[0]) + length
                sequence, n = bins[room].pop()
                each = min(room // length, int(left[length]))
                repeat = min(n, int(left[length]) // each)
                if repeat < n:
                    bins[room].append((sequence + repeat, n - repeat))
                rooms[room] = bool(bins[room])
                put(length, each, repeat, sequence, room)
                room, run = room - each * length, (sequence, repeat)
            bins[room].append(run)
            rooms[room] = True
    rows.sort()
    names = ("length", "first", "each", "repeat", "sequence", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 6).T, strict=True))


def numbered(pieces: DataFrame, capacity: int) -> tuple[DataFrame, dict[int, int]]:
    """The pieces with ``rank``, their number among all of equal length from 0 on, and the
    count of each length. A length that many pieces share is numbered bucket by bucket."""
    n = pieces.count()
    buckets = max(LEAST_BUCKETS, n // ROWS_PER_BUCKET)
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = pieces.groupBy("length", "_bucket").count()
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("_row", F.row_number().over(within)).join(starts, ["length", "_bucket"])
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    assert all(0 < x <= capacity for x in histogram)
    return ranked.withColumn("rank", F.col("_start") + F.col("_row") - 1).drop("_bucket", "_start", "_row"), histogram


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with their ``sequence_id`` and ``offset``. ``pieces`` is read several
    times, so it has to be stored."""
    ranked, histogram = numbered(pieces, capacity)
    where = plan(histogram, capacity)
    shift = max(1, int(max(histogram.values(), default=1)).bit_length() + 1)
    starts = (where["length"] << shift) + where["first"]
    sent = {k: where[k] for k in ("first", "each", "sequence", "offset", "length")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("length", "rank"))
            row = np.searchsorted(starts, (length << shift) + rank, "right") - 1
            nth = rank - sent["first"][row]
            each = sent["each"][row]
            kept = [batch.column(n) for n in PIECES.names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sent["sequence"][row] + nth // each), pa.array(sent["offset"][row] + nth % each * length)],
                names=[*PIECES.names, "sequence_id", "offset"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select(*PIECES.names, "rank").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack a table of texts."""
    return pack(materialize(cut(docs, tokenizer, id_col, text_col, capacity), "pieces"), capacity)
