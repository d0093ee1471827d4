"""BagMinHash near-duplicates: weighted Jaccard over multisets of word shingles.

A text is the multiset of its runs of five words. Every shingle owns Poisson processes over
the axis of its weight: one for the level [0, 1) and one for each doubling [1, 2), [2, 4),
... of the discretised weight. Each process is drawn from the shingle's hash alone, so two
texts see the same points up to the smaller of their weights. A process that the weight cuts
off within its interval is halved further and further: one bit of a point tells in which
half it lies, so a point counts if its place is below the weight. Each point belongs to one
of ``COMPONENTS``; a component's signature is its first point. Points come in order of time,
and a process ends at the latest first point so far, so a text costs about one draw per
shingle plus COMPONENTS log COMPONENTS. Two texts agree in a component with a probability
equal to their weighted Jaccard similarity.

Search: equal texts are one class. Classes that agree in all rows of a band share a bucket. In
each bucket every class is compared with one leader; buckets whose classes are one component
by then are done, the others get another leader. After ``ROUNDS`` of that, classes of a bucket
that are still apart are compared with each other, but for those that cannot be similar:
what two texts share is at most what either shares with any text that is left, so a text
with many shingles of its own needs no comparison. So no link between two classes of a bucket
is lost, and a group of copies is not compared pair by pair. Every comparison is exact, over the whole multisets (of 64-bit hashes). At similarity 0.8 a pair shares a
bucket with probability 1 - (1 - 0.8^5)^25 = 0.99995.

Defined results: null and empty texts are equal texts without shingles; a text of one to four
words is one shingle; rows with equal text are one class whatever their id; rows that repeat
or share an id and a component stay or go together; ids that are null stay in a class by its
other members' least id, or are its representative if it has none; an empty table gives an
empty result. Other columns of the input are never read, and those of ``distinct_rows`` stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegrove.llm.components import components
from notegrove.workspace import materialize

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
COMPONENTS = BANDS * ROWS
ROUNDS = 2
# A bucket with more classes left than this is compared block by block.
FEW, BLOCK = 32, 128
# Characters of text whose shingles one task holds at once (or one text, if it is longer).
BATCH_CHARS = 4_000_000
KNOWN_WORDS = 200_000

_WORD = re.compile(r"[^\W_]+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64: the next 64 random bits after each state."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _Known(dict):
    """Word hashes, bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_known = _Known()


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text's place, hash) of every run of words in every text, as often as it occurs."""
    hashes, counts = [], []
    for text in texts:
        words = _WORD.findall(text.lower())
        if 0 < len(words) < WORDS:
            words = [" ".join(words)] + [""] * (WORDS - 1)
        counts.append(len(words))
        hashes.append(np.fromiter(map(_known.__getitem__, words), np.uint64, len(words)))
    n = np.array(counts, np.int64)
    flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    runs = np.maximum(n - WORDS + 1, 0)
    doc = np.repeat(np.arange(len(texts)), runs)
    first = np.arange(runs.sum()) + np.repeat(np.cumsum(n) - n - (np.cumsum(runs) - runs), runs)
    out = np.zeros(len(first), np.uint64)
    for k in range(WORDS):
        out = mixed(out ^ flat[first + k])
    return doc, out


def multiset(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text's place, hash) with how often it occurs."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashes[at], np.diff(np.append(at, len(doc)))


def signatures(doc: np.ndarray, hashes: np.ndarray, weight: np.ndarray, n: int, components: int = COMPONENTS) -> np.ndarray:
    """The first point's time of every component, for ``n`` weighted sets at once; infinite
    for a set without elements. Weights are whole numbers of the discretisation's step."""
    first = np.full((n, components), np.inf)
    # One process per element and level; level k > 0 is [2^(k-1), 2^k).
    levels = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    element = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(element)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.maximum(low, 1)
    d, w = doc[element], weight[element]
    state = mixed(hashes[element] ^ mixed(level.astype(np.uint64)))
    time, latest = np.zeros(len(d)), np.full(n, np.inf)
    number = 0
    while len(d):
        number += 1
        step = np.uint64(number * int(_MIX1) % (1 << 64))
        bits = mixed(state + step)
        time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (components * width)
        go = time < latest[d]
        d, w, low, width, state, time = d[go], w[go], low[go], width[go], state[go], time[go]
        if not len(d):
            break
        bits = mixed(state ^ mixed(np.full(len(state), step)))
        component = (bits >> np.uint64(32)) % np.uint64(components)
        # The lower bits halve the interval of a process until the place is one level wide.
        place = low + ((bits & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * width).astype(np.int64)
        below = place < w
        np.minimum.at(first, (d[below], component[below].astype(np.int64)), time[below])
        latest = first.max(1)
    return first


def bands_of(first: np.ndarray) -> np.ndarray:
    """A hash of each band's rows."""
    bits = first.view(np.uint64).reshape(len(first), BANDS, ROWS)
    out = np.broadcast_to(mixed(np.arange(BANDS, dtype=np.uint64)), bits.shape[:2])
    for k in range(ROWS):
        out = mixed(out ^ bits[:, :, k])
    return out.view(np.int64)


def chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with a bounded number of characters."""
    start, size, texts = 0, 0, []
    for i, text in enumerate(batch.column(column)):
        text = text.as_py() or ""
        if texts and size + len(text) > BATCH_CHARS:
            yield batch.slice(start, i - start), texts
            start, size, texts = i, 0, []
        texts.append(text)
        size += len(text)
    if texts:
        yield batch.slice(start), texts


def text_key(text: Column) -> Column:
    """Equal for equal texts only: 128 bits of their bytes."""
    return F.unhex(F.md5(F.encode(F.coalesce(text, F.lit("")), "utf-8")))


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per input row: doc_id, key of the text, count of shingles, bands."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, 2):
                doc, hashes = shingles(texts)
                sizes = np.bincount(doc, minlength=len(texts))
                first = signatures(*multiset(doc, hashes), len(texts))
                rows = [b if k else [] for b, k in zip(bands_of(first), sizes, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.binary()), pa.array(sizes), pa.array(rows, pa.list_(pa.int64()))], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("key"), F.col(text_col))
    return rows.mapInArrow(run, "doc_id long, key binary, n long, bands array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two multisets of hashes."""
    x, m = np.unique(a, return_counts=True)
    y, n = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = np.minimum(m[i], n[j]).sum()
    return float(both / max(len(a) + len(b) - both, 1))


def contents(docs: DataFrame, classes: DataFrame, text_col: str = "text") -> DataFrame:
    """The multiset of hashes of each listed class (v, key), as (v, bag), stored. Copies of
    a text leave their tasks once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, 1):
                doc, hashes = shingles(texts)
                cut = np.searchsorted(doc, np.arange(len(texts) + 1))
                bags = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), bags], names=["v", "bag"])

    once = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    return materialize(once.join(classes.select("key", "v"), "key").select("v", "text").mapInArrow(run, "v long, bag array<long>"), "bags")


def verified(pairs: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose multisets are similar enough, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            near = [similarity(x[i].values.to_numpy(), y[i].values.to_numpy()) >= least for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    both = pairs.join(bags.select(F.col("v").alias("a"), F.col("bag").alias("x")), "a").join(bags.select(F.col("v").alias("b"), F.col("bag").alias("y")), "b")
    return materialize(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "near-pairs")


def merged(roots: DataFrame | None, near: DataFrame) -> DataFrame:
    """(node, root) of all components so far, after further links (a, b)."""
    if roots is None:
        return components(near)
    ends = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    known = roots.unionByName(ends.join(roots, "node", "left_anti").withColumn("root", F.col("node")))
    at = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    over = near.join(at("a"), "a", "left").join(at("b"), "b", "left")
    step = components(over.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    step = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
    return materialize(known.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "components")


def shared_sizes(bags: DataFrame) -> DataFrame:
    """(v, s): how much of each multiset is found in any other one."""
    each = bags.select("v", F.explode("bag").alias("h")).groupBy("h").agg(F.min("v").alias("v"), F.max("v").alias("last"), F.count(F.lit(1)).alias("c"))
    own = each.filter("v = last").groupBy("v").agg(F.sum("c").alias("own"))
    return bags.select("v", F.size("bag").alias("n")).join(own, "v", "left").select("v", (F.col("n") - F.coalesce("own", F.lit(0))).alias("s"))


def linked(members: DataFrame, bags: DataFrame, least: float = SIMILARITY, rounds: int = ROUNDS) -> DataFrame | None:
    """(node, root) for the vertices that are near-duplicates of others; None if none are.

    ``members`` is (bucket, v, n), stored; ``n`` is the size of the multiset.
    """
    roots = None
    close = F.least("n", "m") >= least * F.greatest("n", "m")  # else no overlap will do

    def placed() -> DataFrame:
        if roots is None:
            return members.withColumn("root", F.col("v"))
        joined = members.join(roots.withColumnRenamed("node", "v"), "v", "left").withColumn("root", F.coalesce("root", "v"))
        return materialize(joined, "placed")

    for number in range(rounds):
        rows = placed()
        leader = F.min_by(F.struct("v", "n", "root"), F.xxhash64("v", F.lit(number)))
        split = rows.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), leader.alias("x")).filter("lo <> hi")
        other = split.select("bucket", F.col("x.v").alias("w"), F.col("x.n").alias("m"), F.col("x.root").alias("other"))
        pairs = rows.join(other, "bucket").filter((F.col("root") != F.col("other")) & close)
        pairs = materialize(pairs.select(F.least("v", "w").alias("a"), F.greatest("v", "w").alias("b")).distinct(), "candidate-pairs")
        near = verified(pairs, bags, least)
        if not near.isEmpty():
            roots = merged(roots, near)
    # What is still apart. Two multisets have no more in common than either has with all
    # others that are left, which rules out nearly all pairs of a group without a link.
    rows = placed()
    split = rows.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket")
    left = rows.join(split, "bucket", "left_semi")
    shared = shared_sizes(bags.join(left.select("v").distinct(), "v", "left_semi"))
    left = left.join(shared, "v").filter(F.col("s") >= least * F.col("n"))
    left = materialize(left.select("bucket", "v", "n", "s", "root"), "left")
    sizes = left.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    few = left.join(sizes.filter(F.col("members") <= FEW).select("bucket"), "bucket", "left_semi")
    x, y = few.alias("x"), few.alias("y")
    both = F.least("x.s", "y.s")
    apart = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.root") < F.col("y.root")) & (both >= least * (F.col("x.n") + F.col("y.n") - both))
    pairs = x.join(y, apart).select(F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b")).distinct()
    near = verified(pairs, bags, least).unionByName(among_many(left, sizes.filter(F.col("members") > FEW), bags, least))
    return roots if near.isEmpty() else merged(roots, near)


def among_many(left: DataFrame, sizes: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """Links (a, b) within large buckets (bucket, members) that join all that is near there,
    stored. A bucket is cut into blocks and each pair of blocks is compared by one product
    of their count tables; a task gives back no more links than it has vertices."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = left.join(sizes, "bucket").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("v", "bucket"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "v", "root").join(bags, "v")
    return materialize(rows.groupBy("bucket", "lo", "hi").applyInArrow(lambda t: near_in(t, least), "a long, b long"), "near-among-many")


def near_in(table: pa.Table, least: float) -> pa.Table:
    """Spanning links of the near pairs of different roots in a table (v, root, bag)."""
    v, root = table["v"].to_numpy(), table["root"].to_numpy()
    bags = table["bag"].combine_chunks()
    sizes = np.diff(bags.offsets.to_numpy())
    doc, hashes, counts = multiset(np.repeat(np.arange(len(v)), sizes), bags.flatten().to_numpy().view(np.uint64))
    # The k-th occurrence of a hash is a token; those that two texts have fill the table.
    which = np.repeat(np.arange(len(doc)), counts)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    _, token, seen = np.unique(mixed(hashes[which] ^ mixed(nth.astype(np.uint64))), return_inverse=True, return_counts=True)
    common = seen[token] > 1
    _, token = np.unique(token[common], return_inverse=True)
    has = np.zeros((len(v), int(token.max(initial=-1)) + 1), np.float32)
    has[doc[which[common]], token] = 1
    both = has @ has.T
    i, j = np.nonzero(np.triu(both >= least * (sizes[:, None] + sizes[None, :] - both), 1) & (root[:, None] != root[None, :]))
    first = np.arange(len(v))
    while True:  # the least place that can be reached
        new = first.copy()
        np.minimum.at(new, i, first[j])
        np.minimum.at(new, j, first[i])
        new = new[new]
        if (new == first).all():
            break
        first = new
    at = np.flatnonzero(first != np.arange(len(v)))
    return pa.table([pa.array(v[at]), pa.array(v[first[at]])], names=["a", "b"])


def grouped(docs: DataFrame, id_col: str, text_col: str, least: float) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, key of the text) and the root of each key's component."""
    rows = materialize(signed(docs, id_col, text_col), "signatures")
    classes = rows.groupBy("key").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("v", F.monotonically_increasing_id()), "classes")
    each = classes.select("v", F.col("n").cast("int").alias("n"), F.posexplode("bands").alias("band", "hash")).select("v", "n", F.xxhash64("band", "hash").alias("bucket"))
    shared = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("bucket")
    members = materialize(each.join(shared, "bucket").select("bucket", "v", "n"), "members")
    bags = contents(docs, classes.join(members.select("v").distinct(), "v", "left_semi"), text_col)
    roots = linked(members, bags, least)
    told = classes.select("key", "v").withColumn("root", F.col("v"))
    if roots is not None:
        told = told.drop("root").join(roots.withColumnRenamed("node", "v"), "v", "left").withColumn("root", F.coalesce("root", "v"))
    return rows.select("doc_id", "key"), told.select("key", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, key (of its text), component_id (the least id of all
    near-duplicates, by way of others too), kept (whether it is that one)."""
    rows, told = grouped(docs, id_col, text_col, least)
    firsts = rows.groupBy("key").agg(F.min("doc_id").alias("first"))
    told = told.join(firsts, "key")
    least_id = told.groupBy("root").agg(F.min("first").alias("component_id"))
    told = told.join(least_id, "root").select("key", "component_id")
    return rows.join(told, "key").select("doc_id", "key", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def distinct_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row of each component, with all its columns: of the least id (a null one only where
    there is no other), then of the text with the least key; of rows that share both any one."""
    rows, told = grouped(docs, id_col, text_col, least)
    # Rows that share id and text are one line here, with their number.
    lines = rows.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    best = lines.join(told, "key").groupBy("root").agg(F.min_by(F.struct("doc_id", "key", "copies"), order).alias("best"))
    best = materialize(best.select(F.col("best.doc_id").alias("_kept_id"), F.col("best.key").alias("_kept_key"), F.col("best.copies").alias("_copies")), "kept-lines")

    def of(lines: DataFrame) -> DataFrame:
        same = text_key(docs[f"`{text_col}`"]).eqNullSafe(lines["_kept_key"]) & docs[f"`{id_col}`"].cast("long").eqNullSafe(lines["_kept_id"])
        return docs.join(lines, same, "left_semi")

    repeated = best.filter("_copies > 1")
    if repeated.isEmpty():
        return of(best)
    single, many = of(best.filter("_copies = 1")), of(repeated)
    whole = F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")
    id_, key = F.col(f"`{id_col}`").cast("long"), text_key(F.col(f"`{text_col}`"))
    one = many.groupBy(id_.alias("_kept_id"), key.alias("_kept_key")).agg(whole).select("row.*")
    return single.unionByName(one)
