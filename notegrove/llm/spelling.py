"""Spelling variants: frequent words one edit apart, by a bidirectional FM-index.

A word that is one edit away from another matches one of its halves exactly. So a search has
two parts: match the left half, anchored at the delimiter before it, and extend to the right
with one error up to the next delimiter; or match the right half and extend to the left. Both
run over suffix-rank intervals of the delimited vocabulary, kept in the text and in its
reverse at once, so that a match grows on either side. Ranks come from a wavelet matrix, and
all searches for words of one length advance together.

The vocabulary is dealt to shards of bounded size twice, by the first and by the last letters
that every half holds; the parts of a search that need them run there and nowhere else. Letters
that begin (or end) more words than a shard holds get several shards: each word is indexed in
one and searched in all of them. So no task holds more than its shard, and no pair is missed.

Counting words is an aggregation over all texts. Forms are a maximum per word; roots are found
by following forms in doubling steps. A form is at least ``RATIO`` times as frequent as its
word, so there are no rings, and no more steps than the logarithm of the largest count.

Defined results: null and empty texts have no words; a text without an id is never changed;
rows that repeat count as rows; other columns are never read; no words, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegrove.workspace import materialize

LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
# Code points (with delimiters) of a shard's index, about; words that are searched at once.
SHARD_LETTERS, SEARCHED = 400_000, 2048
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

END, DELIMITER = 0, 1


# --- The index ---


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the text's suffixes in order, by doubling the length they are sorted by."""
    n, length = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[:-length] += rank[length:] + 1
        order = np.argsort(key)
        steps = np.diff(key[order]) != 0
        rank[order] = np.concatenate([[0], np.cumsum(steps)])
        if rank[order[-1]] == n - 1:
            return order
        length *= 2


class Ranks:
    """Counts of a symbol, and of all smaller ones, in any range of a sequence."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            one = (symbols >> bit) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int64))
            symbols = np.concatenate([symbols[~one], symbols[one]])
        every = np.arange(n_symbols)
        self.begin = self._down(np.zeros(n_symbols, np.int64), every)

    def _down(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for level, zeros in enumerate(self.zeros):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            before = zeros[at]
            at = np.where(one, zeros[-1] + at - before, before)
        return at

    def __call__(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often ``symbol`` is before lo, how often in lo:hi, and smaller ones in lo:hi."""
        less = np.zeros(len(lo), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            less += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return lo - self.begin[symbol], hi - lo, less


@dataclass
class Matches:
    """Matches of searches: of which word, where in the ranks of the text's suffixes and of
    its reverse, and how many."""

    word: np.ndarray
    lo: np.ndarray
    back: np.ndarray
    size: np.ndarray

    def __getitem__(self, at) -> Matches:
        return Matches(self.word[at], self.lo[at], self.back[at], self.size[at])

    def __add__(self, other: Matches) -> Matches:
        return Matches(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in ("word", "lo", "back", "size")))


class Index:
    """A bidirectional FM-index of words that stand between delimiters."""

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
        self.alphabet = np.unique(np.concatenate([*points, np.empty(0, np.uint32)]))
        sizes = np.array([len(p) for p in points], int)
        at = np.concatenate([[0], np.cumsum(sizes + 1)])
        text = np.full(at[-1] + 1, DELIMITER)
        for p, start in zip(points, at, strict=False):
            text[start + 1 : start + 1 + len(p)] = self.symbols(p)
        n = len(self.alphabet) + 2
        text = np.append(text, END)
        order = suffix_array(text)
        back = np.append(text[-2::-1], END)
        self.n, self.n_symbols = len(text), n
        # The word that begins behind the delimiter at each rank.
        self.words = np.searchsorted(at, order)
        self.left = Ranks(text[order - 1], n)
        self.right = Ranks(back[suffix_array(back) - 1], n)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))])

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; those that no word has become the END, which is in no match."""
        at = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points if len(self.alphabet) else np.zeros(len(at), bool)
        return np.where(known, at + 2, END)

    def all(self, words: np.ndarray) -> Matches:
        zero = np.zeros(len(words), np.int64)
        return Matches(words, zero, zero, zero + self.n)

    def extended(self, m: Matches, symbol: np.ndarray, right: bool) -> Matches:
        """Matches with one more symbol on a side; those without any occurrence go."""
        if right:
            before, size, less = self.right(m.back, m.back + m.size, symbol)
            out = Matches(m.word, m.lo + less, self.smaller[symbol] + before, size)
        else:
            before, size, less = self.left(m.lo, m.lo + m.size, symbol)
            out = Matches(m.word, self.smaller[symbol] + before, m.back + less, size)
        return out[(size > 0) & (symbol != END)]

    def other(self, m: Matches, right: bool, but: np.ndarray | None) -> Matches:
        """Matches with any letter more on a side, except each one's of ``but``."""
        letters = np.arange(2, self.n_symbols)
        wide = m[np.repeat(np.arange(len(m.word)), len(letters))]
        symbol = np.tile(letters, len(m.word))
        if but is not None:
            keep = symbol != np.repeat(but, len(letters))
            wide, symbol = wide[keep], symbol[keep]
        return self.extended(wide, symbol, right)


def one_error(index: Index, words: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """Words of the index one edit away from ``words`` (a row of symbols each), where the half
    on the left (or, with ``right`` false, the one on the right) is the same.

    A letter is never inserted before its equal: it may as well be inserted behind it.
    """
    n, size = words.shape
    half = size // 2
    # The exact half from the inside to its delimiter, then the other from the inside on.
    exact, rest = (range(half - 1, -1, -1), range(half, size)) if right else (range(half, size), range(half - 1, -1, -1))
    none = index.all(np.arange(n))
    for j in exact:
        none = index.extended(none, words[none.word, j], not right)
    delimiter = lambda m, side: index.extended(m, np.full(len(m.word), DELIMITER), side)
    none = delimiter(none, not right)
    one = none[:0]
    for j in rest:
        wanted = words[:, j]
        replaced = index.other(none, right, wanted[none.word])
        inserted = index.extended(replaced, wanted[replaced.word], right)
        matched = index.extended(one, wanted[one.word], right)
        one = matched + replaced + inserted + none
        none = index.extended(none, wanted[none.word], right)
    found = delimiter(one + index.other(none, right, None), right)
    return found.word, index.words[found.lo]


def near_in_shard(words: list[str], indexed: np.ndarray, right: bool) -> Iterator[tuple[int, int]]:
    """Pairs of places in ``words``: a word and an indexed one, one edit away."""
    among = np.flatnonzero(indexed)
    index = Index([words[i] for i in among])
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        for k in range(0, len(mine), SEARCHED):
            some = mine[k : k + SEARCHED]
            points = np.frombuffer("".join(words[i] for i in some).encode("utf-32-le"), np.uint32)
            word, near = one_error(index, index.symbols(points).reshape(len(some), size), right)
            both = np.unique(np.stack([some[word], among[near]], 1), axis=0)
            for a, b in both.tolist():
                # What the right half finds with the same left half is found by that as well.
                if a != b and (right or words[a][: size // 2] != words[b][: size // 2]):
                    yield a, b


# --- Words, shards and forms ---


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run): the letter runs that can become words, A-Z in lower case."""
    found = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(RUN), F.lit(0))
    long = F.filter(found, lambda r: F.length(r) >= LEAST_LETTERS)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.explode(long).alias("run"))
    return rows.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))


def misspelt(doc_id: Column, run: Column) -> Column:
    """The run, which for one of 199 checksums of id and run has lost a letter."""
    h = F.crc32(F.encode(F.concat(doc_id.cast("string"), F.lit(":"), run), "utf-8"))
    at = (h % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % 199 == 0, shorter).otherwise(run)


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def near_words(words: DataFrame, shard_letters: int = SHARD_LETTERS) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, in both orders."""
    half = LEAST_LETTERS // 2
    sides = F.array(
        F.struct(F.lit(True).alias("right"), F.substring("word", 1, half).alias("key")),
        F.struct(F.lit(False).alias("right"), F.substring("word", -half, half).alias("key")),
    )
    rows = words.select("word", "n", F.inline(sides))
    letters = rows.groupBy("right", "key").agg(F.sum(F.length("word") + 1).alias("letters"))
    letters = materialize(letters, "spelling-keys")
    total = letters.agg(F.coalesce(F.sum("letters"), F.lit(0))).first()[0]
    shards = 1 + 2 * total // shard_letters
    slices = F.ceil(F.col("letters") / shard_letters).cast("int")
    rows = rows.join(letters.select("right", "key", slices.alias("slices")), ["right", "key"])
    own = F.pmod(F.xxhash64("word"), F.col("slices"))
    rows = rows.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    shard = F.pmod(F.xxhash64("right", "key", "slice"), F.lit(shards))
    rows = rows.select("right", shard.alias("shard"), "word", "n", (F.col("own") == F.col("slice")).alias("indexed"))

    def shard_pairs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        # A word stands here once for each slice of its letters that came to this shard.
        table = table.group_by(["word", "n"]).aggregate([("indexed", "any")]).sort_by("word")
        names, n = table["word"].to_pylist(), table["n"].to_numpy()
        pairs = np.array(list(near_in_shard(names, table["indexed_any"].to_numpy(), key[0].as_py())), np.int64).reshape(-1, 2)
        a, b = (table["word"].take(pa.array(pairs[:, i])) for i in (0, 1))
        return pa.Table.from_arrays([a, b, pa.array(n[pairs[:, 1]])], names=["word", "near", "near_n"])

    return rows.groupBy("right", "shard").applyInArrow(shard_pairs, "word string, near string, near_n bigint")


def followed(links: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms that begins at each linked word."""
    now = materialize(links, "spelling-links")
    while True:
        # Chains twice as long with every step; the words that are nobody's form drop out.
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        onward = materialize(onward.join(now.select("root").distinct(), "root", "left_semi"), "spelling-onward")
        if onward.isEmpty():
            return now
        now = materialize(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-links")


def variants(words: DataFrame, shard_letters: int = SHARD_LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n)."""
    words = materialize(words.select("word", "n"), "spelling-words")
    pairs = near_words(words, shard_letters)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best"))
    rows = words.join(best, "word", "left")
    frequent = -F.col("best.n") >= RATIO * F.col("n")
    rows = rows.select(
        "word", F.when(frequent, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, -F.col("best.n")).alias("form_n")
    )
    rows = materialize(rows, "spelling-forms")
    roots = followed(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def misspelt_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of all texts, some of which have lost a letter."""
    found = runs(docs, id_col, text_col)
    return variants(vocabulary(found.select(misspelt(F.col("id"), F.col("run")).alias("word"))))
