"""Edit budgets, deletion keys and edit distances for typo-tolerant matching."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Edits that deletion keys allow for, and the beginning of a word that they are made of.
MOST_EDITS = 2
KEY_LETTERS = 8


def auto_edits(term: Column) -> Column:
    """Automatic budget: up to 2 characters none, 3 to 5 one edit, longer two."""
    n = F.length(term)
    return F.when(n <= 2, 0).when(n <= 5, 1).otherwise(2)


def typo_edits(term: Column, one: int, two: int) -> Column:
    """One typo from ``one`` characters on, two from ``two`` on."""
    n = F.length(term)
    return F.when(n < one, 0).when(n < two, 1).otherwise(2)


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points of the words, one row each, zeros behind."""
    out = np.zeros((len(words), width), np.uint32)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def batch_swap_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distances in which exchanging two neighbouring characters costs one.

    Differences of a whole column of the distance table are bits of one machine word (of
    several in turn for longer words), and all pairs take a step together.
    """
    out = np.zeros(len(a), np.int32)
    size = np.array([len(x) for x in a], int)
    words = np.maximum((size + 63) // 64, 1)
    for n in np.unique(words):
        at = np.flatnonzero(words == n)
        out[at] = _swap_distances([a[i] for i in at], [b[i] for i in at], int(n))
    return out


def _swap_distances(a: list[str], b: list[str], n: int) -> np.ndarray:
    one, top = np.uint64(1), np.uint64(63)
    rows, columns = _codes(a, 64 * n), _codes(b, max(map(len, b), default=0))
    m, length = np.array([len(x) for x in a], int), np.array([len(x) for x in b], int)
    vp, vn = np.full((n, len(a)), ~np.uint64(0)), np.zeros((n, len(a)), np.uint64)
    d0, old = np.zeros_like(vn), np.zeros_like(vn)
    last, bit = np.maximum(m - 1, 0) // 64, (np.maximum(m - 1, 0) % 64).astype(np.uint64)
    each, score = np.arange(len(a)), m.copy()
    for j in range(columns.shape[1]):
        same = (rows == columns[:, j : j + 1]) & (rows != 0)
        match = np.packbits(same, axis=1, bitorder="little").view("<u8").T
        here = length > j
        # Carries into the next word: of the sum, the shifted matches and the differences.
        carry = swap = np.zeros(len(a), np.uint64)
        plus, minus = np.ones(len(a), np.uint64), np.zeros(len(a), np.uint64)
        new = [np.empty_like(vn) for _ in range(3)]
        up, down = np.empty_like(vn), np.empty_like(vn)
        for w in range(n):
            p, both = match[w], ~d0[w] & match[w]
            swapped = ((both << one) | swap) & old[w]
            swap = both >> top
            part = (p & vp[w]) + vp[w]
            over = part < vp[w]
            total = part + carry
            carry = (over | (total < part)).astype(np.uint64)
            d = (total ^ vp[w]) | p | vn[w] | swapped
            up[w], down[w] = vn[w] | ~(d | vp[w]), d & vp[w]
            hp, hn = (up[w] << one) | plus, (down[w] << one) | minus
            plus, minus = up[w] >> top, down[w] >> top
            new[0][w], new[1][w], new[2][w] = hn | ~(d | hp), hp & d, d
        step = (up[last, each] >> bit & one).astype(int) - (down[last, each] >> bit & one).astype(int)
        score += np.where(here, step, 0)
        vp, vn, d0 = (np.where(here, x, y) for x, y in zip(new, (vp, vn, d0)))
        old = np.where(here, match, old)
    return np.where(m == 0, length, score)


def swap_distances(a: Column, b: Column) -> Column:
    """``batch_swap_distances`` over Arrow batches; for pairs that survived the cheap checks."""

    def measure(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(batch_swap_distances(x.tolist(), y.tolist()))

    return F.pandas_udf(measure, "int")(a, b)


def beginning(term: Column) -> Column:
    """The part of a term that its deletion keys are made of."""
    return term.substr(1, KEY_LETTERS)


def deletion_keys(term: Column, edits: int) -> Column:
    """Hashes of every string left of the first ``KEY_LETTERS`` characters after removing up
    to ``edits`` of them.

    Two terms within that many edits of each other, exchanges of neighbours included, share
    at least one such string: of what is not matched within both beginnings no more has to
    go than there are edits. That turns the fuzzy join into an equality join.
    """
    keys = F.array(beginning(term))
    step = keys
    for _ in range(edits):
        step = F.flatten(F.transform(step, _drop_each))
        keys = F.concat(keys, step)
    return F.array_distinct(F.transform(keys, lambda k: F.xxhash64(k)))


def _drop_each(s: Column) -> Column:
    n = F.length(s)
    at = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        at, lambda i: F.concat(s.substr(F.lit(1), i - 1), s.substr(i + 1, n - i))
    )
