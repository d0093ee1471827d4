"""Deleted interpolation against a plain computation with dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from notegrove.llm import interpolation, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lower), None]


def fold(doc_id):
    return 9 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 10


def counts_of(texts, order):
    """Counts of n-grams of each order, with the texts' beginnings; contexts are the order below."""
    out = [Counter() for _ in range(order + 1)]
    for t in texts:
        padded = ["begin"] * (order - 1) + t
        for i in range(order - 1, len(padded)):
            for k in range(1, order + 1):
                out[k][tuple(padded[i - k + 1 : i + 1])] += 1
        for k in range(1, order):
            out[k][("begin",) * k] += 1
    return out


def by_hand(rows, order=3):
    """(doc_id, held_out, n_tokens, n_known, N, base, score) with exact ratios in EM."""
    split = [(d, fold(d), tokens_of(t)) for d, t in rows]
    whole = counts_of([t for _, f, t in split if f != 0], order)
    kept = counts_of([t for _, f, t in split if f > 1], order)
    n = sum(len(t) for _, f, t in split if f != 0)
    vocabulary = len({g for g in whole[1] if g != ("begin",)})

    def parts(counts, total, t):
        """Per token and order the estimate and the context's bucket."""
        padded = ["begin"] * (order - 1) + t
        for i in range(order - 1, len(padded)):
            out = []
            for k in range(1, order + 1):
                context = total if k == 1 else counts[k - 1][tuple(padded[i - k + 1 : i])]
                c = counts[k][tuple(padded[i - k + 1 : i + 1])]
                out.append((c / context if context else 0.0, context.bit_length()))
            yield out

    held = [x for _, f, t in split if f == 1 for x in parts(kept, sum(len(t) for _, f, t in split if f > 1), t)]
    below = np.full(len(held), 1 / (vocabulary + 1))
    weights = []
    for k in range(order):
        f, b = np.array([x[k][0] for x in held]), np.array([x[k][1] for x in held], int)
        w = np.full(65, 0.5)
        for at in range(1, 65):
            r = f[b == at] / below[b == at]
            for _ in range(200):
                w[at] = (sum(w[at] * r / (w[at] * r + 1 - w[at])) + 0.5) / (len(r) + 1)
        w[0] = 0
        weights.append(w)
        if held:
            below = w[b] * f + (1 - w[b]) * below
    out = []
    for d, f, t in split:
        base = sum(math.log10((whole[1][(w,)] + 0.1) / (n + 0.1 * (vocabulary + 1))) for w in t)
        total = 0.0
        for x in parts(whole, n, t):
            p = 1 / (vocabulary + 1)
            for (estimate, bucket), w in zip(x, weights, strict=True):
                p = w[bucket] * estimate + (1 - w[bucket]) * p
            total += math.log10(p)
        out.append((d, f == 0, len(t), sum(whole[1][(w,)] > 0 for w in t), n, base, total))
    return out


def order_of(row):
    return (row[0] is None, row[0] or 0, row[2], row[6])


def check(df, rows, order=3):
    got = sorted((tuple(r) for r in interpolation.score(df, order=order).collect()), key=order_of)
    want = sorted(by_hand(rows, order), key=order_of)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=2e-3)


def test_against_plain_counts(spark, folder):
    docs = queries.table(spark, folder, "documents").select("doc_id", F.substring("text", 1, 1500).alias("text"))
    check(docs.repartition(3), [tuple(r) for r in docs.collect()])


ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "One two one TWO"), (4, "One two one TWO"), (None, "one two three"), (5, "Été été あい x"), (6, "w" * 3000 + " " + "v" * 64 + " " + "v" * 65),
    (7, "one two three " * 4000), (8, "a\u0085b \x0bc\x0c d"), (9, "\U0001f600 one"), (11, "two one"), (12, "one"), (13, "one two"), (31, "three two one"), (33, "x"),
]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_odd_rows(spark, order):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    for c in ("fold", "block", "word", "size", "hash", "n", "k", "bucket"):
        df = df.withColumn(c, F.lit("7"))
    assert {fold(d) for d, _ in ODD} >= {0, 1, 9}
    check(df, ODD, order)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    got = interpolation.score(df)
    assert got.count() == 0 and len(got.columns) == 7
    held = next(i for i in range(100) if fold(i) == 0)
    row = interpolation.score(spark.createDataFrame([(held, "no training text")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (4, 0, 0, 0.0, 0.0)


def test_any_blocks(spark, folder):
    """Texts dealt to other blocks give the same counts."""
    docs = queries.table(spark, folder, "documents").select("doc_id", F.substring("text", 1, 300).alias("text")).repartition(2)
    whole = {tuple(r)[:5] for r in interpolation.score(docs).collect()}
    data = np.frombuffer(b"one two  Three", np.uint8)
    assert interpolation.tokens_of(data, np.array([0, 3, 3, 14]))[1].tolist() == [2, 1, 3]
    assert {tuple(r)[:5] for r in interpolation.score(docs.repartition(40)).collect()} == whole


def test_probabilities_sum_to_one(spark):
    """Over all known words and one unknown, after any context."""
    model = interpolation.Mixture(10, 3, [np.full(65, 0.9), np.r_[0.0, np.full(64, 0.6)]])
    counts = [np.array([5, 3, 2, 0]), np.array([2, 1, 0, 0])]
    assert math.isclose(model.probability(counts, [np.full(4, 3)]).sum(), 1)
    assert math.isclose(model.probability([counts[0], np.zeros(4, int)], [np.zeros(4, int)]).sum(), 1)
