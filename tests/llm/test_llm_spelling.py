"""Spelling variants against edit distances of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from notegrove.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in map(lower, RUN.findall(text or "")):
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def by_hand(words):
    """Candidates share what is left without one letter, which all near words do."""
    groups = {}
    for w in words:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            groups.setdefault(x, []).append(w)
    near = {w: set() for w in words}
    for group in groups.values():
        for a in group:
            near[a].update(b for b in group if one_apart(a, b))
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def same(got, words):
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == by_hand(words)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query(spark, size):
    folder = f"/root/testdata/{size}"
    docs = queries.table(spark, folder, "documents")
    words = vocabulary([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert len(words) > 800
    same(queries.QUERIES["op13_spelling_variants"](spark, folder), words)


def words_at_random(seed, n):
    """Words over few letters, so that near ones, runs of a letter and long chains abound."""
    rnd = random.Random(seed)
    out = {"abcdef" + "x" * 400: 7, "abcdef" + "x" * 399: 40, "abcdefg": 5, "abcdeg": 25, "abcdegg": 125, "abcdeggg": 625, "abcdeÿg": 5, "aaaaaa": 9, "aaaaaaa": 9}
    for _ in range(n):
        out["".join(rnd.choices("abé", [5, 3, 1], k=rnd.randrange(6, 13)))] = rnd.choice([5, 6, 30, 31, 200, 1001])
    return out


@pytest.mark.parametrize("letters", [1000, 100_000])
def test_at_random(spark, letters):
    """One shard, and many with letters that begin more words than a shard holds."""
    words = words_at_random(letters, 1500)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    same(spelling.variants(df.repartition(4), letters), words)


def test_index():
    """Intervals of both directions against a plain search."""
    words = sorted(words_at_random(3, 60))[:40]
    index, text = spelling.Index(words), "|" + "|".join(words) + "|"
    for pattern in ("a", "ab", "|a", "b|", "|" + words[3] + "|", "bb", "aab"):
        codes = [1 if c == "|" else int(index.symbols(np.array([ord(c)], np.uint32))[0]) for c in pattern]
        count = sum(text.startswith(pattern, i) for i in range(len(text)))
        for turn in range(len(codes) + 1):
            m = index.all(np.array([0]))
            for c in codes[turn:]:
                m = index.extended(m, np.full(len(m.word), c), True)
            for c in reversed(codes[:turn]):
                m = index.extended(m, np.full(len(m.word), c), False)
            assert m.size.sum() == count
            if pattern.count("|") == 2:
                assert words[index.words[m.lo[0]]] == pattern[1:-1]


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "1234 !!"), (None, "Colour colour COLOUR colour colour"), (4, "coloré " * 30), (4, "coloré " * 30), (5, "colours " * 5 + "Colours×"),
        (6, "x" * 60_000 + " " + "short " * 9), (7, "İstanbul " * 9 + "\U0001f600"), (8, "Écoleés " * 6 + "écoleés " * 5),
    ] + [(k, "colouring colorings") for k in range(100, 14_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("id", "run", "word", "n", "key", "right", "slice", "root", "near"):
        df = df.withColumn(c, F.lit("7"))
    words = vocabulary(rows)
    assert {"colour", "colouring", "colorings"} < set(words) and len(words) > 12
    same(spelling.misspelt_variants(df), words)
    assert spelling.misspelt_variants(df.limit(0)).count() == 0
