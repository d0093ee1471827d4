"""Conversation repair against a plain shortest path over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from notegrove.llm import queries, repair

SOUND = re.compile("(s?(ua)+)?")
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired rows): the least of all edit sequences, by cost, then audit."""
    ways = {"": (0, "", [])}  # by the initials' tail that decides how to go on

    def tail(initials):
        return initials if len(initials) < 2 and "a" not in initials else initials[-1]

    def better(to, initials, way):
        key = tail(initials)
        if key not in to or way[:2] < to[key][:2]:
            to[key] = way

    def fits(key, initial):
        return initial == "s" and key == "" or initial == "u" and key in ("", "s", "a") or initial == "a" and key == "u"

    def inserts(ways):
        for _ in range(3):
            for key, (cost, audit, out) in list(ways.items()):
                for role in ("user", "assistant"):
                    if fits(key, role[0]):
                        better(ways, key + role[0], (cost + 3, audit + "I", [*out, (role, "")]))
        return ways

    for role, text, fault in rows:
        to = {}
        for key, (cost, audit, out) in inserts(ways).items():
            better(to, key, (cost + 4, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 * (fault == "truncated")
            if fits(key, role[:1]):
                better(to, key + role[0], (cost + extra, audit + "K", [*out, (role, text)]))
            for new in ("user", "assistant"):
                if fits(key, new[0]):
                    better(to, key + new[0], (cost + 3 + extra, audit + "R", [*out, (new, text)]))
        ways = to
    inserts(ways)
    return min((ways[k] for k in ("", "a") if k in ways), key=lambda w: w[:2])


def by_hand(original, rows):
    out = []
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, judged = set(), []
        for _, _, role, text in mine:
            bare = re.sub("[\x20\x09-\x0d]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = {t for _, t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, turns = cheapest(judged)
        assert SOUND.fullmatch("".join(r[0] for r, _ in turns))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out.append((conv, gaps, *(sum(f == k for _, _, f in judged) for k in NAMES[2:5]), illegal, cost, audit, digest))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0)
    assert got.columns == NAMES
    got = sorted((tuple(r) for r in got.collect()), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g == w


def test_query(spark, folder):
    rows = [tuple(r) for r in queries.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    same(queries.QUERIES["op12_conversation_repair"](spark, folder), by_hand(rows, damage(rows)))


def rows_at_random(seed, conversations, longest):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "Cut off", "", " \n", "Why?  \t", "é\U0001f600", "one. two", None, " "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "Ümlaut", "a", "u"]
    out = []
    for conv in [None, *range(conversations)]:
        for turn in range(rnd.randrange(longest)):
            text = rnd.choice(texts) if rnd.random() < 0.5 else f"Text {rnd.randrange(10**6)}" + rnd.choice([".", "!", "", " ?"])
            out.append((conv, rnd.choice([turn, turn, 2 * turn, None, -turn]), rnd.choice(roles), text))
    return out


KIND = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_at_random(spark, chunk):
    """Chunks of any size, so that cost vectors and states cross many borders."""
    rows = rows_at_random(chunk, 60, 40)
    df = spark.createDataFrame(rows, KIND)
    for c in ("kind", "copy", "pos", "first", "id", "code", "edits", "tie"):
        df = df.withColumn(c, F.lit("7"))
    same(repair.report_damaged(df.repartition(5), chunk), by_hand(rows, damage(rows)))


def test_one_long_conversation(spark):
    """Mostly repeats, rows without a usable role, and one id for all rows."""
    rows = [(1, t, "tool" if 300 < t < 400 else ("user", "assistant")[t % 2], f"{t}." if t % 3 or 300 < t < 400 else "again.") for t in range(1200)]
    df = spark.createDataFrame(rows, KIND)
    want = by_hand(rows, [(c, t, r, x) for c, t, r, x in rows])
    same(repair.report(df, 16), want)
    turns = repair.repaired(df, 64).orderBy("place").collect()
    assert SOUND.fullmatch("".join(t.role[0] for t in turns)) and [t.place for t in turns] == list(range(len(turns)))
    assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest() == want[0][-1]


def test_rank_convergence():
    """A rerun stops where the vectors meet again and equals a run from the end."""
    rnd = random.Random(5)
    for _ in range(300):
        codes = bytes(rnd.choices([0, 1, 2, 3, 5, 6], [1, 9, 9, 1, 2, 2], k=rnd.randrange(1, 60)))
        old = repair.run_back(codes, repair.UNKNOWN)
        after = repair.costs_before(rnd.randrange(8), repair.DONE)
        assert repair.run_back(codes, after, old) == repair.run_back(codes, after)


def test_empty(spark):
    df = spark.createDataFrame([], KIND)
    assert repair.report_damaged(df).count() == repair.repaired(df).count() == 0
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = repair.report_damaged(spark.createDataFrame([(dropped, 0, "user", "Hi.")], KIND)).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
