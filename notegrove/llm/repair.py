"""Conversation structure repair by a rank-convergence parallel Viterbi search.

A sound conversation is empty or has the role initials ``s?(ua)+``. The cheapest edits that
make one sound are found by costs-to-the-end over four states (nothing yet, after a system, a
user, an assistant turn). Rows are cut into chunks. Every chunk first runs backwards from a
speculative cost vector. Then fix-up passes hand each chunk the vector at its successor's
beginning, and it runs again from its end until a vector differs from its old one by a constant
only (vectors are kept less their minimum, so: until it is equal), for the rest of the chunk
then stays. Passes end when no chunk's end vector changes; one or two do, unless rows without a
usable role follow each other over whole chunks, when a change may wander a chunk a pass. Rows
that have to be deleted change no vector and stand in no chunk. With all vectors stitched, each
chunk is traced from all four states, the states are handed on from chunk to chunk, and the
trace takes the ASCII-least of the cheapest edits at every row.

Only chunks and codes of rows are shuffled on the way. The texts are sorted once, over ranges
that cut a long conversation into many tasks, and read once more in order where a conversation
is written out or hashed; that stream holds one row at a time.

Defined results: null roles and texts are one space; a null id is a conversation; rows of one
turn (null turns first) are taken by role, then text; a role that does not begin with s, u or a
(an empty one included) cannot be kept; other columns are never read; no rows, no conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notegrove.workspace import materialize

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
CHUNK = 4096
BLANKS = " \t\n\x0b\x0c\r"

Costs = tuple[int, ...]

# States: nothing yet, after system, after user, after assistant. Where each role leads, where
# the one fitting user or assistant turn leads, and the cost of ending there.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
TURN = (USER, USER, ASSISTANT, USER)
DONE: Costs = (0, 2 * INSERT, INSERT, 0)
UNKNOWN: Costs = (0, 0, 0, 0)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# A row's code: the place of its role's initial here, four more if it is truncated.
INITIALS = "sua"


def _edits(code: int, after: Costs, state: int) -> dict[str, tuple[int, int]]:
    """Cost to the end and next state of each edit that deals with the row."""
    extra = TRUNCATED if code >= 4 else 0
    out = {"D": (DELETE + after[state], state)}
    if code % 4 < 3 and (to := NEXT[state].get(INITIALS[code % 4])) is not None:
        out["K"] = (extra + after[to], to)
    out["R"] = (REROLE + extra + after[TURN[state]], TURN[state])
    return out


@cache
def _before(code: int, after: Costs) -> Costs:
    costs = [min(c for c, _ in _edits(code, after, s).values()) for s in range(4)]
    for _ in range(3):
        costs = [min(c, INSERT + costs[TURN[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


@cache
def costs_before(code: int, after: Costs) -> Costs:
    """The least costs to the end before a row, less their minimum, from those behind it."""
    costs = _before(code, after)
    return tuple(c - min(costs) for c in costs)


@cache
def least_edits(code: int, after: Costs, state: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits up to this row's own, and the state behind it."""
    costs, out = _before(code, after), ""
    while True:
        options = {k: x for k, x in _edits(code, after, state).items() if x[0] == costs[state]}
        if "D" not in options and INSERT + costs[TURN[state]] == costs[state]:
            out, state = out + "I", TURN[state]
        else:
            edit = min(options)
            return out + edit, options[edit][1]


def last_inserts(state: int) -> str:
    return "I" * (DONE[state] // INSERT)


# --- Chunks ---


def run_back(codes: bytes, after: Costs, old: bytes = b"") -> bytes:
    """The vector before each row, four bytes a row; ``old`` ones stay from the first equal one
    (seen from the end) on."""
    out = bytearray(old or 4 * len(codes))
    for i in range(len(codes) - 1, -1, -1):
        after = costs_before(codes[i], after)
        if old and after == tuple(old[4 * i : 4 * i + 4]):
            break
        out[4 * i : 4 * i + 4] = bytes(after)
    return bytes(out)


def trace(codes: bytes, costs: bytes, after: bytes, state: int) -> tuple[list[str], int]:
    """The edits of each row from ``state`` on, and the state behind the chunk."""
    behind, out = costs[4:] + after, []
    for i, code in enumerate(codes):
        edits, state = least_edits(code, tuple(behind[4 * i : 4 * i + 4]), state)
        out.append(edits)
    return out, state


CHUNKS = "conv_id bigint, first bigint, next bigint, pos array<bigint>, codes binary, after binary, costs binary"
_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run chunks whose end vector is new (column ``new``)."""
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in ("codes", "after", "costs", "new")]
        afters, costs = [], []
        for codes, after, old, new in zip(*rows, strict=True):
            afters.append(after if new is None else new)
            costs.append(old if new is None else run_back(codes, tuple(new), old or b""))
        kept = [batch.column(c) for c in _NAMES[:5]]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(afters, pa.binary()), pa.array(costs, pa.binary())], names=_NAMES)


def cut(firsts: DataFrame, chunk: int) -> DataFrame:
    """Chunks of rows that may stay, each with its successor's first place."""
    run = F.floor(F.col("pos") / chunk)
    rows = firsts.groupBy("conv_id", run.alias("run")).agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    codes = F.unhex(F.array_join(F.transform("rows.code", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    rows = rows.select("conv_id", F.col("rows")[0]["pos"].alias("first"), F.col("rows.pos").alias("pos"), codes.alias("codes"))
    rows = materialize(rows, "repair-chunks")
    order = rows.select("conv_id", "first").withColumn("next", F.lead("first").over(Window.partitionBy("conv_id").orderBy("first")))
    return rows.join(order.select("first", "next"), "first")


def converged(chunks: DataFrame) -> DataFrame:
    """Chunks with their stitched backward costs."""
    end = F.when(F.col("next").isNull(), F.lit(bytes(DONE))).otherwise(F.lit(bytes(UNKNOWN)))
    none = F.lit(None).cast("binary")
    first = chunks.select(*_NAMES[:5], none.alias("after"), none.alias("costs"), end.alias("new"))
    now = materialize(first.mapInArrow(_back, CHUNKS), "repair-costs")
    while True:
        heads = now.select(F.col("first").alias("next"), F.substring("costs", 1, 4).alias("head"))
        stale = now.select("next", "after").join(heads, "next").where(F.col("after") != F.col("head"))
        if stale.isEmpty():
            return now
        new = F.when(F.col("head") != F.col("after"), F.col("head"))
        now = materialize(now.join(heads, "next", "left").select(*_NAMES, new.alias("new")).mapInArrow(_back, CHUNKS), "repair-costs")


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in ("codes", "costs", "after")]
        exits = [bytes(trace(*row, state)[1] for state in range(4)) for row in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("first"), pa.array(exits, pa.binary())], names=["conv_id", "first", "exits"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state at the beginning of each chunk; chunks come in order."""
    conv, state = object(), START
    for batch in batches:
        out = []
        for conv_id, exits in zip(batch.column("conv_id").to_pylist(), batch.column("exits").to_pylist(), strict=True):
            if conv_id != conv:
                conv, state = conv_id, START
            out.append(state)
            state = exits[state]
        yield pa.RecordBatch.from_arrays([batch.column("first"), pa.array(out, pa.int32())], names=["first", "state"])


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in ("codes", "costs", "after", "state")]
        edits = [trace(*row)[0] for row in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("pos"), pa.array(edits, pa.list_(pa.string()))], names=["conv_id", "pos", "edits"])


def edits_of(firsts: DataFrame, chunk: int) -> DataFrame:
    """(conv_id, pos, edits) of every row that may stay; the others are deleted."""
    chunks = converged(cut(firsts, chunk))
    exits = chunks.mapInArrow(_exits, "conv_id bigint, first bigint, exits binary")
    states = exits.repartition("conv_id").sortWithinPartitions("first").mapInArrow(_entries, "first bigint, state int")
    traced = chunks.join(states, "first").mapInArrow(_traced, "conv_id bigint, pos array<bigint>, edits array<string>")
    return traced.select("conv_id", F.explode(F.arrays_zip("pos", "edits")).alias("e")).select("conv_id", "e.pos", "e.edits")


# --- Whole conversations ---


def ends(text: Column) -> Column:
    """The last character that is not white space; empty in a blank text."""
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))


def in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the place ``pos`` in the order of all rows, stored."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    # Rows that are equal throughout may stand in several ranges as well.
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = ["conv_id", "turn", "role", "text", "tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    return materialize(rows.withColumn("pos", F.monotonically_increasing_id()), "repair-rows")


def may_stay(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, code) of the rows that are neither blank nor seen earlier."""
    last = ends(F.col("text"))
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    initial = F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(len(INITIALS))
    code = initial + F.when(last.isin(".", "!", "?"), 0).otherwise(4)
    rows = rows.where(last != "").select("conv_id", "pos", "role", F.unhex(F.sha2("text", 256)).alias("digest"), code.alias("code"))
    same = rows.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos"), F.first("code").alias("code"))
    return same.select("conv_id", "pos", "code")


def with_edits(rows: DataFrame, chunk: int) -> DataFrame:
    """All rows in order, each behind its edits; a conversation is in one partition."""
    ordered = in_order(rows)
    found = edits_of(may_stay(ordered), chunk)
    none = lambda kind: F.lit(None).cast(kind)
    edits = found.select("conv_id", "pos", none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), "edits")
    both = edits.unionByName(ordered.withColumn("edits", none("string")))
    # Of one place the row with edits comes first.
    return both.repartition("conv_id").sortWithinPartitions("pos", F.col("edits").asc_nulls_last())


class Walk:
    """One conversation, row by row: its faults, its edits and what it becomes."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.cost = conv_id, START, 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns: list[int] | None = None  # first, last, how many
        self.initial: str | None = None
        self.audit: list[str] = []
        self.digest, self.n_turns = hashlib.sha256(), 0

    def write(self, role: str, text: str) -> tuple[str, str]:
        self.digest.update(b"\n" * (self.n_turns > 0) + f"{role}:{text}".encode(errors="surrogatepass"))
        self.n_turns += 1
        return role, text

    def insert(self) -> tuple[str, str]:
        self.state = TURN[self.state]
        self.cost += INSERT
        return self.write(ROLE[self.state], "")

    def row(self, turn: int | None, role: str, text: str, edits: str | None) -> Iterator[tuple[str, str]]:
        """Take the next row; yields the turns that are written for it."""
        initial = role[:1]
        self.counts["illegal"] += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None:
            low, high, n = self.turns or (turn, None, 0)
            self.turns = [low, turn, n + (turn != high)]
        last = text.rstrip(BLANKS)[-1:]
        truncated = edits is not None and last not in (".", "!", "?")
        self.counts["truncated"] += truncated
        self.counts["blank"] += not last
        self.counts["duplicate"] += edits is None and bool(last)
        self.audit.append(edits or "D")
        for edit in edits or "D":
            if edit == "I":
                yield self.insert()
            elif edit == "D":
                self.cost += DELETE
            else:
                self.cost += TRUNCATED * truncated + REROLE * (edit == "R")
                self.state = TURN[self.state] if edit == "R" else NEXT[self.state][initial]
                yield self.write(ROLE[self.state] if edit == "R" else role, text)

    def end(self) -> Iterator[tuple[str, str]]:
        self.audit.append(last_inserts(self.state))
        for _ in self.audit[-1]:
            yield self.insert()

    def report(self) -> tuple:
        low, high, n = self.turns or (0, -1, 0)
        return self.conv_id, high - low + 1 - n, *self.counts.values(), self.cost, "".join(self.audit), self.digest.hexdigest()


REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
TURNS = "conv_id bigint, place bigint, role string, text string"
_BATCH = 1_000


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Walk, list[tuple[str, str]], bool]]:
    """Conversations row by row: the walk, the turns just written, whether it has ended."""
    walk, edits = None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "edits")]
        for conv_id, turn, role, text, mine in zip(*columns, strict=True):
            if walk is None or walk.conv_id != conv_id:
                if walk is not None:
                    yield walk, list(walk.end()), True
                walk = Walk(conv_id)
            if mine is not None:
                edits = mine
            else:
                yield walk, list(walk.row(turn, role, text, edits)), False
                edits = None
    if walk is not None:
        yield walk, list(walk.end()), True


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    fields = [c.split() for c in schema.split(", ")]
    held: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = zip(*held, strict=True) if held else [[] for _ in fields]
        out = pa.RecordBatch.from_arrays([pa.array(list(c), kinds[f[1]]) for c, f in zip(columns, fields, strict=True)], names=[f[0] for f in fields])
        held.clear()
        return out

    for row in rows:
        held.append(row)
        if len(held) == _BATCH:
            yield packed()
    yield packed()


def report(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Of each conversation the faults, the cheapest edits and a digest of what they make of it.

    ``rows`` has conv_id, turn, role, text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((walk.report() for walk, _, over in _walked(batches) if over), REPORT)

    return with_edits(rows, chunk).mapInArrow(run, REPORT)


def repaired(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place, role, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            for walk, written, _ in _walked(batches):
                for i, (role, text) in enumerate(written, walk.n_turns - len(written)):
                    yield walk.conv_id, i, role, text

        return _batches(turns(), TURNS)

    return with_edits(rows, chunk).mapInArrow(run, TURNS)


def damaged(rows: DataFrame) -> DataFrame:
    """Faults for tests of the repair, by the checksum of id and turn: of twenty rows one is
    dropped, one emptied, one loses its sentence ends, one is repeated, one becomes a user's."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(F.encode(name, "utf-8")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("kind", kind).where("kind <> 0").withColumn("copy", F.explode(copies))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def report_damaged(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``report`` of the damaged rows, with the conversations that lost all of them."""
    ids = rows.select(F.col("conv_id").cast("long").alias("id")).distinct()
    found = report(damaged(rows), chunk)
    both = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    empty = Walk(None).report()
    names = [c.split()[0] for c in REPORT.split(", ")]
    return both.select(F.col("id").alias("conv_id"), *(F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in zip(names[1:], empty[1:], strict=True)))
