"""JSON arrays read by byte ranges: one large file is as many tasks as it has ranges.

Spark's text reader cuts the files at every closing brace and so may begin anywhere. What a
range cannot know is where it stands: inside a string or not, and how deep. So a first pass
sums each range up for both cases (the state behind it, the change of depth, and how many
braces close at which depth), the summaries are folded over the ranges of a file, and a second
pass, now knowing its state and the number of records before it, cuts the records out. A record
that crosses a border comes in parts, which are put together by its number.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notegrove.sources.readers import running_starts
from notegrove.workspace import materialize, new_folder

# An escaped character, or one that opens or closes something.
_SPECIAL = re.compile(r'\\.|["{}\[\]]', re.S)
RECORD_DEPTH = 1  # of the array, to which a record's closing brace leads back


def braces(text: str, in_string: bool, depth: int) -> Iterator[tuple[int, str, bool, int]]:
    """Place behind, character, state and depth behind it, of every brace, bracket and quote."""
    for found in _SPECIAL.finditer(text):
        mark = found[0]
        if mark == '"':
            in_string = not in_string
        elif in_string or len(mark) > 1:
            continue
        else:
            depth += 1 if mark in "{[" else -1
        yield found.end(), mark, in_string, depth


class Summary:
    """What a range does, begun in or out of a string at depth 0."""

    def __init__(self, in_string: bool):
        self.in_string, self.depth, self.closed = in_string, 0, Counter()

    def add(self, text: str) -> None:
        for _, mark, self.in_string, self.depth in braces(text, self.in_string, self.depth):
            if mark == "}":
                self.closed[self.depth] += 1


_CASE = "struct<in_string:boolean,depth:int,levels:array<int>,counts:array<bigint>>"
SUMMARY = f"file string, start bigint, plain {_CASE}, quoted {_CASE}"
STATE = "file string, start bigint, in_string boolean, depth int, before bigint, n bigint"
PART = "file string, start bigint, record bigint, whole boolean, text string"


def _by_range(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """(file, start, the other columns) of the fragments, in order; a fragment lost its brace."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, both, rows = None, (), []

    def case(s: Summary) -> dict:
        return {"in_string": s.in_string, "depth": s.depth, "levels": list(s.closed), "counts": list(s.closed.values())}

    for file, start, text in _by_range(batches, ["file", "start", "text"]):
        if (file, start) != at:
            at, both = (file, start), (Summary(False), Summary(True))
            rows.append((at, both))
        for s in both:
            s.add(text + "}")
    kind = pa.struct([("in_string", pa.bool_()), ("depth", pa.int32()), ("levels", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r[0][0] for r in rows], pa.string()),
            pa.array([r[0][1] for r in rows], pa.int64()),
            *(pa.array([case(r[1][i]) for r in rows], kind) for i in (0, 1)),
        ],
        names=["file", "start", "plain", "quoted"],
    )


def _folded(ranges: pa.Table) -> pa.Table:
    """The state at each range's beginning; one row per range of one file comes in here."""
    rows, out = ranges.sort_by("start").to_pylist(), []
    in_string, depth, before = False, 0, 0
    for r in rows:
        mine = r["quoted" if in_string else "plain"]
        n = dict(zip(mine["levels"], mine["counts"], strict=True)).get(RECORD_DEPTH - depth, 0)
        out.append((r["file"], r["start"], in_string, depth, before, n))
        in_string, depth, before = mine["in_string"], depth + mine["depth"], before + n
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in STATE.split(", ")]
    return pa.Table.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, or their parts, by their number in the file."""
    names = ["file", "start", "text", "in_string", "depth", "before"]
    at, held, rows = None, [], []
    in_string, depth, record, opened, split = False, 0, 0, False, False
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def packed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in PART.split(", ")])
        rows.clear()
        return out

    def leave() -> None:
        """What is open at the end of a range goes on in the next one."""
        if at and opened and held:
            rows.append((*at, record, False, "".join(held)))

    for file, start, text, *state in _by_range(batches, names):
        if (file, start) != at:
            leave()
            at, held = (file, start), []
            in_string, depth, record = state[0], state[1], state[2] + 1
            opened = split = depth > RECORD_DEPTH
        text += "}"
        begin = 0
        for end, mark, in_string, depth in braces(text, in_string, depth):
            if mark == "{" and depth == RECORD_DEPTH + 1:
                opened, split, begin, held = True, False, end - 1, []
            elif mark == "}" and depth == RECORD_DEPTH and opened:
                held.append(text[begin:end])
                rows.append((*at, record, not split, "".join(held)))
                opened, held, record = False, [], record + 1
        if opened:
            held.append(text[begin:])
        if len(rows) >= 10_000:
            yield packed()
    leave()
    yield packed()


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """file, start of the byte range, text up to the next closing brace; in order per range."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("text"),
    )


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """``id, text`` of all records of JSON-array files: a dense 1-based id in file and array
    order, and the record's JSON."""
    pieces = fragments(spark, path)
    ranges = materialize(pieces.mapInArrow(_summed, SUMMARY), "json-ranges")
    states = materialize(ranges.groupBy("file").applyInArrow(_folded, STATE), "json-states")
    files = states.groupBy("file").agg(F.sum("n").alias("n"))
    starts = running_starts(files, "file").withColumnRenamed("start", "first")
    # A row for each range of the input, sent to the tasks that read the ranges.
    known = F.broadcast(states.select("file", "start", "in_string", "depth", "before"))
    parts = pieces.join(known, ["file", "start"]).mapInArrow(_cut, PART)
    parts = materialize(parts, "json-parts")
    whole = parts.where("whole").select("file", "record", "text")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "")
    split = parts.where("NOT whole").groupBy("file", "record").agg(joined.alias("text"))
    rows = whole.unionByName(split).join(F.broadcast(starts), "file")
    return rows.select((F.col("first") + F.col("record")).alias("id"), "text")


def array_to_rows(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Records of JSON-array files with a dense 1-based ``id``; without a schema it is inferred
    from all records."""
    records = array_records(spark, path)
    if schema is None:
        lines = new_folder(spark, "json-lines")
        # A line break is white space in JSON: none is allowed inside a string.
        records.select(F.regexp_replace("text", r"[\r\n]", " ")).write.text(lines)
        schema = spark.read.json(lines).schema
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return records.select("id", F.from_json("text", kind).alias("record")).select("id", "record.*")
