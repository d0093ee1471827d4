"""Chat formatting by schema fingerprints.

A record's layout is the set of those of its nested field paths that some mapping names. The
hash of these paths picks a declarative mapping (``LAYOUTS``), which names where the turns,
their roles, texts and order lie; so records of many layouts become canonical turns with one
expression and no parser. A mapping requires some paths and allows others, and has a hash
for each choice of those; fields that no mapping names (ids, names, scores) change nothing.
A record that two mappings claim parts of has a hash of neither.
Turns are then written with a template of control strings. A control string inside a text
gets one more backslash after its first character, which reading takes away again.

A conversation is written as segments, one per turn, that join to its text; so no task needs
to hold a conversation. ``read_back`` goes through the segments in order, a batch at a time.

Defined results: a null text is empty, a null role is the empty role; turns of a
conversation come by (turn, role, text), nulls first; turns that repeat all stay; a null
conversation id is a conversation of its own; an empty list of turns is known and gives no
turn; a list that is null or no list has no layout; of content that comes in parts the texts
of the parts are joined; a field that a mapping only allows gives no turn if it is null or
empty; records of an unknown layout are returned by ``unmapped``, counted by ``by_layout``
and give no turn; an empty table gives an empty result. Other top-level columns are part of
a record only if they are passed in.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Strings that chat templates give a meaning. None of them may stand in a
# formatted text but where this template puts it.
CONTROLS = (START, END, "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>", "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>")
_RESTS = "|".join(sorted((re.escape(c[1:]) for c in CONTROLS), key=len, reverse=True))
_GUARD = re.compile(rf"([<\[])(\\*)({_RESTS})")
_GUARDED = re.compile(rf"([<\[])\\(\\*)({_RESTS})")
LEARNED = "assistant"

ROLES = {"human": "user", "user": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "assistant": "assistant", "system": "system"}


# Fields nested deeper are told apart by nothing.
DEPTH = 5


@dataclass(frozen=True)
class Layout:
    """Where the canonical turns of a record lie, as variant paths.

    ``turns`` is an array of ``role`` and ``text`` paths; or ``fields`` lists (role, path)
    pairs in order; or the record is one turn itself, with ``turn`` as its place. ``paths``
    have to be there, ``optional`` ones may be.
    """

    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    turn: str = ""
    fields: tuple[tuple[str, str], ...] = ()


_PARTS = tuple(f"messages[].content[]{x}" for x in ("", ".text", ".type"))

LAYOUTS = (
    Layout(("role", "text", "turn"), role="$.role", text="$.text", turn="$.turn"),
    Layout(("messages[].content", "messages[].role"), _PARTS, turns="$.messages", role="$.role", text="$.content"),
    Layout(("messages[].content[].text", "messages[].role"), (_PARTS[0], _PARTS[2]), turns="$.messages", role="$.role", text="$.content"),
    Layout(("messages[]",), turns="$.messages", role="$.role", text="$.content"),
    Layout(("conversations[].from", "conversations[].value"), turns="$.conversations", role="$.from", text="$.value"),
    Layout(("conversations[]",), turns="$.conversations", role="$.from", text="$.value"),
    Layout(("completion", "prompt"), ("system",), fields=(("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout(("prompt", "response"), ("system",), fields=(("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response"))),
    Layout(("instruction", "output"), ("input", "system"), fields=(("system", "$.system"), ("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
)


def field_paths(record: Column, depth: int = DEPTH) -> Column:
    """The nested field paths of a variant: names after dots, ``[]`` for a list's elements."""

    def node(path: Column, value: Column) -> Column:
        return F.struct(path.alias("path"), value.alias("value"))

    def opened(n: Column) -> Column:
        """A node's children, one level down; a leaf stays as it is."""
        path, value = n["path"], n["value"]
        kind = F.schema_of_variant(value)
        entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
        elements = F.try_variant_get(value, "$", "array<variant>")
        inside = F.concat(path, F.lit("[]"))
        empty = F.array(node(inside, F.lit(None).cast("variant")))
        return (
            F.when(kind.startswith("OBJECT<") & (F.size(entries) > 0), F.transform(entries, lambda e: node(F.concat(path, F.lit("."), e["key"]), e["value"])))
            .when(kind.startswith("ARRAY<") & (F.size(elements) > 0), F.transform(elements, lambda x: node(inside, x)))
            .when(kind.startswith("ARRAY<"), empty)
            .otherwise(F.array(n))
        )

    nodes = F.array(node(F.lit(""), record))
    for _ in range(depth):
        nodes = F.flatten(F.transform(nodes, opened))
    return F.array_distinct(F.transform(nodes, lambda n: F.ltrim(n["path"], F.lit("."))))


def paths_named(layouts: tuple[Layout, ...]) -> list[str]:
    """All paths that a mapping requires or allows."""
    return sorted({p for t in layouts for p in t.paths + t.optional})


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The hash of those of a record's nested field paths that a mapping names."""
    named = F.array(*map(F.lit, paths_named(layouts)))
    # In the order of ``named``, so in order.
    return F.substring(F.sha2(F.array_join(F.array_intersect(named, field_paths(record)), "\n"), 256), 1, 16)


def fingerprints_of(layout: Layout) -> list[str]:
    """The fingerprints of all records that a mapping fits."""
    chosen = (c for n in range(len(layout.optional) + 1) for c in itertools.combinations(layout.optional, n))
    return [hashlib.sha256("\n".join(sorted({*layout.paths, *c})).encode()).hexdigest()[:16] for c in chosen]


def layout_of(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The place in ``layouts`` whose fingerprint is the record's; null if none is."""
    known: dict[str, int] = {}
    for i, layout in enumerate(layouts):
        for key in fingerprints_of(layout):
            known.setdefault(key, i)
    places = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    return F.try_element_at(places, fingerprint(record, layouts))


def text_of(value: Column) -> Column:
    """The text of a variant: itself, or the texts of its parts."""
    part = lambda x: F.coalesce(F.try_variant_get(x, "$.text", "string"), F.lit(""))
    parts = F.array_join(F.transform(F.try_variant_get(value, "$", "array<variant>"), part), "")
    return F.when(F.schema_of_variant(value).startswith("ARRAY<"), parts).otherwise(F.try_variant_get(value, "$", "string"))


def canonical(records: DataFrame, conv_id: str, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Records (variants) as canonical turns: conv_id, turn, role, text."""
    v = F.col(record)
    get = lambda x, path, kind: F.try_variant_get(x, path, kind)
    named = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    called = lambda role: F.coalesce(F.try_element_at(named, role), role)
    turn = "struct<turn:bigint,role:string,text:string>"
    which = F.col("_layout")
    turns = F.array().cast(f"array<{turn}>")
    for i, layout in enumerate(layouts):
        if layout.turns:
            one = partial(lambda t, x, k: F.struct(k.cast("long").alias("turn"), called(get(x, t.role, "string")).alias("role"), text_of(get(x, t.text, "variant")).alias("text")), layout)
            inner = F.transform(get(v, layout.turns, "array<variant>"), lambda x, k: one(x, k))  # noqa: B023
        elif layout.fields:
            always = [k for k, (_, path) in enumerate(layout.fields) if path.removeprefix("$.") in layout.paths]
            inner = F.filter(
                F.array(*(F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), get(v, path, "string").alias("text")) for k, (role, path) in enumerate(layout.fields))),
                partial(lambda ks, t: (F.coalesce(t["text"], F.lit("")) != "") | t["turn"].isin(ks), always),
            )
        else:
            inner = F.array(F.struct(get(v, layout.turn, "long").alias("turn"), get(v, layout.role, "string").alias("role"), get(v, layout.text, "string").alias("text")))
        turns = F.when(which == i, inner.cast(f"array<{turn}>")).otherwise(turns)
    known = records.select(F.col(conv_id).alias("conv_id"), v.alias(record), layout_of(v, layouts).alias("_layout"))
    each = known.select("conv_id", F.explode(turns).alias("t"))
    return each.select("conv_id", "t.turn", F.coalesce("t.role", F.lit("")).alias("role"), F.coalesce("t.text", F.lit("")).alias("text"))


def unmapped(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The records that no layout fits."""
    return records.filter(layout_of(F.col(record), layouts).isNull())


def by_layout(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """How many records each layout has: layout (null: none fits), n."""
    return records.groupBy(layout_of(F.col(record), layouts).alias("layout")).agg(F.count(F.lit(1)).alias("n"))


def guard(text: str) -> str:
    return _GUARD.sub(r"\1\\\2\3", text)


def unguard(text: str) -> str:
    return _GUARDED.sub(r"\1\2\3", text)


def segment(role: str, text: str) -> str:
    """One turn in the template. The role ends with its line."""
    line = guard(role.replace("\\", "\\\\").replace("\n", "\\n"))
    return f"{START}{line}\n{guard(text)}{END}\n"


def turn_of(formatted: str) -> tuple[str, str]:
    """Role and text of a segment; raises where the template is broken."""
    if not formatted.startswith(START) or not formatted.endswith(END + "\n"):
        raise ValueError("a segment does not begin and end as the template says")
    line, gap, text = formatted[len(START) : -len(END) - 1].partition("\n")
    if not gap or any(c in line or c in text for c in CONTROLS):
        raise ValueError("a control string within a segment")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unguard(line))
    return role, unguard(text)


SEGMENTS = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("mask_start", pa.int32()), ("mask_stop", pa.int32())])


def write_segments(turns: DataFrame) -> DataFrame:
    """One formatted segment per turn, in order within its conversation: the segments of a
    conversation, joined, are its text. The mask is the part of a segment whose loss counts
    (code points), empty where none does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first, last = [], [], []
            for role, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                whole = segment(role, text)
                stop = len(whole) - len(END) - 1
                texts.append(whole)
                first.append(whole.index("\n") + 1 if role == LEARNED else stop)
                last.append(stop)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(first, pa.int32()), pa.array(last, pa.int32())], schema=SEGMENTS)

    key = F.col("conv_id").cast("long")
    dealt = turns.select(key.alias("conv_id"), "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, formatted string, mask_start int, mask_stop int")


DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation what reading its segments gives: turns, texts under the mask, and
    their digests, added up while the segments pass. ``segments`` comes from
    ``write_segments``, whose order within partitions it relies on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_, rows = None, False, []

        def packed() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(DIGESTS)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, DIGESTS, strict=True)], schema=DIGESTS)

        for batch in batches:
            for conv, formatted, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not open_ or conv != key:
                    if open_:
                        rows.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), length))
                    key, open_, n, chars, length, turns, loss = conv, True, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                role, text = turn_of(formatted)
                learned = unguard(formatted[start:stop])
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(learned.encode())
                n, chars, length = n + 1, chars + len(learned), length + len(formatted)
            if len(rows) > 5000:
                yield packed()
                rows = []
        if open_:
            rows.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), length))
        yield packed()

    return segments.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
