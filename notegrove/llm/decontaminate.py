"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may occur with e = m * rate edits (insertions, deletions, replaced
characters). Cut into e + 1 pieces, at least one piece is then left as it was, so every
occurrence holds an exact piece. One automaton finds the pieces of all items in a text in one
pass; each hit fixes where the item would lie, and Myers' bit-parallel algorithm finds the
least distance of the item to a passage there. Nothing is sampled: an occurrence within the
budget is always found.

Both sides are compared in lower case with everything that is no letter or digit read as one
space. The items are a stated query set: they are sent in blocks of bounded size, and every
block meets all texts; texts are not shuffled.

Defined results: null and empty texts match nothing; an item without letters or digits
matches nothing; an item too short for any edit has to occur as whole words; repeated
documents match each on their own; repeated items each count; empty tables give an empty
result. Other columns of the inputs are never read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.workspace import materialize

EDIT_RATE = 0.08
# Characters of items that are sent to the tasks at once.
BLOCK_CHARS = 4_000_000

MATCH = "item_id long, distance int, start int, stop int"
_WORDS = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    return " ".join(_WORDS.findall(text or "")).lower()


def distance_in(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Myers: the least edits that turn ``pattern`` into some passage of ``text``, and where
    the first such passage ends. None if it takes more than ``most``."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, high, get = (1 << m) - 1, 1 << (m - 1), masks.get
    plus, minus, score, best, at = full, 0, m, most + 1, -1
    for j, c in enumerate(text):
        same = get(c, 0)
        vertical = same | minus
        diagonal = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            if score < best:
                best, at = score, j + 1
                if not best:
                    break
        up <<= 1
        plus = (down << 1 | ~(vertical | up)) & full
        minus = up & vertical & full
    return (best, at) if best <= most else None


class Items:
    """A block of items: their pieces in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(key, text, int(len(text) * rate)) for key, text in items if text]
        self.automaton = ahocorasick.Automaton()
        for i, (_, text, edits) in enumerate(self.items):
            cuts = [len(text) * k // (edits + 1) for k in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                self._add(text[a:b], (i, a))
        if self.items:
            self.automaton.make_automaton()

    def _add(self, piece: str, where: tuple[int, int]) -> None:
        if piece in self.automaton:
            self.automaton.get(piece).append((*where, len(piece)))
        else:
            self.automaton.add_word(piece, [(*where, len(piece))])

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item's place, edits, start, stop) of the closest passage for every item that
        occurs in a normal text; of equally close ones the first."""
        if not self.items:  # an automaton without words cannot be asked
            return []
        at: dict[int, set[int]] = {}
        for end, found in self.automaton.iter(text):
            for i, a, n in found:
                at.setdefault(i, set()).add(end + 1 - n - a)
        out = []
        for i, shifts in at.items():
            _, item, edits = self.items[i]
            hit = self._closest(item, edits, text, sorted(shifts))
            if hit:
                out.append((i, *hit))
        return sorted(out)

    @staticmethod
    def _closest(item: str, edits: int, text: str, shifts: list[int]) -> tuple[int, int, int] | None:
        m, best = len(item), None
        if not edits:
            whole = (s for s in shifts if f" {text[max(0, s - 1) : s + m + 1]} ".find(f" {item} ") >= 0 and (s == 0 or text[s - 1] == " "))
            s = next(whole, None)
            return None if s is None else (0, s, s + m)
        k = 0
        while k < len(shifts):
            first = last = shifts[k]
            while k < len(shifts) and shifts[k] <= last + edits:  # hits that meet in one window
                last, k = shifts[k], k + 1
            lo = max(0, first - edits)
            window = text[lo : last + m + edits]
            if first == last and first >= 0 and text.startswith(item, first):
                return 0, first, first + m
            hit = distance_in(item, window, edits if best is None else best[0] - 1)
            if hit:
                stop = hit[1]
                back = distance_in(item[::-1], window[:stop][::-1], hit[0])
                best = hit[0], lo + stop - back[1], lo + stop
                if not best[0]:
                    break
        return best


def original_span(text: str, start: int, stop: int) -> tuple[int, int]:
    """Where a span of the normal text lies in the text itself."""
    at, first, last = 0, 0, 0
    for w in _WORDS.finditer(text):
        n = len(w.group().lower())
        if at <= start < at + n + 1:
            first = w.start() + min(max(start - at, 0), len(w.group()))
        if at < stop:
            last = w.start() + min(stop - at, len(w.group()))
        at += n + 1
    return first, last


def blocks(items: DataFrame, id_col: str, text_col: str, most: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of ``most`` characters (or of one item, if it is longer)."""
    block, size = [], 0
    for key, text in items.select(F.col(id_col).cast("long"), F.col(text_col)).toLocalIterator():
        text = normal(text)
        if block and size + len(text) > most:
            yield block
            block, size = [], 0
        block.append((key, text))
        size += len(text)
    if block:
        yield block


MATCHES = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))


def matches_of(spark: SparkSession, block: list[tuple[int, str]], rate: float = EDIT_RATE) -> Callable[[Column], Column]:
    """A column function: all matches of a block of items in a text. The block is sent once
    to each executor; its size is bounded by ``blocks``."""
    sent = spark.sparkContext.broadcast(block)
    known: list[Items] = []

    @F.arrow_udf(f"array<struct<{MATCH}>>")
    def matches(texts: pa.Array) -> pa.Array:
        if not known:
            known.append(Items(sent.value, rate))
        out = []
        for text in texts:
            text = text.as_py()
            found = known[0].matches(normal(text)) if text else ()
            rows = []
            for k, distance, start, stop in found:
                start, stop = original_span(text, start, stop)
                rows.append({"item_id": known[0].items[k][0], "distance": distance, "start": start, "stop": stop})
            out.append(rows)
        return pa.array(out, MATCHES)

    return matches


def find(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE
) -> DataFrame:
    """One row per document and item that occurs in it: the least edits, and the passage
    (code points of the text, end exclusive)."""
    spark, found = docs.sparkSession, None
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    for block in blocks(items, item_col, item_text):
        rows = docs.select("doc_id", F.inline(matches_of(spark, block, rate)("text")))
        if found is not None or sum(len(t) for _, t in block) > BLOCK_CHARS // 2:
            rows = materialize(rows, "benchmark-matches")  # lets go of the block
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], f"doc_id long, {MATCH}") if found is None else found


def clean(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE
) -> DataFrame:
    """The rows whose text holds no item, with all columns. Nothing is joined or shuffled."""
    names = docs.columns
    for block in blocks(items, item_col, item_text):
        docs = docs.filter(F.size(matches_of(docs.sparkSession, block, rate)(F.col(f"`{text_col}`"))) == 0)
        if sum(len(t) for _, t in block) > BLOCK_CHARS // 2:
            docs = materialize(docs, "clean-of-block")
    return docs.select(*(f"`{c}`" for c in names))
