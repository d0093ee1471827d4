"""Filters as Column builders. Values are always literals, never pasted into SQL text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from notegrove.functions.text import STANDARD, Analyzer, join_tokens


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def eq(col, value) -> Column:
    """Exact, case-sensitive equality (reaches the Parquet scan)."""
    return _col(col) == F.lit(value)


def eq_ci(col, value) -> Column:
    """Equality up to case. Over a stored lower-cased column use ``eq`` with a lowered
    value instead: that one is pushed into the scan, this one is not."""
    return F.lower(_col(col)) == F.lower(F.lit(value))


def in_range(col, lo=None, hi=None, inclusive: bool = True) -> Column:
    """Bounded on either side; a null never passes."""
    c = _col(col)
    tests = []
    if lo is not None:
        tests.append(c >= F.lit(lo) if inclusive else c > F.lit(lo))
    if hi is not None:
        tests.append(c <= F.lit(hi) if inclusive else c < F.lit(hi))
    return every(*tests) if tests else c.isNotNull()


def every(*tests: Column) -> Column:
    return reduce(lambda a, b: a & b, tests)


def present(*cols) -> Column:
    return every(*[_col(c).isNotNull() for c in cols])


def holds_any(have: Column, wanted: Column) -> Column:
    """At least one of the wanted tokens is there."""
    return F.arrays_overlap(have, wanted)


def holds_all(have: Column, wanted: Column) -> Column:
    """Every wanted token is there; no tokens match nothing."""
    wanted = F.array_distinct(wanted)
    return (F.size(wanted) > 0) & (F.size(F.array_intersect(wanted, have)) == F.size(wanted))


def holds_phrase(have: Column, wanted: Column) -> Column:
    """The wanted tokens are there next to each other and in order."""
    return (F.size(wanted) > 0) & F.contains(join_tokens(have), join_tokens(wanted))


def any_token(col, text: str, analyzer: Analyzer = STANDARD) -> Column:
    """At least one token of ``text`` occurs. This and the tests below read every row's words;
    over a column of few different values let ``ReviewStore`` test those instead."""
    return holds_any(analyzer.tokens(_col(col)), analyzer.tokens(F.lit(text)))


def all_tokens(col, text: str, analyzer: Analyzer = STANDARD) -> Column:
    """Every token of ``text`` occurs; a text without tokens matches nothing."""
    return holds_all(analyzer.tokens(_col(col)), analyzer.tokens(F.lit(text)))


def phrase(col, text: str, analyzer: Analyzer = STANDARD) -> Column:
    """The tokens of ``text`` occur next to each other and in order."""
    return holds_phrase(analyzer.tokens(_col(col)), analyzer.tokens(F.lit(text)))
