"""Raw lines to typed, validated rows; rows that fail are set aside with the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegrove.functions.text import compose, strip
from notegrove.schema import (
    ALIASES,
    FIELDS,
    FLOAT_FIELDS,
    INT_FIELDS,
    KEY_OPTIONAL,
    NO_PRICE,
    NOT_NULL,
    REVIEW,
    STRING_FIELDS,
    UNKNOWN,
)


@dataclass(frozen=True)
class CleanProfile:
    """What counts as a missing country, and which parts make up the embedding text."""

    blanks: tuple[str, ...]
    embed_parts: tuple[str, ...] = ()
    # Stands in for an embedding part only when its key is absent from the record.
    absent_parts: tuple[tuple[str, str], ...] = ()


# The three ingest variants.
KEYWORD = CleanProfile(blanks=("null",))
VECTOR = CleanProfile(blanks=("",), embed_parts=("variety", "title", "description"))
VECTOR_PLACE = CleanProfile(
    blanks=("",),
    embed_parts=("variety", "country", "province", "title", "description"),
    absent_parts=(("country", UNKNOWN),),
)


def fill_missing(col: Column, blanks: tuple[str, ...] = (), fill: str = UNKNOWN) -> Column:
    """Replace null and the listed blank spellings, compared as they stand (unstripped)."""
    missing = col.isNull()
    for blank in blanks:
        missing = missing | (col == F.lit(blank))
    return F.when(missing, F.lit(fill)).otherwise(col)


# Spellings of numbers. The cast alone also takes suffixes ("90d") and names ("Infinity").
WHOLE_NUMBER = r"^[+-]?[0-9]+(\.0*)?$"
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_integer(col: Column) -> Column:
    """Whole numbers as digits ("90", "90.0"); null for anything else."""
    text = strip(col)
    digits = F.regexp_replace(text, r"\.0*$", "")
    return F.when(text.rlike(WHOLE_NUMBER), digits.try_cast("bigint"))


def to_number(col: Column) -> Column:
    text = strip(col)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def price_label(col: Column) -> Column:
    """The price as text, or the fixed label when there is none."""
    return F.coalesce(col.cast("string"), F.lit(NO_PRICE))


def parse(lines: DataFrame, profile: CleanProfile = KEYWORD) -> DataFrame:
    """``raw, input_file, reason`` plus the typed fields; ``reason`` is null for good rows."""
    # A JSON reader stops after the first value and takes what follows for granted. As the
    # first of two values of an array, the second of which the line cannot foresee, the line
    # has to be one whole value.
    end = F.xxhash64("line").cast("string")
    whole = F.concat(F.lit("["), F.col("line"), F.lit(',{"end":"'), end, F.lit('"}]'))
    strict = {"allowSingleQuotes": "false", "allowNumericLeadingZeros": "false"}
    # Generated columns, so that no filter or projection is merged into the parsing and
    # every line is parsed once however many fields and checks look at it.
    read = F.struct(
        F.from_json(whole, "array<map<string,string>>", strict).alias("texts"),
        # The values as typed in the line: a map of strings no longer knows 5 from "5".
        F.from_json(whole, "array<map<string,variant>>", strict).alias("values"),
    )
    lines = lines.select("line", "input_file", end.alias("end"), F.explode(F.array(read)).alias("read"))
    texts, values = F.col("read.texts"), F.col("read.values")
    sound = (F.size(texts) == 2) & (F.try_element_at(texts, F.lit(2))["end"] == F.col("end"))
    kinds = F.transform_values(F.try_element_at(values, F.lit(1)), lambda _, v: F.schema_of_variant(v))
    kept = F.struct(
        F.when(sound, _last_wins(F.try_element_at(texts, F.lit(1)))).alias("record"),
        F.when(sound, _last_wins(kinds)).alias("typed"),
    )
    lines = lines.select("line", "input_file", F.explode(F.array(kept)).alias("kept"))
    lines = lines.select("line", "input_file", "kept.record", "kept.typed")
    record = F.col("record")
    return lines.select(
        F.col("line").alias("raw"),
        "input_file",
        _reason(record, F.col("typed")).alias("reason"),
        *[_typed(record, f).alias(f) for f in FIELDS if f != "country"],
        strip(fill_missing(record["country"], profile.blanks)).alias("country"),
        _embed_text(record, profile).alias("to_vectorize"),
        _extras(record).alias("_extra"),
    )


def _last_wins(record: Column) -> Column:
    """A key given twice keeps its last value."""

    def once(entries: Column) -> Column:
        def is_last(entry: Column, at: Column) -> Column:
            later = F.slice(entries, at + 2, F.size(entries))
            return ~F.exists(later, lambda other: other["key"] == entry["key"])

        return F.map_from_entries(F.filter(entries, is_last))

    keys = F.map_keys(record)
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(repeated, once(F.map_entries(record))).otherwise(record)


def good_rows(parsed: DataFrame) -> DataFrame:
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in REVIEW.fields]
    return parsed.where(F.col("reason").isNull()).select(*typed)


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("raw", "reason", "input_file")


def _source_names(field: str) -> list[str]:
    return [alias for alias, name in ALIASES.items() if name == field] + [field]


def _value(record: Column, field: str) -> Column:
    """A field's raw text under its incoming or its kept name."""
    names = _source_names(field)
    value = record[names[-1]]
    for name in reversed(names[:-1]):
        value = F.when(F.map_contains_key(record, name), record[name]).otherwise(value)
    return value


def _has_key(record: Column, field: str) -> Column:
    found = F.lit(False)
    for name in _source_names(field):
        found = found | F.map_contains_key(record, name)
    return found


def _typed(record: Column, field: str) -> Column:
    raw = _value(record, field)
    if field in INT_FIELDS:
        return to_integer(raw)
    if field in FLOAT_FIELDS:
        return to_number(raw)
    return strip(raw)


def _not_text(typed: Column, field: str) -> Column:
    """The field holds something other than a JSON string or null."""
    kinds = [F.try_element_at(typed, F.lit(name)) for name in _source_names(field)]
    return ~F.coalesce(*kinds, F.lit("VOID")).isin("STRING", "VOID")


def _reason(record: Column, typed: Column) -> Column:
    """All failed checks of a record, or null."""
    checks = []
    for f in FIELDS:
        raw = _value(record, f)
        if f not in KEY_OPTIONAL:
            checks.append(F.when(~_has_key(record, f), F.lit(f"missing:{f}")))
        if f in NOT_NULL:
            checks.append(F.when(_has_key(record, f) & raw.isNull(), F.lit(f"null:{f}")))
        if f in STRING_FIELDS:
            checks.append(F.when(_not_text(typed, f), F.lit(f"type:{f}")))
        else:
            failed = raw.isNotNull() & _typed(record, f).isNull()
            checks.append(F.when(failed, F.lit(f"type:{f}")))
    points = to_integer(_value(record, "points"))
    too_big = points.isNotNull() & points.try_cast("int").isNull()
    checks.append(F.when(too_big, F.lit("type:points")))
    found = F.array_join(F.array_compact(F.array(*checks)), ";")
    return F.when(record.isNull(), F.lit("not_json")).when(found != "", found)


def _embed_text(record: Column, profile: CleanProfile) -> Column:
    """Built from the raw parts: not filled, and stripped only at the outer ends."""
    if not profile.embed_parts:
        return F.lit(None).cast("string")
    absent = dict(profile.absent_parts)
    parts = []
    for name in profile.embed_parts:
        part = record[name]
        if name in absent:
            part = F.when(F.map_contains_key(record, name), part).otherwise(F.lit(absent[name]))
        parts.append(part)
    return compose(*parts)


def _extras(record: Column) -> Column:
    known = F.array(*[F.lit(n) for n in FIELDS + tuple(ALIASES)])
    return F.map_filter(record, lambda k, v: ~F.array_contains(known, k))
