"""Secret scans over whole corpora: candidate spans per text, then ownership frequency.

Every step is a DataFrame function; no Python runs on the executors. Spans come from
regular expressions inside the row. The hashes of all candidate values are then counted by
distinct repository and owner over the whole corpus: a value that many owners share is a
copied example, a value of one or two owners that looks random is taken for live.

Defined results: a null text is empty and has no spans; a null repository or owner counts
as the empty name; rows that repeat count as rows, and count once per owner; offsets are
code points, end exclusive; an empty table gives an empty result. Other columns of the
input, whatever their names, are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegrove.workspace import materialize

# Kinds in the order in which equal starts are listed; the first three are the base kinds.
ASSIGN, ACCESS, HEX, TOKEN = "assign", "access", "hex", "token"
KINDS = (ASSIGN, ACCESS, HEX, TOKEN)
BASE_KINDS = (ASSIGN, ACCESS, HEX)

_KEY = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
_ASSIGN = r"(" + _KEY + r"\x20*[\"']?([A-Za-z0-9+/_.=-]+))"
# Kind: quick test of the whole text, pattern of one match (its groups: span, value), least
# code points of the value. A maximal run that is too short holds no longer one, so the
# least length is part of the pattern wherever the pattern is a plain run.
PATTERNS = {
    ASSIGN: (_KEY, _ASSIGN, 6),
    ACCESS: (r"AKIA[A-Z0-9]{16}", r"((AKIA[A-Z0-9]{16,}))", 20),
    HEX: (r"[0-9a-f]{24}", r"(([0-9a-f]{24,}))", 24),
    TOKEN: (r"[A-Za-z0-9_-]{24}", r"(([A-Za-z0-9_-]{24,}))", 24),
}
# Values found with this many owners or more are copied examples.
EXAMPLE_OWNERS = 3
# A live-looking value has at least so many different characters and none of these words.
LIVE_CHARACTERS = 8
PLACEHOLDER = r"(?i)example|sample|changeme|placeholder|dummy|xxxx|your[_-]?"

SPAN = "struct<kind:string,start:int,stop:int,value:string>"


def _positions(text: Column, pattern: str) -> Column:
    """All non-overlapping matches from the left, as structs (start, stop, value).

    The text is cut into gap and match pairs; their lengths add up to the positions. The
    last pair ends at the end of the text, so no search starts over within a tail.
    """
    pairs = r"(?s)(.*?)(?:" + pattern + r"|\z)"
    gaps, spans, values = (F.regexp_extract_all(text, F.lit(pairs), F.lit(g)) for g in (1, 2, 3))
    zipped = F.arrays_zip(gaps.alias("gap"), spans.alias("span"), values.alias("value"))
    item = "struct<start:int,stop:int,value:string>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        stop = start + F.char_length(x["span"])
        found = F.struct(start.alias("start"), stop.alias("stop"), x["value"].alias("value"))
        return F.struct(
            stop.alias("at"),
            F.when(x["span"] != "", F.concat(acc["out"], F.array(found))).otherwise(acc["out"]).cast(f"array<{item}>").alias("out"),
        )

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{item}>").alias("out"))
    return F.aggregate(zipped, empty, step, lambda acc: acc["out"])


def spans_of(text: Column, kind: str) -> Column:
    """The spans of one kind in a text, as an array of ``SPAN`` sorted by start."""
    quick, pattern, least = PATTERNS[kind]
    none = F.array().cast(f"array<{SPAN}>")
    found = F.filter(_positions(text, pattern), lambda s: F.char_length(s["value"]) >= least)
    if kind == TOKEN:  # mixed case and digits, else it is a word, a rule of dashes or a hex run
        found = F.filter(found, lambda s: s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]"))
    named = F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"], s["stop"], s["value"]))
    return F.when(text.rlike(quick), named.cast(f"array<{SPAN}>")).otherwise(none)


def in_order(spans: Column) -> Column:
    """Spans by start, then by kind as listed in ``KINDS``."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), rank(s).alias("b"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def candidate_spans(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> DataFrame:
    """One narrow row per input row: id, owner, repo, base spans, further candidates. A
    further candidate that touches a base span says nothing new and is left out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(repo, F.lit("")).alias("repo"),
        F.coalesce(owner, F.lit("")).alias("owner"),
        *(spans_of(text, k).alias(k) for k in KINDS),
    )
    base = in_order(F.concat(*BASE_KINDS))
    clear = F.filter(TOKEN, lambda t: ~F.exists(F.concat(*BASE_KINDS), lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])))
    return rows.select("id", "repo", "owner", base.alias("base"), clear.alias("more"))


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash: rows, distinct repositories and owners over the whole corpus, and
    its class. ``spans`` has value, repo and owner, one row per occurrence. A value found a
    great many times shrinks to one row per owner and task before it is shuffled."""
    by_place = spans.groupBy(F.sha2("value", 256).alias("hash"), "repo", "owner").agg(
        F.count(F.lit(1)).alias("n"),
        F.min((F.size(F.array_distinct(F.split("value", ""))) >= LIVE_CHARACTERS) & ~F.col("value").rlike(PLACEHOLDER)).alias("random"),
    )
    by_owner = by_place.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"), F.min("random").alias("random"))
    counts = by_owner.groupBy("hash").agg(
        F.sum("n").alias("n_rows"), F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"), F.min("random").alias("random")
    )
    copied = F.col("n_owners") >= EXAMPLE_OWNERS
    return counts.withColumn("class", F.when(copied, "example").when(F.col("random"), "live").otherwise("weak"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None) -> DataFrame:
    """One row per input row: id, ``base`` spans, ``spans`` (base and live further ones)
    and ``live`` spans (of any kind, of values that few owners have and that look random).

    The repository is a part of its owner's work; both default to the source column.
    """
    owner = F.col("source") if owner is None else owner
    repo = owner if repo is None else repo
    rows = candidate_spans(docs, id_col, text_col, repo, owner)
    rows = materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "secret-candidates")
    return with_classes(rows)


def with_classes(rows: DataFrame) -> DataFrame:
    """The stored candidate rows with the spans that corpus-wide ownership makes live."""
    found = rows.filter((F.size("base") > 0) | (F.size("more") > 0))
    each = found.select("rid", "repo", "owner", F.explode(F.concat("base", "more")).alias("s")).select("rid", "repo", "owner", "s", "s.value")
    classes = ownership(each).select("hash", "class")
    judged = (
        each.withColumn("hash", F.sha2("value", 256))
        .join(classes, "hash")
        .groupBy("rid")
        .agg(F.collect_list(F.when(F.col("class") == "live", F.col("s"))).alias("live"), F.count_if(F.col("class") == "example").alias("n_copied"))
    )
    none = F.array().cast(f"array<{SPAN}>")
    live = in_order(F.coalesce("live", none))
    out = rows.join(judged, "rid", "left").withColumn("live", live)
    added = F.filter("live", lambda s: s["kind"] == TOKEN)
    return out.select("id", "rid", "base", in_order(F.concat("base", added)).alias("spans"), "live", F.coalesce("n_copied", F.lit(0)).alias("n_copied"))


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced by ``mark``; spans that overlap give one mark."""
    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        piece = F.when(s["start"] >= acc["at"], F.concat(gap, F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    cut = F.aggregate(spans, start, step)
    return F.concat(F.array_join(cut["out"], ""), F.substring(text, cut["at"] + 1, F.char_length(text)))


def redact_live(docs: DataFrame, text_col: str = "text", repo: Column | None = None, owner: Column | None = None) -> DataFrame:
    """The input with every live credential of its texts replaced. Rows, columns and texts
    without one stay as they are. Only rows with a candidate are stored and joined."""
    owner = F.col("source") if owner is None else owner
    repo = owner if repo is None else repo
    text = F.coalesce(F.col(text_col), F.lit(""))
    hit = F.lit(False)
    for quick, _, _ in PATTERNS.values():
        hit = hit | text.rlike(quick)
    names = docs.columns
    whole = docs.filter(hit).select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), text.alias("text"), repo.alias("r"), owner.alias("o"))
    rows = candidate_spans(whole.withColumn("id", F.struct("row", "text")), "id", "text", F.col("r"), F.col("o"))
    rows = materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "secret-rows")
    judged = with_classes(rows)
    clean = redacted(F.col("id.text"), F.col("live"))
    is_text = lambda c: F.when(F.size("live") > 0, clean).otherwise(F.col(f"id.row.`{c}`"))
    counted = lambda c: F.when(F.size("live") > 0, F.char_length(clean).cast(docs.schema[c].dataType)).otherwise(F.col(f"id.row.`{c}`"))
    changed = judged.select(*((is_text(c) if c == text_col else counted(c) if c == "n_chars" else F.col(f"id.row.`{c}`")).alias(c) for c in names))
    return docs.filter(~hit).unionByName(changed)
