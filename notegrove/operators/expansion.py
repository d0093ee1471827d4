"""Query words to indexed terms: exact, within an edit budget, or by prefix.

Words are matched against the vocabulary, which is far smaller than the texts and grows ever
more slowly than they do. It is stored in order, so that a prefix is a range of it. Beside it
lie the hashed deletion keys of its terms' beginnings, so that a typo is an equality join; many
terms share a beginning, and its keys are stored once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.functions.edits import MOST_EDITS, beginning, deletion_keys, swap_distances
from notegrove.functions.text import Analyzer
from notegrove.workspace import bounded_rows, read_bucketed, small_frame, write_bucketed

# Up to so many keys or prefixes reach the scan of the stored vocabulary themselves.
MAX_PUSHED_KEYS = 1000
MAX_PUSHED_PREFIXES = 50


@dataclass(frozen=True)
class Vocabulary:
    """``terms``: term, once each and in order; ``keys``: key, beginning, bucketed by key."""

    terms: DataFrame
    keys: DataFrame


def write_vocabulary(terms: DataFrame, path: str, buckets: int) -> Vocabulary:
    """Store the different values of ``terms(term)`` in order, and the deletion keys of their
    different beginnings."""
    spark = terms.sparkSession
    ordered = terms.select("term").distinct().repartitionByRange("term").sortWithinPartitions("term")
    ordered.write.mode("overwrite").parquet(f"{path}/terms")
    stored = spark.read.parquet(f"{path}/terms")
    # A number of parts is named: each beginning grows to dozens of keys in the same task.
    begun = stored.select(beginning(F.col("term")).alias("beginning")).repartition(buckets, "beginning").distinct()
    keys = begun.select(F.explode(deletion_keys(F.col("beginning"), MOST_EDITS)).alias("key"), "beginning")
    write_bucketed(keys.repartition(buckets, "key"), f"{path}/keys", buckets, "key", "key")
    return open_vocabulary(spark, path, buckets)


def open_vocabulary(spark: SparkSession, path: str, buckets: int) -> Vocabulary:
    return Vocabulary(
        spark.read.parquet(f"{path}/terms"), read_bucketed(spark, f"{path}/keys", buckets, "key", "key")
    )


def query_words(queries: DataFrame, analyzer: Analyzer, distinct: bool = True) -> DataFrame:
    """``qid, word_no, word, n_words, is_last`` of each query's text in ``terms``."""
    tokens = analyzer.tokens(F.col("terms"))
    listed = queries.select(
        "qid", (F.array_distinct(tokens) if distinct else tokens).alias("words")
    )
    return listed.select(
        "qid", F.size("words").alias("n_words"), F.posexplode("words").alias("word_no", "word")
    ).withColumn("is_last", F.col("word_no") == F.col("n_words") - 1)


def expand_words(
    words: DataFrame, vocabulary: Vocabulary, transpositions: bool = True
) -> DataFrame:
    """``word, term, typos, by_prefix`` for ``words(word, edits, prefix)``.

    A term matches when it is within ``edits`` (at most ``MOST_EDITS``) of the word, or starts
    with it where ``prefix`` is set (then with no typo). Exchanged neighbours count as one
    edit with ``transpositions``. Nothing is capped: every term that fits is kept.
    """
    wanted = words.select("word", "edits", "prefix").distinct()
    near = _by_keys(wanted, vocabulary)
    candidates = near.unionByName(_by_prefix(wanted.where(F.col("prefix")), vocabulary.terms))
    return _measured(candidates.distinct(), transpositions)


def _by_keys(wanted: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Terms whose beginning shares a deletion key with a word's, its budget's number of
    deletions deep."""
    key = F.when(F.col("edits") <= 0, deletion_keys(F.col("word"), 0))
    for n in range(1, MOST_EDITS + 1):
        key = key.when(F.col("edits") == n, deletion_keys(F.col("word"), n))
    asked = wanted.select("*", F.explode(key).alias("key"))
    rows, keys, few = bounded_rows(asked), vocabulary.keys, False
    if rows is not None:
        some = sorted({r["key"] for r in rows})
        if few := len(some) <= MAX_PUSHED_KEYS:
            keys = keys.where(F.col("key").isin(some))
        asked = small_frame(wanted.sparkSession, rows, asked)
    begun = keys.join(asked, "key").select("word", "edits", "prefix", "beginning").distinct()
    terms = vocabulary.terms.select("term", beginning(F.col("term")).alias("beginning"))
    found = terms.join(F.broadcast(begun) if few else begun, "beginning")
    close = F.abs(F.length("term") - F.length("word")) <= F.col("edits")
    return found.where(close).select("word", "edits", "prefix", "term")


def _by_prefix(starts: DataFrame, terms: DataFrame) -> DataFrame:
    """Terms that begin with a word. Few words are ranges of the stored order; any number are
    joined on as many first letters as they have, a join for each length."""
    rows = bounded_rows(starts)
    lengths = starts.select(F.length("word").alias("n")).distinct().collect()
    if rows is not None:
        if len(rows) <= MAX_PUSHED_PREFIXES:
            tests = [F.col("term").startswith(r["word"]) for r in rows]
            terms = terms.where(reduce(lambda a, b: a | b, tests, F.lit(False)))
        starts = small_frame(terms.sparkSession, rows, starts)
    found = terms.select("term").where(F.lit(False)).join(starts.limit(0), F.lit(True))
    for (n,) in lengths:
        same = F.substring("term", 1, n) == F.col("word")
        found = found.unionByName(terms.join(starts.where(F.length("word") == n), same))
    return found.select("word", "edits", "prefix", "term")


def _measured(candidates: DataFrame, transpositions: bool) -> DataFrame:
    """Exact distances; candidates beyond their budget fall out here."""
    term, word = F.col("term"), F.col("word")
    plain = F.levenshtein(term, word)
    # Only a pair that plain edits alone cannot settle goes to Python.
    unsettled = (F.col("edits") > 0) & (plain > 1) & (plain <= F.col("edits") * 2)
    if transpositions:
        settled = candidates.where(~unsettled).withColumn("distance", plain)
        swapped = candidates.where(unsettled).withColumn("distance", swap_distances(term, word))
        measured = settled.unionByName(swapped)
    else:
        measured = candidates.withColumn("distance", plain)
    within = F.col("distance") <= F.col("edits")
    prefix = F.col("prefix") & term.startswith(word) & (term != word)
    return measured.where(within | prefix).select(
        "word",
        "term",
        F.when(prefix, 0).otherwise(F.col("distance")).alias("typos"),
        prefix.alias("by_prefix"),
    )
