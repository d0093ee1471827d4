"""The training-data pipeline over ``documents``: drop toxic texts, keep one of each group of
near-duplicates, drop texts with benchmark passages, replace live credentials, pack tokens.

``documents`` comes with its parameters beside it: ``labels`` (what is known to be toxic) and
``benchmark`` (what may not be trained on). Every stage but the last returns all columns of
its input; ``run`` writes each stage to the shared folder and reads it back, so a lost
executor costs no earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.llm import bag_minhash, decontaminate, packing, secret_scan, toxicity
from notegrove.llm.queries import table, tokenizer_file
from notegrove.workspace import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    return bag_minhash.distinct_rows(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that look live are replaced; the documents stay."""
    return secret_scan.redact_live(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of what is left, in as few sequences as possible."""
    return packing.pack_documents(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", keep_distinct),
    ("decontamination", drop_benchmark),
    ("secrets", replace_secrets),
    ("packing", pack),
]

# The trained classifier, the signatures and the tokenizer are beyond SQL; the tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
