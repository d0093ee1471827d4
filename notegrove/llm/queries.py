"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegrove.llm import bag_minhash, chat_format, decontaminate, embedding_dedup, html_extract, interpolation, oracles, packing, quality, repair, secret_scan, spelling, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from confirmed toxic and unlabelled ones."""
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to web archives and read back."""
    return warc.roundtrip(table(spark, folder, "pages")).drop("url")


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents; an owner is a source, a repository a source and language."""
    docs = table(spark, folder, "documents")
    found = secret_scan.scan(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    return found.select(
        F.col("id").alias("doc_id"),
        *(secret_scan.count_of(k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS),
        F.sha2(secret_scan.joined(F.col("base")), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        F.col("n_copied").cast("long"),
    )


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The path of a public tokenizer's file; it is on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file())


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that occur in documents, with edits."""
    return decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates among all embeddings."""
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op7_bag_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates among all documents: every document with its class."""
    found = bag_minhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "component_id", "kept")


def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = [(-7, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.createDataFrame(odd, "conv_id long, turn long, role string, text string"))
    records = rows.select("conv_id", F.to_variant_object(F.struct("conv_id", "turn", "role", "text")).alias("record"))
    return chat_format.read_back(chat_format.write_segments(chat_format.canonical(records, "conv_id", "record")))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents, learnt from the labels outside the held-out fold."""
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return html_extract.extract(table(spark, folder, "pages"))


def op11_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents under a trigram mixture of the training fold."""
    return interpolation.score(table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged, with the cheapest edits that repair them."""
    return repair.report_damaged(table(spark, folder, "conversations"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Frequent words of all documents, grouped with the spellings they are variants of."""
    return spelling.misspelt_variants(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_secret_scan": op3_secret_scan,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_bag_minhash": op7_bag_minhash,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_html_extraction": op10_html_extraction,
    "op11_deleted_interpolation": op11_deleted_interpolation,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op2_warc": oracles.WARC,
    "op3_secret_scan": oracles.SECRETS,
    "op8_chat_formatting": oracles.CHAT,

}
