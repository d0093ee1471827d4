"""Review-shaped views of the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as reviews: nation as province, region as country."""
    customer, nation, region = (table(spark, folder, n) for n in ("customer", "nation", "region"))
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("province"), F.col("r_name").alias("country")
    )
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("title"),
        F.col("c_acctbal").alias("points"),
        F.col("c_mktsegment").alias("variety"),
        "province",
        "country",
    )


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as reviews with a price."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_size").alias("points"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("variety"),
        F.col("p_brand").alias("winery"),
    )


def docs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews: first line as title, quality as price (null when unlabelled)."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return documents.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("description"),
        F.col("n_chars").alias("points"),
        F.col("lang").alias("country"),
        F.col("source").alias("province"),
        F.col("quality").cast("double").alias("price"),
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The searchable part of ``docs``, without the join."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("description"),
    )


def vecs(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as reviews with derived points and price."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("vector"),
        F.col("label").alias("country"),
        (F.lit(80) + F.col("vec_id") % 21).cast("int").alias("points"),
        ((F.col("vec_id") * 7) % 150).cast("double").alias("price"),
    )
