"""Claim-shaped rows cut from the driver tables, so that SQL can derive the same rows.

Evidence is a document's text. Its claim quotes 80 characters from the middle; every fifth
document's quote is altered, every seventh cites a document that does not exist. A value is the
length of the text, grounded only where the text happens to hold it or every third run declares it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def evidence(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("source").alias("run_id"), F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))


def claims(docs: DataFrame) -> DataFrame:
    d, text = F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))
    middle = F.substr(text, (F.length(text) / 2).cast("int") + 1, F.lit(80))
    return docs.select(
        F.col("source").alias("run_id"),
        d.alias("claim_index"),
        F.concat(F.lit("claim-"), d.cast("string")).alias("id"),
        F.lit("reported_fact").alias("classification"),
        F.concat(F.lit("Length was "), F.length(text).cast("string"), F.lit(" in FY2026.")).alias("claim_text"),
        F.when(d % 5 == 0, F.concat(middle, F.lit(" altered"))).otherwise(middle).alias("quote"),
        F.when(d % 7 == 0, "missing").otherwise(d.cast("string")).alias("segment_id"),
        F.lit(None).cast("string").alias("web_evidence_id"),
        F.concat(F.lit('{"length": '), F.length(text).cast("string"), F.lit("}")).alias("values"),
        F.array().cast("array<string>").alias("inferred_from"),
    )


def financials(docs: DataFrame) -> DataFrame:
    """Every third document's length is a known fact of its run."""
    return docs.where(F.col("doc_id") % 3 == 0).select(F.col("source").alias("run_id"), F.length(F.coalesce("text", F.lit(""))).cast("double").alias("value"))


def no_pages(docs: DataFrame) -> DataFrame:
    return docs.limit(0).select(F.col("source").alias("run_id"), F.col("lang").alias("id"), F.col("text").alias("content"), F.col("lang").alias("temporal_status"))
