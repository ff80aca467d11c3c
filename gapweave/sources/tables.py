"""Parquet tables in the roles the engine needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    return as_files(table(spark, folder, "documents"))


def as_files(docs: DataFrame) -> DataFrame:
    """``documents`` as source files: ``file_id``, path ``source/doc_id.lang``, bytes and text."""
    return docs.select("doc_id", "source", "lang", "text").select(
        F.col("doc_id").alias("file_id"),
        F.concat_ws("", F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit("."), F.col("lang")).alias(
            "path"
        ),
        "lang",
        "text",
        F.encode("text", "UTF-8").alias("content"),
    )


def page_files(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "html")
    return pages.select(
        F.col("page_id").alias("file_id"), F.col("html").alias("text"), F.encode("html", "UTF-8").alias("content")
    )
