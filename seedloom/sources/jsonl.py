"""JSON Lines and whole JSON documents as text with a strictly parsed VARIANT; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seedloom.functions.canonical_json import checked_json
from seedloom.functions.json_text import strict_json


def read_jsonl(spark: SparkSession, path: str | list[str], line_numbers: bool = False) -> DataFrame:
    """Records of JSON Lines files, plain or gzip: file, raw, v, and line (from 1) if asked for.

    Lines end with a line feed only; empty lines are no records but count for the numbers. ``v`` is NULL where a line isn't
    one JSON value or repeats a member name. Line numbers need one count per block of a file, not an order
    of the whole input: a block's first number is the sum of the counts of the blocks before it.
    """
    rows = spark.read.option("lineSep", "\n").text(path)
    if not line_numbers:
        return rows.where("value <> ''").select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"), strict_json("value").alias("v"))
    rows = rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    blocks = rows.groupBy("file", "block").agg(F.min("n").alias("first"), F.count("*").alias("lines"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("lines").over(before), F.lit(0))).drop("lines")
    numbered = rows.join(blocks, ["file", "block"]).withColumn("line", F.col("n") - F.col("first") + F.col("before") + 1)
    return numbered.where("value <> ''").select("file", "line", F.col("value").alias("raw"), strict_json("value").alias("v"))


def read_json_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file that holds one JSON document: file, raw, v (NULL where it isn't one)."""
    rows = spark.read.option("wholetext", True).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"), strict_json("value").alias("v"))


def with_parse_report(df: DataFrame, raw: str = "raw", report: str = "parse") -> DataFrame:
    """Adds the canonical text, or code, path and message of what is wrong, of every JSON text."""
    return df.withColumn(report, checked_json(raw))


def read_binary(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """Whole files as bytes, for hashing: path, length, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length", "content")
