"""Malformed CSV lines with their file and line number.

Lenient reading turns a bad cell into null. Here the same lines are parsed once
more from text, and those that Spark's parser marks as corrupt (a cell that is
not of its type, too few or too many cells) are kept whole. Line numbers count
from 1 with the header; they come from a row's place in its file block and the
number of rows in the blocks before it, two small tables of one row a block.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, raw) of every line of the text files at ``path``."""
    rows = spark.read.text(path).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    blocks = rows.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("before", F.coalesce(before, F.lit(0))).drop("rows")
    return rows.join(blocks, ["file", "block"]).select(
        "file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), "raw")


def rejected_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, line, raw) of the data lines that do not fit ``schema``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    parsed = F.from_csv("raw", columns, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (numbered_lines(spark, path).filter((F.col("line") > 1) & (F.trim("raw") != ""))
            .withColumn("parsed", parsed).filter(F.col(f"parsed.{CORRUPT}").isNotNull()).drop("parsed"))
