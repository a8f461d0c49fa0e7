"""Text files as ordered lines, without ever holding a file in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file (its full path), block, at, value: (block, at) is the order of the lines inside a file."""
    meta = F.col("_metadata")
    return spark.read.text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def read_packed_lines(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_lines``, of text files that hold the lines of many files, each behind its file's name and a tab."""
    parts = F.split("value", "\t", 2)
    return read_lines(spark, path).filter(F.size(parts) == 2).select(parts[0].alias("file"), "block", "at", parts[1].alias("value"))


def running_total(lines: DataFrame, value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over the lines strictly before each line of its file: inside the block first,
    then over the few blocks of the file."""
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    valued = lines.withColumn("_v", value.cast("bigint"))
    blocks = valued.groupBy("file", "block").agg(F.sum("_v").alias("_sum"))
    starts = blocks.select("file", "block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    return (valued.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
            .join(starts, ["file", "block"]).withColumn(name, F.col("_in") + F.col("_start"))
            .drop("_v", "_in", "_start"))


def previous_line(lines: DataFrame, value: Column, name: str) -> DataFrame:
    """``value`` of the line before, across block borders."""
    inside = Window.partitionBy("file", "block").orderBy("at")
    across = Window.partitionBy("file").orderBy("block")
    valued = lines.withColumn("_v", value)
    ends = valued.groupBy("file", "block").agg(F.max_by("_v", "at").alias("_last"))
    ends = ends.select("file", "block", F.lag("_last").over(across).alias("_carry"))
    first = F.row_number().over(inside) == 1
    return (valued.withColumn("_prev", F.lag("_v").over(inside)).withColumn("_first", first)
            .join(ends, ["file", "block"])
            .withColumn(name, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev")))
            .drop("_v", "_prev", "_first", "_carry"))


def first_match(lines: DataFrame, patterns: dict[str, str], groups: dict[str, int] | None = None) -> DataFrame:
    """First captured text of each named pattern in a file: file, name, found."""
    hits = F.array(*[
        F.struct(F.lit(name).alias("name"), F.nullif(F.regexp_extract("value", p, (groups or {}).get(name, 1)), F.lit("")).alias("found"))
        for name, p in patterns.items()])
    rows = lines.select("file", "block", "at", F.inline(hits)).filter("found is not null")
    return rows.groupBy("file", "name").agg(F.min_by("found", F.struct("block", "at")).alias("found"))
