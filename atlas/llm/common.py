"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlas.session import scratch_folder

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back: computed once, and kept if executors go."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def indices(first: Column | int, last: Column) -> Column:
    """``first … last`` as an array, empty when ``last < first``."""
    low = F.lit(first) if isinstance(first, int) else first
    return F.when(last >= low, F.sequence(low, last)).otherwise(F.array().cast("array<int>"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Columns that are equal for repeated rows only, so that results can be joined back to whole rows."""
    return [doc_id.alias("k_id"), F.xxhash64(text, F.lit(7)).alias("k_hash")]


def join_back(rows: DataFrame, found: DataFrame, how: str = "left") -> DataFrame:
    """Join on ``k_id`` and ``k_hash`` where a null id equals a null id; the key columns of ``rows`` stay."""
    other = found.withColumnRenamed("k_id", "o_id").withColumnRenamed("k_hash", "o_hash")
    joined = rows.join(other, rows["k_id"].eqNullSafe(other["o_id"]) & (rows["k_hash"] == other["o_hash"]), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("o_id", "o_hash")


def give_back() -> None:
    """Return a Python worker's freed memory to the system: workers outlive their tasks, and the next stage needs the room.

    Functions travel by value, each with its module's tables, and go in a cycle with them, so ended tasks must be collected first.
    The token table that packing keeps in a worker goes too; packing itself does not call this.
    """
    import ctypes
    import gc
    import sys

    import pyarrow as pa

    sys.__dict__.pop("_word_tokens", None)
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):   # a C library without it keeps the memory for the worker
        ctypes.CDLL("libc.so.6").malloc_trim(0)


MOST_BROADCAST = 32 << 20   # bytes


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, marked for broadcast if its rows, counted now, take at most ``MOST_BROADCAST`` bytes; else joins shuffle it.

    Give it a written table: the count then reads footers only.
    """
    return F.broadcast(df) if df.count() * row_bytes <= MOST_BROADCAST else df


def tokenizer_path(spark: SparkSession, name: str) -> str:
    """A vocabulary file of the installed public tokenizers, or of the folder in ``spark.atlas.tokenizers``."""
    folder = spark.conf.get("spark.atlas.tokenizers", None)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)
