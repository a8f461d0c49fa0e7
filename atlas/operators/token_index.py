"""Full-text index of built tables: which tokens of which field lead to which row.

The index is a table (token, field, key), range-partitioned and sorted by token, so a token or a prefix is one short range:
the files' and row groups' bounds answer where it lies, and other row groups are not read. A token that many rows share
continues over several parts, since the ranges are cut by (token, key). Every indexed row also has an entry with the empty
token, so the index states which rows it covers, even those whose text has no token at all.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlas.operators.search import search_fold

# The fields each table of the search and address formats is found by.
FIELDS = {"place": ("name", "aliases"), "street": ("name", "aliases", "city", "city_alt"), "locality": ("name", "aliases"), "commune": ("name", "aliases")}
ROW_GROUP_BYTES, PAGE_ROWS = 4 << 20, 10_000
COVERED = ""   # the token of the entries that say a row is indexed


def tokens_of(value: Column) -> Column:
    """Distinct folded runs of letters and digits."""
    return F.array_distinct(F.filter(F.split(search_fold(value), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def token_rows(rows: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(token, field, key): the distinct tokens of every field, text or list of texts, and one entry for the row itself."""
    lists = {f.name for f in rows.schema.fields if f.dataType.typeName() == "array"}
    one = lambda f: F.transform(tokens_of(F.array_join(f, " ") if f in lists else F.coalesce(f, F.lit(""))),
                                lambda w: F.struct(w.alias("token"), F.lit(f).alias("field")))
    entries = [F.coalesce(one(f), F.array().cast("array<struct<token:string,field:string>>")) for f in fields]
    covered = F.array(F.struct(F.lit(COVERED).alias("token"), F.lit("").alias("field")))
    return rows.select(F.explode(F.concat(covered, *entries)).alias("e"), F.col(key).alias("key")).select("e.token", "e.field", "key").distinct()


def write_tokens(rows: DataFrame, key: str, fields: Sequence[str], path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    entries = token_rows(rows, key, fields)
    (entries.repartitionByRange("token", "key").sortWithinPartitions("token", "key", "field").write.mode("overwrite")
     .option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path))


def read_tokens(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{table}_token")


def _term(term: str) -> Column:
    """A term: ``[field:]word[*]``. Comparisons on the bare column, so that they reach the files."""
    field, _, word = term.rpartition(":")
    folded = search_fold(F.lit(word.rstrip("*")))
    hit = F.col("token").startswith(folded) if word.endswith("*") else F.col("token") == folded
    return hit & (F.col("field") == field) if field else hit


def match(tokens: DataFrame, query: str) -> DataFrame:
    """Keys of the rows in which every term of the query occurs, in any field unless the term names one.

    A term's own separators split it into several, of which the last keeps the ``*``. A query without a term finds nothing.
    """
    terms = [t for t in query.split() if t.strip("*:")]
    if not terms:
        return tokens.select("key").limit(0)
    hits = [_term(t) for t in terms]
    found = tokens.where(F.col("token") != COVERED).where(functools.reduce(Column.__or__, hits))
    flags = found.groupBy("key").agg(*[F.max(F.coalesce(h, F.lit(False))).alias(f"t{i}") for i, h in enumerate(hits)])
    return flags.where(functools.reduce(Column.__and__, [F.col(f"t{i}") for i in range(len(hits))])).select("key")


def covered_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n): how many rows each token table covers; reads the entries of the empty token only."""
    parts = [t.where(F.col("token") == COVERED).agg(F.count_distinct("key").alias("n")).select(F.lit(name).alias("table"), "n") for name, t in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts)
