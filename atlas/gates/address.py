"""Gate of the address index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_UNRESOLVED = 0.01
COLUMNS = {
    "street": ("id", "name", "aliases", "city", "lat", "lon", "houses", "locality", "city_alt"),
    "house": ("street", "key", "osm", "num", "lat_e7", "lon_e7"),
    "locality": ("id", "name", "aliases", "kind", "district", "lat", "lon", "pop", "houses", "commune"),
    "commune": ("id", "name", "display", "aliases", "district"),
}


def missing_columns(tables: dict[str, DataFrame]) -> list[str]:
    return [f"{t} lacks {c}" for t, cols in COLUMNS.items() for c in cols if c not in tables[t].columns]


def referential_check(street: DataFrame, house: DataFrame, locality: DataFrame, commune: DataFrame) -> DataFrame:
    """Dangling references: rule, n (zero rows are kept, so the counts are always stated)."""
    ids = lambda df, name: df.select(F.col("id").alias(name))
    count = lambda df, rule: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")
    return (count(street.filter("locality is not null").join(ids(locality, "locality"), "locality", "left_anti"), "streets point at missing localities")
            .unionByName(count(locality.filter("commune is not null").join(ids(commune, "commune"), "commune", "left_anti"), "localities point at missing communes"))
            .unionByName(count(house.join(ids(street, "street"), "street", "left_anti"), "houses point at missing streets")))


def address_gate(street: DataFrame, house: DataFrame, locality: DataFrame, commune: DataFrame, meta: DataFrame, indexed: DataFrame) -> DataFrame:
    """Problem rows: rule, n. ``meta(k, v)`` states table sizes; ``indexed(table, n)`` how many rows the token
    index covers per table."""
    tables = {"street": street, "house": house, "locality": locality, "commune": commune}
    lacking = missing_columns(tables)
    spark = street.sparkSession
    if lacking:
        return spark.createDataFrame([(rule, 1) for rule in lacking], "rule string, n bigint")
    sizes = None
    for name, df in tables.items():
        s = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("k"), "n")
        sizes = s if sizes is None else sizes.unionByName(s)
    empty = sizes.filter("n = 0 and k <> 'commune'").select(F.concat(F.lit("empty "), "k").alias("rule"), F.lit(1).cast("bigint").alias("n"))
    stated = meta.join(sizes, "k").filter(F.col("v") != F.col("n")).select(F.concat(F.lit("meta differs for "), "k").alias("rule"), "n")
    covered = sizes.filter("k <> 'house'").join(indexed.select(F.col("table").alias("k"), F.col("n").alias("i")), "k", "left")
    index = covered.filter(F.coalesce("i", F.lit(0)) != F.col("n")).select(F.concat(F.lit("index does not cover "), "k").alias("rule"), "n")
    dangling = referential_check(street, house, locality, commune).filter("n > 0")
    lost = street.agg(F.count_if(F.col("locality").isNull()).alias("n"), F.count(F.lit(1)).alias("all"))
    loose = lost.filter(F.col("n") > MAX_UNRESOLVED * F.col("all")).select(F.lit("streets without locality").alias("rule"), "n")
    return empty.unionByName(stated).unionByName(index).unionByName(dangling).unionByName(loose)
