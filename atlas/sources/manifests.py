"""Release manifests and package indexes (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlas import schemas


def read_manifest(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per country: code, tag and the fields of its region block. ``multi_line=False`` reads one
    manifest per line."""
    m = spark.read.schema(schemas.MANIFEST).json(path, multiLine=multi_line)
    return m.select("tag", F.explode("regions").alias("code", "r")).select("tag", "code", "r.*")


def read_portal_files(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    m = spark.read.schema(schemas.MANIFEST).json(path, multiLine=multi_line)
    return m.select("tag", F.explode("portals").alias("pair", "t")).select("tag", "pair", "t.*")


def read_index(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per package: package, countries, graph, basemap, index."""
    i = spark.read.schema(schemas.INDEX).json(path, multiLine=multi_line)
    return i.select(F.explode("packages").alias("package", "p")).select("package", "p.*")
