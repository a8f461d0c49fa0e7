"""Query registry, driver tables and the map-shaped views derived from them.

A view is one SQL text that Spark and DuckDB read alike, or a Spark builder with a DuckDB text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@dataclass(frozen=True)
class View:
    sql: str | None
    build: Callable[[Tables], DataFrame] | None = None


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


VIEWS: dict[str, View] = {}
REGISTRY: dict[str, Query] = {}


class Tables:
    """Tables and views of one data folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in VIEWS:
            view = VIEWS[name]
            return view.build(self) if view.build else self.sql(view.sql)
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        used = [n for n in mentioned(text) if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", text)]
        for n in used:
            text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}} AS {n}", text)
        return self.spark.sql(text, **{n: getattr(self, n) for n in used})


def mentioned(text: str) -> list[str]:
    return [n for n in (*TABLES, *VIEWS) if re.search(rf"\b{n}\b", text)]


def view(name: str, sql: str, build: Callable[[Tables], DataFrame] | None = None) -> None:
    VIEWS[name] = View(sql, build)


def with_views(text: str) -> str:
    """Prefix a DuckDB query with the views it uses, in definition order."""
    needed: set[str] = set()
    queue = [n for n in mentioned(text) if n in VIEWS]
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue += [n for n in mentioned(VIEWS[name].sql) if n in VIEWS and n != name]
    parts = [f"{n} AS ({VIEWS[n].sql})" for n in VIEWS if n in needed]
    text = text.strip()
    match = re.match(r"WITH\s+(RECURSIVE\s+)?", text)
    if not parts:
        return text
    if match:
        return f"WITH {match.group(1) or ''}{', '.join(parts)}, {text[match.end():]}"
    return f"WITH {', '.join(parts)} {text}"


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(lambda spark, folder: fn(Tables(spark, folder)),
                               with_views(oracle) if oracle else None)
        return fn
    return register
