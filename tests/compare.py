"""Run a registered query and its DuckDB twin and compare them as bags of rows."""

from __future__ import annotations

import math
import time

import duckdb

from atlas.queries.base import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if type(value).__name__ == "Decimal":
        return float(value)
    return value


KINDS = {"TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "INT": "int", "BIGINT": "bigint",
         "HUGEINT": "hugeint", "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float", "BOOLEAN": "boolean"}


def compare(spark, con, folder, name, query) -> tuple[bool, str]:
    start = time.time()
    df = query.run(spark, folder)
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    spent = time.time() - start
    if query.oracle is None:
        return bool(rows), f"{len(rows)} rows, no SQL twin, {spent:.1f}s"
    start = time.time()
    rel = con.sql(query.oracle)
    want_cols = sorted(rel.columns)
    at = [rel.columns.index(c) for c in want_cols]
    want = [tuple(_norm(r[i]) for i in at) for r in rel.fetchall()]
    sql_spent = time.time() - start
    if cols != want_cols:
        return False, f"columns {cols} vs {want_cols}"
    kinds = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    drift = [f"{f.name}:{f.dataType.simpleString()}/{kinds[f.name]}" for f in df.schema.fields
             if KINDS.get(kinds[f.name], kinds[f.name]) != f.dataType.simpleString()]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    rows.sort(key=key)
    want.sort(key=key)
    note = f"{len(rows)} rows, spark {spent:.1f}s, duckdb {sql_spent:.1f}s" + (f", types {drift}" if drift else "")
    if rows == want:
        return len(rows) > 0, note
    extra = [r for r in rows if r not in set(want)][:3]
    missing = [r for r in want if r not in set(rows)][:3]
    return False, f"{len(rows)} vs {len(want)} rows; only spark {extra}; only duckdb {missing} {note}"
