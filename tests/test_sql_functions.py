"""Every registered SQL function gives what its column function gives, null included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from atlas.functions import sql

TEXTS = ["Str. Bătrân-x", "10A;7 b, 12/1", "", "50 mph", "2/000/818/660.gph", "or. Alfa", "https://host.example/download/v1/land-latest.osm.pbf", "NNE;90.25", "_p~iF~ps|U_ulLnnqC", "it's \\ \"quoted\"", "PASS", "n", None]
SAMPLES = {
    "STRING": TEXTS, "DOUBLE": [0.0, 47.000137, -28.5, 1e-7, 123.456, None], "INT": [0, 1, 2, 14, None], "BIGINT": [0, 1, 12345, 470001234, 70368744177663, None], "BOOLEAN": [True, False, None],
    "TIMESTAMP": [dt.datetime(2024, 1, 31, 23, 59), dt.datetime(2024, 3, 1, 12), None], sql.NAMES: [["Кишинёв", "b"], [], None],
    sql.TAGS: [{"highway": "primary", "name": "Ёлка", "oneway": "-1", "lanes:bus": "1", "bridge": "yes", "layer": "1", "name:en": "Tree"}, {"highway": "service", "service": "driveway", "route": "ferry"},
               {"highway": "motorway_link", "name": "x", "oneway": "yes", "official_name": " oraș x", "population": "1 200"}, {}, None],
    sql.POINTS: [[(47.0, 28.0), (47.1, 28.1), (47.2, 28.0)], [], None], sql.RINGS: [[[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 0.0)]], None],
    "STRUCT<west: DOUBLE, south: DOUBLE, east: DOUBLE, north: DOUBLE>": [(27.0, 46.0, 29.0, 48.0), None],
}

STRICT = ("tile_id_from_path",)


def rows(parameters):
    """Each value of each parameter once, the others moving along at their own pace."""
    lists = [SAMPLES[kind] for _, kind in parameters]
    return [tuple(values[(i * (k + 1) + k) % len(values)] for k, values in enumerate(lists)) for i in range(max(map(len, lists)) * 2)]


@pytest.mark.parametrize("name", sql.functions())
def test_sql_name_equals_column(spark, name):
    fn = sql.functions()[name]
    (called,) = sql.register(spark, name)
    names = [p for p, _ in fn.parameters]
    df = spark.createDataFrame(rows(fn.parameters), ", ".join(f"{p} {kind}" for p, kind in fn.parameters))
    left = df.select(fn.build(*map(F.col, names)).alias("v"))
    right = df.selectExpr(f"{called}({', '.join(names)}) AS v")
    assert left.schema["v"].dataType == right.schema["v"].dataType
    if name in STRICT:   # raises where a text is not of its form, under either name
        for df in (left, right):
            with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
                df.collect()
    else:
        assert list(map(repr, left.collect())) == list(map(repr, right.collect()))   # also equal where the value is NaN
    assert "Python" not in right._jdf.queryExecution().executedPlan().toString()


def test_functions_reach_the_scan(spark, folder):
    """An inlined function is an expression like any other: unused columns are not read."""
    sql.register(spark, "name_key")
    spark.read.parquet(f"{folder}/documents.parquet").createOrReplaceTempView("documents_by_name")
    plan = spark.sql("SELECT atlas_name_key(lang) AS k FROM documents_by_name WHERE doc_id > 5")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan and "GreaterThan(doc_id,5)" in plan


def test_what_has_no_sql_is_refused(spark):
    with pytest.raises(TypeError):
        sql.sql_text(F.col("a").withField("b", F.lit(1)))
