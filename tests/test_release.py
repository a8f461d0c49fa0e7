"""Release operators that scale by what they move: the same answers, fewer rows and bytes."""

from atlas.gates import routes
from atlas.operators import release
from atlas.queries.base import Tables
from atlas.queries import load, sources

SIDE = "struct<source_md5:string,source:string>"
REGION = f"code string, source struct<md5:string>, frontier {SIDE}, features {SIDE}, bus_lanes {SIDE}, search struct<addresses:struct<source_md5:string>>, map string"


def regions(spark, rows):
    return spark.createDataFrame(rows, REGION)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_carry_losses(spark):
    f = ("m", None)
    now = regions(spark, [("a", ("m",), f, None, None, None, None), ("a", ("m",), None, None, f, None, None), ("b", ("m",), None, None, None, None, None), (None, ("m",), None, None, None, None, None)])
    before = regions(spark, [("a", ("m",), f, f, f, (("m",),), "x"), ("a", ("m",), None, f, None, None, None), ("b", ("m",), f, f, f, None, None), ("c", ("m",), f, f, f, None, None), (None, ("m",), f, f, f, None, None)])
    got = release.carry_losses(now, before, spark.createDataFrame([("b",), (None,)], "code string"))
    assert sorted((r.code, r.block) for r in got.collect()) == [("a", "features"), ("a", "features"), ("a", "map"), ("a", "search")]
    text = plan(got)
    assert text.index("Generate explode") < text.index("Join")   # blocks become rows after the joins


def test_source_identity(spark):
    now = regions(spark, [("a", ("m",), ("m", "graph-only"), ("x", None), None, (("m",),), None), ("b", ("",), ("x", None), None, ("", None), None, None),
                          ("c", (None,), None, ("x", None), ("graph-only", None), None, None), (None, (None,), ("m", None), None, None, None, None)])
    built = spark.createDataFrame([("b",), ("b",), ("a",), (None,)], "code string")
    got = release.source_identity(now, built)
    none, other, graph = "no source identity", "other source than the graph", "the graph has no source md5"
    want = [("a", "features", other), ("a", "bus_lanes", none), *2 * [("b", "frontier", other), ("b", "features", none), ("b", "bus_lanes", none), ("b", "addresses", none), ("b", "graph", graph)],
            ("c", "features", other), (None, "frontier", other)]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    text = plan(got)
    assert text.count("Join") == 1 and text.index("Generate inline") < text.index("Join")


def test_transit_plan_spreads_one_file(spark):
    ways = spark.createDataFrame([(i, 47.0, 28.0) for i in range(100)], "way bigint, lat double, lon double").coalesce(1)
    rows = routes.transit_plan(ways)
    assert rows.rdd.getNumPartitions() > 1 and rows.count() == 1200


def test_manifest_is_written_compressed(spark, folder, monkeypatch):
    seen = {}
    real = sources.written

    def spy(df, name, **options):
        seen.update(options)
        return real(df, name, **options)

    load()
    monkeypatch.setattr(sources, "written", spy)
    assert sources.s14(Tables(spark, folder)).count() > 0
    assert seen.get("compression") == "snappy"
