"""Value vectors of the scalar rules."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from atlas.functions import geo, osm, text


def column(spark, rows, expr, schema="v string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[1] for r in sorted(df.select("i", expr(F.col("v")).alias("o")).collect())]


def test_every_code_point_folds_to_its_decomposition_without_marks(spark):
    bare = lambda s: "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")
    codes = [i for i in range(1, 0x110000) if not 0xD800 <= i <= 0xDFFF and unicodedata.category(chr(i)) != "Cn"]
    df = spark.createDataFrame([(i, f"x{chr(i)}y") for i in codes], "i int, v string").repartition(8)
    assert [r.i for r in df.select("i", text.fold(F.col("v")).alias("f")).collect() if r.f != bare(f"x{chr(r.i)}y")] == []
    words = ["서울특별시 Étage", "ǖ́ Ḝ 각각", "\U0001d15e x", "", None]
    assert column(spark, words, text.fold) == [w and bare(w) for w in words[:4]] + [None]


def test_texts_are_told_from_spelled_out_letters_by_one_range(spark):
    assert {c for c in map(chr, range(0x80, 0x30000)) if re.match(f"[{text.spelled_out_class()}]", c)} == set(text.spelled_out())
    plan = spark.range(1).select(text.name_key(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert re.search(r", \[[^\]]-[^\]]\]\) AND RLIKE\(", plan)


def test_street_keys(spark):
    cases = {"Alba-Iulia": "alba iulia", "Șoseaua Muncești": "soseaua muncesti", "Şoseaua Munceşti": "soseaua muncesti",
             "str. 31 August 1989": "str 31 august 1989", "Stradela Ion  Creangă": "stradela ion creanga", "улица Ленина": "улица ленина",
             "Майская, Ёлочка": "маиская елочка", "__a__b__": "a b"}
    assert column(spark, list(cases), text.street_key) == list(cases.values())


def test_house_keys(spark):
    cases = {"10": ["10"], "10A": ["10a"], "10 A": ["10a"], "10/1": ["10/1"], "10А": ["10a"], "10\\1": ["10/1"], "abc": [],
             "10;12": ["10", "12"], "10, 10A": ["10", "10a"], "10;10": ["10"], "1" * 17: []}
    assert column(spark, list(cases), text.house_keys) == list(cases.values())
    assert column(spark, ["10;12A"], lambda v: text.house_display(v, F.lit("12a"))) == ["12A"]
    assert column(spark, ["10;12A"], lambda v: text.house_display(v, F.lit("99"))) == ["99"]


def test_house_order(spark):
    keys = ["11", "10a", "2", "7б", "10", "7", "10/1", "7a"]
    df = spark.createDataFrame([(k,) for k in keys], "v string")
    assert [r.v for r in df.orderBy(*text.house_sort_key(F.col("v"))).collect()] == ["2", "7", "7a", "7б", "10", "10/1", "10a", "11"]


def test_speeds_and_directions(spark):
    assert column(spark, ["50", "30 mph", "RO:urban", "none", " 25mph ", "50.5", None], osm.maxspeed_kmh) == [50, 48, None, None, 40, 50, None]
    rows = column(spark, ["forward", "backward", "reverse", "both", "-225", "NE", "90;270", "0-90", "90;W", "", None], osm.parse_direction)
    assert [r.src for r in rows] == ["fwd", "bwd", "bwd", "both", "deg", "card", "deg", None, "deg", None, None]
    assert [r.degrees for r in rows[4:7]] == [[135.0], [45.0], [90.0, 270.0]]


TAGS = "v map<string,string>"


@pytest.mark.parametrize("tags,allowed", [
    ({}, True), ({"access": "no"}, False), ({"access": "private"}, False), ({"access": "no", "vehicle": "yes"}, True),
    ({"vehicle": "no"}, False), ({"vehicle": "no", "motor_vehicle": "yes"}, True), ({"motor_vehicle": "no", "motorcar": "yes"}, True),
    ({"motorcar": "no", "access": "yes"}, False), ({"access": "destination"}, True), ({"motorcar": "", "vehicle": "private"}, False)])
def test_access(spark, tags, allowed):
    assert column(spark, [tags], osm.access_ok, TAGS) == [allowed]


def test_bus_lane_sides(spark):
    cases = [({"busway": "lane"}, "right"), ({"busway:both": "lane"}, "both"), ({"busway:left": "lane"}, "left"),
             ({"busway:left": "lane", "busway:right": "lane"}, "both"), ({"lanes:bus": "0"}, None), ({"lanes:psv": "2"}, "right"),
             ({"lanes:bus:backward": "1"}, "left"), ({"lanes:bus:forward": "1", "lanes:psv:backward": "1"}, "both"),
             ({"busway": "opposite_lane"}, None), ({"lanes:bus": "yes"}, None), ({}, None)]
    assert column(spark, [t for t, _ in cases], osm.bus_lane_side, TAGS) == [s for _, s in cases]


def test_promote_and_undo(spark):
    tags = {"highway": "service", "service": "driveway", "name": "x"}
    lifted = column(spark, [tags], osm.promote_tags, TAGS)[0]
    assert lifted == {"highway": "tertiary", osm.PARKED_SERVICE_KEY: "driveway", "name": "x"}
    undone = column(spark, [lifted], osm.undo_promote, TAGS)[0]
    assert undone == {"highway": "tertiary", "service": "driveway", "name": "x"}
    assert column(spark, [{"service": "alley"}], osm.promote_tags, TAGS)[0] == {"service": "alley", "highway": "tertiary"}
    assert column(spark, [{osm.PARKED_SERVICE_KEY: "alley"}], osm.is_foreign_parked, TAGS) == [True]


def test_decimal_cell_is_exact(spark):
    values = [47.00545, 28.01145, 0.125, 2.675, 1.005, 47.00125, -3.14155, 10.5]
    got = column(spark, values, lambda v: geo.decimal_cell(v, 4), "v double")
    assert got == [round(round(v, 4) * 10 ** 4) for v in values]


def test_aliases(spark):
    tags = {"name": "Сёла", "name:ru": "Сёла;Другое", "alt_name": " Ёж ; Ёж", "old_name": "x" * 81}
    assert column(spark, [tags], lambda v: text.locality_aliases(v, v["name"]), TAGS)[0] == ["Другое", "Ёж", "Села", "Еж"]
