"""The matching rule on small cases, and its brute force."""

import math
import random

import pytest

from atlas.gates.frontier import frontier_gate
from atlas.operators import matching

SCHEMA = "pair int, row int, level int, lat_e7 int, lon_e7 int, local_id bigint, osm bigint"
X, Y = 476943833, 169752574


def sides(spark, a, b):
    build = lambda rows: spark.createDataFrame([(0, i, lv, la, lo, i * 8 + lv, osm) for i, (lv, la, lo, osm) in enumerate(rows)], SCHEMA)
    return build(a), build(b)


CASES = [
    ("moved but same id", [(2, X, Y, 5)], [(2, X, Y - 356, 5)], [(0, 0, "osm", 2.67)], 0),
    ("exact position", [(1, X, Y, None)], [(1, X, Y, None)], [(0, 0, "coord", 0.0)], 0),
    ("near, ids differ", [(2, X, Y, 111)], [(2, X + 270, Y, 222)], [(0, 0, "near", 3.01)], 0),
    ("just inside", [(2, X, Y, None)], [(2, X + 449, Y, None)], [(0, 0, "near", 5.0)], 0),
    ("just outside", [(2, X, Y, None)], [(2, X + 451, Y, None)], [], 0),
    ("two candidates", [(2, X, Y, None)], [(2, X + 180, Y, None), (2, X - 270, Y, None)], [], 1),
    ("not mutual", [(2, X, Y, None), (2, X + 360, Y, None)], [(2, X + 180, Y, None)], [], 2),
    ("levels differ", [(1, X, Y, 7)], [(2, X, Y, 7)], [], 0),
    ("id before position", [(2, X, Y, 5)], [(2, X + 360, Y, 5), (2, X, Y, None)], [(0, 0, "osm", 4.01)], 0),
    ("one id on two levels", [(1, X, Y, 77), (2, X, Y, 77)], [(1, X, Y, 77), (2, X, Y, 77)], [(0, 0, "osm", 0.0), (1, 1, "osm", 0.0)], 0),
    ("ambiguous id stays free", [(2, X, Y, 9), (2, X + 9000, Y, 9)], [(2, X, Y, 9)], [(0, 0, "coord", 0.0)], 2),
]


@pytest.mark.parametrize("name,a,b,pairs,ambiguous", CASES, ids=[c[0] for c in CASES])
def test_cases(spark, name, a, b, pairs, ambiguous):
    got, stats = matching.match_frontiers(*sides(spark, a, b))
    assert sorted((r.a_row, r.b_row, r.method, r.distance) for r in got.collect()) == pairs
    assert stats.collect()[0].ambiguous == ambiguous


def metres(p, q):
    la1, lo1, la2, lo2 = (math.radians(v / 1e7) for v in (p[1], p[2], q[1], q[2]))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(h))


def test_crowded_spot_against_brute_force(spark):
    r = random.Random(11)
    crowd = [(0, X, Y, None)] * 200
    a = crowd + [(0, X + r.randrange(-2000, 2000), Y + r.randrange(-2000, 2000), None) for _ in range(120)]
    b = crowd[:150] + [(0, X + r.randrange(-2000, 2000), Y + r.randrange(-2000, 2000), None) for _ in range(120)]
    got, stats = matching.match_frontiers(*sides(spark, a, b))
    spot_a = {p: [i for i, q in enumerate(a) if q == p] for p in set(a)}
    spot_b = {p: [i for i, q in enumerate(b) if q == p] for p in set(b)}
    coord = {(v[0], spot_b[p][0]) for p, v in spot_a.items() if len(v) == 1 and len(spot_b.get(p, ())) == 1}
    fa = [i for i in range(len(a)) if i not in {x for x, _ in coord}]
    fb = [j for j in range(len(b)) if j not in {y for _, y in coord}]
    near = {i: [j for j in fb if metres(a[i], b[j]) <= 5] for i in fa}
    back = {j: [i for i in fa if metres(a[i], b[j]) <= 5] for j in fb}
    want = coord | {(i, c[0]) for i, c in near.items() if len(c) == 1 and len(back[c[0]]) == 1}
    assert {(x.a_row, x.b_row) for x in got.collect()} == want
    unclear = sum(1 for c in near.values() if c and not (len(c) == 1 and len(back[c[0]]) == 1))
    assert stats.collect()[0].ambiguous == unclear


def test_gate(spark):
    rows = [("A", 0, 1, 1, 8, 5), ("A", 0, 1, 1, 16, 5), ("A", 3, 2, 2, 3, None), ("A", 1, 3, 3, 16, None), ("A", 0, 4, 4, 1 << 50, None)]
    df = spark.createDataFrame(rows, "country string, level int, lat_e7 int, lon_e7 int, local_id bigint, osm bigint")
    countries = spark.createDataFrame([("A", False), ("B", False), ("C", True)], "country string, may_be_empty boolean")
    got = {(r.country, r.rule) for r in frontier_gate(df, countries).collect()}
    assert got == {("A", "two nodes on one spot"), ("A", "one OSM node twice on a level"), ("A", "impossible level"),
                   ("A", "local id of another level"), ("A", "local id carries region bits"), ("B", "empty frontier")}


def test_sides_are_not_repeated_for_their_pairs(spark):
    rows = [("A", 2, X, Y, 8, 5), ("B", 2, X - 356, Y, 8, 5), ("C", 2, X, Y, 8, None), ("C", 2, X + 9000, Y, 16, None), (None, 2, X, Y, 8, 5)]
    df = spark.createDataFrame(rows, "country string, level int, lat_e7 int, lon_e7 int, local_id bigint, osm bigint")
    borders = spark.createDataFrame([("A", "B"), ("A", "C"), ("B", "C")], "a string, b string")
    a, b, pairs = matching.neighbour_sides(df, borders)
    assert a.count() == len(rows)
    got, stats = matching.match_frontiers(a, b, pairs)
    assert sorted((r.pair, r.a_row, r.b_row, r.method) for r in got.collect()) == [("A-B", 8, 8, "osm"), ("A-C", 8, 8, "coord"), ("B-C", 8, 8, "near")]
    assert {r.pair: (r.unmatched_a, r.unmatched_b) for r in stats.collect()} == {"A-B": (0, 0), "A-C": (0, 1), "B-C": (0, 1)}
