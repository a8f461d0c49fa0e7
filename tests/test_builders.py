"""Builders on a small country, graph steps against brute force."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from atlas.operators import network
from atlas.plans.address_index import build_address_index
from atlas.plans.arterial import build_arterial_network
from atlas.plans.localities import build_localities

RINGS = "rings array<array<struct<x:double,y:double>>>"


def square(x, y, half):
    return [[{"x": a, "y": b} for a, b in ((x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half), (x - half, y - half))]]


@pytest.fixture(scope="module")
def places(spark):
    t = lambda **kv: {k.replace("__", ":"): v for k, v in kv.items()}
    points = spark.createDataFrame([
        ("n1", t(name="Alfa", place="town", population="5 000", name__ru="Альфа"), 47.0, 28.0), ("n2", t(name="Beta", place="village", wikidata="Q2"), 47.0, 28.5),
        ("n3", t(name="Beta", place="village"), 46.0, 28.5), ("n4", t(name="Abroad", place="city"), 47.0, 31.0), ("n5", t(name="Beta", place="hamlet"), 47.005, 28.505),
        ("n6", t(name="Not a place", place="locality"), 47.0, 28.1), ("n0", t(name="Iota", place="hamlet"), 47.03, 28.5)], "pid string, tags map<string,string>, lat double, lon double")
    areas = spark.createDataFrame([
        ("w10", t(name="Бета", place="village", name__en="Beta", population="77"), square(28.5, 47.0, 0.02)), ("w11", t(name="Gamma", place="village"), square(27.5, 46.5, 0.02)),
        ("w12", t(name="Gamma", place="village"), square(27.53, 46.5, 0.005)), ("w13", t(name="Бета", place="village"), square(28.5, 47.02, 0.03))], f"pid string, tags map<string,string>, {RINGS}")
    admin = lambda pid, name, x, y, half: (pid, t(name=name, boundary="administrative", admin_level="8"), square(x, y, half))
    schema = f"pid string, tags map<string,string>, {RINGS}"
    country = spark.createDataFrame([("country", square(28.5, 47.0, 1.5))], f"pid string, {RINGS}")
    district = spark.createDataFrame([admin("r1", "West", 27.75, 47.0, 0.75), admin("r2", "East", 29.25, 47.0, 0.75)], schema)
    commune = spark.createDataFrame([admin("r3", "comuna Nord", 28.5, 47.2, 0.5), admin("r4", "Sud", 28.0, 46.3, 0.6)], schema)
    return build_localities(points, areas, country, district, commune), areas.select("pid", "rings"), country


def test_localities(places):
    loc = {r.pid: r for r in places[0].locality.collect()}
    assert set(loc) == {"n0", "n1", "n2", "n3", "w11"}                    # abroad dropped, n5 merged, w12 joined w11
    assert [r.pid for r in sorted(loc.values(), key=lambda r: r.id)] == ["n1", "n2", "n3", "w11", "n0"]
    assert loc["n1"].aliases == ["Альфа"] and loc["n1"].pop == 5000
    assert loc["n2"].aliases == ["Бета", "Beta"] and loc["n2"].pop == 77       # the area's names and population reach the point
    assert (loc["n1"].district, loc["n2"].district, loc["w11"].district) == ("West", "East", "West")   # 28.5 is the edge: it belongs to the eastern square
    assert {r.name: r.display for r in places[0].commune.collect()} == {"comuna Nord": "Comuna Nord", "Sud": "Sud"}
    assert loc["n2"].commune != loc["n3"].commune
    assert [(r.lat, r.lon) for r in places[0].ghost.collect()] == [(47.005, 28.505)]
    owner = {r.pid: r.id for r in places[0].owner.collect()}
    # w13 holds several points; the name that n2 gained from w10 decides
    assert owner == {"w10": loc["n2"].id, "w11": loc["w11"].id, "w12": loc["w11"].id, "w13": loc["n2"].id}
    stats = {r.what: r.n for r in places[0].stats.collect()}
    assert stats["foreign_localities_dropped"] == 1 and stats["duplicates_merged_near"] == 1 and stats["area_only_localities"] == 1


@pytest.fixture(scope="module")
def index(spark, places):
    rows = [
        (0, 1, 47.001, 28.001, "Main St", None, "or. Alfa", "10A"), (1, 2, 47.00105, 28.001, "Main-St", None, "Альфа", "10a"),       # same house twice, 5 m apart
        (1, 3, 47.003, 28.001, "Main St", None, "Alfa", "10a;12"),                                                               # 200 m away: another house
        (0, 4, 47.001, 28.501, "Lenin", None, None, "5"),                                                                       # by area
        (0, 5, 46.5, 27.5, "Wood", None, "Gammaville", "1"), (0, 6, 46.501, 27.5, "Wood", None, "Gammaville", "2"), (0, 7, 46.502, 27.5, "Wood", None, "Gammaville", "3"),
        (0, 8, 47.001, 28.5352, "Lenin", None, "Nowhere", "9"),                                                                # outside the area, near a house of the same street
        (2, 9, 47.08, 28.0, None, None, None, "1"), (0, 10, 47.001, 31.0, "Abroad", None, None, "1"), (0, 11, 47.0, 28.0, None, None, None, "4"),
        (0, 12, 45.6, 29.9, "Lost", None, None, "1"), (0, 13, 47.0, 28.002, None, "Hamlet Place", "Alfa", "abc")]
    objects = spark.createDataFrame(rows, "kind int, oid bigint, lat double, lon double, street string, place string, city string, num string")
    objects = objects.withColumns({c + "_e7": F.bround(F.col(c) * 1e7).cast("int") for c in ("lat", "lon")})
    members = spark.createDataFrame([(50, 2, 9, "house", "Relation Street"), (60, 2, 9, "house", "Later"), (50, 0, 1, "house", "Ignored")], "rel_id bigint, kind int, ref bigint, role string, name string")
    ways = spark.createDataFrame([(1, {"highway": "residential", "name": "Lenin", "name:ru": "Семёнова"}), (2, {"name": "Wood", "name:en": "no road"})], "id bigint, tags map<string,string>")
    local, areas, country = places
    return build_address_index(objects, members, ways, local, areas, country)


def test_address_index(index, places):
    loc = {r.pid: r.id for r in places[0].locality.collect()}
    street = {(r.skey, r.locality): r for r in index.street.collect()}
    got = {(k[0], k[1]): (v.method, v.houses) for k, v in street.items()}
    assert got == {("main st", loc["n1"]): ("name", 3), ("lenin", loc["n2"]): ("anchor", 2), ("wood", loc["w11"]): ("area", 3),
                   ("relation street", loc["n1"]): ("nearest", 1), ("lost", None): ("unresolved", 1)}
    assert street[("main st", loc["n1"])].name == "Main St"
    assert street[("lenin", loc["n2"])].aliases == ["Семёнова", "Семенова"]
    assert street[("wood", loc["w11"])].city_alt == ["Gammaville"] and street[("wood", loc["w11"])].aliases is None
    assert street[("main st", loc["n1"])].lat == 47.003                             # upper median of four addresses
    assert [r.id for r in sorted(street.values(), key=lambda r: (r.skey, r.locality or -1))] == list(range(1, 6))
    houses = {(r.street, r.key, r.osm): r.num for r in index.house.collect()}
    main = street[("main st", loc["n1"])].id
    assert houses[(main, "10a", 4)] == "10A" and (main, "10a", 2 * 4 + 1) not in houses and houses[(main, "10a", 13)] is None and (main, "12", 13) in houses
    assert {r.id: r.houses for r in index.locality.collect()} == {loc["n1"]: 4, loc["n2"]: 2, loc["w11"]: 3, loc["n3"]: 0, loc["n0"]: 0}
    stats = {r.what: r.n for r in index.stats.collect()}
    want = {"objects": 13, "foreign_objects_dropped": 1, "no_street": 1, "via_associated_street": 1, "via_addr_place": 1, "dedup_dropped": 1,
            "aliases_learned": 1, "streets": 5, "houses": 10, "streets_by_unresolved": 1}
    assert {k: stats[k] for k in want} == want


def test_address_index_keeps_few_tables(index):
    """Of the tables between its steps only those stay that its results read."""
    read = [Path(file.removeprefix("file:")).parents[1] for df in (index.stats, index.house) for file in df.inputFiles()]
    assert {frozenset(x.name for x in folder.iterdir()) for folder in read if folder.name.startswith("scratch-")} == {frozenset({"inside", "done"}), frozenset({"kept"})}


def test_directed_search_against_brute_force(spark):
    r = random.Random(8)
    ways = {w: ([r.randrange(60) for _ in range(r.randrange(2, 5))], r.choice(["residential", "service", "service", "primary"] if w % 9 == 0 else ["residential", "service"]), r.choice([0, 0, 1, -1])) for w in range(45)}
    steps = spark.createDataFrame([(w, i, n, d, cls == "primary") for w, (refs, cls, d) in ways.items() for i, n in enumerate(refs)], "way bigint, idx int, node bigint, dir int, arterial boolean")
    sources = list(range(0, 60, 3))
    asked = spark.createDataFrame([(s,) for s in sources], "source bigint")
    found = network.connector_search(steps, asked)
    got = {(x.node, x.heading): x.level for x in found.collect() if x.node in sources}
    every = network.connector_search(steps)
    assert every.count() == every.select("node", "heading").distinct().count() <= 2 * 60     # one state per node and heading, whoever asks
    at = {}
    for w, (refs, _, _) in ways.items():
        for i, n in enumerate(refs):
            at.setdefault(n, []).append((w, i))
    want = {}
    for s in sources:
        for heading in ("out", "in"):
            level, frontier, seen = 0, {s}, {s}
            while frontier:
                states = [x for n in frontier for x in at.get(n, ())]
                if any(ways[w][1] == "primary" for w, _ in states):
                    want[(s, heading)] = level
                    break
                fresh = set()
                for w, i in states:
                    refs, _, d = ways[w]
                    ahead, back = (d != -1, d != 1) if heading == "out" else (d != 1, d != -1)
                    fresh |= set(refs[i + 1:]) if ahead else set()
                    fresh |= set(refs[:i]) if back else set()
                frontier = fresh - seen
                seen |= frontier
                level += 1
    assert got == want and len({v for v in want.values()}) > 1
    path = network.chains(found, asked).collect()
    walked = {}
    for x in path:
        walked.setdefault((x.source, x.heading), []).append((x.level, x.way))
    assert walked.keys() == want.keys()
    for (s, heading), steps_taken in walked.items():
        steps_taken = [w for level, w in sorted(steps_taken, reverse=True) if level > 0]
        assert len(steps_taken) == want[s, heading]
        here = {s}   # the ways can be driven one after another, from the source to a node of an arterial way
        for w in steps_taken:
            refs, cls, d = ways[w]
            ahead, back = (d != -1, d != 1) if heading == "out" else (d != 1, d != -1)
            assert cls != "primary"
            here = {n for i, m in enumerate(refs) if m in here for n in (refs[i + 1:] if ahead else []) + (refs[:i] if back else [])}
        assert any(ways[w][1] == "primary" for n in here for w, _ in at[n])


def test_chain_rings(spark):
    p = lambda i: {"x": float(i % 10), "y": float(i // 10)}
    rows = [(7, [p(1), p(2), p(3)]), (3, [p(3), p(4)]), (5, [p(4), p(1)]),                      # a ring of three ways
            (1, [p(20), p(21), p(22), p(20)]), (2, [p(30), p(31), p(30)]),                       # closed alone; too short
            (10, [p(40), p(41)]), (11, [p(41), p(42)]), (12, [p(50), p(51), p(52)])]             # open chains
    rows += [(100 + i, [p(60 + i), p(60 + (i + 1) % 17)]) for i in range(17)]                    # a ring of seventeen
    df = spark.createDataFrame(rows, "way bigint, points array<struct<x:double,y:double>>")
    rings = {}
    for r in sorted(network.chain_rings(df).collect(), key=lambda r: (r.pid, r.ord)):
        assert r.ord == len(rings.setdefault(r.pid, []))     # numbered from 0 without gaps
        rings[r.pid].append((r.x, r.y))
    xy = lambda i: (float(i % 10), float(i // 10))
    assert rings == {3: [xy(3), xy(4), xy(1), xy(2), xy(3)], 1: [xy(20), xy(21), xy(22), xy(20)],
                     100: [xy(60 + i) for i in range(17)] + [xy(60)]}


def test_long_rings_keep_small_estimates(spark):
    """Each round joins a table with itself; its estimated size must not be the square of the last round's."""
    n = 200
    p = lambda i: {"x": float(i % n), "y": 0.0}
    df = spark.createDataFrame([(i + 1, [p(i), p(i + 1)]) for i in range(n)], "way bigint, points array<struct<x:double,y:double>>")
    found = network.chain_rings(df)
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 500
    assert sorted((r.pid, r.ord, r.x) for r in found.collect()) == [(1, i, float(i % n)) for i in range(n + 1)]


def test_arterial_network(spark):
    """A port: ferry 900 ends at node 1; service road 10 leads one way to street 11 and on to primary 20."""
    node = spark.createDataFrame([(i, 47.0 + i * 0.001, 28.0, {}) for i in range(1, 10)] + [(50, 48.0, 29.0, {})], "id bigint, lat double, lon double, tags map<string,string>")
    way = spark.createDataFrame([
        (900, [1, 50], {"route": "ferry"}), (901, [9, 50], {"route": "ferry", "motor_vehicle": "no"}), (10, [1, 2, 3], {"highway": "service", "service": "driveway", "oneway": "yes"}),
        (11, [3, 4], {"highway": "residential"}), (12, [4, 1], {"highway": "service", "access": "private"}), (20, [4, 5, 6], {"highway": "primary"}), (30, [7, 8], {"highway": "footway"})],
        "id bigint, refs array<bigint>, tags map<string,string>")
    relation = spark.createDataFrame([(1, [], {"type": "restriction"}), (2, [], {"type": "route"})], "id bigint, members array<struct<type:string,ref:bigint,role:string>>, tags map<string,string>")
    built = build_arterial_network(node, way, relation)
    tags = {r.id: r.tags for r in built.way.collect()}
    assert set(tags) == {900, 901, 20, 10, 11}
    assert tags[10]["highway"] == tags[11]["highway"] == "tertiary" and "service" not in tags[10]
    assert {r.source: r.outcome for r in built.ends.collect()} == {1: "one way", 50: "no road"}
    assert {r.way for r in built.connector.collect()} == {10, 11}
    assert [r.id for r in built.relation.collect()] == [1]


def counted(spark, df):
    """``df`` with an accumulator of the rows that its computations have made so far."""
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), rows


def test_inputs_of_the_road_search_are_computed_once(spark):
    ways = spark.createDataFrame([(900, [1, 50], {"route": "ferry"}), (10, [1, 2, 3], {"highway": "service"}), (20, [3, 5], {"highway": "primary"})], "id bigint, refs array<bigint>, tags map<string,string>")
    steps, rows = counted(spark, network.way_nodes(ways))
    lengths = spark.createDataFrame([(10, 7.0)], "way bigint, length double")
    classes = spark.createDataFrame([(10, "service")], "way bigint, highway string")
    found, ends = network.connectors(network.ferry_ends(ways), steps, lengths, classes)
    assert [(r.source, r.way, r.length) for r in found.collect()] == [(1, 10, 7.0)]
    assert {r.source: r.outcome for r in ends.collect()} == {1: "both ways", 50: "no road"}
    assert rows.value == 5


def test_relations_of_the_features_are_computed_once(spark):
    from atlas.plans.features import build_features_for_network

    node = spark.createDataFrame([(i, 47.0 + i * 0.001, 28.0, {"highway": "speed_camera"} if i == 2 else {}) for i in range(1, 6)], "id bigint, lat double, lon double, tags map<string,string>")
    way = spark.createDataFrame([(10, [1, 2, 3], {"highway": "primary"})], "id bigint, refs array<bigint>, tags map<string,string>")
    members = [{"type": "n", "ref": 2, "role": "device"}, {"type": "n", "ref": 1, "role": "from"}]
    relation = spark.createDataFrame([(7, members, {"type": "enforcement", "enforcement": "maxspeed", "maxspeed": "60"})],
                                     "id bigint, members array<struct<type:string,ref:bigint,role:string>>, tags map<string,string>")
    relation, rows = counted(spark, relation)
    found, _ = build_features_for_network(node, way, relation, node)
    assert [(r.id, r.type, r.maxspeed) for r in found.collect()] == [("n2", "camera_speed", 60)]
    assert rows.value == 1


def test_city_keys_are_made_once_per_spelling_and_cell(spark, folder):
    from atlas.queries import load

    plan = load()["j04_by_city"].run(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    made = [part.partition("Relation [")[0] for part in plan.split("Generate posexplode")[1:]]
    assert made and all("Aggregate [city" in below for below in made)
