"""Grade separations on crowded positions against brute force."""

import math
import random

from atlas.operators import probes

VERTEX = "way bigint, idx int, node bigint, lat double, lon double"


def test_crowded_positions_against_brute_force(spark, monkeypatch):
    r = random.Random(5)
    spots = [(47.0, 28.0), (47.0004, 28.0), (47.0004, 28.0003), (47.0, 28.0006)]
    names = [None, "", "One", "Two"]
    tags = {w: {"highway": "primary", **({"name": n} if (n := r.choice(names)) is not None else {}), **({"bridge": "yes", "layer": "1"} if w > 60 else {})} for w in range(1, 81)}
    nodes = {}
    for way in tags:
        # low roads share a node with many bridges, so bridges have to walk on at a position
        nodes[way] = [r.randrange(6) * 4 + r.randrange(4) for _ in range(3)]
    at = lambda node: spots[node % 4]
    ways = spark.createDataFrame(list(tags.items()), "id bigint, tags map<string,string>")
    vertices = spark.createDataFrame([(w, i, n, *at(n)) for w, ns in nodes.items() for i, n in enumerate(ns)], VERTEX)
    sizes = {}
    stored = probes.stored

    def counted(df, name):
        out = stored(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(probes, "stored", counted)
    got = {x.bridge: (x.road, round(x.separation, 6), x.b_lat, x.b_lon, x.r_lat, x.r_lon) for x in probes.grade_separation_pairs(ways, vertices).collect()}
    want = {}
    for b in range(61, 81):
        found = []
        for road in range(1, 61):
            b_name, r_name = tags[b].get("name"), tags[road].get("name")
            if set(nodes[b]) & set(nodes[road]) or (b_name and b_name == r_name):
                continue
            for p in {at(n) for n in nodes[b]}:
                for q in {at(n) for n in nodes[road]}:
                    d = math.hypot((p[0] - q[0]) * 111320, (p[1] - q[1]) * 111320 * math.cos(math.radians(p[0])))
                    if 25 <= d <= 80:
                        found.append((d, road, *p, *q))
        if found:
            d, road, *rest = min(found)
            want[b] = (road, round(d, 6), *rest)
    assert got == want and len(want) > 10
    assert sizes["shared"] > 0                                   # some had to walk on
    assert sizes["asked"] <= 20 * len(spots) * (len(spots) - 1)  # one row per bridge and pair of positions, not per road
