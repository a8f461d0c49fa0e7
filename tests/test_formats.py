"""Strict text formats: what is written reads back, and one broken thing is one problem."""

import pytest
from pyspark.sql import functions as F

from atlas.sources import archives, lines, map_objects, strict_text


def text_lines(spark, text):
    rows = [("f", 0, i, v) for i, v in enumerate(text)]
    return spark.createDataFrame(rows, "file string, block bigint, at bigint, value string")


FRONTIER = ["x-frontier 1", "country MD", "graph_version 2026-01-01", "entries 2", strict_text.FRONTIER_COLUMNS, "0 1 2 8 -", "1 3 4 9 77"]


def swap(text, i, value):
    return text[:i] + ([value] if value is not None else []) + text[i + 1:]


def test_frontier_reads(spark):
    parsed = strict_text.parse_frontier(text_lines(spark, FRONTIER))
    assert [(r.level, r.osm) for r in parsed.rows.orderBy("at").collect()] == [(0, None), (1, 77)]
    assert parsed.problems.count() == 0
    assert {r.k: r.v for r in parsed.header.collect()}["country"] == "MD"


@pytest.mark.parametrize("broken,rule", [
    (swap(FRONTIER, 0, "x-frontier 2"), "wrong format line"), (swap(FRONTIER, 3, "entries 3"), "entries differ from the header"),
    (swap(FRONTIER, 5, "0 1 x 8 -"), "not numeric"), (swap(FRONTIER, 5, "0 1 2 8"), "wrong number of fields"),
    (swap(FRONTIER, 4, None), "no column line"), (swap(FRONTIER, 1, None), "header has no country"), (swap(FRONTIER, 1, "country"), "malformed header line")])
def test_frontier_problems(spark, broken, rule):
    rules = {r.rule for r in strict_text.parse_frontier(text_lines(spark, broken)).problems.collect()}
    assert rule in rules


LANES = ["x-buslanes 1", "w1 right", "w2 both"]


@pytest.mark.parametrize("broken,rule", [
    (swap(LANES, 0, "x-buslanes 2"), "wrong format line"), (swap(LANES, 1, "1 right"), "not 'w<id> <side>'"), (swap(LANES, 1, "w1  right"), "not 'w<id> <side>'"),
    (swap(LANES, 1, "w1 middle"), "unknown side"), (swap(LANES, 1, "w2 left"), "duplicate way")])
def test_bus_lane_problems(spark, broken, rule):
    assert rule in {r.rule for r in strict_text.parse_bus_lanes(text_lines(spark, broken)).problems.collect()}
    assert strict_text.parse_bus_lanes(text_lines(spark, LANES)).problems.count() == 0


def test_object_lines(spark):
    raw = ["n1 v1 x28.5 y47.25 Tname=Ia%219%i%20%Nou,k=a%3d%b%1f600%", "n2 v1 x y T", "w5 v2 Thighway=service Nn1,n2,n3", "r7 v1 Ttype=x Mn1@via,w5@a%20%b,r9@"]
    node, way, relation = map_objects.parse_osm_lines(spark.createDataFrame([(v,) for v in raw], "value string"))
    assert [(r.id, r.lat, r.lon, r.tags) for r in node.collect()] == [(1, 47.25, 28.5, {"name": "Iași Nou", "k": "a=b😀"})]
    assert [(r.id, r.refs) for r in way.collect()] == [(5, [1, 2, 3])]
    assert [tuple(m) for m in relation.collect()[0].members] == [("n", 1, "via"), ("w", 5, "a b"), ("r", 9, "")]


def test_poly_resets_on_a_header_line(spark):
    text = ["name", "1", " 1.0 2.0", " 3.0 4.0", "END", "!2", " 9.0 9.0", "broken ring here", " 5.0 6.0", "7.0 x", "8.0 9.0", "END", "END"]
    rows = sorted((r.ring, r.ord, r.x, r.y) for r in map_objects.parse_poly(text_lines(spark, text)).collect())
    assert rows == [(0, 0, 1.0, 2.0), (0, 1, 3.0, 4.0), (1, 0, 5.0, 6.0), (1, 1, 8.0, 9.0)]


def test_lines_across_blocks(spark):
    rows = [("f", b, i, str(10 * b + i)) for b in range(3) for i in range(4)]
    df = spark.createDataFrame(rows, "file string, block bigint, at bigint, value string")
    total = {r.value: r.s for r in lines.running_total(df, F.lit(1), "s").collect()}
    assert [total[v] for *_, v in rows] == list(range(12))
    before = {r.value: r.p for r in lines.previous_line(df, F.col("value"), "p").collect()}
    assert [before[v] for *_, v in rows] == [None] + [v for *_, v in rows[:-1]]


def test_archive_header_files(spark, tmp_path):
    from atlas.gates.archive import archive_gate
    import struct
    head = bytearray(127)
    head[:7] = bytes.fromhex(archives.MAGIC_HEX)
    head[7] = 3
    struct.pack_into("<QQQQQQQQ", head, 8, 127, 10, 137, 5, 142, 0, 142, 8)
    head[97], head[98], head[99], head[100], head[101] = 2, 2, 1, 0, 14
    struct.pack_into("<iiii", head, 102, -1, -2, 3, 4)
    (tmp_path / "good.bin").write_bytes(bytes(head) + b"x" * 23)
    (tmp_path / "short.bin").write_bytes(bytes(head[:50]))
    head[101] = 16
    (tmp_path / "zoom.bin").write_bytes(bytes(head) + b"x" * 20)
    read = archives.archive_header_audit(archives.read_archive_headers(spark, str(tmp_path)))
    good = {r.path.rsplit("/", 1)[-1]: r for r in read.collect()}["good.bin"]
    assert (good.version, good.root_start, good.tiles_bytes, good.west_e7, good.south_e7) == (3, 127, 8, -1, -2)
    got = {(r.path.rsplit("/", 1)[-1], r.rule) for r in archive_gate(read).collect()}
    assert got == {("short.bin", "too short"), ("zoom.bin", "zoom range"), ("zoom.bin", "tiles beyond the file")}


def test_files_of_one_name_in_two_folders_stay_apart(spark, tmp_path):
    from atlas.sources import logs

    def put(folder, name, text):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text)

    put("a", "samples.csv", "# memory source: cgroup2\nepoch,mem_bytes,disk_kb\n1,100,7\n")
    put("b", "samples.csv", "# memory source: meminfo\nepoch,disk_kb,mem_bytes\n1,8,200\n")
    rows = logs.read_samples(spark, str(tmp_path / "*" / "samples.csv")).collect()
    assert sorted((r.file.split("/")[-2], r.mem_bytes, r.disk_kb, r.source) for r in rows) == [("a", 100, 7, "cgroup2"), ("b", 200, 8, "meminfo")]
    put("a", "stages.csv", "stage,seconds\nx,1\nx,2\n")
    put("b", "stages.csv", "seconds,stage\n5,x\n".replace("seconds,stage", "stage,note,seconds").replace("5,x", "x,n,5"))
    assert sorted(r.seconds for r in logs.read_stages(spark, str(tmp_path / "*" / "stages.csv")).collect()) == [3, 5]
    for folder, x in (("a", 1), ("b", 5)):
        put(folder, "c.poly", f"land\n1\n {x} 0\n {x} 1\n {x + 1} 1\nEND\nEND\n")
        put(folder, "c.geojson", '{"type":"Polygon","coordinates":[[[%d,0],[%d,1],[2,2],[%d,0]]]}' % (x, x, x))
        put(folder, "lanes.txt", f"x-buslanes 1\nw{x} right\n")
        put(folder, "frontier.txt", "\n".join(FRONTIER[:6] + [f"1 3 4 9 {x}"]))
        put(folder, "portals.txt", f"{x} 2 0   # 1.0, 2.0\n")
    every = lambda name: str(tmp_path / "*" / name)
    assert sorted((r.file[-8:-7], r.ring, r.ord) for r in map_objects.read_poly(spark, every("c.poly")).collect()) == [(f, 0, k) for f in "ab" for k in range(3)]
    assert map_objects.read_geojson_polygons(spark, every("c.geojson")).select("file").distinct().count() == 2
    assert sorted(r.way_id for r in strict_text.read_bus_lanes(spark, every("lanes.txt")).rows.collect()) == [1, 5]
    parsed = strict_text.read_frontier(spark, every("frontier.txt"))
    assert parsed.problems.count() == 0 and parsed.rows.select("file").distinct().count() == 2
    assert strict_text.read_portals(spark, every("portals.txt")).select("file").distinct().count() == 2


def test_long_verdicts_are_kept_whole(spark):
    from atlas.sources import logs

    said = logs.mine_gate_reports(text_lines(spark, ["ROUTES GATE: " + "x" * 3000]), "routes").first().said
    assert said == "x" * 3000


def test_direction_lists_take_the_kind_of_their_first_part(spark):
    from atlas.functions import osm

    rows = spark.createDataFrame([("N;90",), ("90;N",), ("N;0-90",)], "v string").select("v", osm.parse_direction(F.col("v")).alias("d")).collect()
    assert {r.v: (r.d.src, r.d.degrees) for r in rows} == {"N;90": ("card", [0.0, 90.0]), "90;N": ("deg", [90.0, 0.0]), "N;0-90": (None, None)}


def test_archive_headers_are_read_as_ranges(spark, tmp_path):
    """Of a file of three gigabytes, a short one and one whose name needs quoting, only the first bytes."""
    with open(tmp_path / "large.pmtiles", "wb") as file:   # without blocks behind the header
        file.write(bytes.fromhex(archives.MAGIC_HEX) + b"\x03" + bytes(119))
        file.truncate(3 << 30)
    (tmp_path / "short.pmtiles").write_bytes(b"PM")
    (tmp_path / "ä b%20#1.pmtiles").write_bytes(b"other" * 40)
    rows = {r.path.rsplit("/", 1)[1]: r for r in archives.read_archive_headers(spark, f"{tmp_path}/*.pmtiles").collect()}
    assert {k: (r.length, len(r.header)) for k, r in rows.items()} == {"large.pmtiles": (3 << 30, 127), "short.pmtiles": (2, 2), "ä b%20#1.pmtiles": (200, 127)}
    found = {r.path.rsplit("/", 1)[1]: (r.magic_ok, r.version) for r in archives.archive_header_audit(archives.read_archive_headers(spark, f"{tmp_path}/large*")).collect()}
    assert found == {"large.pmtiles": (True, 3)}


def test_archives_share_volumes(spark, tmp_path):
    """Many archives in few files; what a failed task left behind is not read, and no header runs into the next archive."""
    import os

    content = {f"a {i} %.pmtiles": bytes.fromhex(archives.MAGIC_HEX) + bytes([i % 250]) + bytes(119) + b"body" * (i % 7) for i in range(600)}
    content["short"] = b"xy"
    rows = spark.createDataFrame([(k, bytearray(v)) for k, v in content.items()], "path string, content binary").repartition(3)
    folder = f"file:{tmp_path}/archives"
    members = archives.write_archive_volumes(rows, folder)
    assert len(os.listdir(f"{tmp_path}/archives/volumes")) <= 3
    (tmp_path / "archives" / "volumes" / "left.volume").write_bytes(b"left by a failed task")
    read = archives.read_archive_headers(spark, f"{folder}/volumes", members=members).collect()
    assert {r.path: (r.length, bytes(r.header)) for r in read} == {k: (len(v), v[:127]) for k, v in content.items()} and len(read) == len(content)


def test_packed_samples_are_read_as_files(spark, tmp_path):
    """Builds by the hundred share text files; each keeps its own first comment and its own order of columns."""
    from atlas.sources import logs, sinks

    rows = []
    for i in range(300):
        head = "epoch,mem_bytes,disk_kb" if i % 2 else "epoch,disk_kb,mem_bytes"
        rows += [(f"b{i}", at, text) for at, text in enumerate([f"# memory source: s{i % 3}", head, f"1,{i},7", "# note: later", f"2,{i},\t8"])]
    lines = spark.createDataFrame(rows, "file string, o int, value string").repartition(5)
    sinks.write_packed_lines(lines, "o", str(tmp_path / "packed"))
    assert len(list((tmp_path / "packed").glob("part-*"))) < 20
    got = sorted((int(r.file[1:]), r.epoch, r.mem_bytes, r.disk_kb, r.source) for r in logs.read_samples(spark, str(tmp_path / "packed"), packed=True).collect())
    assert got == sorted((i, e, i if i % 2 else v, v if i % 2 else i, f"s{i % 3}") for i in range(300) for e, v in ((1, 7), (2, 8)))
