"""Map extracts: object text lines, GeoJSON, polygon files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlas import schemas
from atlas.sources.lines import read_lines, running_total


def _utf8(code: Column) -> Column:
    """A code point as text, through its UTF-8 bytes."""
    low = lambda shift: F.lpad(F.hex(F.lit(128) + F.call_function("shiftright", code, F.lit(shift)).bitwiseAND(F.lit(63).cast("bigint"))), 2, "0")
    lead = lambda base, shift: F.lpad(F.hex(F.lit(base) + F.call_function("shiftright", code, F.lit(shift))), 2, "0")
    octets = (F.when(code < 0x80, F.lpad(F.hex(code), 2, "0"))
              .when(code < 0x800, F.concat(lead(192, 6), low(0)))
              .when(code < 0x10000, F.concat(lead(224, 12), low(6), low(0)))
              .otherwise(F.concat(lead(240, 18), low(12), low(6), low(0))))
    return F.decode(F.unhex(octets), "UTF-8")


def unescape(text: Column) -> Column:
    """``%hex%`` escapes → characters."""
    parts = F.split(text, "%")
    shown = F.transform(parts, lambda p, i: F.when(i % 2 == 0, p).when(
        p.rlike("^[0-9a-fA-F]+$"), _utf8(F.conv(p, 16, 10).cast("bigint"))).otherwise(F.concat(F.lit("%"), p, F.lit("%"))))
    return F.when(text.contains("%"), F.array_join(shown, "")).otherwise(text)


def _field(letter: str) -> Column:
    """Last token that starts with the letter, without it."""
    mine = F.filter(F.slice("_t", 2, F.size("_t")), lambda p: p.startswith(letter))
    return F.substring(F.try_element_at(mine, F.lit(-1)), 2, 1 << 30)


def _tags() -> Column:
    pairs = F.filter(F.split(F.coalesce(_field("T"), F.lit("")), ","), lambda kv: kv.contains("="))
    entries = F.transform(pairs, lambda kv: F.struct(
        unescape(F.split(kv, "=", 2)[0]).alias("key"), unescape(F.split(kv, "=", 2)[1]).alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def parse_osm_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines ``n… / w… / r…`` → node, way, relation tables (see ``schemas``)."""
    t = lines.filter(F.col("value") != "").select(F.split(F.rtrim("value"), " ").alias("_t"))
    head = t.select("_t", F.substring(F.col("_t")[0], 1, 1).alias("kind"), F.substring(F.col("_t")[0], 2, 30).try_cast("bigint").alias("id"))
    lat, lon = _field("y").try_cast("double"), _field("x").try_cast("double")
    node = head.filter("kind = 'n'").select("id", lat.alias("lat"), lon.alias("lon"), _tags().alias("tags")).filter("lat is not null and lon is not null")
    refs = F.filter(F.split(F.coalesce(_field("N"), F.lit("")), ","), lambda r: r.startswith("n"))
    way = head.filter("kind = 'w'").select("id", F.transform(refs, lambda r: F.regexp_extract(r, r"^n(\d+)", 1).try_cast("bigint")).alias("refs"), _tags().alias("tags"))
    listed = F.filter(F.split(F.coalesce(_field("M"), F.lit("")), ","), lambda m: m != "")
    member = lambda m: F.struct(
        F.substring(m, 1, 1).alias("type"), F.regexp_extract(m, r"^.(\d+)", 1).try_cast("bigint").alias("ref"),
        unescape(F.coalesce(F.try_element_at(F.split(m, "@", 2), F.lit(2)), F.lit(""))).alias("role"))
    relation = head.filter("kind = 'r'").select("id", F.transform(listed, member).alias("members"), _tags().alias("tags"))
    return node, way, relation


def read_osm_text(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return parse_osm_lines(spark.read.text(path))


def rings_of(kind: Column, coordinates: Column) -> Column:
    """GeoJSON coordinates (as text) → rings; parts and holes flattened, other kinds give no ring."""
    point = lambda c: F.struct(c[0].alias("x"), c[1].alias("y"))
    shape = lambda rings: F.transform(rings, lambda r: F.transform(r, point))
    one = F.from_json(coordinates, "array<array<array<double>>>")
    many = F.flatten(F.from_json(coordinates, "array<array<array<array<double>>>>"))
    return (F.when(kind == "Polygon", shape(one)).when(kind == "MultiPolygon", shape(many))
            .otherwise(F.array().cast(schemas.RINGS)))


def parse_geojson(texts: DataFrame, column: str = "value") -> DataFrame:
    """Feature or bare geometry texts → properties, kind, rings, lat, lon (points and lines: first position)."""
    f = F.from_json(F.regexp_replace(F.trim(F.col(column)), "^\x1e", ""), schemas.FEATURE)
    read = texts.withColumn("_f", f)
    kind = F.coalesce("_f.geometry.type", "_f.type")
    coordinates = F.coalesce("_f.geometry.coordinates", "_f.coordinates")
    spot = F.when(kind == "Point", F.from_json(coordinates, "array<double>"))
    line = F.when(kind == "LineString", F.from_json(coordinates, "array<array<double>>"))
    return (read.withColumn("kind", kind).withColumn("properties", F.col("_f.properties"))
            .withColumn("rings", rings_of(kind, coordinates)).withColumn("line", F.transform(line, lambda c: F.struct(c[0].alias("x"), c[1].alias("y"))))
            .withColumn("lat", spot[1]).withColumn("lon", spot[0]).drop("_f", column))


def read_geojson_polygons(spark: SparkSession, path: str) -> DataFrame:
    """One polygon file per row: file, properties, rings."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return parse_geojson(texts).select("file", "properties", "rings")


def read_geojson_seq(spark: SparkSession, path: str) -> DataFrame:
    """Record-separated features with ``@type`` and ``@id``: kind, pid, oid, tags, rings, line, lat, lon."""
    lines = spark.read.text(path).filter(F.regexp_replace(F.trim("value"), "^\x1e", "") != "")
    parsed = parse_geojson(lines)
    p = F.col("properties")
    own = F.map_filter(p, lambda k, v: ~k.startswith("@"))
    return parsed.select(F.col("kind"), F.concat(F.substring(p["@type"], 1, 1), p["@id"]).alias("pid"),
                         F.substring(p["@type"], 1, 1).alias("object"), p["@id"].try_cast("bigint").alias("oid"),
                         own.alias("tags"), "rings", "line", "lat", "lon")


def parse_poly(lines: DataFrame) -> DataFrame:
    """Polygon files as vertex rows: file, ring, ord, x, y. A ring is the run of ``lon lat`` lines before an END; any other
    line starts over. Rings and vertices are numbered from 0 in file order, and no ring is gathered."""
    words = F.split(F.trim("value"), r"\s+")
    typed = (lines.filter(F.trim("value") != "").withColumn("w", words)
             .withColumn("x", F.when(F.size("w") == 2, F.col("w")[0].try_cast("double")))
             .withColumn("y", F.when(F.size("w") == 2, F.col("w")[1].try_cast("double"))))
    is_end = F.trim("value") == "END"
    breaks = is_end | (F.size("w") != 2)
    placed = running_total(typed.withColumn("is_end", is_end), breaks, "run")
    vertex = F.col("x").isNotNull() & F.col("y").isNotNull()
    placed = running_total(placed, vertex, "line").select("file", "run", "line", "is_end", "x", "y")
    points = placed.filter(vertex)
    closed = placed.filter("is_end").select("file", "run")
    rings = points.join(closed, ["file", "run"], "left_semi").groupBy("file", "run").agg(F.min("line").alias("first"))
    rings = rings.withColumn("ring", F.row_number().over(Window.partitionBy("file").orderBy("run")) - 1)   # one row per ring
    return points.join(rings, ["file", "run"]).select("file", "ring", (F.col("line") - F.col("first")).cast("int").alias("ord"), "x", "y")


def read_poly(spark: SparkSession, path: str) -> DataFrame:
    return parse_poly(read_lines(spark, path))
