"""Distances, bearings, tile arithmetic and ring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
EARTH_KM = 6_371.0
TILE_DEGREES = {0: 4.0, 1: 1.0, 2: 0.25}


def from_e7(value: Column) -> Column:
    return value / F.lit(1e7)


def e7(degrees: Column) -> Column:
    """Fixed-point degrees, rounded half to even."""
    return F.bround(degrees * F.lit(1e7)).cast("int")


def decimal_cell(value: Column, digits: int) -> Column:
    """``value`` rounded to decimals as a whole number of cells, from the exact binary value.

    Positions carry five decimals, so halves are common; which side a half lies on is decided by the error
    of the product (two-product), and only a true half goes to the even neighbour.
    """
    n = F.lit(2.0 * 10 ** digits)
    split = F.lit(134217729.0) * value
    high = split - (split - value)
    product = value * n
    error = (high * n - product) + (value - high) * n
    half = product / 2
    base = F.floor(half)
    rest = half - base
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (base % 2 != 0))))
    return (base + up.cast("int")).cast("bigint")


def meters(a_lat: Column, a_lon: Column, b_lat: Column, b_lon: Column) -> Column:
    """Flat distance scaled at the mean latitude, metres."""
    k = F.cos(F.radians((a_lat + b_lat) / 2)) * F.lit(111_320.0)
    return F.hypot((b_lon - a_lon) * k, (b_lat - a_lat) * F.lit(110_540.0))


def km(a_lat: Column, a_lon: Column, b_lat: Column, b_lon: Column) -> Column:
    k = F.cos(F.radians((a_lat + b_lat) / 2)) * F.lit(111.32)
    return F.hypot((b_lon - a_lon) * k, (b_lat - a_lat) * F.lit(110.54))


def probe_metres(a_lat: Column, a_lon: Column, b_lat: Column, b_lon: Column) -> Column:
    """City-scale distance: one scale for both axes, longitude shrunk at the first point."""
    dy = (a_lat - b_lat) * F.lit(111_320.0)
    dx = (a_lon - b_lon) * F.lit(111_320.0) * F.cos(F.radians(a_lat))
    return F.hypot(dx, dy)


def haversine(a_lat: Column, a_lon: Column, b_lat: Column, b_lon: Column,
              radius: float = EARTH_M) -> Column:
    la1, lo1, la2, lo2 = (F.radians(c) for c in (a_lat, a_lon, b_lat, b_lon))
    h = (F.pow(F.sin((la2 - la1) / 2), F.lit(2.0))
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), F.lit(2.0)))
    root = F.sqrt(h)
    return F.lit(2.0 * radius) * F.asin(F.when(root > 1.0, F.lit(1.0)).otherwise(root))


def bearing(a_lat: Column, a_lon: Column, b_lat: Column, b_lon: Column) -> Column:
    """Initial bearing of a→b, 0..360."""
    la1, lo1, la2, lo2 = (F.radians(c) for c in (a_lat, a_lon, b_lat, b_lon))
    y = F.sin(lo2 - lo1) * F.cos(la2)
    x = F.cos(la1) * F.sin(la2) - F.sin(la1) * F.cos(la2) * F.cos(lo2 - lo1)
    return F.pmod(F.degrees(F.atan2(y, x)) + F.lit(360.0), F.lit(360.0))


def angle_diff(a: Column, b: Column) -> Column:
    d = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(d, F.lit(360.0) - d)


def destination(lat: Column, lon: Column, metres: Column, brg: Column) -> Column:
    """Point at ``metres`` along ``brg``: struct(lat, lon)."""
    d, b = metres / F.lit(EARTH_M), F.radians(brg)
    la, lo = F.radians(lat), F.radians(lon)
    la2 = F.asin(F.sin(la) * F.cos(d) + F.cos(la) * F.sin(d) * F.cos(b))
    lo2 = lo + F.atan2(F.sin(b) * F.sin(d) * F.cos(la), F.cos(d) - F.sin(la) * F.sin(la2))
    return F.struct(F.degrees(la2).alias("lat"), F.degrees(lo2).alias("lon"))


def haversine_e7(a_lat: Column, a_lon: Column, b_lat: Column, b_lon: Column) -> Column:
    return haversine(from_e7(a_lat), from_e7(a_lon), from_e7(b_lat), from_e7(b_lon))


def portal_distance(a_lat: Column, a_lon: Column, b_lat: Column, b_lon: Column) -> Column:
    """Metres between two e7 points, rounded up to a centimetre; 0 only for the same point."""
    up = F.ceil(haversine_e7(a_lat, a_lon, b_lat, b_lon) * 100.0) / F.lit(100.0)
    return (F.when((a_lat == b_lat) & (a_lon == b_lon), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.01), up)))


def by_level(level: Column, values: dict[int, float]) -> Column:
    out = F.lit(None).cast("double")
    for key, value in values.items():
        out = F.when(level == key, F.lit(float(value))).otherwise(out)
    return out


def tile_bbox(level: Column, tile_id: Column) -> Column:
    """Routing tile → struct(west, south, east, north)."""
    size = by_level(level, TILE_DEGREES)
    columns = (F.lit(360.0) / size).cast("bigint")
    row = F.floor(tile_id / columns).cast("bigint")
    west = F.lit(-180.0) + F.pmod(tile_id, columns) * size
    south = F.lit(-90.0) + row * size
    return F.struct(west.alias("west"), south.alias("south"),
                    (west + size).alias("east"), (south + size).alias("north"))


def tile_of_point(level: Column, lat: Column, lon: Column) -> Column:
    """Id of the routing tile of ``level`` that holds the point."""
    size = by_level(level, TILE_DEGREES)
    columns = (F.lit(360.0) / size).cast("bigint")
    return (F.floor((lat + 90.0) / size) * columns + F.floor((lon + 180.0) / size)).cast("bigint")


def tile_id_from_path(path: Column) -> Column:
    """``2/000/818/660.gph`` → struct(level, tile_id)."""
    stem = F.regexp_replace(path, r"\.[^.]*$", "")
    parts = F.split(stem, "/")
    digits = F.array_join(F.slice(parts, 2, F.size(parts)), "")
    return F.struct(parts[0].cast("int").alias("level"), digits.cast("bigint").alias("tile_id"))


def web_tile(lat: Column, lon: Column, zoom: Column) -> Column:
    """Web-Mercator tile of a point: struct(x, y)."""
    n = F.pow(F.lit(2.0), zoom)
    x = ((lon + 180.0) / 360.0 * n).cast("bigint")
    y = ((F.lit(1.0) - F.asinh(F.tan(F.radians(lat))) / F.pi()) / 2.0 * n).cast("bigint")
    return F.struct(x.alias("x"), y.alias("y"))


def tile_pixel_to_lonlat(z: Column, x: Column, y: Column, px: Column, py: Column,
                         extent: Column) -> Column:
    """Position inside a tile → struct(lat, lon) rounded to 5 decimals."""
    n = F.pow(F.lit(2.0), z)
    lon = (x + px / extent) / n * 360.0 - 180.0
    lat = F.degrees(F.atan(F.sinh(F.pi() * (F.lit(1.0) - (y + py / extent) * 2.0 / n))))
    return F.struct(F.bround(lat, 5).alias("lat"), F.bround(lon, 5).alias("lon"))


LAST_ZOOM = 32   # the zoom in which the ids of 64 bits end


def hilbert_zxy(tile_id: Column) -> Column:
    """Archive tile id (Hilbert order, zooms one after another) → struct(z, x, y), for every id of 64 bits.

    The quadrant of each two bits, lowest first, is undone by a fold over the bit pairs.
    """
    first = F.array(*[F.lit((4 ** z - 1) // 3).cast("bigint") for z in range(LAST_ZOOM + 1)])
    z = F.greatest(F.size(F.filter(first, lambda v: v <= tile_id)) - 1, F.lit(0))
    start = F.element_at(first, z + 1)
    zero = F.lit(0).cast("bigint")

    def undo(acc: Column, k: Column) -> Column:
        side = F.call_function("shiftleft", F.lit(1).cast("bigint"), k)
        pair = F.call_function("shiftright", acc["d"], 2 * k).bitwiseAND(F.lit(3).cast("bigint"))
        right = F.call_function("shiftright", pair, F.lit(1))
        upper = pair.bitwiseXOR(right).bitwiseAND(F.lit(1).cast("bigint"))
        mirror = (upper == 0) & (right == 1)
        mx = F.when(mirror, side - 1 - acc["x"]).otherwise(acc["x"])
        my = F.when(mirror, side - 1 - acc["y"]).otherwise(acc["y"])
        nx = F.when(upper == 0, my).otherwise(mx)
        ny = F.when(upper == 0, mx).otherwise(my)
        return F.struct(acc["d"].alias("d"), (nx + side * right).alias("x"),
                        (ny + side * upper).alias("y"))

    seed = F.struct((tile_id - start).cast("bigint").alias("d"), zero.alias("x"), zero.alias("y"))
    steps = F.when(z > 0, F.sequence(F.lit(0), z - 1)).otherwise(F.array().cast("array<int>"))
    done = F.aggregate(steps, seed, undo)
    return F.struct(z.cast("int").alias("z"), done["x"].alias("x"), done["y"].alias("y"))


def polyline6_steps(shape: Column) -> Column:
    """Encoded route shape (1e-6 degrees) → array of struct(dlat, dlon) in whole units.

    Characters end a number when their value is below 32, so the text is cut into numbers with one
    regular expression; each number is a sum of 5-bit digits, lowest first.
    """
    numbers = F.regexp_extract_all(shape, F.lit("([_-~]*[?-^])"), F.lit(1))

    def value(text: Column) -> Column:
        digits = F.transform(F.split(text, ""), lambda c, i: F.call_function(
            "shiftleft", (F.ascii(c) - 63).bitwiseAND(F.lit(31)).cast("bigint"), i * 5))
        raw = F.aggregate(digits, F.lit(0).cast("bigint"), lambda s, v: s + v)
        half = F.call_function("shiftright", raw, F.lit(1))
        return F.when(raw.bitwiseAND(F.lit(1).cast("bigint")) == 1, -half - 1).otherwise(half)

    deltas = F.transform(numbers, value)
    evens = F.filter(deltas, lambda v, i: i % 2 == 0)
    odds = F.filter(deltas, lambda v, i: i % 2 == 1)
    return F.zip_with(evens, odds, lambda a, b: F.struct(a.alias("dlat"), b.alias("dlon")))


def segment_meets_box(x0: Column, y0: Column, x1: Column, y1: Column,
                      bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    """Does the closed segment touch the closed box? The parameter range of each axis is an
    interval; the segment meets the box when the three intervals (both axes and 0..1) overlap."""
    def span(p: Column, d: Column, low: Column, high: Column) -> tuple[Column, Column, Column]:
        a, b = F.try_divide(low - p, d), F.try_divide(high - p, d)
        inside = (p >= low) & (p <= high)
        return (F.when(d == 0, F.lit(0.0)).otherwise(F.least(a, b)),
                F.when(d == 0, F.lit(1.0)).otherwise(F.greatest(a, b)),
                (d != 0) | inside)

    enter_x, leave_x, ok_x = span(x0, x1 - x0, bx0, bx1)
    enter_y, leave_y, ok_y = span(y0, y1 - y0, by0, by1)
    enter = F.greatest(F.lit(0.0), enter_x, enter_y)
    leave = F.least(F.lit(1.0), leave_x, leave_y)
    return ok_x & ok_y & (enter <= leave)


def ring_area(rings: Column) -> Column:
    """Sum of absolute shoelace areas of the rings (array of arrays of struct(x, y))."""
    def one(ring: Column) -> Column:
        nxt = F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0)))
        cross = F.zip_with(ring, nxt, lambda a, b: F.coalesce(a["x"] * b["y"] - b["x"] * a["y"], F.lit(0.0)))
        return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2

    return F.aggregate(F.transform(rings, one), F.lit(0.0), lambda s, v: s + v)


def ring_centroid(rings: Column) -> Column:
    """Mean of the vertices of the first ring, the closing vertex included: struct(x, y)."""
    first = F.get(rings, F.lit(0))
    mean = lambda f: F.aggregate(F.transform(first, lambda p: p[f]), F.lit(0.0),
                                 lambda s, v: s + v) / F.size(first)
    return F.struct(mean("x").alias("x"), mean("y").alias("y"))


def consecutive_pairs(points: Column) -> Column:
    """Array of points → array of struct(a, b) of neighbours."""
    count = F.greatest(F.size(points) - 1, F.lit(0))
    return F.zip_with(F.slice(points, 1, count), F.slice(points, 2, count),
                      lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def path_length(points: Column, distance) -> Column:
    """Sum of the distances between consecutive points; NULL points are skipped pair by pair."""
    steps = F.transform(consecutive_pairs(points), lambda p: F.coalesce(
        distance(p["a"]["lat"], p["a"]["lon"], p["b"]["lat"], p["b"]["lon"]), F.lit(0.0)))
    return F.aggregate(steps, F.lit(0.0), lambda s, v: s + v)
