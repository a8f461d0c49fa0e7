"""Release tables: tile deltas, rebuild decisions, manifests, package indexes, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atlas.functions import osm, text
from atlas.operators.groups import dense_ids

MAX_REGION_ID = 255
BLOCKS = ("map", "search", "frontier", "features", "bus_lanes")


# ---- tiles -----------------------------------------------------------------------------------


def tile_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(path, bytes, sha, body_sha)`` of two builds → path, what, bytes of the new tile."""
    o = old.select("path", *[F.col(c).alias(f"o_{c}") for c in ("bytes", "sha", "body_sha")])
    joined = new.join(o, "path", "full")
    same_size = F.col("bytes") == F.col("o_bytes")
    what = (F.when(F.col("o_sha").isNull(), "added").when(F.col("sha").isNull(), "removed")
            .when(same_size & (F.col("sha") == F.col("o_sha")), "identical")
            .when(same_size & (F.col("body_sha") == F.col("o_body_sha")), "stamp only").otherwise("changed"))
    return joined.select("path", what.alias("what"), F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"))


def tile_delta_summary(delta: DataFrame) -> DataFrame:
    """Tiles per outcome, what a download would move, and whether that is worth it."""
    count = lambda w: F.count_if(F.col("what") == w)
    moves = F.col("what").isin("changed", "added")
    total = F.count_if(F.col("what") != "removed")
    row = delta.agg(count("identical").alias("identical"), count("stamp only").alias("stamp_only"), count("changed").alias("changed"),
                    count("added").alias("added"), count("removed").alias("removed"), total.alias("total"),
                    F.coalesce(F.sum(F.when(moves, F.col("bytes"))), F.lit(0)).alias("moved_bytes"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"))
    verdict = F.when(F.col("changed") * 2 > F.col("total"), "rewritten").when(F.col("stamp_only") > 0, "stamp blocks delta").otherwise("delta")
    return row.withColumn("verdict", verdict)


def path_sets(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths only new, only old, in both."""
    o, n = old.select("path"), new.select("path")
    tag = lambda df, what: df.withColumn("what", F.lit(what))
    return tag(n.exceptAll(o), "added").unionByName(tag(o.exceptAll(n), "removed")).unionByName(tag(n.intersect(o), "shared"))


def shared_tile_identity(tiles: DataFrame) -> DataFrame:
    """Per country pair: tiles both hold and how many are byte-identical. ``tiles(country, path, sha)``.

    Countries holding one path are few (region ids stop at 255), so the pairs per path are bounded.
    """
    a, b = tiles.alias("a"), tiles.alias("b")
    met = a.join(b, (F.col("a.path") == F.col("b.path")) & (F.col("a.country") < F.col("b.country")))
    return met.groupBy(F.col("a.country").alias("a"), F.col("b.country").alias("b")).agg(
        F.count(F.lit(1)).alias("shared"), F.count_if(F.col("a.sha") == F.col("b.sha")).alias("identical"))


def cut_overhead(tiles: DataFrame, owners: DataFrame) -> DataFrame:
    """Tiles and bytes per country, tiles shared by several, and the cuts against the whole:
    ``tiles(level, tile_id, bytes)``, ``owners(level, tile_id, country)``."""
    held = tiles.join(owners, ["level", "tile_id"])
    per_tile = held.groupBy("level", "tile_id").agg(F.count(F.lit(1)).alias("holders"), F.max("bytes").alias("bytes"))
    cuts = per_tile.agg(F.count_if(F.col("holders") > 1).alias("shared"), F.sum(F.col("holders") * F.col("bytes")).alias("cut_bytes"))
    whole = tiles.agg(F.count(F.lit(1)).alias("tiles"), F.sum("bytes").alias("bytes"))
    one = F.lit(1)
    return whole.withColumn("_k", one).join(cuts.withColumn("_k", one), "_k").drop("_k").withColumn(
        "overhead", F.try_divide(F.col("cut_bytes"), F.col("bytes")))


# ---- what to rebuild -------------------------------------------------------------------------


def rebuild_decision(wanted: DataFrame, published: DataFrame, engine_sha: str, tz_sha: str, forced: str | list[str] = "auto") -> DataFrame:
    """``wanted(code, md5)`` against manifest rows: code, rebuild, reason.

    ``forced`` is ``auto``, ``all`` or a list of codes. A carried code that was never published is refused
    by ``rebuild_consistency``.
    """
    r = published.select("code", F.lit(True).alias("known"), F.col("source.md5").alias("old_md5"), "engine_sha", F.col("timezones.sha256").alias("tz"))
    joined = wanted.join(r, "code", "left")
    if forced == "all":
        reason = F.lit("forced (all)")
    elif forced != "auto":
        reason = F.when(F.col("code").isin(*forced), "forced")
    else:
        reason = (F.when(F.col("known").isNull(), "not in the current manifest").when(F.coalesce("old_md5", F.lit("")) == "", "no source md5 recorded")
                  .when(~F.col("old_md5").eqNullSafe(F.col("md5")), "extract changed").when(~F.col("engine_sha").eqNullSafe(F.lit(engine_sha)), "engine changed")
                  .when(~F.col("tz").eqNullSafe(F.lit(tz_sha)), "time zones changed"))
    return joined.select("code", reason.isNotNull().alias("rebuild"), reason.alias("reason"))


def effective_set(asked: DataFrame, graphs: DataFrame, basemaps: DataFrame, published: DataFrame) -> DataFrame:
    """What became of each country asked to rebuild: rebuilt (both halves there), carried (published before)
    or absent, with the reason."""
    mark = lambda df, name: df.select("code").distinct().withColumn(name, F.lit(True))
    j = asked.select("code").join(mark(graphs, "g"), "code", "left").join(mark(basemaps, "b"), "code", "left").join(mark(published, "p"), "code", "left")
    g, b = F.col("g").isNotNull(), F.col("b").isNotNull()
    why = (F.when(g & b, F.lit(None).cast("string")).when(~g & ~b, "graph and map/search jobs failed")
           .when(~g, "graph job failed").otherwise("map/search job failed"))
    outcome = F.when(g & b, "rebuilt").when(F.col("p").isNotNull(), "carried").otherwise("absent")
    return j.select("code", outcome.alias("outcome"), why.alias("reason"))


# ---- manifests -------------------------------------------------------------------------------


STAMPED = ("frontier", "features", "bus_lanes", "addresses")


def source_stamps(regions: DataFrame) -> DataFrame:
    """Manifest rows as code, graph and the stamp of each derived asset."""
    frontier = F.when(F.col("frontier.source") == "graph-only", "graph-only").otherwise(F.col("frontier.source_md5"))
    return regions.select("code", F.col("source.md5").alias("graph"), frontier.alias("frontier"), F.col("features.source_md5").alias("features"),
                          F.col("bus_lanes.source_md5").alias("bus_lanes"), F.col("search.addresses.source_md5").alias("addresses"))


def source_identity(regions: DataFrame, built: DataFrame) -> DataFrame:
    """Derived assets that do not come from the graph's own source file: code, what, problem.

    Stamps are judged in their row, so only codes and flags are joined with what was built."""
    absent = lambda c: F.coalesce(c, F.lit("")) == ""
    judged = source_stamps(regions).select(
        "code", absent(F.col("graph")).alias("no_graph"),
        *[(~F.coalesce(F.col(w) == "graph-only", F.lit(False)) & ~absent(F.col(w)) & ~F.col(w).eqNullSafe(F.col("graph"))).alias(f"other_{w}") for w in STAMPED],
        *[absent(F.col(w)).alias(f"no_{w}") for w in STAMPED])
    now = F.coalesce("now", F.lit(False))
    rows = judged.join(built.select("code", F.lit(True).alias("now")), "code", "left")
    problem = lambda what, text: F.struct(F.lit(what).alias("what"), F.lit(text).alias("problem"))
    found = [F.when(F.col(f"no_{w}") & now, problem(w, "no source identity")).when(F.col(f"other_{w}"), problem(w, "other source than the graph")) for w in STAMPED]
    found.append(F.when(F.col("no_graph") & now, problem("graph", "the graph has no source md5")))
    return rows.select("code", F.inline(F.array_compact(F.array(*found))))


def block_flags(regions: DataFrame) -> DataFrame:
    return regions.select("code", *[F.col(b).isNotNull().alias(b) for b in BLOCKS])


def carry_losses(now: DataFrame, previous: DataFrame, built: DataFrame) -> DataFrame:
    """Blocks a carried country had before and lacks now: code, block. One flag per block is joined, not a row."""
    held = block_flags(now).groupBy("code").agg(*[F.max(b).alias(f"now_{b}") for b in BLOCKS])
    carried = held.join(built.select("code"), "code", "left_anti")
    lost = F.array_compact(F.array(*[F.when(F.col(b) & ~F.col(f"now_{b}"), F.lit(b)) for b in BLOCKS]))
    return block_flags(previous).join(carried, "code").select("code", F.explode(lost).alias("block"))


def completeness(catalog: DataFrame, borders: DataFrame, regions: DataFrame, portals: DataFrame, absent: DataFrame) -> DataFrame:
    """Countries and legacy borders of the catalog that the manifest lacks or contradicts: subject, problem."""
    gone = absent.select("code", F.lit(True).alias("gone"))
    r = regions.select("code", F.lit(True).alias("there"), F.col("region_id").alias("has_id"), F.col("frontier").isNotNull().alias("has_frontier"))
    c = catalog.select("code", "region_id").join(r, "code", "left").join(gone, "code", "left")
    problem = (F.when(F.col("there").isNull(), F.when(F.col("gone").isNull(), "missing"))
               .when(F.col("has_id") != F.col("region_id"), "other region id").when(~F.col("has_frontier"), "no frontier"))
    countries = c.select(F.col("code").alias("subject"), problem.alias("problem")).filter("problem is not null")
    end = lambda name: absent.select(F.col("code").alias(name))
    legacy = borders.filter("legacy").join(end("a"), "a", "left_anti").join(end("b"), "b", "left_anti")
    pair = F.concat_ws("-", "a", "b").alias("pair")
    lost = legacy.select(pair).join(portals.select("pair"), "pair", "left_anti")
    return countries.unionByName(lost.select(F.col("pair").alias("subject"), F.lit("no table").alias("problem")))


def exploded_assets(regions: DataFrame) -> DataFrame:
    """Every file a manifest points to: code, block, name, url, bytes, sha256 (parts instead of the whole)."""
    folder = lambda url: F.regexp_replace(url, r"/[^/]*$", "")
    whole = F.array(F.struct(F.col("package").alias("name"), F.col("url").alias("url"), F.col("bytes").alias("bytes"), F.col("sha256").alias("sha256")))
    split = lambda parts, url: F.transform(parts, lambda p: F.struct(
        p["name"].alias("name"), F.concat(folder(url), F.lit("/"), p["name"]).alias("url"), p["bytes"].alias("bytes"), p["sha256"].alias("sha256")))
    has = lambda parts: F.coalesce(F.size(parts) > 0, F.lit(False))
    graph = regions.select("code", F.lit("graph").alias("block"), F.inline(F.when(has(F.col("parts")), split(F.col("parts"), F.col("url"))).otherwise(whole)))
    out = graph
    for block in ("frontier", "features", "bus_lanes"):
        b = regions.filter(F.col(block).isNotNull())
        out = out.unionByName(b.select("code", F.lit(block).alias("block"), F.col(f"{block}.file").alias("name"), F.col(f"{block}.url").alias("url"),
                                       F.col(f"{block}.bytes").alias("bytes"), F.col(f"{block}.sha256").alias("sha256")))
    for block in ("map", "search"):
        b = regions.filter(F.col(f"{block}.url").isNotNull() & F.col(f"{block}.file").isNotNull())
        one = F.array(F.struct(*[F.col(f"{block}.{f}").alias(g) for f, g in (("file", "name"), ("url", "url"), ("bytes", "bytes"), ("sha256", "sha256"))]))
        files = F.when(has(F.col(f"{block}.parts")), split(F.col(f"{block}.parts"), F.col(f"{block}.url"))).otherwise(one)
        out = out.unionByName(b.select("code", F.lit(block).alias("block"), F.inline(files)))
    return out


def release_assets(assets: DataFrame, tag: str) -> DataFrame:
    """The files that belong to the release ``tag``."""
    return assets.filter(text.tag_of(F.col("url")) == tag)


def asset_reconcile(assets: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest files against what is really there: name, verdict (ok, mismatch, missing, unexpected).

    ``listing(name, bytes, sha256)``; both sides may name a file more than once.
    """
    want = assets.groupBy("name").agg(F.max("bytes").alias("w_bytes"), F.max("sha256").alias("w_sha"))
    have = listing.groupBy("name").agg(F.max("bytes").alias("h_bytes"), F.max("sha256").alias("h_sha"))
    same = (F.col("w_bytes") == F.col("h_bytes")) & (F.col("w_sha") == F.col("h_sha"))
    verdict = (F.when(F.col("h_sha").isNull(), "missing").when(F.col("w_sha").isNull(), "unexpected").when(same, "ok").otherwise("mismatch"))
    return want.join(have, "name", "full").select("name", verdict.alias("verdict"))


# ---- package index ---------------------------------------------------------------------------


def promote_upsert(index: DataFrame, graphs: DataFrame, basemaps: DataFrame, searches: DataFrame, assets: DataFrame, plans: DataFrame) -> DataFrame:
    """New halves replace published ones, everything else is kept.

    ``index(package, countries, graph, basemap, index)``; ``graphs(package, dataDate, timezones)``,
    ``basemaps(package, dataDate)``, ``searches(package)``; ``assets(name, url, bytes, sha256)``;
    ``plans(package, countries)``. A half without an uploaded asset, or a graph without time zones, is
    not promoted.
    """
    half = lambda name: F.struct("url", "bytes", "sha256", name)
    def uploaded(metas: DataFrame, extension: str, alias: str) -> DataFrame:
        named = metas.withColumn("name", F.concat("package", F.lit("-"), F.col("dataDate"), F.lit(f".{extension}")))
        return named.join(assets, "name").select("package", half("dataDate").alias(alias))
    g = uploaded(graphs.filter(F.coalesce("timezones", F.lit(True))), "tar", "new_graph")
    b = uploaded(basemaps, "pmtiles", "new_basemap")
    s = searches.withColumn("name", F.concat("package", F.lit("-index.json"))).join(assets, "name").select(
        "package", F.struct("url", "bytes", "sha256", F.lit(None).cast("string").alias("dataDate")).alias("new_index"))
    news = g.join(b, "package", "full").join(s, "package", "full").join(plans.select("package", F.col("countries").alias("planned")), "package", "left")
    merged = index.join(news, "package", "full")
    countries = F.when(F.col("new_graph").isNotNull(), F.coalesce("planned", "countries")).otherwise(F.col("countries"))
    return merged.select("package", F.coalesce(countries, F.array().cast("array<string>")).alias("countries"),
                         *[F.coalesce(f"new_{h}", h).alias(h) for h in ("graph", "basemap", "index")])


def vintage_skew(index: DataFrame) -> DataFrame:
    """Whether both halves are there, and the days between their data."""
    whole = F.col("graph").isNotNull() & F.col("basemap").isNotNull()
    days = F.abs(F.datediff(F.col("graph.dataDate").try_cast("date"), F.col("basemap.dataDate").try_cast("date")))
    return index.withColumn("complete", whole).withColumn("skew_days", F.when(whole, days))


def country_names(published: DataFrame, planned: DataFrame, used: DataFrame) -> DataFrame:
    """Name of each country: this run's plan, else the published one, else the bare code."""
    p = planned.groupBy("code").agg(F.max("name").alias("planned"))
    codes = used.select("code").unionByName(published.select("code")).unionByName(p.select("code")).distinct()
    joined = codes.join(published.select("code", F.col("name").alias("old")), "code", "left").join(p, "code", "left")
    return joined.select("code", F.coalesce("planned", "old", "code").alias("name"))


def distinct_build_id(metas: DataFrame) -> DataFrame:
    """More than one build id is a mixture: builds, refused."""
    return metas.agg(F.count_distinct("build_id").alias("builds")).withColumn("refused", F.col("builds") != 1)


# ---- ids, retention, rollback ----------------------------------------------------------------


def stable_id_assignment(existing: DataFrame, keys: DataFrame) -> DataFrame:
    """Existing keys keep their ids, new ones follow the highest in sorted order: key, id, exhausted."""
    fresh = keys.select("key").distinct().join(existing.select("key"), "key", "left_anti")
    numbered = dense_ids(fresh, [F.col("key")], "n")
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).withColumn("_k", F.lit(1))
    given = numbered.withColumn("_k", F.lit(1)).join(F.broadcast(top), "_k").select("key", (F.col("top") + F.col("n")).cast("bigint").alias("id"))
    out = existing.select("key", F.col("id").cast("bigint").alias("id")).unionByName(given)
    return out.withColumn("exhausted", F.col("id") > MAX_REGION_ID)


def dated_assets(assets: DataFrame) -> DataFrame:
    """Release files named after a package and a date: name, package, date, half."""
    return assets.select("name", text.asset_parts(F.col("name")).alias("p")).filter("p.package is not null").select("name", "p.*")


def retention(assets: DataFrame, live: DataFrame, keep: int) -> DataFrame:
    """Verdict per dated file: kept (among the newest), live, missing half, or delete."""
    dated = dated_assets(assets)
    builds = dated.groupBy("package", "date").agg(F.count(F.lit(1)).alias("halves"))
    rank = F.row_number().over(Window.partitionBy("package").orderBy(F.desc("date")))
    newest = builds.withColumn("rank", rank).filter(F.col("rank") <= keep)      # a rank limit: no package is sorted whole
    oldest_kept = newest.groupBy("package").agg(F.min("date").alias("oldest_kept"))
    used = live.select("name", F.lit(True).alias("used"))
    joined = dated.join(builds, ["package", "date"]).join(oldest_kept, "package").join(used, "name", "left")
    verdict = (F.when(F.col("date") >= F.col("oldest_kept"), "kept").when(F.col("used").isNotNull(), "live")
               .when(F.col("halves") < 2, "missing half").otherwise("delete"))
    return joined.select("name", "package", "date", verdict.alias("verdict"))


def rollback_candidates(assets: DataFrame) -> DataFrame:
    """Dated builds per package with the halves still there: package, date, halves, complete, bytes."""
    dated = dated_assets(assets).join(assets.select("name", "bytes"), "name")
    return dated.groupBy("package", "date").agg(F.array_join(F.array_sort(F.collect_set("half")), "+").alias("halves"), F.sum("bytes").alias("bytes")).withColumn(
        "complete", F.col("halves") == "pmtiles+tar")


# ---- structure of connector ways --------------------------------------------------------------

# fixed values
LEGAL_ACCESS = ("private", "destination", "customers", "delivery", "permit", "residents")
MAIN_CLASSES = ("motorway", "trunk", "primary")


def edge_sets(edges: DataFrame) -> DataFrame:
    """Edges of a way summed up: dest_only, levels, uses and classes as sets (each a handful of values)."""
    s = lambda c: F.array_sort(F.collect_set(c))
    return edges.groupBy("way").agg(s("dest_only").alias("dest"), s("level").alias("levels"), s("use").alias("uses"), s("class").alias("classes"))


def baseline_vs_new(ways: DataFrame, baseline: DataFrame, new: DataFrame) -> DataFrame:
    """Each connector way found in both graphs with what happened to its destination-only flag.

    ``ways(way, tags)``; edges ``(way, dest_only, level, use, class)``. Outcome: inferred service, lifted,
    lifted outside, other loss, gained, kept legal, unchanged.
    """
    tags = F.col("tags")
    o, n = edge_sets(baseline), edge_sets(new)
    j = (ways.join(o.select("way", F.col("dest").alias("o_dest"), F.col("levels").alias("o_levels")), "way")
         .join(n.withColumnsRenamed({"dest": "n_dest", "levels": "n_levels", "uses": "n_uses", "classes": "n_classes"}), "way"))
    only = lambda c, v: F.col(c) == F.array(F.lit(v))
    legal = F.coalesce(F.exists(F.array(*[tags[k] for k in osm.ACCESS_KEYS]), lambda v: v.isin(*LEGAL_ACCESS)), F.lit(False))
    lost = F.array_contains("o_dest", True) & only("n_dest", False)
    moved = (F.col("n_levels") == F.array(F.lit(0))) & ~F.arrays_overlap("n_classes", F.array(*[F.lit(c) for c in MAIN_CLASSES]))
    inferred = F.coalesce(tags["service"].isin(*osm.INFERRED_SERVICE), F.lit(False)) | F.coalesce(tags[osm.PARKED_SERVICE_KEY].isin(*osm.INFERRED_SERVICE), F.lit(False))
    gained = only("o_dest", False) & F.array_contains("n_dest", True)
    outcome = (F.when(lost & legal & moved, "lifted").when(lost & legal, "lifted outside").when(lost & inferred, "inferred service")
               .when(lost, "other loss").when(gained, "gained").when(legal & F.array_contains("o_dest", True), "kept legal").otherwise("unchanged"))
    return j.select("way", outcome.alias("outcome"), "n_dest", "n_levels", "n_uses")

