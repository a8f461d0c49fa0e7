"""Verdicts over recorded route answers and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.functions import geo
from atlas.operators import routes
from atlas.sources.logs import REPORT_LINES

ONEWAY_RATIO = 1.4
SEPARATION_RATIO = 5.0
SANE_DETOUR_M = 8000
GAP_KM = 5.0
PAIRS_PER_WAY = 12
RING_METRES = (1500.0, 4000.0)

# fixed values: names that betray a detour over the Channel Islands
CHANNEL_NAMES = ("Guernsey", "Jersey", "Peter Port", "Saint Malo", "Saint-Malo", "GBG", "GBJ")


def continuity(answers: DataFrame, key: list[str]) -> DataFrame:
    """Largest step in the shape of each answer and whether it can be a road: key…, gap_km, broken.

    An answer without a shape has a NULL gap, which is not a pass.
    """
    gaps = routes.largest_gap(routes.shape_points(answers.filter("shape <> ''"), key), key)
    return answers.select(*key).join(gaps, key, "left").select(*key, "gap_km", (F.col("gap_km") > GAP_KM).alias("broken"))


def struct_verdict(compared: DataFrame, controls: DataFrame) -> DataFrame:
    """Counts of every outcome and PASS / FAIL: no loss outside the allowed kinds, no gain, control ways in
    their state. ``controls(way, want_dest, want_levels, banned_use)``, NULL: not asked."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    counts = compared.agg(n("lifted").alias("lifted"), n("lifted outside").alias("lifted_outside"), n("inferred service").alias("inferred"),
                          n("other loss").alias("other"), n("gained").alias("gained"), n("kept legal").alias("kept"))
    j = controls.join(compared, "way", "left")
    right = (F.col("n_dest").isNotNull() & (F.col("want_dest").isNull() | F.col("n_dest").eqNullSafe(F.array("want_dest")))
             & (F.col("want_levels").isNull() | F.col("n_levels").eqNullSafe(F.array("want_levels")))
             & (F.col("banned_use").isNull() | ~F.coalesce(F.array_contains("n_uses", F.col("banned_use")), F.lit(False))))
    wrong = j.agg(F.count_if(~right).alias("wrong_controls"))
    row = counts.withColumn("_k", F.lit(1)).join(wrong.withColumn("_k", F.lit(1)), "_k").drop("_k")
    clean = F.col("lifted_outside") + F.col("other") + F.col("gained") + F.col("wrong_controls") == 0
    return row.withColumn("verdict", F.when(clean, "PASS").otherwise("FAIL"))


def transit_plan(ways: DataFrame) -> DataFrame:
    """Twelve fixed pairs of points on two rings around each lifted way: way, n, from, to.

    ``ways(way, lat, lon)``. The pairs are the lowest of all ordered pairs of the sixteen ring points by the
    digest of (way, from, to), so they are the same in every run and in any engine.
    """
    spots = [(m, b) for m in RING_METRES for b in range(0, 360, 45)]
    ring = F.array(*[geo.destination(F.col("lat"), F.col("lon"), F.lit(m), F.lit(float(b))) for m, b in spots])
    choice = [F.struct(F.md5(F.concat_ws(":", F.col("way").cast("string"), F.lit(i), F.lit(j))).alias("h"), F.lit(i).alias("i"), F.lit(j).alias("j"))
              for i in range(len(spots)) for j in range(len(spots)) if i != j]
    picked = F.slice(F.array_sort(F.array(*choice)), 1, PAIRS_PER_WAY)
    # a small table may be one file, and each of its rows is hundreds of digests
    spread = ways.repartition(4 * ways.sparkSession.sparkContext.defaultParallelism)
    rows = spread.withColumn("ring", ring).select("way", "ring", F.posexplode(picked).alias("n", "p"))
    return rows.select("way", "n", F.col("p.i").alias("i"), F.col("p.j").alias("j"),
                       F.get("ring", F.col("p.i")).alias("from"), F.get("ring", F.col("p.j")).alias("to"))


def interior(ways: Column) -> Column:
    """Ways of a route without its first and last."""
    return F.slice(ways, 2, F.greatest(F.size(ways) - 2, F.lit(0)))


def new_transit_ways(answers: DataFrame, lifted: DataFrame) -> DataFrame:
    """Lifted ways newly driven through by each land answer: way, n, transit (sorted).

    ``answers(way, n, ferry, ways, old_ways)``. The crossing with the lifted set is a join, so that set may be
    of any size.
    """
    land = answers.filter(~F.coalesce("ferry", F.lit(True)) & F.col("ways").isNotNull())
    fresh = land.select("way", "n", F.explode(F.array_except(interior(F.col("ways")), F.coalesce(interior(F.col("old_ways")), F.array().cast("array<bigint>")))).alias("driven"))
    hit = fresh.join(lifted.select(F.col("way").alias("driven")), "driven", "left_semi")
    return hit.groupBy("way", "n").agg(F.array_sort(F.collect_set("driven")).alias("transit"))


def transit_verdict(plan_ways: DataFrame, answers: DataFrame, lifted: DataFrame) -> DataFrame:
    """Pairs asked, land-only answers, new transits and ways without a position; PASS only with none of the
    last two. ``plan_ways(way, lat, lon)``."""
    bad = new_transit_ways(answers, lifted).agg(F.count(F.lit(1)).alias("new_transits"))
    base = answers.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(~F.coalesce("ferry", F.lit(True)) & F.col("ways").isNotNull()).alias("land_only"))
    lost = plan_ways.agg(F.count_if(F.col("lat").isNull()).alias("unplaced"))
    k = F.lit(1)
    row = base.withColumn("_k", k).join(bad.withColumn("_k", k), "_k").join(lost.withColumn("_k", k), "_k").drop("_k")
    return row.withColumn("verdict", F.when(F.col("new_transits") + F.col("unplaced") == 0, "PASS").otherwise("FAIL"))


def route_reasons() -> Column:
    """Why a recorded answer is not acceptable (array, empty when it is)."""
    names = F.array_join("ferries", " | ")
    straight = geo.haversine(F.col("from_lat"), F.col("from_lon"), F.col("to_lat"), F.col("to_lon"), geo.EARTH_KM)
    routed = F.col("km").isNotNull()
    none_expected = F.col("expected").isNull()
    named = F.exists("expected", lambda e: F.contains(names, e))
    channel = F.exists(F.array(*[F.lit(n) for n in CHANNEL_NAMES]), lambda n: F.contains(names, n))
    return F.array_compact(F.array(
        F.when(~routed, F.lit("no route")),
        F.when(routed & none_expected & (F.size("ferries") > 0), F.lit("ferry where a land route is expected")),
        F.when(routed & ~none_expected & ~named, F.lit("wrong ferry")),
        F.when(routed & F.col("channel") & channel, F.lit("Channel Islands")),
        F.when(routed & (straight > 30) & (F.col("km") > straight * 2.5), F.lit("detour"))))


def routes_verdict(answers: DataFrame) -> DataFrame:
    """PASS / ACCEPTED / KNOWN / FAIL per direction.

    ``answers(from, to, km, ferries, expected, channel, accepted, prod_km, prod_ferries, from_lat, …)``.
    """
    same = (F.abs(F.col("km") - F.col("prod_km")) < 0.05) & (F.col("ferries") == F.col("prod_ferries"))
    judged = answers.withColumn("why", route_reasons())
    verdict = (F.when(F.size("why") == 0, "PASS").when(F.col("accepted"), "ACCEPTED").when(F.coalesce(same, F.lit(False)), "KNOWN").otherwise("FAIL"))
    return judged.withColumn("verdict", verdict)


def verdict_counts(verdicts: DataFrame, labels: tuple[str, ...] = ("PASS", "KNOWN", "ACCEPTED", "FAIL")) -> DataFrame:
    return verdicts.agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in labels])


def combined_gate_verdict(reports: DataFrame) -> DataFrame:
    """Verdict of a release from its three mined reports.

    ``reports(release, kind, counts, missing, verdict_lines, said, exit_code)``. Every summary line, exactly one
    PASS line, exit code 0; and the transit gate must have asked twelve pairs per lifted way.
    """
    sound = (F.col("missing") == 0) & (F.col("verdict_lines") == 1) & F.col("said").eqNullSafe("PASS") & (F.col("exit_code") == 0)
    r = reports.withColumn("ok", sound)
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, c))
    lifted = F.col("counts")["lost_in_ferry_reclassification"] + F.coalesce(F.col("counts")["lost_outside_reclassification"], F.lit(0))
    row = r.groupBy("release").agg(F.count_if("ok").alias("sound"), of("struct", lifted).alias("lifted"), of("transit", F.col("counts")["pairs"]).alias("pairs"))
    covered = F.col("lifted").isNotNull() & F.coalesce(F.col("pairs") == F.col("lifted") * PAIRS_PER_WAY, F.lit(True))
    return row.withColumn("verdict", F.when((F.col("sound") == len(REPORT_LINES)) & covered, "PASS").otherwise("FAIL"))


def probe_verdict(probes: DataFrame) -> DataFrame:
    """Reason a probe fails, NULL when it holds.

    ``probes(probe, kind, with_m, against_m, gap_m, driven_m, routed, expect, got, km, min_km, max_km, gap_km,
    through, seen)``; kinds: oneway, grade_separation, timezone, admin, border, corridor.
    """
    c = F.col
    oneway = (F.when(c("with_m").isNull() | c("against_m").isNull(), "no route in one or both directions")
              .when(c("against_m") < c("with_m") * ONEWAY_RATIO, "the directions agree"))
    grade = (F.when(c("driven_m").isNull(), "no route").when(c("driven_m") < c("gap_m") * SEPARATION_RATIO, "the bridge has become a junction")
             .when(c("driven_m") > SANE_DETOUR_M, "far beyond any detour"))
    point = (F.when(~c("routed"), "the probe points do not route").when(F.size("got") == 0, "nothing reported")
             .when(~F.array_contains("got", c("expect")), "another answer"))
    line = (F.when(c("km").isNull(), "no route").when(~c("km").between(c("min_km"), c("max_km")), "length out of range")
            .when(c("gap_km").isNull(), "no geometry").when(c("gap_km") > GAP_KM, "the geometry jumps"))
    wanted = F.size("through") > 0
    ground = (F.when(wanted & (F.size("seen") == 0), "countries unchecked").when(wanted & (F.size(F.array_except("through", "seen")) > 0), "never entered a country"))
    reason = (F.when(c("kind") == "oneway", oneway).when(c("kind") == "grade_separation", grade).when(c("kind").isin("timezone", "admin"), point)
              .when(c("kind") == "border", line).when(c("kind") == "corridor", F.coalesce(line, ground)).otherwise("unknown probe kind"))
    return probes.withColumn("reason", reason)


def regression_verdict(probes: DataFrame, answers: DataFrame, have: DataFrame) -> DataFrame:
    """Recorded answers against expectations: probe, verdict (ok, skipped, FAIL), reason.

    ``probes(probe, needs, km_about, km_tol, seams)``; ``answers(probe, km, seams, lost)``; ``have(country)``. If
    nothing ran at all that is a failure of its own (see ``regression_summary``).
    """
    need = probes.select("probe", F.explode("needs").alias("country"))
    lacking = need.join(have, "country", "left_anti").select("probe").distinct().withColumn("skip", F.lit(True))
    j = probes.join(lacking, "probe", "left").join(answers.select("probe", "km", F.col("seams").alias("got_seams"), "lost"), "probe", "left")
    why = F.concat_ws("; ", F.when(F.col("km").isNull(), "no route"), F.when(F.abs(F.col("km") - F.col("km_about")) > F.col("km_tol"), "length out of tolerance"),
                      F.when(F.col("km").isNotNull() & (F.col("got_seams") != F.col("seams")), "seam count"), F.when(F.col("lost") > 0, "lost region"))
    verdict = F.when(F.col("skip").isNotNull(), "skipped").when(why == "", "ok").otherwise("FAIL")
    return j.select("probe", verdict.alias("verdict"), F.when(F.col("skip").isNull(), why).alias("reason"))


def regression_summary(verdicts: DataFrame) -> DataFrame:
    row = verdicts.agg(F.count_if(F.col("verdict") != "skipped").alias("ran"), F.count_if(F.col("verdict") == "FAIL").alias("failed"))
    return row.withColumn("verdict", F.when((F.col("ran") > 0) & (F.col("failed") == 0), "PASS").otherwise("FAIL"))


def seam_verdict(answers: DataFrame) -> DataFrame:
    """What a route over the seam of two builds shows. ``answers(seam, km, seconds, expect_km, gap_km,
    control_a_km, control_a_known, control_b_km, control_b_known)``; a control off by 5 % makes it inconclusive."""
    c = F.col
    kmh = F.try_divide(c("km"), c("seconds") / 3600.0)
    seen = (F.when(c("km").isNull(), "BROKEN").when(c("gap_km") > GAP_KM, "CORRUPT").when(kmh > 130, "CORRUPT")
            .when(c("km") < c("expect_km") * 0.9, "SUSPECT").when(c("km") > c("expect_km") * 1.15, "DETOURS").otherwise("HOLDS"))
    steady = lambda x: F.coalesce(F.abs(c(f"control_{x}_km") - c(f"control_{x}_known")) / c(f"control_{x}_known") * 100 < 5, F.lit(False))
    sound = steady("a") & steady("b")
    return answers.select("seam", F.when(sound, seen).otherwise("INCONCLUSIVE").alias("verdict"), seen.alias("seen"), sound.alias("controls_ok"))


def zone_diagnosis(points: DataFrame, reported: DataFrame) -> DataFrame:
    """Zone in the graph, zone of the route and the expected one per point and label: agree, wrong.

    ``points(name, expect)``; ``reported(label, name, source, zone)`` with source graph or route. Only a graph
    that holds another zone is wrong; a silent source is not.
    """
    wide = reported.groupBy("label", "name").pivot("source", ["graph", "route"]).agg(F.max("zone"))
    j = wide.join(points, "name")
    return j.select("label", "name", "graph", "route", "expect", F.col("graph").eqNullSafe(F.col("route")).alias("agree"),
                    (F.col("graph").isNotNull() & (F.col("graph") != F.col("expect"))).alias("wrong"))


def baseline_coverage(questions: DataFrame, recorded: DataFrame) -> DataFrame:
    """Questions without a recorded answer for exactly that question: section, key, at (text of coordinates)."""
    return questions.join(recorded.select("section", "key", "at"), ["section", "key", "at"], "left_anti")


def cut_verdict(members: DataFrame, cuts: DataFrame, probes: DataFrame) -> DataFrame:
    """Per plan: each country's own probes on its own cut (borders left out) and the joint ones; a country
    without a cut fails. ``members(plan, country)``, ``cuts(country)``, ``probes(plan, country, reason, kind)``
    with NULL country for the joint pass."""
    uncut = members.join(cuts, "country", "left_anti").groupBy("plan").agg(F.count(F.lit(1)).alias("uncut"))
    judged = probes.filter(F.col("country").isNull() | (F.col("kind") != "border"))
    own = judged.join(cuts.select("country", F.lit(True).alias("cut")), "country", "left").filter(F.col("country").isNull() | F.col("cut").isNotNull())
    failed = own.groupBy("plan").agg(F.count_if(F.col("reason").isNotNull()).alias("failed"))
    j = members.select("plan").distinct().join(uncut, "plan", "left").join(failed, "plan", "left").na.fill(0, ["uncut", "failed"])
    return j.withColumn("verdict", F.when(F.col("uncut") + F.col("failed") == 0, "PROMOTABLE").otherwise("BLOCKED"))


