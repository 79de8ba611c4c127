"""Fingerprints and differences between versions, scans and artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ids import fingerprint_lines
from . import spatial as X
from .rules import union_all

# Hard cap of one device scan window, and layers a map may not carry.
SCAN_WINDOW_CAP = 512
FORBIDDEN_LAYERS = ["building", "poi", "poi_detail"]
# Classes of ways that a map layer must hold.
SUPPORTED_ROADS = [
    "motorway", "trunk", "primary", "secondary", "motorway_link", "trunk_link", "primary_link", "secondary_link",
    "tertiary", "tertiary_link", "unclassified", "residential", "road", "living_street", "service", "track",
]


def tile_fingerprints(tiles: DataFrame) -> DataFrame:
    """Per graph: fingerprint of all tiles, of inner tiles and of each boundary.

    tiles: region_id, path, sha256, boundaries array.  A fingerprint is a digest
    over the sorted ``path:sha`` lines.  A graph has one tile per grid position
    of its three levels, about a million at most, so one group stays bounded.
    """
    line = F.concat_ws(":", "path", "sha256")
    lines = tiles.select("region_id", line.alias("line"), F.coalesce("boundaries", F.array().cast("array<string>")).alias("b"))

    def fold(df: DataFrame, kind: str) -> DataFrame:
        return df.groupBy("region_id", "source_id").agg(
            fingerprint_lines(F.collect_list("line")).alias("fingerprint"), F.count("line").alias("tile_count")
        ).withColumn("kind", F.lit(kind))

    none = F.lit(None).cast("string")
    whole = fold(lines.withColumn("source_id", none), "graph")
    inner = fold(lines.select("region_id", F.when(F.size("b") == 0, F.col("line")).alias("line"), none.alias("source_id")), "internal")
    edges = fold(lines.select("region_id", "line", F.explode("b").alias("source_id")), "boundary")
    return union_all(whole, inner, edges).select("region_id", "kind", "source_id", "fingerprint", "tile_count")


def diff_tiles(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tiles added, removed or changed, with the boundaries they touch in either build."""
    empty = F.array().cast("array<string>")

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select("region_id", "path", F.col("sha256").alias(f"{p}_sha"), F.coalesce("boundaries", empty).alias(f"{p}_b"))

    both = side(a, "a").join(side(b, "b"), ["region_id", "path"], "full_outer")
    status = (
        F.when(F.col("a_sha").isNull(), "added").when(F.col("b_sha").isNull(), "removed").when(F.col("a_sha") != F.col("b_sha"), "changed")
    )
    touched = F.array_sort(F.array_union(F.coalesce("a_b", empty), F.coalesce("b_b", empty)))
    rows = both.select("region_id", "path", status.alias("status"), touched.alias("boundaries")).filter(F.col("status").isNotNull())
    return rows.withColumn("scope", F.when(F.size("boundaries") == 0, "internal").otherwise("boundary"))


def diff_tile_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("region_id", "status", "scope").agg(F.count(F.lit(1)).alias("tiles"))


def diff_boundaries(fp_a: DataFrame, fp_b: DataFrame, changes: DataFrame) -> DataFrame:
    """Per boundary: both fingerprints, whether it needs a refresh, changed tiles."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col("kind") == "boundary").select("region_id", "source_id", F.col("fingerprint").alias(name))

    n = changes.select("region_id", F.explode("boundaries").alias("source_id")).groupBy("region_id", "source_id").agg(
        F.count(F.lit(1)).alias("changed_tiles")
    )
    both = side(fp_a, "old_fp").join(side(fp_b, "new_fp"), ["region_id", "source_id"], "full_outer")
    return both.join(n, ["region_id", "source_id"], "left").select(
        "region_id", "source_id", (~F.col("old_fp").eqNullSafe(F.col("new_fp"))).alias("requires_refresh"), F.coalesce("changed_tiles", F.lit(0)).alias("changed_tiles")
    )


def _micro(v: Column) -> Column:
    return F.floor(v * 1000000 + 0.5).cast("long").cast("string")


def line_signature(shape: Column) -> Column:
    """Six-decimal geometry text that does not depend on the drawing direction."""

    def text(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda p: F.concat_ws(",", _micro(p["lon"]), _micro(p["lat"]))), ";")

    return F.least(text(shape), text(F.reverse(shape)))


def way_signatures(features: DataFrame, attributes: list[str]) -> DataFrame:
    """Distinct attribute and geometry signatures of each way, one row per signature."""
    attr = F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"})
    pair = F.array(
        F.struct(F.lit("attributes").alias("part"), attr.alias("signature")),
        F.struct(F.lit("geometry").alias("part"), line_signature(F.col("shape")).alias("signature")),
    )
    return features.select("way_id", F.explode(pair).alias("s")).select("way_id", "s.part", "s.signature").distinct()


def layer_signatures(features: DataFrame, attributes: list[str]) -> DataFrame:
    """One combined signature per map-layer feature: filled properties and geometry as drawn."""
    filled = F.to_json(F.struct(*[F.when(F.col(a).cast("string") != "", F.col(a)).alias(a) for a in attributes]))
    shape = F.array_join(F.transform("shape", lambda p: F.concat_ws(",", p["lon"].cast("string"), p["lat"].cast("string"))), ";")
    return features.select("way_id", F.lit("feature").alias("part"), F.concat_ws("|", filled, shape).alias("signature")).distinct()


def _diff_signatures(a: DataFrame, b: DataFrame) -> DataFrame:
    """Compare signature sets row by row; no set is ever gathered."""
    key = ["way_id", "part", "signature"]
    both = a.withColumn("in_a", F.lit(True)).join(b.withColumn("in_b", F.lit(True)), key, "full_outer")
    per = both.groupBy("way_id").agg(
        F.count("in_a").alias("a"), F.count("in_b").alias("b"), F.count_if(F.col("in_a").isNull() | F.col("in_b").isNull()).alias("apart")
    )
    status = F.when(F.col("a") == 0, "added").when(F.col("b") == 0, "removed").when(F.col("apart") > 0, "changed").otherwise("unchanged")
    return per.select("way_id", status.alias("status"))


def diff_ways(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ways added / removed / changed / unchanged by their signature sets."""
    return _diff_signatures(a, b)


def diff_layer_roads(a: DataFrame, b: DataFrame) -> DataFrame:
    return _diff_signatures(a, b)


def edge_parity(native: DataFrame, correlated: DataFrame, candidates: DataFrame, proven: DataFrame, windows: DataFrame) -> DataFrame:
    """Differences between a native scan and what later stages hold, as reason rows.

    native, correlated: side, graph_id.  candidates: from_id, to_id (NULL when
    unknown).  proven: from_id, to_id, mode, direction.  windows: side,
    window_index, requested, returned, complete, truncated.
    """
    ids = F.array(F.struct(F.lit("from").alias("side"), F.col("from_id").alias("graph_id")), F.struct(F.lit("to").alias("side"), F.col("to_id").alias("graph_id")))
    exact = candidates.filter(F.col("from_id").isNotNull() & F.col("to_id").isNotNull())
    held = exact.select(F.explode(ids).alias("e")).select("e.*")
    nat = native.select("side", "graph_id").distinct()

    def rows(df: DataFrame, subject: Column, reason: str) -> DataFrame:
        return df.select(subject.cast("string").alias("subject"), F.lit(reason).alias("reason"))

    key = F.concat_ws(":", "side", "graph_id")
    pair = F.concat_ws(">", "from_id", "to_id")
    unknown = candidates.filter(F.col("from_id").isNull() | F.col("to_id").isNull())

    def absent(side: str, col: str) -> DataFrame:
        known = nat.filter(F.col("side") == side).select(F.col("graph_id").alias(col))
        return proven.join(known, col, "left_anti")

    bad = F.col("requested").isNull() | (F.col("requested") <= 0)
    limit = F.least("requested", F.lit(SCAN_WINDOW_CAP))
    wrong = F.col("returned").isNull() | (F.col("returned") < 0) | (F.col("returned") > limit)
    unproven = ~F.coalesce("complete", F.lit(False)) | F.coalesce("truncated", F.lit(True)) | (F.col("returned") >= limit)
    window_reason = (
        F.when(bad, "WINDOW_WITHOUT_LIMIT").when(wrong, "WINDOW_RETURNED_INVALID").when(unproven, "WINDOW_NOT_PROVEN_COMPLETE")
    )
    return union_all(
        rows(nat.join(correlated.select("side", "graph_id").distinct(), ["side", "graph_id"], "left_anti"), key, "MISSING_FROM_CORRELATIONS"),
        rows(nat.join(held.distinct(), ["side", "graph_id"], "left_anti"), key, "MISSING_FROM_CANDIDATES"),
        rows(unknown, F.col("candidate_id"), "CANDIDATE_WITHOUT_IDS"),
        rows(absent("from", "from_id"), pair, "PROVEN_NOT_IN_SCAN"),
        rows(absent("to", "to_id"), pair, "PROVEN_NOT_IN_SCAN"),
        rows(proven.join(exact.select("from_id", "to_id").distinct(), ["from_id", "to_id"], "left_anti"), pair, "PROVEN_NOT_A_CANDIDATE"),
        windows.select(F.concat_ws(":", "side", "window_index").alias("subject"), window_reason.alias("reason")).filter(F.col("reason").isNotNull()),
    ).distinct()


def window_parity(native: DataFrame, windows: DataFrame, raw: DataFrame, grouped: DataFrame, size: float = 0.002) -> DataFrame:
    """Per window: missing, unknown and grouped-away ids and saturation.

    windows: window_index, bounds, requested.  raw / grouped: window_index, graph_id.
    """
    box = windows.select("window_index", "min_lat", "max_lat", "min_lon", "max_lon")
    want = X.window_edges(native.select("graph_id", "lat", "lon"), box, size).select("window_index", "graph_id").withColumn("n", F.lit(True))
    got = raw.select("window_index", "graph_id").withColumn("r", F.lit(True))
    kept = grouped.select("window_index", "graph_id").withColumn("g", F.lit(True))
    key = ["window_index", "graph_id"]
    per = (
        want.join(got, key, "full_outer")
        .join(kept, key, "left")
        .groupBy("window_index")
        .agg(
            F.count("n").alias("native_edges"),
            F.count("r").alias("returned"),
            F.count_if(F.col("r").isNull()).alias("missing"),
            F.count_if(F.col("n").isNull()).alias("unknown"),
            F.count_if(F.col("r").isNotNull() & F.col("g").isNull()).alias("grouped_away"),
        )
    )
    names = ["native_edges", "returned", "missing", "unknown", "grouped_away"]
    out = windows.select("window_index", "requested").join(per, "window_index", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in names})
    saturated = F.col("returned") >= F.least("requested", F.lit(SCAN_WINDOW_CAP))
    clean = (F.col("missing") == 0) & (F.col("unknown") == 0) & (F.col("grouped_away") == 0)
    return out.select("window_index", *names, saturated.alias("saturated"), (clean & ~saturated).alias("lossless"))


def near_outline(shapes: DataFrame, outline: DataFrame, metres: float, key: str, size: float = 0.01) -> DataFrame:
    """Keys of shapes within ``metres`` of an outline (the border corridor)."""
    c = F.col
    d = X.metres_to_degrees(metres)
    seg = X.shape_segments(shapes, key)
    wide = F.lit(d) / F.cos(F.radians(F.abs("ay")))
    s = X.line_cells(seg, size, (c("ax"), c("ay")), (c("ex"), c("ey")), d, F.greatest(wide, F.lit(d) / F.cos(F.radians(F.abs("ey")))))
    o = X.line_cells(outline.select("ax", "ay", "ex", "ey"), size, (c("ax"), c("ay")), (c("ex"), c("ey")))
    o = o.withColumnsRenamed({"ax": "ox", "ay": "oy", "ex": "qx", "ey": "qy"})
    ends = ((c("ax"), c("ay")), (c("ex"), c("ey")), (c("ox"), c("oy")), (c("qx"), c("qy")))
    # A little wider than the corridor, because a degree of longitude shrinks with latitude.
    apart = X.boxes_apart(*ends, dx=F.lit(d * 1.1) / F.cos(F.radians(F.greatest(F.abs("ay"), F.abs("ey")))), dy=F.lit(d * 1.1))
    return s.join(o, ["cy", "cx"]).filter(~apart & (X.segment_distance(*ends) <= metres)).select(key).distinct()


def required_roads(features: DataFrame, major: list[str], border: DataFrame, supported: list[str] = SUPPORTED_ROADS) -> DataFrame:
    """Required ways with their categories: MAJOR by class, BORDER by corridor.

    features: way_id, highway.  border: way_id of the ways near the outline.
    Features of a class that is not ``supported`` (footpaths and the like) and
    features without a way are no roads: the map layer need not hold them,
    wherever they lie.
    """
    near = border.select("way_id").distinct().withColumn("near", F.lit(True))
    roads = features.filter(F.col("highway").isin(supported) & F.col("way_id").isNotNull())
    per = roads.groupBy("way_id").agg(F.bool_or(F.col("highway").isin(major)).alias("major"), F.min("highway").alias("highway"))
    rows = per.join(near, "way_id", "left")
    cats = F.array_compact(F.array(F.when(F.col("near"), F.lit("BORDER")), F.when(F.col("major"), F.lit("MAJOR"))))
    return rows.select("way_id", "highway", cats.alias("categories")).filter(F.size("categories") > 0)


def layer_coverage(required: DataFrame, layer_ids: DataFrame) -> DataFrame:
    """Each required way with whether the map layer holds it."""
    seen = layer_ids.select("way_id").distinct().withColumn("present", F.lit(True))
    return required.join(seen, "way_id", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def layer_coverage_counts(coverage: DataFrame) -> DataFrame:
    sums = coverage.agg(
        F.count(F.lit(1)).alias("source"),
        F.count_if(F.array_contains("categories", "MAJOR")).alias("major"),
        F.count_if(F.array_contains("categories", "BORDER")).alias("border"),
        F.count_if("present").alias("observed"),
        F.count_if(~F.col("present")).alias("missing"),
    )
    return sums.unpivot([], sums.columns, "counter", "n")


def layer_observations(tile_features: DataFrame, required: list[str], forbidden: list[str] = FORBIDDEN_LAYERS) -> DataFrame:
    """Per pack: layers seen, required layers missing, forbidden layers present, extent.

    tile_features: pack_id, zoom, tile_key, layer, min_lat, max_lat, min_lon, max_lon.
    The set of layer names of a map is a short fixed list.
    """
    per = tile_features.groupBy("pack_id").agg(
        F.array_sort(F.collect_set("layer")).alias("layers"),
        F.count_distinct("tile_key").alias("tiles"),
        F.min("zoom").alias("min_zoom"),
        F.max("zoom").alias("max_zoom"),
        F.min("min_lat").alias("min_lat"),
        F.max("max_lat").alias("max_lat"),
        F.min("min_lon").alias("min_lon"),
        F.max("max_lon").alias("max_lon"),
    )
    lits = lambda names: F.array(*[F.lit(n) for n in names])
    return per.withColumns(
        {
            "missing_layers": F.array_sort(F.array_except(lits(required), F.col("layers"))),
            "forbidden_layers": F.array_sort(F.array_intersect(F.col("layers"), lits(forbidden))),
        }
    )


HANDOFF_COLUMNS = ["kind", "id", "from_region_id", "to_region_id", "from_lat", "from_lon", "to_lat", "to_lon", "modes", "evidence"]


def artifact_currency(artifacts: DataFrame, current: DataFrame) -> DataFrame:
    """Add CURRENT or STALE from both sides' graph and boundary fingerprints.

    artifacts: from_/to_ region_id, graph_fp, boundary_fp (NULL when not bound),
    source_id (NULL when unknown).  current: region_id, graph_fp, boundaries map.
    """

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        now = current.select(
            F.col("region_id").alias(f"{own}_region_id"), F.col("graph_fp").alias(f"{own}_now"), F.col("boundaries").alias(f"{own}_b")
        )
        df = df.join(now, f"{own}_region_id", "left")
        bound = F.col(f"{own}_boundary_fp")
        live = F.try_element_at(F.col(f"{own}_b"), F.col(f"{other}_source_id"))
        graph = F.col(f"{own}_graph_fp").eqNullSafe(F.col(f"{own}_now"))
        edge = F.when(bound.isNull(), F.lit(True)).when(F.col(f"{other}_source_id").isNull(), F.lit(False)).otherwise(F.coalesce(live == bound, F.lit(False)))
        return df.withColumn(f"{own}_ok", graph & edge).drop(f"{own}_now", f"{own}_b")

    both = side(side(artifacts, "from", "to"), "to", "from")
    return both.withColumn("status", F.when(F.col("from_ok") & F.col("to_ok"), "CURRENT").otherwise("STALE")).drop("from_ok", "to_ok")


def _common(df: DataFrame, kind: Column, modes: Column, evidence: Column) -> DataFrame:
    point = F.col("from_lat").isNotNull() & F.col("from_lon").isNotNull() & F.col("to_lat").isNotNull() & F.col("to_lon").isNotNull()
    out = df.filter(point).withColumns({"kind": kind, "modes": modes, "evidence": evidence})
    return out.select(*HANDOFF_COLUMNS, "status")


def handoff_items(candidates: DataFrame, runtime: DataFrame, proposals: DataFrame, bound: DataFrame, learned: DataFrame, manual: DataFrame) -> DataFrame:
    """Six artifact kinds in one row shape; each input already carries ``status``.

    Shared columns: id, region ids and both points.  ``candidates``: tier and two
    match flags.  ``runtime``: tier and four support flags.  ``proposals`` and
    ``learned``: modes and evidence arrays.  ``bound``: one mode.
    """
    lit = F.lit
    tier = F.when(F.col("tier").isNotNull(), F.concat(lit("EVIDENCE_TIER_"), F.col("tier").cast("string")))
    found = F.array_compact(
        F.array(
            lit("GENERATED_CANDIDATE"), tier, F.when(F.col("both_match_way"), lit("BOTH_MATCH_STABLE_OSM_WAY")), F.when(F.col("same_way"), lit("SAME_CORRELATED_OSM_WAY"))
        )
    )
    support = F.array_compact(
        F.array(*[F.when(F.col(f"{m}_{d}"), lit(f"{m}_{d}".upper())) for m in ("motorcycle", "car") for d in ("from_to", "to_from")])
    )
    empty = F.array().cast("array<string>")
    return union_all(
        _common(candidates, lit("candidate"), empty, found),
        _common(runtime, lit("accepted"), support, F.array_compact(F.array(lit("VALHALLA_PROVEN_RUNTIME"), tier))),
        _common(proposals, lit("candidate"), F.coalesce("modes", empty), F.coalesce("evidence", empty)),
        _common(bound, lit("accepted"), F.array("mode"), F.array(lit("VALHALLA_PROVEN_BOUND_TRANSITION"))),
        _common(learned, lit("learned"), F.coalesce("modes", empty), F.coalesce("evidence", empty)),
        _common(manual, lit("manual"), F.array(lit("MOTORCYCLE"), lit("CAR")), F.array(lit("MANUAL_VALHALLA_PROOF"))),
    )


def handoff_counts(items: DataFrame) -> DataFrame:
    key = F.concat_ws(".", F.coalesce("kind", F.lit("unknown")), F.coalesce("status", F.lit("unknown")))
    return items.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
