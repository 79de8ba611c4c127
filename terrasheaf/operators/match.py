"""Matching the two graphs at exact points, and checks of recorded routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import lines as L
from ..functions.geo import AUTO_BIT, MODES, MOTORCYCLE_BIT, PLANAR_TOPOLOGY, haversine_m, mode_names
from . import spatial as X
from .graph import allowed_bits
from .rules import repeated, union_all, violations
from ..session import stage, stage_by


def cut_geometry(shapes: DataFrame, segments: DataFrame, key: str = "graph_id") -> DataFrame:
    """Per final edge: shape hash, vertex count, cut met or not, distance to the outline, metres outside."""
    text = F.array_join(F.transform("shape", lambda p: F.concat_ws(",", p["lat"].cast("string"), p["lon"].cast("string"))), ";")
    meets = X.cut_crossings(shapes, segments).select(key).distinct().withColumn("meets_cut", F.lit(True))
    near = X.nearest_outline(X.shape_segments(shapes, key), segments, key)
    out = shapes.select(key, F.concat(F.lit("sha256:"), F.sha2(text, 256)).alias("shape_hash"), F.size("shape").alias("vertices"))
    return (
        out.join(meets, key, "left")
        .join(near, key, "left")
        .join(X.metres_outside(shapes, segments, key), key, "left")
        .withColumn("meets_cut", F.coalesce("meets_cut", F.lit(False)))
    )


# Thresholds of the directed comparison, in metres.
NEAR_X, OVERLAP_MAX, EXACT_MAX = 4.0, 0.75, 0.10
MIN_PROGRESS, MIN_SHORT, SHORT_SLACK, END_REMAINING = 1.0, 0.5, 0.12, 1.0
ORDER_SLACK = 0.25
COLOCATED = 1.0
TWO_MODES = AUTO_BIT | MOTORCYCLE_BIT

MATCHED = "MATCHED_DIRECTED_SOURCE_GEOMETRY_OVERLAP"
ENDS_AT_X = "B_PREDECESSOR_ENDS_AT_X_NEEDS_NATIVE_SUCCESSOR"
SAME_NODE = "VERIFIED_B_ORIGINAL_SAME_NODE_LEGAL_BRANCH"
INTERIOR = "VERIFIED_B_DIRECTED_INTERIOR_SOURCE_OVERLAP"
INTERIOR_EVIDENCE = "INTERIOR_B_EDGE_OVERLAP_PHYSICAL_IDENTITY_UNVERIFIED"
ROOT_OPTIONS = "ROOT_HAS_NATIVE_RECEIVER_OPTIONS_SOURCE_LINEAGE_UNPROVEN"
ROOT_TERMINAL = "ROOT_TERMINAL_CANDIDATE_NO_CONFIRMED_RECEIVER"
ROOT_NONE = {1: "ROOT_NO_TERMINAL_CANDIDATE_WITHIN_ONE_NATIVE_HOP", 2: "ROOT_NO_TERMINAL_CANDIDATE_WITHIN_TWO_BOUNDED_HOPS"}
CONDITIONAL = "ORIGINAL_B_CONDITIONAL_HIERARCHY_OR_PATH_CONTEXT_UNRESOLVED"
NO_FORWARD = "NO_ORIGINAL_B_NATIVE_ALLOWED_FORWARD_CONTINUATION"


def receiver_topology(source_ends: DataFrame, near: DataFrame) -> DataFrame:
    """Each source dead end with the class of its nearby receiver ends.

    ``near`` comes from the proximity join; its rows are grouped by counts only.
    """
    same = F.col("source_way") == F.col("receiver_way")
    goes_on = same & ~F.col("receiver_deadend")
    per = near.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("nearby"),
        F.count_if(same).alias("same_way"),
        F.count_if(goes_on).alias("continuing"),
        F.coalesce(F.bool_or(goes_on & (F.col("distance_m") <= 0.25)), F.lit(False)).alias("submetre"),
    )
    rows = source_ends.filter("deadend").select(F.col("graph_id").alias("source_id")).join(per, "source_id", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("nearby", "same_way", "continuing")}).withColumn(
        "submetre", F.coalesce("submetre", F.lit(False))
    )
    status = (
        F.when(F.col("continuing") > 0, "PROVISIONAL_SAME_WAY_NON_DEADEND_RECEIVER")
        .when(F.col("same_way") > 0, "UNRESOLVED_RECEIVER_ALSO_DEADEND")
        .when(F.col("nearby") > 0, "UNRESOLVED_DIFFERENT_WAY_NEARBY")
        .otherwise("UNRESOLVED_NO_NEARBY_RECEIVER_INCOMING")
    )
    return rows.withColumn("status", status)


def topology_counts(topology: DataFrame) -> DataFrame:
    """The twelve counters of the topology audit as (counter, n) rows."""
    c = F.col
    sums = topology.agg(
        F.count(F.lit(1)).alias("dead_ends"),
        F.sum("nearby").alias("nearby_occurrences"),
        F.sum("same_way").alias("same_way_occurrences"),
        F.sum("continuing").alias("continuing_occurrences"),
        F.count_if(c("nearby") > 0).alias("with_nearby"),
        F.count_if(c("same_way") > 0).alias("with_same_way"),
        F.count_if(c("continuing") > 0).alias("with_continuation"),
        F.count_if(c("continuing") > 1).alias("ambiguous_continuations"),
        F.count_if((c("continuing") > 0) & c("submetre")).alias("submetre_colocated"),
        F.count_if((c("continuing") == 0) & (c("same_way") > 0)).alias("only_dead_end_receiver"),
        F.count_if((c("same_way") == 0) & (c("nearby") > 0)).alias("only_other_way"),
        F.count_if(c("nearby") == 0).alias("none_nearby"),
    )
    return sums.unpivot([], sums.columns, "counter", "n")


def terminal_evidence(edges: DataFrame, ends: DataFrame, probes: DataFrame) -> DataFrame:
    """Per edge: which endpoint or neighbour evidence is there and what it says."""
    e = edges.select("graph_id").join(ends.select("graph_id", "matched", "deadend"), "graph_id", "left")
    e = e.join(probes.select("graph_id", "found", "continues"), "graph_id", "left")
    resolved = F.coalesce("matched", F.lit(False))
    probe_wanted = resolved & F.coalesce("deadend", F.lit(False))
    status = (
        F.when(~resolved, "UNRESOLVED_ENDPOINT")
        .when(~probe_wanted & F.col("found").isNotNull(), "PROBE_WITHOUT_DEAD_END")
        .when(~probe_wanted, "NOT_A_DEAD_END")
        .when(F.col("found").isNull(), "UNRESOLVED_PROBE")
        .when(F.col("continues") & ~F.col("found"), "CONTINUATION_WITHOUT_NEIGHBOUR")
        .when(~F.col("found"), "NO_NEIGHBOUR")
        .when(~F.col("continues"), "NEIGHBOUR_ALSO_STOPS")
        .otherwise("PROVISIONAL_TERMINAL")
    )
    return e.select("graph_id", status.alias("status"))


def clip_terminals(adjacency: DataFrame, own: DataFrame, peer: DataFrame, outline_metres: float = 200.0) -> DataFrame:
    """Per edge and mode: local terminal, inside the peer area, near the own outline.

    Distance to the outline is a note and never filters.
    """
    modes = F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(b).cast("long").alias("bit")) for m, b in MODES.items()])
    rows = adjacency.select("*", F.explode(modes).alias("m"))
    goes = F.exists(
        "outgoing",
        lambda o: (o["graph_id"] != F.col("opposing_id")) & (o["forward_access"].bitwiseAND(F.col("m.bit")) != 0),
    )
    rows = rows.select(
        F.col("source_id").alias("graph_id"),
        "end_lat",
        "end_lon",
        "m.mode",
        (F.coalesce("deadend", F.lit(False)) & (F.col("forward_access").bitwiseAND(F.col("m.bit")) != 0) & ~goes).alias("local_terminal"),
    )
    rows = stage(rows, "clip-rows")
    places = stage(rows.filter("local_terminal").select("graph_id", "end_lat", "end_lon").distinct(), "clip-places")
    inside = X.points_in_polygon(places, peer, lat="end_lat", lon="end_lon").select("graph_id").distinct().withColumn("in_peer", F.lit(True))
    spot = places.select(
        "graph_id", F.col("end_lon").alias("ax"), F.col("end_lat").alias("ay"), F.col("end_lon").alias("ex"), F.col("end_lat").alias("ey")
    )
    near = X.nearest_outline(spot, own, "graph_id")
    out = rows.join(inside, "graph_id", "left").join(near, "graph_id", "left")
    candidate = F.col("local_terminal") & F.coalesce("in_peer", F.lit(False))
    status = (
        F.when(candidate & (F.col("outline_m") <= outline_metres), "NATIVE_MODE_LOCAL_TERMINAL_IN_PEER_BUFFER_NEAR_OWN_OUTLINE")
        .when(candidate, "NATIVE_MODE_LOCAL_TERMINAL_IN_PEER_BUFFER_OUTLINE_FARTHER")
        .otherwise("NOT_VERIFIED_AS_CLIP_TERMINAL")
    )
    return out.select("graph_id", "mode", "local_terminal", candidate.alias("candidate"), "outline_m", status.alias("status"))


def cut_orientation(shapes: DataFrame, segments: DataFrame) -> DataFrame:
    """Direction of every cut-meeting edge, in the two variants of the jobs.

    ``travel`` tells four end-point cases apart; ``orientation`` calls a point on
    the outline, or two equal sides, AMBIGUOUS.
    """
    meets = X.cut_crossings(shapes, segments).select("graph_id").distinct()
    rows = shapes.join(meets, "graph_id", "left_semi")
    first, last = F.element_at("shape", 1), F.element_at("shape", -1)
    rows = rows.select(
        "graph_id", first["lat"].alias("s_lat"), first["lon"].alias("s_lon"), last["lat"].alias("e_lat"), last["lon"].alias("e_lon")
    )
    rows = X.covers_flag(rows, "graph_id", segments, "s_in", lat="s_lat", lon="s_lon")
    rows = X.covers_flag(rows, "graph_id", segments, "e_in", lat="e_lat", lon="e_lon")
    s, e = F.col("s_in"), F.col("e_in")
    travel = (
        F.when(s & ~e, "OUTWARD_FROM_ORIGINAL_SOURCE_BUFFER")
        .when(~s & e, "INWARD_TOWARD_ORIGINAL_SOURCE_BUFFER")
        .when(s & e, "BOTH_ENDPOINTS_WITHIN_BUFFER_CUT_INTERSECTION")
        .otherwise("BOTH_ENDPOINTS_OUTSIDE_BUFFER_CUT_INTERSECTION")
    )
    on_line = (s & ~F.col("s_in_strictly")) | (e & ~F.col("e_in_strictly"))
    orientation = F.when(on_line, "AMBIGUOUS").when(s & ~e, "OUTWARD").when(~s & e, "INWARD").otherwise("AMBIGUOUS")
    return rows.select("graph_id", travel.alias("travel"), orientation.alias("orientation"))


def near_usable() -> Column:
    """Edges that :func:`edges_at_point` looks for: motor roads and no shortcuts."""
    return ~F.col("is_shortcut") & ~F.col("is_transit") & (F.col("forward_access").bitwiseAND(F.lit(TWO_MODES)) != 0)


def edges_at_point(
    points: DataFrame, shapes: DataFrame, metres: float = NEAR_X, size: float = 0.002, of_point: list[str] | None = None, of_edge: list[str] | None = None
) -> DataFrame:
    """(source_id, receiver_id, distance_m): motor edges within ``metres`` of each point.

    points: source_id, x_lat, x_lon.  Both directions of a road have their own shape.
    A shape is copied to the cells within reach of it and a point lies in one cell, so
    that a pair meets once.  With ``of_point`` and ``of_edge`` these columns of both sides
    come with each pair and no later join is needed; there is one row for each pair
    of rows then, and one for each pair of ids otherwise.
    """
    c = F.col
    reach = X.metres_to_degrees(metres * 1.01)
    edges = shapes.filter(near_usable()).select(c("graph_id").alias("receiver_id"), *[x for x in of_edge or [] if x != "shape"], "shape")
    near = X.shape_cells(edges, size, reach)
    p = X.point_cells(points.select("source_id", "x_lat", "x_lon", *[x for x in of_point or [] if x not in ("x_lat", "x_lon")]), size, c("x_lat"), c("x_lon"))
    wide = F.lit(reach) / F.cos(F.radians(F.abs("x_lat")))
    here, corners = (c("x_lon"), c("x_lat")), ((F.array_min("lon"), F.array_min("lat")), (F.array_max("lon"), F.array_max("lat")))
    apart = X.boxes_apart(*corners, here, here, dx=wide, dy=F.lit(reach))
    gap = F.array_min(L.pairs(F.arrays_zip("lat", "lon"), lambda a, b: X.point_segment_m(*here, a["lon"], a["lat"], b["lon"], b["lat"])))
    # Of short lines the few segments are written out, which is much faster than a function over an array.
    seg = [X.point_segment_m(*here, *[F.get(x, F.lit(j)) for j in (i, i + 1) for x in ("lon", "lat")]) for i in range(3)]
    gap = F.when(F.size("lat").between(2, 4), F.least(*seg)).otherwise(gap)
    met = p.join(near, ["cy", "cx"]).filter(~apart).withColumn("distance_m", gap).filter(c("distance_m") <= metres)
    if of_point is None and of_edge is None:
        # Laid out by source, as the joins that follow need them.
        return met.select("source_id", "receiver_id", "distance_m").repartition("source_id").groupBy("source_id", "receiver_id").agg(F.min("distance_m").alias("distance_m"))
    edge = [F.arrays_zip("lat", "lon").alias("shape") if x == "shape" else c(x) for x in of_edge or []]
    return met.select("source_id", "receiver_id", "distance_m", *(of_point or []), *edge)


def directed_overlap(rows: DataFrame) -> DataFrame:
    """Eight-way verdict on a source end and a receiver shape.

    Columns: access, x_lat, x_lon, app_lat, app_lon, layer, bridge, tunnel of the
    source; r_access, r_layer, r_bridge, r_tunnel, r_shape of the receiver edge.
    """
    c = F.col
    scale = PLANAR_TOPOLOGY
    rows = rows.withColumns(
        {
            "common_modes": c("access").bitwiseAND(c("r_access")).bitwiseAND(F.lit(TWO_MODES)),
            "_p": L.two_places((c("x_lat"), c("x_lon")), (c("app_lat"), c("app_lon")), c("r_shape"), scale),
        }
    )
    k = F.cos(F.radians("x_lat"))
    segment = F.lit(scale) * F.hypot((c("app_lon") - c("x_lon")) * k, c("app_lat") - c("x_lat"))
    rows = rows.withColumns(
        {
            "x_m": c("_p.x_m"),
            "approach_m": c("_p.a_m"),
            "progress_m": c("_p.x_along") - c("_p.a_along"),
            "segment_m": segment,
            "remaining_m": c("_p.length") - c("_p.x_along"),
            "same_structure": c("layer").eqNullSafe(c("r_layer")) & c("bridge").eqNullSafe(c("r_bridge")) & c("tunnel").eqNullSafe(c("r_tunnel")),
        }
    )
    strict = (c("x_m") <= OVERLAP_MAX) & (c("approach_m") <= OVERLAP_MAX)
    forward = ((c("progress_m") >= MIN_PROGRESS) & (c("segment_m") >= MIN_PROGRESS)) | _exact_short()
    status = (
        F.when(c("common_modes") == 0, "REJECTED_NO_SHARED_VEHICLE_MODE")
        .when(c("app_lat").isNull() | c("app_lon").isNull(), "UNRESOLVED_SOURCE_APPROACH_MISSING")
        .when(c("_p.length") <= 0, "UNRESOLVED_B_GEOMETRY_DEGENERATE")
        .when(strict & (c("progress_m") <= -MIN_SHORT), "REJECTED_OPPOSITE_DIRECTED_SHAPE")
        .when(strict & forward & ~c("same_structure"), "UNRESOLVED_NATIVE_LEVEL_OR_STRUCTURE_CONFLICT")
        .when(strict & forward & (c("remaining_m") < END_REMAINING), ENDS_AT_X)
        .when(strict & forward, MATCHED)
        .otherwise("UNRESOLVED_NO_DIRECTED_SOURCE_OVERLAP")
    )
    measures = ["x_m", "approach_m", "progress_m", "segment_m", "remaining_m"]
    return rows.withColumn("status", status).withColumns({m: F.round(m, 3) for m in measures}).drop("_p")


def _exact_short() -> Column:
    """Sub-metre source part: accepted only with centimetre agreement."""
    c = F.col
    return (
        (c("segment_m") >= MIN_SHORT)
        & (c("segment_m") < MIN_PROGRESS)
        & (c("x_m") <= EXACT_MAX)
        & (c("approach_m") <= EXACT_MAX)
        & (c("progress_m") >= MIN_SHORT)
        & (c("progress_m") >= c("segment_m") - SHORT_SLACK)
    )


def successor_relation(rows: DataFrame) -> DataFrame:
    """How a receiver successor relates to its predecessor at the exact point.

    Columns: x_lat, x_lon, start_lat, start_lon; class/use/layer/bridge/tunnel with
    prefixes ``p_`` and ``n_``.
    """
    c = F.col
    k = F.cos(F.radians("x_lat"))
    gap = F.hypot((c("start_lon") - c("x_lon")) * PLANAR_TOPOLOGY * k, (c("start_lat") - c("x_lat")) * PLANAR_TOPOLOGY)

    def same(*names: str) -> Column:
        out = F.lit(True)
        for n in names:
            out = out & c(f"p_{n}").eqNullSafe(c(f"n_{n}"))
        return out

    rows = rows.withColumns(
        {
            "start_gap_m": gap,
            "same_class": same("class"),
            "same_use": same("use"),
            "same_structure": same("layer", "bridge", "tunnel"),
        }
    )
    relation = (
        F.when(c("start_gap_m") > OVERLAP_MAX, "START_NOT_AT_X")
        .when(~c("same_structure"), "NATIVE_STRUCTURE_CHANGE_PHYSICAL_IDENTITY_UNVERIFIED")
        .when(~(c("same_class") & c("same_use")), "NATIVE_CLASS_OR_USE_CHANGE_PHYSICAL_IDENTITY_UNVERIFIED")
        .otherwise("CONSISTENT_NATIVE_ROAD_ATTRIBUTES_PHYSICAL_IDENTITY_UNVERIFIED")
    )
    return rows.withColumn("relation", relation).withColumn("start_gap_m", F.round("start_gap_m", 4))


def correlate(candidates: DataFrame, overlaps: DataFrame, options: DataFrame) -> dict[str, DataFrame]:
    """Match every source final to receiver roads and their legal successors.

    candidates: source_id, modes, x_lat, x_lon, one row per source.  overlaps:
    output of :func:`directed_overlap`, one row per source and receiver.  options:
    predecessor_id, option_id, option_access, car, motorcycle, start_lat, start_lon
    and the p_/n_ attributes.
    Returns ``options`` (one row per source and receiver edge), ``unknowns`` and
    ``status`` (exactly one row per source).

    All facts about a source are rows of one table, written once and laid out by
    source; the three results are aggregates and filters over it without a shuffle.
    """
    c = F.col
    counts = overlaps.groupBy("source_id").agg(
        F.count_if(c("status") == ENDS_AT_X).alias("n_predecessors"), F.count_if(c("status") == MATCHED).alias("n_inside")
    )
    base = candidates.select("source_id", c("modes").alias("source_modes"), "x_lat", "x_lon").join(counts, "source_id", "left")
    met = base.join(
        overlaps.filter(c("status").isin(ENDS_AT_X, MATCHED)).select("source_id", "receiver_id", c("status").alias("met"), "common_modes"),
        "source_id",
        "left",
    )
    # Only ends have successors; the other rows are spread by their source in the join on the predecessor.
    at_end = F.coalesce(c("met") == ENDS_AT_X, F.lit(False))
    met = met.withColumns({"at_end": at_end, "after": F.when(at_end, c("receiver_id")).otherwise(c("source_id"))})
    turns = options.withColumnRenamed("predecessor_id", "after").withColumn("at_end", F.lit(True))
    tried = met.join(turns, ["after", "at_end"], "left")
    bits = allowed_bits(c("car"), c("motorcycle"))
    tried = tried.withColumn("turn_modes", bits.bitwiseAND(c("source_modes")).bitwiseAND(c("option_access")))
    tried = successor_relation(tried)
    legal = c("at_end") & F.coalesce(c("turn_modes") != 0, F.lit(False))
    inside = F.coalesce(c("met") == MATCHED, F.lit(False))
    missing = c("at_end") & c("option_id").isNull()
    open_turn = F.startswith("car", F.lit("UNRESOLVED_")) | F.startswith("motorcycle", F.lit("UNRESOLVED_"))
    facts = tried.select(
        "source_id",
        F.when(inside, c("receiver_id")).otherwise(c("option_id")).alias("option_id"),
        "source_modes",
        "x_lat",
        "x_lon",
        F.coalesce("n_predecessors", F.lit(0)).alias("n_predecessors"),
        F.coalesce("n_inside", F.lit(0)).alias("n_inside"),
        legal.alias("legal"),
        inside.alias("inside"),
        missing.alias("missing"),
        (missing | (c("at_end") & F.coalesce(open_turn, F.lit(False)))).alias("unknown"),
        F.when(c("at_end"), c("receiver_id")).alias("predecessor_id"),
        F.when(inside, c("common_modes").bitwiseAND(c("source_modes"))).otherwise(c("turn_modes")).alias("modes"),
        "car",
        "motorcycle",
        "relation",
        "start_gap_m",
    )
    facts = stage_by(facts, "match-facts", "source_id")
    node = F.bool_or("legal")

    def of_legal(name: str) -> Column:
        return F.when(c("legal"), c(name))

    found = facts.filter(c("legal") | c("inside")).groupBy("source_id", "option_id").agg(
        F.when(node, F.bit_or(of_legal("modes"))).otherwise(F.bit_or(F.when(c("inside"), c("modes")))).alias("modes"),
        F.array_sort(F.collect_set(of_legal("predecessor_id"))).alias("predecessors"),  # edges that end at one point
        F.when(node, F.min(of_legal("relation"))).otherwise(INTERIOR_EVIDENCE).alias("relation"),
        F.when(node, F.size(F.collect_set(of_legal("relation")))).otherwise(1).cast("long").alias("relations"),  # a handful exist
        F.max(of_legal("start_gap_m")).alias("start_gap_m"),
        F.when(node, SAME_NODE).otherwise(INTERIOR).alias("evidence"),
    )
    unknowns = facts.filter("unknown").select(
        "source_id",
        "predecessor_id",
        "option_id",
        "car",
        "motorcycle",
        F.when(c("missing"), "MISSING_ORIGINAL_B_NATIVE_NODE_READBACK").alias("reason"),
    )
    whole = ["source_modes", "x_lat", "x_lon", "n_predecessors", "n_inside"]
    per_option = facts.groupBy("source_id", "option_id").agg(
        F.bool_or(c("legal") | c("inside")).alias("is_option"), F.count_if("unknown").alias("n_unknown"), *[F.max(n).alias(n) for n in whole]
    )
    rows = per_option.groupBy("source_id").agg(
        F.count_if("is_option").alias("n_options"), F.sum("n_unknown").alias("n_unknown"), *[F.max(n).alias(n) for n in whole]
    )
    rows = rows.select("source_id", *whole[:3], "n_options", *whole[3:], "n_unknown")
    status = (
        F.when(c("n_unknown") > 0, "B_NODE_CONTINUATION_PARTIALLY_UNRESOLVED")
        .when((c("n_options") > 0) & (c("n_predecessors") <= 1) & (c("n_inside") <= 1), "B_NATIVE_DIRECTIONAL_CONTINUATIONS_IDENTIFIED")
        .when(c("n_options") > 0, "B_MULTIPLE_OVERLAPPING_PREDECESSORS_UNRESOLVED")
        .when(c("n_predecessors") > 0, "NO_PROVEN_B_NATIVE_OUTGOING_AFTER_X")
        .otherwise("NO_PROVEN_CORRESPONDING_B_DIRECTION")
    )
    return {"options": found, "unknowns": unknowns, "status": rows.withColumn("status", status)}


def matched_roads(overlaps: DataFrame, candidates: DataFrame) -> DataFrame:
    """Receiver roads at the point with END_NODE / INTERIOR, thresholds checked again.

    ``code`` is NULL on a sound row and names the first broken rule otherwise.
    """
    c = F.col
    rows = overlaps.filter(c("status").isin(ENDS_AT_X, MATCHED)).join(
        candidates.select("source_id", F.col("modes").alias("source_modes")), "source_id"
    )
    modes = c("common_modes").bitwiseAND(c("source_modes")).bitwiseAND(F.lit(TWO_MODES))
    code = (
        F.when(
            (c("x_m") > OVERLAP_MAX) | (c("approach_m") > OVERLAP_MAX) | ~((c("progress_m") >= MIN_PROGRESS) | _exact_short()) | ~c("same_structure"),
            "no_overlap",
        )
        .when((c("status") == ENDS_AT_X) & (c("remaining_m") >= END_REMAINING), "end_contradicted")
        .when((c("status") == MATCHED) & (c("remaining_m") < END_REMAINING), "interior_contradicted")
        .when(modes == 0, "no_shared_mode")
    )
    return rows.select(
        "source_id",
        "receiver_id",
        c("status").alias("relationship"),
        F.when(c("remaining_m") < END_REMAINING, "END_NODE").otherwise("INTERIOR").alias("position"),
        modes.alias("modes"),
        "x_m",
        "progress_m",
        code.alias("code"),
    )


def handoff_catalog(eligible: DataFrame, correlated: dict[str, DataFrame]) -> DataFrame:
    """Each eligible source exactly once: candidate with its options, or unresolved.

    Options meet at one exact point, so the nested list is short.
    """
    opts = correlated["options"].groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct("option_id", "modes", "evidence", "relation"))).alias("options")
    )
    rows = eligible.select("source_id").join(correlated["status"], "source_id").join(opts, "source_id", "left")
    has = F.size(F.coalesce("options", F.array())) > 0
    return rows.select(
        "source_id",
        F.col("status").alias("correlation"),
        F.when(has, "CANDIDATE").otherwise("UNRESOLVED").alias("kind"),
        F.when(~has, F.when(F.col("n_unknown") > 0, CONDITIONAL).otherwise(NO_FORWARD)).alias("reason"),
        "options",
        "n_unknown",
        F.col("source_modes").alias("modes"),
    )


def catalog_counts(catalog: DataFrame) -> DataFrame:
    sums = catalog.agg(
        F.count(F.lit(1)).alias("eligible"),
        F.count_if(F.col("kind") == "CANDIDATE").alias("candidates"),
        F.count_if(F.col("kind") == "UNRESOLVED").alias("unresolved"),
        F.coalesce(F.sum(F.size(F.coalesce("options", F.array()))), F.lit(0)).alias("options"),
    )
    return sums.unpivot([], sums.columns, "counter", "n")


def root_coverage(roots: DataFrame, links: DataFrame, options: DataFrame, hops: int = 2) -> DataFrame:
    """Each cut root: has options, terminal only, or none within the hops."""
    good = options.select(F.col("source_id").alias("terminal_id")).distinct().withColumn("good", F.lit(True))
    per = links.join(good, "terminal_id", "left").groupBy("root_id").agg(
        F.count_distinct("terminal_id").alias("finals"), F.bool_or(F.coalesce("good", F.lit(False))).alias("any_good")
    )
    rows = roots.select(F.col("graph_id").alias("root_id")).join(per, "root_id", "left")
    status = F.when(F.col("any_good"), ROOT_OPTIONS).when(F.col("finals") > 0, ROOT_TERMINAL).otherwise(ROOT_NONE[hops])
    return rows.select("root_id", F.coalesce("finals", F.lit(0)).alias("finals"), status.alias("status"))


def dispositions(catalog: DataFrame, matched: DataFrame) -> DataFrame:
    """Four-way disposition per source with facts on its incoming receiver roads."""
    per = matched.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("incoming"), F.max("x_m").alias("max_x_m"), F.max("progress_m").alias("max_progress_m")
    )
    open_turn = F.col("n_unknown") > 0
    has = F.col("kind") == "CANDIDATE"
    name = (
        F.when(has & open_turn, "NATIVE_LEGAL_B_BRANCHES_WITH_CONDITIONAL_UNCERTAINTY")
        .when(has, "NATIVE_LEGAL_B_BRANCHES_NO_KNOWN_UNCERTAINTY")
        .when(open_turn, "NO_NATIVE_ALLOWED_B_BRANCH_WITH_CONDITIONAL_UNCERTAINTY")
        .otherwise("NO_NATIVE_ALLOWED_B_BRANCH_AT_CHECKED_CONTEXT")
    )
    return catalog.join(per, "source_id", "left").select(
        "source_id", name.alias("disposition"), F.coalesce("incoming", F.lit(0)).alias("incoming"), "max_x_m", "max_progress_m", (~has).alias("must_not_connect")
    )


def handoff_projection(catalog: DataFrame) -> DataFrame:
    """Flat branch rows for acceptance; exceptions stay as rows without a branch."""
    rows = catalog.select("source_id", "kind", "reason", "modes", F.explode_outer("options").alias("o"))
    return rows.select(
        "source_id",
        F.when(F.col("kind") == "CANDIDATE", "BRANCH").otherwise("EXCEPTION").alias("row_kind"),
        F.col("o.option_id").alias("receiver_id"),
        F.col("o.relation").alias("relation"),
        F.array_join(mode_names(F.coalesce("o.modes", "modes")), "+").alias("travel_modes"),
        "reason",
    )


def conditional_uncertainty(catalog: DataFrame, unknowns: DataFrame, options: DataFrame) -> DataFrame:
    """Counts of unknown turns on matched and unmatched sources, and mode conflicts."""
    kinds = catalog.select("source_id", "kind")
    u = unknowns.join(kinds, "source_id")
    found = options.select("source_id", "option_id", F.col("modes").alias("found_modes"), "predecessors")
    rows = u.join(found, ["source_id", "option_id"], "left")

    def broken(result: str, bit: int) -> Column:
        recorded = F.coalesce(F.col("found_modes").bitwiseAND(F.lit(bit)) != 0, F.lit(False))
        allowed = F.coalesce(F.col(result) == "ALLOWED_NATIVE_IMMEDIATE", F.lit(False))
        alone = (F.size("predecessors") == 1) & (F.element_at("predecessors", 1) == F.col("predecessor_id"))
        return (allowed & ~recorded) | (~allowed & recorded & alone)

    sums = rows.agg(
        F.count_distinct(F.when(F.col("kind") == "CANDIDATE", F.col("source_id"))).alias("matched_sources_with_unknown"),
        F.count_if(F.col("kind") == "CANDIDATE").alias("unknown_on_matched"),
        F.count_if(F.col("kind") == "UNRESOLVED").alias("unknown_on_unmatched"),
        F.count_if(broken("car", AUTO_BIT) | broken("motorcycle", MOTORCYCLE_BIT)).alias("mode_conflicts"),
    )
    return sums.unpivot([], sums.columns, "counter", "n")


def connection_catalog(matched: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Final source -> point -> receiver rows, and the violations that block them."""
    c = F.col
    rows = candidates.select("source_id", F.col("modes").alias("source_modes"), "x_lat", "x_lon").join(
        matched.drop("code"), "source_id", "left"
    )
    bad_geometry = ~(
        c("position").isin("END_NODE", "INTERIOR")
        & c("x_m").between(0, OVERLAP_MAX)
        & ((c("progress_m") >= MIN_PROGRESS) | (c("progress_m").between(MIN_SHORT, MIN_PROGRESS) & (c("x_m") <= EXACT_MAX)))
    )
    some = c("receiver_id").isNotNull()
    rules = {
        "no_receiver_road": ~some,
        "source_mode_missing": c("source_modes").bitwiseAND(F.lit(TWO_MODES)) == 0,
        "point_out_of_range": ~(c("x_lat").between(-90, 90) & c("x_lon").between(-180, 180)),
        "modes_exceed_source": some & ((c("modes") == 0) | (c("modes").bitwiseAND(F.bitwise_not("source_modes")) != 0)),
        "bad_geometry": some & bad_geometry,
    }
    found = violations(rows, [c("source_id").cast("string").alias("subject")], rules).distinct()
    found = union_all(
        found,
        repeated(candidates, ["source_id"], c("source_id"), "source_repeated"),
        repeated(matched, ["receiver_id"], c("receiver_id"), "receiver_repeated"),
    )
    return rows.filter(some).select("source_id", "x_lat", "x_lon", "receiver_id", "position", "modes", "x_m", "progress_m"), found


ORDER_NAMES = (
    "SAMPLED_DIRECTED_ORDER_ALIGNED_ONLY",
    "SAMPLED_DIRECTED_ORDER_OPPOSED_ONLY",
    "AMBIGUOUS_SAMPLED_DIRECTED_ORDER",
    "INSUFFICIENT_SAMPLED_SEGMENT_OVERLAP",
)


def tail_direction(pairs: DataFrame) -> DataFrame:
    """Order in which a source tail runs along a receiver shape.

    pairs: source_id, receiver_id, shape, r_shape.
    """
    c = F.col
    rows = pairs.select("source_id", "receiver_id", L.tail_order(c("shape"), c("r_shape"), COLOCATED, ORDER_SLACK).alias("o"))
    aligned, opposed, ambiguous, few = ORDER_NAMES
    state = F.when(c("o.matched") < 2, few).when(c("o.falls"), aligned).when(c("o.rises"), opposed).otherwise(ambiguous)
    return rows.select("source_id", "receiver_id", "o.samples", "o.matched", "o.max_gap_m", state.alias("state"))


def terminal_geometry(pairs: DataFrame) -> DataFrame:
    """Gap, projection and tangent of a source end against each chosen receiver."""
    end = F.element_at("shape", -1)
    r_end = F.element_at("r_shape", -1)
    rows = pairs.withColumns({"_p": L.project_on_line(end["lat"], end["lon"], F.col("r_shape")), "_h": L.terminal_heading(F.col("shape"))})
    return rows.select(
        "source_id",
        "receiver_id",
        (F.col("source_way") == F.col("receiver_way")).alias("same_way"),
        haversine_m(end["lat"], end["lon"], r_end["lat"], r_end["lon"]).alias("end_gap_m"),
        F.col("_p.metres").alias("line_gap_m"),
        F.col("_p.segment").alias("segment"),
        (F.col("_h.x") * F.col("_p.tx") + F.col("_h.y") * F.col("_p.ty")).alias("tangent_cosine"),
        (F.col("_p.metres") <= COLOCATED).alias("within_metre"),
    )


# Receivers of a source that are measured together.
TAIL_BATCH = 64


def tail_coverage(pairs: DataFrame, laid_by: list[str] | None = None) -> DataFrame:
    """Per source: tail samples within a metre of any chosen receiver.

    The receivers of a source are measured together, so that its samples become counts
    where its pairs are; a source with many is cut into batches of ``TAIL_BATCH``, and
    only of those all samples move.  ``laid_by`` names columns that follow from the
    source and by which the pairs lie together: they need not move then.
    """
    c = F.col
    own = [*(laid_by or []), "source_id"]
    rows = pairs.select(*own, F.struct("shape", "r_shape").alias("pair"))
    nth = F.row_number().over(Window.partitionBy(*own).orderBy(*own))
    batches = rows.withColumn("batch", F.floor((nth - 1) / TAIL_BATCH)).groupBy(*own, "batch").agg(F.collect_list("pair").alias("pairs"))
    measured = batches.select("source_id", L.tail_cover(c("pairs"), F.lit(COLOCATED), F.lit(TAIL_BATCH)).alias("m")).select("source_id", "m.*")
    # One sample a column: nothing but a row for each batch moves, with gaps only where there may be more batches.
    least = [F.min(F.get("gaps", F.lit(i))).alias(f"g{i}") for i in range(L.TAIL_MAX_STEPS + 1)]
    per = measured.groupBy("source_id").agg(
        F.max("samples").alias("samples"), F.max("covered").alias("covered"), F.max("max_gap_m").alias("max_gap_m"), F.bool_or(c("gaps").isNotNull()).alias("many"), *least
    )
    gaps = F.array(*[f"g{i}" for i in range(L.TAIL_MAX_STEPS + 1)])
    return per.filter("samples > 0").select(
        "source_id",
        c("samples").cast("long").alias("samples"),
        F.when(c("many"), F.size(F.filter(gaps, lambda g: g <= COLOCATED))).otherwise(c("covered")).cast("long").alias("covered"),
        F.when(c("many"), F.array_max(gaps)).otherwise(c("max_gap_m")).alias("max_gap_m"),
    )


def chain_in_trace(rows: DataFrame) -> DataFrame:
    """First place where the chain occurs as a run in the trace (0-based), else NULL.

    ``chain`` and ``trace`` are arrays of edge ids of one recorded route.
    """
    n, m = F.size("chain"), F.size("trace")
    starts = F.when(m >= n, F.sequence(F.lit(1), m - n + 1)).otherwise(F.array().cast("array<int>"))
    hits = F.filter(starts, lambda i: F.slice("trace", i, n) == F.col("chain"))
    first = F.get(hits, F.lit(0)) - 1
    status = F.when(first.isNull(), "UNPROVEN_FOR_THIS_ROUTE").otherwise("B_GRAPH_DIRECTED_CHAIN_TRACED_FOR_THIS_LOCAL_ROUTE")
    return rows.withColumns({"first_index": first, "status": status})


def handoff_geometry(rows: DataFrame) -> DataFrame:
    """Place of a recorded handoff on the last source and first receiver edge.

    rows: pair_id, a_lat, a_lon, b_lat, b_lon, shape, r_shape.
    """
    c = F.col
    rows = rows.withColumns(
        {
            "_a": L.project_on_line(c("a_lat"), c("a_lon"), c("shape")),
            "_b": L.project_on_line(c("b_lat"), c("b_lon"), c("r_shape")),
            "gap_m": haversine_m(c("a_lat"), c("a_lon"), c("b_lat"), c("b_lon")),
            "_len": L.line_length(c("shape")),
        }
    )
    remaining = F.greatest(F.lit(0.0), c("_len") - c("_a.along"))
    near = (c("_a.metres") <= COLOCATED) & (c("_b.metres") <= COLOCATED) & (c("gap_m") <= COLOCATED)
    return rows.select(
        "pair_id",
        "gap_m",
        c("_a.metres").alias("a_off_m"),
        c("_b.metres").alias("b_off_m"),
        c("_a.along").alias("a_along_m"),
        c("_b.along").alias("b_along_m"),
        remaining.alias("a_remaining_m"),
        (c("_a.tx") * c("_b.tx") + c("_a.ty") * c("_b.ty")).alias("tangent_cosine"),
        ((remaining <= COLOCATED) & (c("_a.metres") <= COLOCATED)).alias("at_edge_end"),
        near.alias("colocated"),
    )


def hierarchy_end_status(candidates: DataFrame, node_edges: DataFrame) -> DataFrame:
    """Per candidate and mode: accessible edges on other levels, or none.

    candidates: graph_id, root_node, opposing_id, mode.  node_edges: root_node,
    node_id, edge_id, access, one row per outgoing edge of each level node.
    """
    bit = F.when(F.col("mode") == "auto", F.lit(AUTO_BIT)).otherwise(F.lit(MOTORCYCLE_BIT))
    usable = F.col("access").bitwiseAND(bit) != 0
    on_root = F.col("node_id") == F.col("root_node")
    rows = candidates.join(node_edges, "root_node", "left")
    per = rows.groupBy("graph_id", "mode").agg(
        F.count_if(usable & ~on_root).alias("other_level"),
        F.count_if(usable & on_root & (F.col("edge_id") != F.col("opposing_id"))).alias("same_node"),
    )
    status = (
        F.when(F.col("same_node") > 0, "VIOLATION_ROOT_CONTINUATION")
        .when(F.col("other_level") > 0, "HIERARCHY_MODE_ACCESSIBLE_ALTERNATIVES_UNRESOLVED")
        .otherwise("NO_OTHER_NATIVE_MODE_ACCESSIBLE_HIERARCHY_OUTGOING")
    )
    return per.withColumn("status", status)


def outer_reconcile(prior: DataFrame, inventory: DataFrame) -> DataFrame:
    """Add only absent ids; an id on both sides must agree exactly.

    Both: graph_id, end_node, end_lat, end_lon, access, terminal_modes; ``prior``
    also vehicle_modes.
    """
    facts = ["end_node", "end_lat", "end_lon", "access", "terminal_modes"]
    a = prior.select("graph_id", "vehicle_modes", F.struct(*facts).alias("p"))
    b = inventory.select("graph_id", F.struct(*facts).alias("n"))
    rows = a.join(b, "graph_id", "full_outer")
    wider = F.col("vehicle_modes").bitwiseAND(F.bitwise_not("n.terminal_modes")) != 0
    status = (
        F.when(F.col("p").isNull() & (F.col("n.terminal_modes") <= 0), "CONFLICT_NOT_TERMINAL")
        .when(F.col("p").isNull(), "ADDED")
        .when(F.col("n").isNull(), "PRIOR_ONLY")
        .when((F.col("p") != F.col("n")) | wider, "CONFLICT")
        .otherwise("CONFIRMED")
    )
    return rows.select("graph_id", status.alias("status"))


def cut_coverage(cut: DataFrame, direct: DataFrame, beyond: DataFrame) -> DataFrame:
    """Coverage of observed cut edges by direct finals and by predecessors.

    cut: side, graph_id, travel.  direct: side, graph_id.  beyond: side,
    predecessor_id.  One row per cut edge or missing predecessor.
    """
    d = direct.select("side", "graph_id").distinct().withColumn("direct", F.lit(True))
    p = beyond.select("side", F.col("predecessor_id").alias("graph_id")).distinct().withColumn("before", F.lit(True))
    rows = cut.select("side", "graph_id", "travel").join(d, ["side", "graph_id"], "full_outer").join(p, ["side", "graph_id"], "full_outer")
    observed = F.col("travel").isNotNull()
    outward = F.col("travel") == "OUTWARD_FROM_ORIGINAL_SOURCE_BUFFER"
    status = (
        F.when(~observed & F.col("direct"), "VIOLATION_DIRECT_NOT_OBSERVED")
        .when(~observed, "MISSING_PREDECESSOR")
        .when(F.col("direct") | F.col("before"), "COVERED")
        .when(outward, "UNLINKED_OUTWARD")
        .otherwise("UNLINKED")
    )
    return rows.select("side", "graph_id", status.alias("status"))
