"""Recorded journeys: choice of proposals, checks of legs and of whole routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import EARTH_SEARCH_M, EARTH_VERIFY_M, haversine_m
from ..functions.ids import dense_ids, stable_id
from . import spatial as X
from .graph import PROPOSAL_PREFIX
from .rules import RANK_BROKEN, ranked_neighbours, union_all, violations

# Tolerances in metres and limits of the probes.
ARRIVAL_M, HANDOFF_M, SNAP_M = 25.0, 1.0, 150.0
DIVERSITY_CELL, PER_CELL = 0.015, 2
CROSSING_SNAP_KM, CROSSING_MAX_KM, KM_PER_DEGREE = 5.0, 80.0, 111.3


def diverse_proposals(proposals: DataFrame, start: tuple[float, float], end: tuple[float, float], k: int) -> DataFrame:
    """The ``k`` least detours, at most two per cell, among all rows.

    Equal to picking greedily in (detour, id) order.
    """
    lat, lon = F.col("lat"), F.col("lon")
    a = haversine_m(F.lit(start[0]), F.lit(start[1]), lat, lon, EARTH_SEARCH_M)
    b = haversine_m(lat, lon, F.lit(end[0]), F.lit(end[1]), EARTH_SEARCH_M)
    measured = proposals.withColumn("detour_m", a + b)
    cell = Window.partitionBy(F.floor(lat / DIVERSITY_CELL), F.floor(lon / DIVERSITY_CELL)).orderBy("detour_m", "id")
    kept = measured.withColumn("_n", F.row_number().over(cell)).filter(F.col("_n") <= PER_CELL).drop("_n")
    return kept.orderBy("detour_m", "id").limit(k)


def ordinal_page(proposals: DataFrame, start: int, size: int, pair: tuple[str, str, str]) -> DataFrame:
    """Rows ``start`` to ``start + size - 1`` of the whole stream in receiver order.

    Each row carries the total, the next cursor and whether its id is bound to
    its pair and receiver.
    """
    numbered = dense_ids(proposals, "receiver_graph_id", ["id"], "ordinal").withColumn("ordinal", F.col("ordinal") - 1)
    total = proposals.agg(F.count(F.lit(1)).alias("total"))
    ident = stable_id(PROPOSAL_PREFIX, *[F.lit(p) for p in pair], F.col("direction"), F.col("receiver_graph_id"))
    page = numbered.filter(F.col("ordinal").between(start, start + size - 1)).join(F.broadcast(total))  # total is one row
    cursor = F.when(F.lit(start + size) < F.col("total"), F.lit(start + size))
    return page.select("ordinal", "id", "receiver_graph_id", "total", cursor.alias("next_cursor"), (F.col("id") == ident).alias("bound"))


def best_route(results: DataFrame) -> DataFrame:
    """FASTER and SHORTER choice among the successes of each journey."""
    ok = results.filter("success")
    best = ok.groupBy("journey_id").agg(
        F.min(F.struct("seconds", "candidate_id")).alias("f"), F.min(F.struct("km", "candidate_id")).alias("s")
    )
    row = F.array(
        F.struct(F.lit("FASTER").alias("style"), F.col("f.candidate_id").alias("candidate_id")),
        F.struct(F.lit("SHORTER").alias("style"), F.col("s.candidate_id").alias("candidate_id")),
    )
    return best.select("journey_id", F.explode(row).alias("r")).select("journey_id", "r.*")


def rank_contiguity(rows: DataFrame, group: str, rank: str, keys: list[str], subject: Column) -> DataFrame:
    """Violations where ranks are not 0..n-1 or do not follow the declared key."""
    step = ranked_neighbours(rows, [group], rank, F.struct(*keys))
    rules = {"rank_not_contiguous": F.expr(RANK_BROKEN.format(rank=rank)), "order_broken": F.col("prev") > F.col("own")}
    return violations(step, [subject.cast("string").alias("subject")], rules)


def route_arrival_audit(routes: DataFrame, limit_m: float = SNAP_M) -> DataFrame:
    """Offsets of the driven ends and the failure category, if any.

    routes: route_id, status, length_km, start_/end_ lat/lon, actual_start_/actual_end_ lat/lon.
    """
    c = F.col

    def off(side: str) -> Column:
        return haversine_m(c(f"{side}_lat"), c(f"{side}_lon"), c(f"actual_{side}_lat"), c(f"actual_{side}_lon"), EARTH_VERIFY_M)

    def sane(side: str) -> Column:
        return c(f"actual_{side}_lat").between(-90, 90) & c(f"actual_{side}_lon").between(-180, 180)

    rows = routes.withColumns({"start_offset_m": off("start"), "end_offset_m": off("end")})
    shape_ok = F.coalesce(sane("start") & sane("end"), F.lit(False))
    near = (c("start_offset_m") <= limit_m) & (c("end_offset_m") <= limit_m)
    failure = (
        F.when(~c("status").eqNullSafe(F.lit(0)), "route_status")
        .when(c("length_km").isNull() | (c("length_km") < 0), "missing_route_summary")
        .when(~shape_ok, "invalid_route_shape")
        .when(~near, "route_endpoints_mismatch")
    )
    return rows.select("route_id", "start_offset_m", "end_offset_m", failure.alias("failure"), failure.isNull().alias("passed"))


def border_endpoints(routes: DataFrame, segments: DataFrame) -> DataFrame:
    """Exactly one requested end of a border route may lie inside the region."""
    rows = X.covers_flag(routes, "route_id", segments, "start_in", lat="start_lat", lon="start_lon")
    rows = X.covers_flag(rows, "route_id", segments, "end_in", lat="end_lat", lon="end_lon")
    return rows.select("route_id", "start_in", "end_in", (F.col("start_in") != F.col("end_in")).alias("valid"))


def route_crossing_audit(routes: DataFrame, segments: DataFrame) -> DataFrame:
    """Does the driven line cross the outline between the requested sides?

    routes: route_id, length_km, requested ends and ``shape`` (driven vertices).
    """
    first, last = F.element_at("shape", 1), F.element_at("shape", -1)
    rows = routes.withColumns(
        {"a_lat": first["lat"], "a_lon": first["lon"], "z_lat": last["lat"], "z_lon": last["lon"]}
    )
    for name, lat, lon in (("start_in", "start_lat", "start_lon"), ("end_in", "end_lat", "end_lon"), ("a_in", "a_lat", "a_lon"), ("z_in", "z_lat", "z_lon")):
        rows = X.covers_flag(rows, "route_id", segments, name, lat=lat, lon=lon)
    meets = X.cut_crossings(rows.select(F.col("route_id").alias("graph_id"), "shape"), segments)
    meets = meets.select(F.col("graph_id").alias("route_id")).distinct().withColumn("meets", F.lit(True))
    rows = rows.join(meets, "route_id", "left")
    c = F.col

    def snap_km(lat: str, lon: str, want_lat: str, want_lon: str) -> Column:
        return F.hypot((c(lon) - c(want_lon)) * KM_PER_DEGREE * F.cos(F.radians(want_lat)), (c(lat) - c(want_lat)) * KM_PER_DEGREE)

    far = (snap_km("a_lat", "a_lon", "start_lat", "start_lon") > CROSSING_SNAP_KM) | (snap_km("z_lat", "z_lon", "end_lat", "end_lon") > CROSSING_SNAP_KM)
    reason = (
        F.when(F.size("shape") < 2, "no_shape")
        .when(far, "snapped_far")
        .when(F.coalesce("length_km", F.lit(0.0)) > CROSSING_MAX_KM, "too_long")
        .when(c("meets").isNull(), "no_crossing")
        .when(c("start_in") == c("end_in"), "same_side_requested")
        .when((c("a_in") != c("start_in")) | (c("z_in") != c("end_in")), "other_side_driven")
    )
    return rows.select("route_id", reason.isNull().alias("proven"), reason.alias("reason"))


def two_leg_verdict(rows: DataFrame) -> DataFrame:
    """Verdict on two recorded legs of one journey; the first failing rule wins.

    rows: case_id, source_id, receiver_id, mode_bit, source_access, receiver_access,
    node_gap_m, outgoing, a_status, a_start_m, a_end_m, a_edges, b_status, b_start_m,
    b_end_m, handoff_m, b_edges and both legs' seconds and km.
    """
    c = F.col
    first_b = F.get("b_edges", F.lit(0))
    goes_on = F.array_contains("outgoing", first_b) | ((first_b == c("receiver_id")) & F.array_contains("outgoing", F.get("b_edges", F.lit(1))))
    goes_on = F.coalesce(goes_on, F.lit(False))
    no_access = (c("source_access").bitwiseAND(c("mode_bit")) == 0) | (c("receiver_access").bitwiseAND(c("mode_bit")) == 0)

    def empty(col: str) -> Column:
        return F.coalesce(F.size(col) <= 0, F.lit(True))

    def failed(leg: str) -> Column:
        return F.when(c(f"{leg}_status") == "INCONCLUSIVE", "INCONCLUSIVE").otherwise("UNPROVEN")

    def out(state, reason: str) -> Column:
        return F.struct((F.lit(state) if isinstance(state, str) else state).alias("status"), F.lit(reason).alias("reason"))

    verdict = (
        F.when(c("a_status") != "SUCCEEDED", out(failed("a"), "leg_a_failed"))
        .when((c("a_start_m") > ARRIVAL_M) | (c("a_end_m") > HANDOFF_M), out("UNPROVEN", "leg_a_not_at_terminal"))
        .when(empty("a_edges"), out("INCONCLUSIVE", "leg_a_trace_missing"))
        .when(F.element_at("a_edges", -1) != c("source_id"), out("UNPROVEN", "leg_a_other_last_edge"))
        .when(c("b_status") != "SUCCEEDED", out(failed("b"), "leg_b_failed"))
        .when((c("b_start_m") > HANDOFF_M) | (c("b_end_m") > ARRIVAL_M) | (c("handoff_m") > HANDOFF_M), out("UNPROVEN", "leg_b_not_at_terminal"))
        .when(empty("b_edges"), out("INCONCLUSIVE", "leg_b_trace_missing"))
        .when(~goes_on, out("UNPROVEN", "leg_b_does_not_continue"))
        .when(no_access, out("UNPROVEN", "access_unsupported"))
        .when(c("node_gap_m") > HANDOFF_M, out("UNPROVEN", "nodes_not_colocated"))
        .otherwise(F.struct(F.lit("GRAPH_LOCAL_TRACES_MATCHED_FOR_THIS_JOURNEY").alias("status"), F.lit(None).cast("string").alias("reason")))
    )
    ok = c("v.reason").isNull()
    return rows.withColumn("v", verdict).select(
        "case_id", "v.status", "v.reason", F.when(ok, c("a_seconds") + c("b_seconds")).alias("seconds"), F.when(ok, c("a_km") + c("b_km")).alias("km")
    )


def route_edge_audit(routes: DataFrame, register: DataFrame) -> DataFrame:
    """Violations of recorded route documents and of their final edge.

    routes: route_id, edges, node_count, first_id, last_id, seconds, km, start_m,
    end_m, expected_last.  register: graph_id of known final edges.
    """
    c = F.col
    known = register.select(F.col("graph_id").alias("expected_last")).distinct().withColumn("known", F.lit(True))
    rows = routes.join(known, "expected_last", "left")
    empty = F.coalesce(F.size("edges") <= 0, F.lit(True))
    rules = {
        "edges_missing": empty,
        "node_count": ~c("node_count").eqNullSafe(F.size("edges") + 1),
        "first_id": ~empty & ~c("first_id").eqNullSafe(F.get("edges", F.lit(0))),
        "last_id": ~empty & ~c("last_id").eqNullSafe(F.element_at("edges", -1)),
        "cost_not_positive": ~F.coalesce((c("seconds") > 0) & (c("km") > 0), F.lit(False)),
        "not_expected_edge": ~c("last_id").eqNullSafe(c("expected_last")),
        "snap_too_far": ~F.coalesce((c("start_m") <= HANDOFF_M) & (c("end_m") <= HANDOFF_M), F.lit(False)),
        "edge_not_registered": c("known").isNull(),
        "edge_id_invalid": F.exists("edges", lambda e: e.isNull() | (e <= 0)),
    }
    return violations(rows, ["route_id"], rules)


def trace_proof_audit(proofs: DataFrame, paths: DataFrame) -> DataFrame:
    """Violations of recorded edge lists against the suffix they must end in.

    proofs: final_id, mode, proven, method (DIRECT or ONE_HOP), predecessor_id,
    trace, start_m, end_m, declared_count.  paths: final_id, path_key, expected
    number of witnesses per final.
    """
    c = F.col
    suffix = F.when(c("method") == "ONE_HOP", F.array("predecessor_id", "final_id")).otherwise(F.array("final_id"))
    n = F.size(suffix)
    tail = F.when(F.size("trace") >= n, F.slice("trace", F.size("trace") - n + 1, n))
    exact = F.coalesce((tail == suffix) & (c("start_m").between(0, 1)) & (c("end_m").between(0, 1)), F.lit(False))
    found = violations(
        proofs,
        [c("final_id").cast("string").alias("subject")],
        {
            "proven_without_suffix": c("proven") & ~exact,
            "trace_id_invalid": F.exists("trace", lambda e: e.isNull() | (e <= 0)),
            "predecessor_missing": c("proven") & (c("method") == "ONE_HOP") & c("predecessor_id").isNull(),
        },
    )
    hops = proofs.filter(c("method") == "ONE_HOP").groupBy("final_id").agg(F.count_if("proven").alias("n"), F.max("declared_count").alias("d"))
    modes = proofs.groupBy("final_id").agg(F.count_distinct(F.when(c("proven"), c("mode"))).alias("modes"))
    seen = paths.groupBy("final_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("path_key").alias("k"), F.max("expected").alias("e"))
    subject = c("final_id").cast("string").alias("subject")
    return union_all(
        found,
        hops.filter(c("n") != c("d")).select(subject, F.lit("one_hop_count_mismatch").alias("code")),
        modes.filter(c("modes") < 2).select(subject, F.lit("mode_without_proof").alias("code")),
        seen.filter((c("n") != c("k"))).select(subject, F.lit("path_repeated").alias("code")),
        seen.filter((c("n") != c("e"))).select(subject, F.lit("witness_count_mismatch").alias("code")),
    ).distinct()
