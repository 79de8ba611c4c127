"""Quality jobs: every broken rule of a document table becomes a (subject, code) row.

Documents are flat tables here.  Rules are SQL conditions; a NULL condition does
not count, so a rule that must catch NULL says so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.geo import AUTO_BIT, MOTORCYCLE_BIT
from ..functions.ids import canonical_json
from .match import EXACT_MAX, MIN_PROGRESS, MIN_SHORT, OVERLAP_MAX, ROOT_NONE, ROOT_OPTIONS
from .rules import RANK_BROKEN, ranked_neighbours, repeated, union_all, violations

# Identifiers and limits the documents must keep to.
SHA = "^sha256:[0-9a-f]{64}$"
SEMVER = r"^[0-9]+\\.[0-9]+\\.[0-9]+$"
SAFE_FILE = "^[A-Za-z0-9._{}-]+$"
MAJOR_CLASSES = ["motorway", "trunk", "primary", "secondary", "motorway_link", "trunk_link", "primary_link", "secondary_link"]
MAX_SEARCH_LIMIT = 12


def check(df: DataFrame, subject: str, rules: dict[str, str]) -> DataFrame:
    """Rules given as SQL conditions over the columns of ``df``."""
    return violations(df, [F.expr(f"cast({subject} as string)").alias("subject")], {code: F.expr(cond) for code, cond in rules.items()})


def _counts(rows: DataFrame, key: str, name: str, when: str = "true") -> DataFrame:
    return rows.groupBy(key).agg(F.count_if(F.expr(when)).alias(name))


def config_rules(configs: DataFrame, targets: DataFrame, sources: DataFrame, routes: DataFrame) -> DataFrame:
    """Region configuration checks.

    configs: one row per region with search_*, layer_* and graph_* settings.
    targets: region_id, idx, name_equals, query, limit.  sources: region_id,
    source_id, url.  routes: region_id, idx, name, kind, start/end lat/lon.
    """
    main = check(
        configs,
        "region_id",
        {
            "search_file_name": "search_enabled and not (file_name rlike '%s' and file_name like '%%.sqlite')" % SAFE_FILE,
            "search_manifest_name": "search_enabled and not (manifest_name rlike '%s' and manifest_name like '%%.json')" % SAFE_FILE,
            "coverage_not_numeric": "search_enabled and (min_lat is null or max_lat is null or min_lng is null or max_lng is null)",
            "coverage_latitude": "search_enabled and not (-90 <= min_lat and min_lat < max_lat and max_lat <= 90)",
            "coverage_longitude": "search_enabled and not (-180 <= min_lng and min_lng < max_lng and max_lng <= 180)",
            "country_code": "search_enabled and not (coalesce(country, '') rlike '^[A-Za-z]{2}$')",
            "layer_source_url": "layer_enabled and not (coalesce(layer_url, '') like 'https://%.osm.pbf')",
            "layer_polygon_url": "layer_enabled and not (coalesce(layer_polygon_url, '') like 'https://%.poly')",
            "layer_threads": "layer_enabled and not coalesce(layer_threads between 1 and 64, false)",
            "layer_template": "layer_enabled and not (coalesce(layer_template, '') like '%{version}%' and layer_template like '%.pmtiles')",
            "layer_classes": "layer_enabled and (coalesce(size(major_classes), 0) <= 0 or size(array_distinct(major_classes)) <> size(major_classes) or exists(major_classes, c -> not array_contains(array(%s), c)))"
            % ", ".join(f"'{c}'" for c in MAJOR_CLASSES),
            "layer_tolerance": "layer_enabled and not coalesce(border_tolerance between 0 and 1000, false)",
            "graph_version": f"graph_enabled and not (coalesce(engine_version, '') rlike '{SEMVER}')",
            "graph_buffer": "graph_enabled and not coalesce(buffer_km > 0 and buffer_km <= 100, false)",
            "graph_threads": "graph_enabled and not coalesce(graph_threads between 1 and 64, false)",
            "graph_template": "graph_enabled and not (coalesce(graph_template, '') like '%{version}%' and graph_template like '%.tar')",
            "graph_mode": "graph_enabled and validation_mode not in ('manual', 'auto')",
            "primary_differs": "graph_enabled and layer_enabled and not (layer_primary_id <=> graph_primary_id)",
        },
    )
    wanted = targets.join(configs.filter("search_enabled").select("region_id"), "region_id", "left_semi")
    target = check(
        wanted,
        "region_id",
        {
            "target_name": "coalesce(trim(name_equals), '') = ''",
            "target_query": "length(trim(coalesce(nullif(query, ''), name_equals))) < 2",
            "target_limit": f"not coalesce(`limit` between 1 and {MAX_SEARCH_LIMIT}, true)",
        },
    )
    graphs = configs.filter("graph_enabled")
    own = sources.join(graphs.select("region_id"), "region_id", "left_semi")
    source = check(own, "region_id", {"source_record": "coalesce(source_id, '') = '' or not (coalesce(url, '') like 'https://%.osm.pbf')"})
    route = check(
        routes.join(graphs.select("region_id"), "region_id", "left_semi"),
        "region_id",
        {
            "route_name": "coalesce(trim(name), '') = ''",
            "route_kind": "kind not in ('interior', 'border')",
            "route_point": "not coalesce(start_lat between -90 and 90 and end_lat between -90 and 90 and start_lon between -180 and 180 and end_lon between -180 and 180, false)",
        },
    )
    has = configs.join(_counts(targets, "region_id", "n_targets"), "region_id", "left")
    for df, name, cond in ((sources, "n_sources", "true"), (routes, "n_routes", "true"), (routes, "n_border", "kind = 'border'")):
        has = has.join(_counts(df, "region_id", name, cond), "region_id", "left")
    primary = sources.select("region_id", F.col("source_id").alias("graph_primary_id")).distinct().withColumn("listed", F.lit(True))
    has = has.join(primary, ["region_id", "graph_primary_id"], "left")
    whole = check(
        has,
        "region_id",
        {
            "targets_missing": "search_enabled and coalesce(n_targets, 0) = 0",
            "sources_missing": "graph_enabled and coalesce(n_sources, 0) = 0",
            "primary_not_listed": "graph_enabled and coalesce(n_sources, 0) > 0 and listed is null",
            "routes_missing": "graph_enabled and coalesce(n_routes, 0) = 0 and validation_mode <> 'auto'",
            "border_route_missing": "graph_enabled and coalesce(n_border, 0) = 0 and validation_mode <> 'auto'",
        },
    )
    twice = repeated(own, ["region_id", "source_id"], F.col("region_id"), "source_repeated")
    return union_all(main, target, source, route, whole, twice).distinct()


def audit_catalog(catalog: DataFrame, evidence: DataFrame, options: DataFrame, refs: DataFrame, incoming: DataFrame, census: DataFrame) -> DataFrame:
    """Catalogue against evidence, both ways.

    catalog / evidence: source_id, end_node, x_lat, x_lon, modes, correlation.
    options / refs: source_id, option_id, modes, relation, evidence.
    incoming: source_id, receiver_id of matched roads.  census: source_id of all finals.
    """
    c = F.col
    e = evidence.select("source_id", *[c(x).alias(f"e_{x}") for x in ("end_node", "x_lat", "x_lon", "modes", "correlation")])
    src = check(
        catalog.join(e, "source_id", "left"),
        "source_id",
        {
            "source_without_evidence": "e_end_node is null",
            "end_node_changed": "end_node <> e_end_node",
            "point_changed": "abs(x_lat - e_x_lat) > 1e-8 or abs(x_lon - e_x_lon) > 1e-8",
            "modes_changed": "modes <> e_modes",
            "correlation_changed": "correlation <> e_correlation",
        },
    )
    key = ["source_id", "option_id"]
    # Counted where the rows meet their references, so that the keys do not move once more.
    same = F.count(F.lit(1)).over(Window.partitionBy(*key))
    mine = options.select(*key, c("modes").alias("o_modes"), c("relation").alias("o_relation"), c("evidence").alias("o_evidence"), same.alias("o_n"))
    theirs = refs.join(catalog.select("source_id").distinct(), "source_id", "left_semi")
    theirs = theirs.select(*key, c("modes").alias("r_modes"), c("relation").alias("r_relation"), c("evidence").alias("r_evidence"))
    opt = check(
        mine.join(theirs, key, "full_outer"),
        "source_id",
        {
            "option_suppressed": "o_evidence is null",
            "option_invented": "r_evidence is null",
            "option_modes_changed": "o_modes <> r_modes",
            "option_relation_changed": "o_relation <> r_relation",
            "option_evidence_changed": "o_evidence <> r_evidence",
            "option_repeated": "o_n > 1",
        },
    )
    owners = incoming.groupBy("receiver_id").agg(F.count_distinct("source_id").alias("n")).filter("n > 1")
    shared = owners.select(c("receiver_id").cast("string").alias("subject"), F.lit("receiver_owned_twice").alias("code"))
    ids = catalog.select("source_id").distinct()
    known = census.select("source_id").distinct()

    def side(df: DataFrame, code: str) -> DataFrame:
        return df.select(c("source_id").cast("string").alias("subject"), F.lit(code).alias("code"))

    return union_all(
        src,
        opt,
        shared,
        repeated(catalog, ["source_id"], c("source_id"), "source_repeated"),
        side(known.join(ids, "source_id", "left_anti"), "source_omitted"),
        side(ids.join(known, "source_id", "left_anti"), "source_not_in_census"),
    ).distinct()


def root_audit(roots: DataFrame, links: DataFrame, candidates: DataFrame, recorded: DataFrame, unlinked: DataFrame) -> DataFrame:
    """Cut-root statuses, recorded counts and the list of unlinked roots.

    roots: root_id, status.  links: root_id, terminal_id.  candidates: source_id
    with options.  recorded: status, n.  unlinked: root_id.
    """
    good = candidates.select(F.col("source_id").alias("terminal_id")).distinct().withColumn("good", F.lit(True))
    per = links.join(good, "terminal_id", "left").groupBy("root_id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_or("good"), F.lit(False)).alias("good"))
    listed = unlinked.select("root_id").distinct().withColumn("listed", F.lit(True))
    rows = roots.join(per, "root_id", "left").join(listed, "root_id", "full_outer")
    none = ROOT_NONE[2]
    found = check(
        rows,
        "root_id",
        {
            "status_unknown": f"status not in ('{ROOT_OPTIONS}', 'ROOT_TERMINAL_CANDIDATE_NO_CONFIRMED_RECEIVER', '{none}')",
            "unlinked_with_terminal": f"status = '{none}' and coalesce(n, 0) > 0",
            "linked_without_terminal": f"status <> '{none}' and coalesce(n, 0) = 0",
            "options_misclassified": f"coalesce(n, 0) > 0 and status <> '{none}' and (status = '{ROOT_OPTIONS}') <> good",
            "unlinked_not_listed": f"status = '{none}' and listed is null",
            "listed_not_unlinked": f"listed and not (status <=> '{none}')",
        },
    )
    now = roots.groupBy("status").agg(F.count(F.lit(1)).alias("now"))
    counts = check(now.join(recorded, "status", "full_outer"), "status", {"count_mismatch": "not (now <=> n)"})
    return union_all(found, counts, repeated(roots, ["root_id"], F.col("root_id"), "root_repeated"))


def tile_scope_audit(inventory: DataFrame) -> DataFrame:
    """Selected tiles = cut + endpoint + owner tiles; extra ids unique and positive."""
    both = "concat(endpoint_ids, owner_ids)"
    return check(
        inventory,
        "pair_id",
        {
            "count_negative": "endpoint_tiles < 0 or owner_tiles < 0",
            "cut_only_with_extra": "scope = 'CUT_ONLY' and (endpoint_tiles <> 0 or owner_tiles <> 0)",
            "scope_unknown": "scope not in ('CUT_ONLY', 'CUT_PLUS_ENDPOINT', 'CUT_PLUS_ENDPOINT_AND_OWNER')",
            "sum_mismatch": "scope <> 'CUT_ONLY' and selected_tiles <> cut_tiles + endpoint_tiles + owner_tiles",
            "indexed_exceeds_selected": "scope <> 'CUT_ONLY' and indexed_tiles > selected_tiles",
            "id_count_mismatch": "scope <> 'CUT_ONLY' and (size(endpoint_ids) <> endpoint_tiles or size(owner_ids) <> owner_tiles)",
            "id_repeated": f"size(array_distinct({both})) <> size({both})",
            "id_invalid": f"exists({both}, x -> x <= 0)",
            "endpoint_scope_wrong": "scope = 'CUT_PLUS_ENDPOINT' and not (endpoint_tiles > 0 and owner_tiles = 0)",
            "owner_scope_wrong": "scope = 'CUT_PLUS_ENDPOINT_AND_OWNER' and owner_tiles <= 0",
        },
    )


def preflight(matches: DataFrame, sources: DataFrame, disposed: DataFrame, facts: DataFrame, counts: DataFrame) -> DataFrame:
    """Catalogue, dispositions and audit must agree on ids, modes, overlaps and counts.

    matches: source_id, receiver_id, position, modes, x_m, progress_m.  sources:
    source_id, modes.  disposed: source_id, modes, max_x_m.  facts: source_id,
    receiver_id, progress_m of the independent disposition.  counts: counter, n.
    """
    c = F.col
    s = sources.select("source_id", c("modes").alias("s_modes"))
    d = disposed.select("source_id", c("modes").alias("d_modes"), "max_x_m")
    per = matches.groupBy("source_id").agg(F.count(F.lit(1)).alias("roads"), F.max("x_m").alias("now_max"))
    found = check(
        s.join(d, "source_id", "full_outer").join(per, "source_id", "left"),
        "source_id",
        {
            "not_disposed": "s_modes is not null and d_modes is null",
            "not_in_catalogue": "s_modes is null and d_modes is not null",
            "modes_differ": "s_modes <> d_modes",
            "no_receiver_road": "s_modes is not null and roads is null",
            "deviation_differs": "now_max <> max_x_m",
        },
    )
    f = facts.select("source_id", "receiver_id", c("progress_m").alias("f_progress"))
    rows = matches.join(f, ["source_id", "receiver_id"], "full_outer").join(d.select("source_id", "d_modes"), "source_id", "left")
    road = check(
        rows,
        "source_id",
        {
            "road_omitted": "position is null",
            "road_invented": "position is not null and f_progress is null",
            "overlap_differs": "progress_m <> f_progress",
            "modes_wider": f"(modes & ~d_modes) <> 0 or (modes & {AUTO_BIT | MOTORCYCLE_BIT}) = 0",
            "geometry_unsupported": f"not (x_m between 0 and {OVERLAP_MAX} and (progress_m >= {MIN_PROGRESS} or (progress_m >= {MIN_SHORT} and x_m <= {EXACT_MAX})))",
        },
    )
    now = sources.agg(F.lit("sources").alias("counter"), F.count(F.lit(1)).alias("now")).unionByName(
        matches.agg(F.lit("roads").alias("counter"), F.count(F.lit(1)).alias("now"))
    )
    total = check(now.join(counts, "counter", "left"), "counter", {"count_mismatch": "not (now <=> n)"})
    return union_all(found, road, total, repeated(matches, ["receiver_id"], c("receiver_id"), "receiver_repeated")).distinct()


def scan_audit(windows: DataFrame, edges: DataFrame) -> DataFrame:
    """Scan windows are unique, aligned and whole; edges are unique and typed.

    windows: side, window_index, bounds, complete, truncated, max_results,
    visited_tiles, visited_nodes, returned.  edges: side, graph_id, way_id, access
    masks, road_class, road_use, lat, lon, inner_lat, inner_lon.
    """
    c = F.col
    subject = F.concat_ws(":", "side", "window_index")
    w = check(
        windows,
        "concat_ws(':', side, window_index)",
        {
            "window_incomplete": "not coalesce(complete, false) or coalesce(truncated, true) or max_results is not null",
            "window_counts": "not coalesce(visited_tiles >= 0 and visited_nodes >= 0 and returned >= 0, false)",
            "window_unscanned": "visited_tiles < 1",
            "window_bounds": "not coalesce(-90 <= min_lat and min_lat < max_lat and max_lat <= 90 and -180 <= min_lon and min_lon < max_lon and max_lon <= 180, false)",
        },
    )
    box = ["min_lat", "max_lat", "min_lon", "max_lon"]
    twice = windows.groupBy("side", *box).agg(F.count(F.lit(1)).alias("n"), F.min("window_index").alias("window_index")).filter("n > 1")
    a = windows.filter("side = 'from'").select("window_index", F.struct(*box).alias("a"))
    b = windows.filter("side = 'to'").select("window_index", F.struct(*box).alias("b"))
    apart = a.join(b, "window_index", "full_outer").filter(~c("a").eqNullSafe(c("b")))
    e = check(
        edges,
        "concat_ws(':', side, graph_id)",
        {
            "edge_id": "not coalesce(graph_id > 0, false)",
            "way_id": "not coalesce(way_id > 0, false)",
            "access_mask": "not coalesce(forward_access between 0 and 4294967295 and reverse_access between 0 and 4294967295, false)",
            "edge_field": "not coalesce(road_class >= 0 and road_use >= 0, false)",
            "edge_point": "not coalesce(lat between -90 and 90 and lon between -180 and 180 and inner_lat between -90 and 90 and inner_lon between -180 and 180, false)",
        },
    )
    return union_all(
        w,
        twice.select(subject.alias("subject"), F.lit("window_repeated").alias("code")),
        apart.select(c("window_index").cast("string").alias("subject"), F.lit("windows_not_aligned").alias("code")),
        e,
        repeated(edges, ["side", "graph_id"], F.concat_ws(":", "side", "graph_id"), "edge_repeated"),
    )


def check_inventory(roads: DataFrame) -> DataFrame:
    """Boundary road anchors: identity, kinds, overlap, tags and forbidden fields.

    roads: pair_id, road_id, way_id, crossing_index, kind, lat, lon, heading,
    overlap_m, highway, vertices, graph_field (a graph-local field that leaked).
    """
    found = check(
        roads,
        "road_id",
        {
            "road_id": "not (coalesce(road_id, '') rlike '^fr-[0-9a-z]+$')",
            "way_id": "not coalesce(way_id > 0, false)",
            "crossing_index": "not coalesce(crossing_index >= 0, false)",
            "kind": "kind not in ('CROSSING', 'FRONTIER_OVERLAP')",
            "point": "not coalesce(lat between -90 and 90 and lon between -180 and 180, false)",
            "heading": "not coalesce(heading >= 0 and heading < 360, false)",
            "overlap_missing": "kind = 'FRONTIER_OVERLAP' and not coalesce(overlap_m > 0, false)",
            "overlap_forbidden": "kind = 'CROSSING' and overlap_m is not null",
            "highway_missing": "coalesce(trim(highway), '') = ''",
            "line_too_short": "not coalesce(vertices >= 2, false)",
            "graph_identity_leaked": "graph_field is not null",
        },
    )
    return union_all(
        found,
        repeated(roads, ["pair_id", "road_id"], F.col("road_id"), "road_repeated"),
        repeated(roads, ["pair_id", "way_id", "crossing_index"], F.concat_ws("#", "way_id", "crossing_index"), "crossing_index_repeated"),
    )


def check_correlations(sides: DataFrame, candidates: DataFrame) -> DataFrame:
    """Correlated road sides: contiguous ranks, same-way first, counts and status.

    sides: side_id, way_id, status, candidate_count, same_way_count, error.
    candidates: side_id, rank, way_id, way_match, distance_m, percent, heading.
    """
    c = F.col
    rows = candidates.join(sides.select("side_id", c("way_id").alias("stable_way")), "side_id", "left")
    rows = ranked_neighbours(rows, ["side_id"], "rank", F.struct("way_match"))
    found = check(
        rows,
        "side_id",
        {
            "rank_not_contiguous": RANK_BROKEN.format(rank="rank"),
            "way_match_wrong": "way_match <> (way_id <=> stable_way)",
            "same_way_not_first": "way_match and not prev.way_match",
            "percent": "percent < 0 or percent > 1",
            "distance": "not coalesce(distance_m >= 0, false)",
            "heading": "heading < 0 or heading >= 360",
        },
    )
    n = candidates.groupBy("side_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("way_match").alias("m"))
    total = check(
        sides.join(n, "side_id", "left"),
        "side_id",
        {
            "status": "status not in ('CORRELATED', 'NO_CANDIDATES', 'LOCATE_FAILED')",
            "candidate_count": "candidate_count <> coalesce(n, 0)",
            "same_way_count": "same_way_count <> coalesce(m, 0)",
            "correlated_empty": "status = 'CORRELATED' and candidate_count = 0",
            "empty_expected": "status <> 'CORRELATED' and candidate_count <> 0",
            "error_missing": "status = 'LOCATE_FAILED' and coalesce(trim(error), '') = ''",
            "error_forbidden": "status <> 'LOCATE_FAILED' and error is not null",
        },
    )
    return found.unionByName(total).distinct()


def check_candidates(pairs: DataFrame, candidates: DataFrame, unresolved: DataFrame) -> DataFrame:
    """Crossing candidates: evidence flags recomputed; resolved + unresolved = total.

    pairs: pair_id, road_count, candidate_count, validation_state.  candidates:
    pair_id, candidate_id, road_id, rank, tier, from/to way_id and way_match, three
    evidence flags, separation_m, heading_delta.  unresolved: pair_id, road_id.
    """
    c = F.col
    rows = ranked_neighbours(candidates, ["pair_id", "road_id"], "rank", F.struct("candidate_id"))
    found = check(
        rows,
        "candidate_id",
        {
            "tier": "not coalesce(tier between 0 and 4, false)",
            "rank_not_contiguous": RANK_BROKEN.format(rank="rank"),
            "both_match_wrong": "both_match <> (from_match and to_match)",
            "one_match_wrong": "one_match <> (from_match or to_match)",
            "same_way_wrong": "same_way <> coalesce(from_way_id = to_way_id, false)",
            "separation": "not coalesce(separation_m >= 0, false)",
            "heading_delta": "heading_delta < 0 or heading_delta > 180",
        },
    )
    key = ["pair_id", "road_id"]
    both = candidates.select(*key).distinct().join(unresolved.select(*key).distinct(), key, "left_semi")
    n_roads = candidates.select(*key).distinct().groupBy("pair_id").agg(F.count(F.lit(1)).alias("resolved"))
    total = pairs.join(n_roads, "pair_id", "left").join(_counts(unresolved, "pair_id", "open"), "pair_id", "left")
    total = total.join(_counts(candidates, "pair_id", "n"), "pair_id", "left")
    sums = check(
        total,
        "pair_id",
        {
            "candidate_count": "candidate_count <> coalesce(n, 0)",
            "road_count": "road_count <> coalesce(resolved, 0) + coalesce(open, 0)",
            "validation_state": "validation_state <> 'UNPROVEN'",
        },
    )
    return union_all(
        found,
        both.select(c("road_id").cast("string").alias("subject"), F.lit("resolved_and_unresolved").alias("code")),
        sums,
        repeated(candidates, ["pair_id", "candidate_id"], c("candidate_id"), "candidate_repeated"),
        repeated(unresolved, key, c("road_id"), "unresolved_repeated"),
    )


def check_proofs(legs: DataFrame, proofs: DataFrame, totals: DataFrame) -> DataFrame:
    """Proofs recomputed from leg to direction to state, and their totals.

    legs: proof_id, mode, direction, graph (A or B), status, expected_id, actual_id,
    edge_matched, error.  proofs: proof_id, pair_id, state, supported array.
    totals: pair_id, proven, rejected, inconclusive.
    """
    leg = check(
        legs,
        "proof_id",
        {
            "leg_status": "status not in ('PASSED', 'FAILED', 'ERROR')",
            "edge_match_wrong": "edge_matched <> coalesce(expected_id = actual_id, false)",
            "passed_with_error": "status = 'PASSED' and error is not null",
            "passed_without_match": "status = 'PASSED' and not edge_matched",
            "failed_without_error": "status <> 'PASSED' and coalesce(trim(error), '') = ''",
            "failed_with_match": "status <> 'PASSED' and edge_matched",
            "missing_id_not_error": "expected_id is null and status <> 'ERROR'",
        },
    )
    way = legs.groupBy("proof_id", "mode", "direction").agg(
        F.every(F.col("status") == "PASSED").alias("passed"), F.some(F.col("status") == "ERROR").alias("errored"), F.count(F.lit(1)).alias("n_legs")
    )
    name = F.concat_ws("_", "mode", "direction")
    per = way.groupBy("proof_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("passed") & (F.col("n_legs") == 2), name))).alias("want"),  # four at most
        F.some("errored").alias("errored"),
        F.count(F.lit(1)).alias("ways"),
    )
    state = F.expr("case when size(want) > 0 then 'PROVEN' when errored then 'INCONCLUSIVE' else 'REJECTED' end")
    rows = proofs.join(per, "proof_id", "left").withColumn("want_state", state)
    proof = check(
        rows,
        "proof_id",
        {
            "legs_missing": "coalesce(ways, 0) <> 4",
            "supported_wrong": "array_sort(supported) <> want",
            "supported_repeated": "size(array_distinct(supported)) <> size(supported)",
            "state_wrong": "state <> want_state",
        },
    )
    now = proofs.groupBy("pair_id").agg(*[F.count_if(F.col("state") == s.upper()).alias(f"now_{s}") for s in ("proven", "rejected", "inconclusive")])
    sums = check(
        totals.join(now, "pair_id", "left"),
        "pair_id",
        {f"{s}_count": f"{s} <> coalesce(now_{s}, 0)" for s in ("proven", "rejected", "inconclusive")},
    )
    return union_all(leg, proof, sums, repeated(proofs, ["proof_id"], F.col("proof_id"), "proof_repeated")).distinct()


def check_runtime(pairs: DataFrame, crossings: DataFrame, support: DataFrame) -> DataFrame:
    """Runtime crossings: a supported mode and direction has a metric, and only then.

    pairs: pair_id, crossing_count, support_count, candidate_count, proof_count.
    crossings: pair_id, crossing_id, pos, tier, rank, way_id.  support: crossing_id,
    pair_id, mode, direction, supported, km, seconds.
    """
    s = check(
        support,
        "crossing_id",
        {
            "metric_missing": "supported and not coalesce(km >= 0 and seconds >= 0, false)",
            "metric_forbidden": "not supported and (km is not null or seconds is not null)",
        },
    )
    key = F.struct("tier", "rank", "way_id", "crossing_id")
    rows = ranked_neighbours(crossings, ["pair_id"], "pos", key).join(_counts(support, "crossing_id", "n", "supported"), "crossing_id", "left")
    x = check(
        rows,
        "crossing_id",
        {"way_id": "not coalesce(way_id > 0, false)", "rank": "rank < 0 or tier < 0", "unsupported": "coalesce(n, 0) = 0", "order_broken": "prev > own"},
    )
    total = pairs.join(_counts(crossings, "pair_id", "n"), "pair_id", "left").join(_counts(support, "pair_id", "m", "supported"), "pair_id", "left")
    t = check(
        total,
        "pair_id",
        {
            "crossing_count": "crossing_count <> coalesce(n, 0)",
            "support_count": "support_count <> coalesce(m, 0)",
            "proof_count": "proof_count <> candidate_count",
            "more_than_candidates": "crossing_count > candidate_count",
        },
    )
    return union_all(s, x, t, repeated(crossings, ["pair_id", "crossing_id"], F.col("crossing_id"), "crossing_repeated"))


def check_anchors(regions: DataFrame, sources: DataFrame, anchors: DataFrame) -> DataFrame:
    """Connector anchors: references, roles and order.

    regions: region_id, anchor_count.  sources: region_id, pair_id, neighbour_id,
    sha256.  anchors: region_id, anchor_id, pos, way_id, candidate_id, neighbour_id,
    pair_id, roles_motorcycle, roles_car.
    """
    src = check(sources, "pair_id", {"source_sha": f"not (coalesce(sha256, '') rlike '{SHA}')", "neighbour_self": "neighbour_id <=> region_id"})
    known = sources.select("region_id", "pair_id").distinct().withColumn("known", F.lit(True))
    key = F.struct("neighbour_id", "way_id", "candidate_id", "anchor_id")
    rows = ranked_neighbours(anchors, ["region_id"], "pos", key).join(known, ["region_id", "pair_id"], "left")
    roles = "concat(roles_motorcycle, roles_car)"
    a = check(
        rows,
        "anchor_id",
        {
            "pair_unknown": "known is null",
            "neighbour_self": "neighbour_id <=> region_id",
            "way_id": "not coalesce(way_id > 0, false)",
            "role_unknown": f"exists({roles}, r -> r not in ('ENTRY', 'EXIT'))",
            "role_repeated": "size(array_distinct(roles_motorcycle)) <> size(roles_motorcycle) or size(array_distinct(roles_car)) <> size(roles_car)",
            "role_order": "array_sort(roles_motorcycle) <> roles_motorcycle or array_sort(roles_car) <> roles_car",
            "role_missing": f"size({roles}) = 0",
            "order_broken": "prev > own",
        },
    )
    total = check(regions.join(_counts(anchors, "region_id", "n"), "region_id", "left"), "region_id", {"anchor_count": "anchor_count <> coalesce(n, 0)"})
    return union_all(
        src,
        a,
        total,
        repeated(sources, ["region_id", "pair_id"], F.col("pair_id"), "source_repeated"),
        repeated(anchors, ["region_id", "anchor_id"], F.col("anchor_id"), "anchor_repeated"),
    )


def check_matrix(modes: DataFrame, cells: DataFrame, anchors: DataFrame) -> DataFrame:
    """Connector matrix: every pair present, field rules per status, counts.

    modes: region_id, mode, pair_count, reachable, unreachable, inconclusive.
    cells: region_id, mode, from_id, to_id, status, km, seconds, matrix_km,
    matrix_seconds, from_graph_id, to_graph_id, error.  anchors: region_id, mode,
    anchor_id, is_entry, is_exit.
    """
    c = F.col
    key = ["region_id", "mode"]
    entry = anchors.filter("is_entry").select(*key, c("anchor_id").alias("from_id")).distinct().withColumn("entry", F.lit(True))
    exits = anchors.filter("is_exit").select(*key, c("anchor_id").alias("to_id")).distinct().withColumn("exit", F.lit(True))
    rows = cells.join(entry, [*key, "from_id"], "left").join(exits, [*key, "to_id"], "left")
    found = check(
        rows,
        "concat_ws(':', region_id, mode, from_id, to_id)",
        {
            "from_not_entry": "entry is null",
            "to_not_exit": "exit is null",
            "self_pair": "from_id = to_id",
            "status": "status not in ('REACHABLE', 'UNREACHABLE', 'INCONCLUSIVE')",
            "reachable_fields": "status = 'REACHABLE' and (km is null or seconds is null or matrix_km is null or matrix_seconds is null or from_graph_id is null or to_graph_id is null or error is not null)",
            "unreachable_fields": "status = 'UNREACHABLE' and coalesce(km, seconds, matrix_km, matrix_seconds, from_graph_id, to_graph_id) is not null",
            "unreachable_error": "status = 'UNREACHABLE' and error is not null",
            "inconclusive_fields": "status = 'INCONCLUSIVE' and (km is not null or seconds is not null or matrix_km is null or matrix_seconds is null or coalesce(error, '') = '')",
        },
    )
    # The number of pairs follows from three counts, so no pair list is built.
    sizes = anchors.groupBy(*key).agg(
        F.count_if("is_entry").alias("e"), F.count_if("is_exit").alias("x"), F.count_if(c("is_entry") & c("is_exit")).alias("b")
    )
    now = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c("status") == s.upper()).alias(f"now_{s}") for s in ("reachable", "unreachable", "inconclusive")])
    total = check(
        modes.join(sizes, key, "left").join(now, key, "left"),
        "concat_ws(':', region_id, mode)",
        {
            "pair_count": "pair_count <> coalesce(e * x - b, 0) or pair_count <> coalesce(n, 0)",
            **{f"{s}_count": f"{s} <> coalesce(now_{s}, 0)" for s in ("reachable", "unreachable", "inconclusive")},
        },
    )
    return union_all(found, total, repeated(cells, [*key, "from_id", "to_id"], F.concat_ws(":", *key, "from_id", "to_id"), "cell_repeated"))


def check_chain_plan(plans: DataFrame, chains: DataFrame, hops: DataFrame, options: DataFrame) -> DataFrame:
    """Chain plan: no region twice, hops follow the regions, score and order.

    plans: plan_id, route_style, max_hops, from_region, to_region, status.  chains:
    plan_id, chain_id, rank, regions, score, km, seconds.  hops: chain_id, pos,
    from_region, to_region.  options: chain_id, hop_pos, candidate_id, rank, km,
    seconds, tier, source_rank, way_id, route_style.
    """
    c = F.col
    score = F.expr("case when route_style = 'FASTER' then seconds else km end")
    rows = chains.join(plans.select("plan_id", "route_style", "max_hops", "from_region", "to_region", "status"), "plan_id", "left")
    key = F.struct("score", F.size("regions"), "regions", "chain_id")
    rows = ranked_neighbours(rows.withColumn("want_score", score), ["plan_id"], "rank", key)
    rows = rows.join(_counts(hops, "chain_id", "n_hops"), "chain_id", "left")
    found = check(
        rows,
        "chain_id",
        {
            "region_cycle": "size(array_distinct(regions)) <> size(regions)",
            "hop_count": "coalesce(n_hops, 0) <> size(regions) - 1",
            "too_many_hops": "size(regions) - 1 > max_hops",
            "endpoints": "element_at(regions, 1) <> from_region or element_at(regions, -1) <> to_region",
            "rank": RANK_BROKEN.format(rank="rank"),
            "score": "score < 0 or abs(score - want_score) >= 1e-6",
            "order_broken": "prev > own",
            "unexpected_chain": "status = 'NO_CHAIN'",
        },
    )
    h = hops.join(chains.select("chain_id", "regions"), "chain_id", "left")
    hop = check(h, "chain_id", {"hop_regions": "not (from_region <=> get(regions, pos) and to_region <=> get(regions, pos + 1))"})
    okey = F.struct(score, "tier", "source_rank", "way_id", "candidate_id")
    o = ranked_neighbours(options, ["chain_id", "hop_pos"], "rank", okey)
    opt = check(o, "chain_id", {"option_rank": RANK_BROKEN.format(rank="rank"), "option_metric": "not coalesce(km >= 0 and seconds >= 0, false)", "option_order": "prev > own"})
    bare = hops.join(options.select("chain_id", c("hop_pos").alias("pos")).distinct(), ["chain_id", "pos"], "left_anti")
    none = plans.filter("status = 'FOUND'").join(chains.select("plan_id").distinct(), "plan_id", "left_anti")
    return union_all(
        found,
        hop,
        opt,
        bare.select(c("chain_id").cast("string").alias("subject"), F.lit("hop_without_option").alias("code")),
        none.select(c("plan_id").cast("string").alias("subject"), F.lit("found_without_chain").alias("code")),
        repeated(chains, ["chain_id"], c("chain_id"), "chain_repeated"),
    ).distinct()


def check_hierarchical_plan(chains: DataFrame, crossings: DataFrame, traversals: DataFrame, matrices: DataFrame) -> DataFrame:
    """Layered plan: traversal totals, anchor continuity and ranking key.

    chains: plan_id, chain_id, rank, regions, route_style, km, seconds, score.
    crossings: chain_id, pos, from_region, to_region, exit_anchor, entry_anchor.
    traversals: chain_id, pos, region_id, entry_anchor, exit_anchor, km, seconds.
    matrices: region_id.
    """
    sums = traversals.groupBy("chain_id").agg(F.sum("km").alias("sum_km"), F.sum("seconds").alias("sum_seconds"), F.count(F.lit(1)).alias("n_trav"))
    rows = chains.join(sums, "chain_id", "left").join(_counts(crossings, "chain_id", "n_cross"), "chain_id", "left")
    rows = rows.na.fill(0, ["n_trav", "n_cross"]).na.fill(0.0, ["sum_km", "sum_seconds"])
    second = F.expr("case when route_style = 'FASTER' then sum_km else sum_seconds end")
    key = F.struct("score", second, "n_cross", "chain_id")
    rows = ranked_neighbours(rows, ["plan_id"], "rank", key)
    found = check(
        rows,
        "chain_id",
        {
            "rank": RANK_BROKEN.format(rank="rank"),
            "region_cycle": "size(array_distinct(regions)) <> size(regions)",
            "crossing_count": "n_cross <> size(regions) - 1",
            "traversal_count": "n_trav <> greatest(0, size(regions) - 2)",
            "distance_total": "abs(km - sum_km) >= 1e-6",
            "time_total": "abs(seconds - sum_seconds) >= 1e-6",
            "score": "abs(score - case when route_style = 'FASTER' then sum_seconds else sum_km end) >= 1e-6",
            "order_broken": "prev > own",
        },
    )
    x = crossings.join(chains.select("chain_id", "regions"), "chain_id", "left")
    cross = check(x, "chain_id", {"crossing_regions": "not (from_region <=> get(regions, pos) and to_region <=> get(regions, pos + 1))"})
    into = crossings.select("chain_id", "pos", F.col("entry_anchor").alias("want_entry"))
    out = crossings.select("chain_id", (F.col("pos") - 1).alias("pos"), F.col("exit_anchor").alias("want_exit"))
    have = matrices.select("region_id").distinct().withColumn("matrix", F.lit(True))
    t = traversals.join(into, ["chain_id", "pos"], "left").join(out, ["chain_id", "pos"], "left").join(have, "region_id", "left")
    t = t.join(chains.select("chain_id", "regions"), "chain_id", "left")
    trav = check(
        t,
        "chain_id",
        {
            "traversal_region": "not (region_id <=> get(regions, pos + 1))",
            "region_without_matrix": "matrix is null",
            "entry_anchor": "not (entry_anchor <=> want_entry)",
            "exit_anchor": "not (exit_anchor <=> want_exit)",
            "traversal_metric": "not coalesce(km >= 0 and seconds >= 0, false)",
        },
    )
    return union_all(found, cross, trav, repeated(chains, ["chain_id"], F.col("chain_id"), "chain_repeated")).distinct()


def check_pair_metadata(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pair documents: identity, fingerprints, evidence; VALIDATED needs a valid proof.

    pairs: pair_id, from_region, to_region, versions, four fingerprints, binding_state,
    validation_state.  candidates: pair_id, candidate_id, from_region, to_region,
    evidence array, separation_m, states array (four proof states).
    """
    c = check(
        candidates.join(pairs.select("pair_id", F.col("from_region").alias("pf"), F.col("to_region").alias("pt")), "pair_id", "left"),
        "candidate_id",
        {
            "region_mismatch": "not (from_region <=> pf and to_region <=> pt)",
            "evidence_empty": "coalesce(size(evidence), 0) <= 0",
            "evidence_repeated": "size(array_distinct(evidence)) <> size(evidence)",
            "separation": "not coalesce(separation_m >= 0, false)",
            "proof_state": "coalesce(size(states), 0) <> 4 or exists(states, s -> s not in ('NOT_RUN', 'VALID', 'INVALID'))",
        },
    )
    has = candidates.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n"), F.some(F.expr("array_contains(states, 'VALID')")).alias("valid"))
    fps = {f"{s}_{k}_fingerprint": f"not (coalesce({s}_{k}_fp, '') rlike '{SHA}')" for s in ("from", "to") for k in ("graph", "boundary")}
    p = check(
        pairs.join(has, "pair_id", "left"),
        "pair_id",
        {
            "same_region": "from_region = to_region",
            "pair_id": "pair_id <> concat(from_region, '__', to_region)",
            "version_missing": "coalesce(trim(from_version), '') = '' or coalesce(trim(to_version), '') = ''",
            **fps,
            "binding_state": "binding_state <> 'STABLE_PHYSICAL'",
            "validation_state": "validation_state not in ('UNPROVEN', 'VALIDATED', 'STALE', 'REJECTED')",
            "validated_empty": "validation_state = 'VALIDATED' and coalesce(n, 0) = 0",
            "validated_without_proof": "validation_state = 'VALIDATED' and n > 0 and not coalesce(valid, false)",
        },
    )
    return union_all(c, p, repeated(candidates, ["pair_id", "candidate_id"], F.col("candidate_id"), "candidate_repeated"))


# --- refresh, publication and pack identity -------------------------------


def refresh_pairs(bound: DataFrame, current: DataFrame) -> DataFrame:
    """CURRENT / STALE / UNRESOLVED with action and reasons per bound pair.

    bound: pair_id and from_/to_ region, neighbour source, graph_fp, boundary_fp.
    current: region_id, graph_fp, boundaries map.
    """
    rows = bound
    for s in ("from", "to"):
        now = current.select(F.col("region_id").alias(f"{s}_region"), F.col("graph_fp").alias(f"{s}_now"), F.col("boundaries").alias(f"{s}_map"))
        rows = rows.join(now, f"{s}_region", "left").withColumn(f"{s}_live", F.try_element_at(f"{s}_map", F.col(f"{s}_neighbour")))
    tests = []
    for s in ("from", "to"):
        u = s.upper()
        gone = F.col(f"{s}_now").isNull()
        tests += [
            F.when(gone, f"{u}_GRAPH_MISSING").when(F.col(f"{s}_now") != F.col(f"{s}_graph_fp"), f"{u}_GRAPH_CHANGED"),
            F.when(~gone & F.col(f"{s}_live").isNull(), f"{u}_BOUNDARY_MISSING").when(
                ~gone & (F.col(f"{s}_live") != F.col(f"{s}_boundary_fp")), f"{u}_BOUNDARY_CHANGED"
            ),
        ]
    rows = rows.withColumn("reasons", F.array_compact(F.array(*tests)))
    missing = F.exists("reasons", lambda r: r.endswith("_GRAPH_MISSING"))
    edge = F.exists("reasons", lambda r: r.contains("BOUNDARY_"))
    status = F.when(missing, "UNRESOLVED").when(F.size("reasons") > 0, "STALE").otherwise("CURRENT")
    action = F.when(missing, "WAIT_FOR_GRAPH").when(edge, "REDISCOVER_BOUNDARY").when(F.size("reasons") > 0, "REBIND_GRAPH").otherwise("NONE")
    return rows.select("pair_id", status.alias("status"), action.alias("action"), "reasons")


def refresh_connectors(regions: DataFrame, inventories: DataFrame, sources: DataFrame, matrices: DataFrame) -> DataFrame:
    """One of five actions per region from presence and currency of both documents.

    regions: region_id, graph_fp, boundaries map.  inventories: region_id, sha256,
    graph_fp, anchor_count.  sources: sha256 of the inventory, neighbour, boundary_fp.
    matrices: region_id, graph_fp, source_sha256, anchor_count.
    """
    now = regions.select("region_id", F.col("graph_fp").alias("now_fp"), "boundaries")
    inv = inventories.join(now, "region_id")
    src = sources.join(inv.select("sha256", "boundaries"), "sha256")
    fresh = src.groupBy("sha256").agg(
        F.every(F.coalesce(F.try_element_at("boundaries", F.col("neighbour")) == F.col("boundary_fp"), F.lit(False))).alias("edges_ok")
    )
    inv = inv.join(fresh, "sha256", "left").withColumn(
        "inv_current", F.col("graph_fp").eqNullSafe(F.col("now_fp")) & F.coalesce("edges_ok", F.lit(True))
    )
    per_inv = inv.groupBy("region_id").agg(F.some("inv_current").alias("inv_current"))
    mine = inv.select(F.col("sha256").alias("source_sha256"), F.col("anchor_count").alias("inv_anchors"), F.col("inv_current").alias("src_current"))
    mat = matrices.join(now.select("region_id", "now_fp"), "region_id").join(mine, "source_sha256", "left")
    ok = F.col("graph_fp").eqNullSafe(F.col("now_fp")) & F.coalesce("src_current", F.lit(False)) & F.col("anchor_count").eqNullSafe(F.col("inv_anchors"))
    per_mat = mat.groupBy("region_id").agg(F.some(ok).alias("mat_current"))
    rows = regions.select("region_id").join(per_inv, "region_id", "left").join(per_mat, "region_id", "left")
    action = (
        F.when(F.col("inv_current").isNull(), "BUILD_INVENTORY_AND_MATRIX")
        .when(~F.col("inv_current"), "REBUILD_INVENTORY_AND_MATRIX")
        .when(F.col("mat_current").isNull(), "BUILD_MATRIX")
        .when(~F.col("mat_current"), "REBUILD_MATRIX")
        .otherwise("NONE")
    )
    status = F.when(action == "NONE", "CURRENT").when(F.startswith(action, F.lit("BUILD_")), "MISSING").otherwise("STALE")
    return rows.select("region_id", status.alias("status"), action.alias("action"))


def refresh_layers(manifests: DataFrame, current: DataFrame) -> DataFrame:
    """Refresh action of each map pack, first changed input wins.

    manifests: region_id, source_fp, profile_fp, layer_fp and index_* (NULL when no
    road index).  current: region_id, source_fp, profile_fp, classes, tolerance.
    """
    now = current.select("region_id", *[F.col(c).alias(f"now_{c}") for c in ("source_fp", "profile_fp", "classes", "tolerance")])
    rows = manifests.join(now, "region_id")
    same = F.coalesce(
        F.expr(
            "array_sort(index_classes) = array_sort(now_classes) and index_tolerance = now_tolerance and index_source_fp = source_fp and index_layer_fp = layer_fp and index_missing = 0"
        ),
        F.lit(False),
    )
    reason = (
        F.when(~F.col("source_fp").eqNullSafe(F.col("now_source_fp")), "SOURCE_CHANGED")
        .when(~F.col("profile_fp").eqNullSafe(F.col("now_profile_fp")), "PROFILE_CHANGED")
        .when(F.col("index_source_fp").isNull(), "ROAD_INDEX_MISSING")
        .when(~same, "ROAD_VALIDATION_CHANGED")
    )
    action = (
        F.when(reason == "SOURCE_CHANGED", "REBUILD_SOURCE").when(reason == "PROFILE_CHANGED", "REBUILD_PROFILE").when(reason.isNotNull(), "REVALIDATE_ROADS").otherwise("NONE")
    )
    return rows.select("region_id", action.alias("action"), reason.alias("reason"))


def publish_plan(manifests: DataFrame, files: DataFrame) -> DataFrame:
    """Release row per region and version: sorted objects, keys and release hash.

    manifests: kind, prefix, region_id, version, built_at.  files: region_id,
    version, role, file_name, size_bytes, sha256.  A release has a few files.
    """
    root = F.concat_ws("/", "prefix", "region_id", "version")
    rows = files.join(manifests, ["region_id", "version"])
    item = F.struct("role", F.concat_ws("/", root, "file_name").alias("key"), "size_bytes", "sha256")
    rel = rows.groupBy("kind", "prefix", "region_id", "version", "built_at").agg(F.array_sort(F.collect_list(item)).alias("objects"))
    text = F.array_join(F.transform("objects", lambda o: F.concat_ws(",", o["role"], o["key"], o["size_bytes"], o["sha256"])), ";")
    body = canonical_json(kind=F.col("kind"), regionId=F.col("region_id"), version=F.col("version"), builtAt=F.col("built_at"), prefix=root, objects=text)
    return rel.select(
        "kind",
        "region_id",
        "version",
        "built_at",
        "objects",
        F.concat_ws("/", root, F.lit("release.json")).alias("release_key"),
        F.concat_ws("/", "prefix", "region_id", F.lit("latest.json")).alias("latest_key"),
        F.concat(F.lit("sha256:"), F.sha2(body, 256)).alias("release_sha256"),
    )


def publish_plan_audit(plans: DataFrame, published: DataFrame, sources: DataFrame) -> DataFrame:
    """Plan rules: keys below the prefix, unique, source equal to published, hash.

    plans: plan_id, prefix, release_key, latest_key, release_sha256, computed_sha256,
    latest_release_key, latest_sha256.  published / sources: plan_id, key, role,
    file_name, size_bytes, sha256, content_type.
    """
    top = check(
        plans,
        "plan_id",
        {
            "release_key": "release_key <> concat(prefix, '/release.json')",
            "latest_inside_prefix": "latest_key like concat(prefix, '/%')",
            "release_sha": "release_sha256 <> computed_sha256",
            "latest_release_key": "latest_release_key <> release_key",
            "latest_sha": "latest_sha256 <> release_sha256",
        },
    )
    keys = check(published.join(plans.select("plan_id", "prefix"), "plan_id"), "key", {"key_outside_prefix": "not (key like concat(prefix, '/%'))", "key_unsafe": "key like '%..%' or key like '/%'"})
    cols = ["role", "file_name", "size_bytes", "sha256", "content_type"]
    a = published.select("plan_id", "key", *[F.col(c).alias(f"p_{c}") for c in cols]).withColumn("in_p", F.lit(True))
    b = sources.select("plan_id", "key", *[F.col(c).alias(f"s_{c}") for c in cols]).withColumn("in_s", F.lit(True))
    rules = {"not_published": "in_p is null", "no_source": "in_s is null"}
    rules |= {f"{c}_mismatch": f"in_p and in_s and not (p_{c} <=> s_{c})" for c in cols}
    pair = check(a.join(b, ["plan_id", "key"], "full_outer"), "key", rules)
    return union_all(top, keys, pair, repeated(published, ["plan_id", "key"], F.col("key"), "key_repeated"), repeated(sources, ["plan_id", "key"], F.col("key"), "source_repeated")).distinct()


def publish_reconcile(plan: DataFrame, store: DataFrame) -> DataFrame:
    """CREATE / CONFIRM / CONFLICT per object; the pointer moves only without conflict.

    plan: plan_id, key, size_bytes, sha256.  store: key, size_bytes, sha256.
    """
    have = store.select("key", F.col("size_bytes").alias("h_size"), F.col("sha256").alias("h_sha"))
    rows = plan.join(have, "key", "left")
    same = F.col("h_size").eqNullSafe(F.col("size_bytes")) & F.col("h_sha").eqNullSafe(F.col("sha256"))
    rows = rows.withColumn("action", F.when(F.col("h_sha").isNull(), "CREATE").when(same, "CONFIRM").otherwise("CONFLICT"))
    free = rows.groupBy("plan_id").agg(F.every(F.col("action") != "CONFLICT").alias("pointer_may_move"))
    return rows.select("plan_id", "key", "action").join(free, "plan_id")


def activate_release(releases: DataFrame, objects: DataFrame, store: DataFrame) -> DataFrame:
    """Pointer row of each release whose objects are all present and equal.

    releases: release_key, prefix, region_id, version, kind, built_at, release_sha256.
    objects: release_key, key, size_bytes, sha256.
    """
    same = objects.join(store.select("key", "size_bytes", "sha256"), ["key", "size_bytes", "sha256"], "left_anti")
    bad = same.select("release_key").distinct()
    ready = releases.filter(F.col("release_key") == F.concat(F.col("prefix"), F.lit("/release.json"))).join(bad, "release_key", "left_anti")
    latest = F.concat(F.regexp_replace("prefix", "/[^/]+$", ""), F.lit("/latest.json"))
    return ready.select(latest.alias("latest_key"), "release_key", "release_sha256", "region_id", "version", "kind", "built_at")


def check_graph_pack(manifests: DataFrame, tiles: DataFrame, sources: DataFrame, routes: DataFrame) -> DataFrame:
    """Graph pack: artifact identity, tile count, sources and recorded routes.

    manifests: pack_id, file_name, size_bytes, sha256, tile_count, graph_fp, buffer_km,
    actual_size, actual_sha256.  tiles: pack_id, path.  sources: pack_id, source_id,
    size_bytes, sha256.  routes: pack_id, kind, passed.
    """
    rows = manifests.join(_counts(tiles, "pack_id", "n_tiles", "path like '%.gph'"), "pack_id", "left").join(_counts(sources, "pack_id", "n_sources"), "pack_id", "left")
    for name, cond in (("n_routes", "true"), ("n_border", "kind = 'border' and passed"), ("n_failed", "not coalesce(passed, false)")):
        rows = rows.join(_counts(routes, "pack_id", name, cond), "pack_id", "left")
    found = check(
        rows,
        "pack_id",
        {
            "file_name": "not (coalesce(file_name, '') like '%.tar')",
            "integrity_incomplete": "not coalesce(size_bytes > 0 and tile_count > 0 and sha256 rlike '^[0-9a-f]{64}$', false)",
            "graph_fingerprint": "not (graph_fp <=> concat('sha256:', sha256))",
            "size_mismatch": "not (size_bytes <=> actual_size)",
            "sha_mismatch": "not (sha256 <=> actual_sha256)",
            "tile_count": "tile_count <> coalesce(n_tiles, 0)",
            "buffer": "not coalesce(buffer_km > 0, false)",
            "sources_missing": "coalesce(n_sources, 0) = 0",
            "routes_missing": "coalesce(n_routes, 0) = 0",
            "border_route_missing": "coalesce(n_border, 0) = 0",
            "route_failed": "coalesce(n_failed, 0) > 0",
        },
    )
    src = check(sources, "pack_id", {"source_size": "not coalesce(size_bytes > 0, false)", "source_sha": "not (coalesce(sha256, '') rlike '^[0-9a-f]{64}$')"})
    return union_all(found, src).distinct()


def identity_audit(pairs: DataFrame, manifests: DataFrame) -> DataFrame:
    """Region, version, graph and boundary fingerprints of a pair still current.

    pairs: pair_id and from_/to_ region, version, graph_fp, boundary_fp, boundary_source.
    manifests: region_id, version, graph_fp, source_id, boundaries map.
    """
    rows = pairs
    for s in ("from", "to"):
        m = manifests.select(
            F.col("region_id").alias(f"{s}_region"), F.col("version").alias(f"{s}_m_version"), F.col("graph_fp").alias(f"{s}_m_graph"),
            F.col("source_id").alias(f"{s}_m_source"), F.col("boundaries").alias(f"{s}_m_bounds"),
        )
        rows = rows.join(m, f"{s}_region", "left")
    rules = {}
    for s, other in (("from", "to"), ("to", "from")):
        here = f"{s}_m_graph is not null"
        rules |= {
            f"{s}_graph_missing": f"{s}_m_graph is null",
            f"{s}_version_stale": f"{here} and not ({s}_version <=> {s}_m_version)",
            f"{s}_graph_stale": f"{here} and not ({s}_graph_fp <=> {s}_m_graph)",
            f"{s}_boundary_stale": f"{here} and not ({s}_boundary_fp <=> try_element_at({s}_m_bounds, {s}_boundary_source))",
            f"{s}_source_mismatch": f"{here} and not ({s}_m_source <=> {other}_boundary_source)",
        }
    return check(rows, "pair_id", rules)


def check_layer_pack(manifests: DataFrame, indexes: DataFrame, observed: DataFrame, forbidden: list[str]) -> DataFrame:
    """Map pack: manifest, road index and artifact agree; no required road missing.

    manifests: pack_id, region_id, version, source_fp, layer_fp, size_bytes, sha256,
    actual_size, actual_sha256, tile_count, min_zoom, max_zoom, layers, required,
    road_count, missing_count.  indexes: pack_id, region_id, version, source_fp,
    layer_fp, road_count, missing_count.  observed: pack_id, layers, tiles, min_zoom, max_zoom.
    """
    i = indexes.select("pack_id", *[F.col(c).alias(f"i_{c}") for c in ("region_id", "version", "source_fp", "layer_fp", "road_count", "missing_count")])
    o = observed.select("pack_id", F.col("layers").alias("o_layers"), F.col("tiles").alias("o_tiles"), F.col("min_zoom").alias("o_min"), F.col("max_zoom").alias("o_max"))
    rows = manifests.join(i, "pack_id", "left").join(o, "pack_id", "left")
    names = ", ".join(f"'{f}'" for f in forbidden)
    rules = {
        "size_mismatch": "not (size_bytes <=> actual_size)",
        "sha_mismatch": "not (sha256 <=> actual_sha256)",
        "layer_fingerprint": "not (layer_fp <=> concat('sha256:', sha256))",
        "required_not_declared": "size(array_except(required, layers)) > 0",
        "forbidden_declared": f"size(array_intersect(layers, array({names}))) > 0",
        "artifact_missing": "o_layers is null",
        "tile_count": "tile_count <> o_tiles",
        "zoom_range": "min_zoom <> o_min or max_zoom <> o_max",
        "layer_not_recorded": "size(array_except(o_layers, layers)) > 0",
        "forbidden_in_artifact": f"size(array_intersect(o_layers, array({names}))) > 0",
        "roads_missing": "i_missing_count <> 0",
    }
    rules |= {f"index_{c}": f"i_region_id is not null and not ({c} <=> i_{c})" for c in ("region_id", "version", "source_fp", "layer_fp", "road_count", "missing_count")}
    return check(rows, "pack_id", rules)
