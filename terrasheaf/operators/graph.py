"""Directed road graphs: peers, scans, adjacency, terminals, bounded hops.

An edge row has graph_id, way_id, lat, lon (start), inner_lat, inner_lon,
forward_access, reverse_access, ...  An adjacency row describes the end node of
one edge: source_id, end_node, opposing_id, deadend, way_id, forward_access,
end_lat, end_lon and ``outgoing``, an array bounded by the degree of the node.
The directed id is the only identity; nothing is merged by way, name or place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import AUTO_BIT, MODES, MOTORCYCLE_BIT, planar_m, tile_id
from ..functions.ids import stable_id
from ..session import cut_lineage, stage, stage_by
from .rules import repeated, union_all, violations

# Id prefixes of the two ledgers.
PEER_PREFIX = "nf8peer-"
PROPOSAL_PREFIX = "nf8gps-"

# Bounds of the hop searches.
MAX_HOPS, MAX_VISITS, MAX_FANOUT = 10, 4096, 64

PHYSICAL_KEY = ["way_id", "k_lat", "k_lon", "k_inner_lat", "k_inner_lon"]


def drivable_edges(edges: DataFrame, modes: int = AUTO_BIT | MOTORCYCLE_BIT) -> DataFrame:
    """Road or ferry edges a vehicle may use whose inner point is a metre away."""
    access = F.col("forward_access").bitwiseOR(F.col("reverse_access")).bitwiseAND(F.lit(modes))
    return edges.filter(
        ~F.col("is_shortcut")
        & ~F.col("is_transit")
        & (F.col("is_road") | F.col("is_ferry"))
        & (access != 0)
        & (F.col("way_id") != 0)
        & (planar_m(F.col("lat"), F.col("lon"), F.col("inner_lat"), F.col("inner_lon")) >= 1.0)
    )


def physical_key(edges: DataFrame) -> DataFrame:
    """Add the exact six-decimal key (ties to even): way, start and inner point."""
    return edges.withColumns(
        {f"k_{c}": F.rint(F.col(c) * 1000000).cast("long") for c in ("lat", "lon", "inner_lat", "inner_lon")}
    )


def physical_peers(a: DataFrame, b: DataFrame, pair_id: str, from_fp: str, to_fp: str) -> DataFrame:
    """Every pair of edges of the two graphs with the same physical key."""
    left = physical_key(a).select(*PHYSICAL_KEY, F.col("graph_id").alias("from_graph_id"))
    right = physical_key(b).select(*PHYSICAL_KEY, F.col("graph_id").alias("to_graph_id"))
    ident = stable_id(
        PEER_PREFIX, F.lit(pair_id), F.lit(from_fp), F.lit(to_fp), F.col("from_graph_id"), F.col("to_graph_id")
    )
    return left.join(right, PHYSICAL_KEY).select(ident.alias("id"), "way_id", "from_graph_id", "to_graph_id")


def unpaired_edges(a: DataFrame, b: DataFrame) -> DataFrame:
    """Edges without a peer on the other side; kept, never rejected."""
    ka, kb = physical_key(a), physical_key(b)

    def alone(mine: DataFrame, other: DataFrame, side: str) -> DataFrame:
        rest = mine.join(other.select(*PHYSICAL_KEY).distinct(), PHYSICAL_KEY, "left_anti")
        return rest.select(F.lit(side).alias("side"), "graph_id", "way_id")

    return alone(ka, kb, "from").unionByName(alone(kb, ka, "to"))


def peer_members(origin: DataFrame) -> DataFrame:
    """Peer groups of a graph, one row per member; the group id names its key."""
    return physical_key(origin).select(stable_id("key-", *[F.col(c) for c in PHYSICAL_KEY]).alias("peer_group"), "graph_id")


def crossing_proposals(receiver: DataFrame, origin: DataFrame, pair_id: str, from_fp: str, to_fp: str, direction: str) -> DataFrame:
    """One proposal per receiver edge, with or without peers in the other graph.

    Peers are named by group: :func:`peer_members` lists every origin edge of the
    group once, so a key with many copies on both sides stays linear in size.
    """
    sizes = peer_members(origin).groupBy("peer_group").agg(F.count(F.lit(1)).alias("peer_count"))
    rows = physical_key(receiver).withColumn("peer_group", stable_id("key-", *[F.col(c) for c in PHYSICAL_KEY]))
    ident = stable_id(
        PROPOSAL_PREFIX, F.lit(pair_id), F.lit(from_fp), F.lit(to_fp), F.lit(direction), F.col("graph_id")
    )
    return rows.join(sizes, "peer_group", "left").select(
        ident.alias("id"),
        F.lit(direction).alias("direction"),
        F.col("graph_id").alias("receiver_graph_id"),
        F.col("way_id").alias("receiver_way_id"),
        F.col("inner_lat").alias("lat"),
        F.col("inner_lon").alias("lon"),
        "peer_group",
        F.coalesce("peer_count", F.lit(0)).alias("peer_count"),
    )


def endpoint_join(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """Violations of the one-to-one match of edges and endpoint rows."""
    e = edges.select("graph_id", "way_id", "forward_access", "reverse_access").withColumn("in_edges", F.lit(True))
    n = ends.select(
        F.col("source_id").alias("graph_id"),
        F.col("way_id").alias("n_way"),
        F.col("forward_access").alias("n_fwd"),
        F.col("reverse_access").alias("n_rev"),
    ).withColumn("in_ends", F.lit(True))
    both = e.join(n, "graph_id", "full_outer")
    matched = F.col("in_edges") & F.col("in_ends")
    rules = {
        "endpoint_missing": F.col("in_ends").isNull(),
        "edge_missing": F.col("in_edges").isNull(),
        "way_mismatch": matched & ~F.col("way_id").eqNullSafe(F.col("n_way")),
        "access_mismatch": matched
        & ~(F.col("forward_access").eqNullSafe(F.col("n_fwd")) & F.col("reverse_access").eqNullSafe(F.col("n_rev"))),
    }
    found = violations(both, [F.col("graph_id").cast("string").alias("subject")], rules).distinct()
    return union_all(
        found,
        repeated(edges, ["graph_id"], F.col("graph_id"), "edge_repeated"),
        repeated(ends, ["source_id"], F.col("source_id"), "endpoint_repeated"),
    )


def distinct_scan(window_edges: DataFrame) -> DataFrame:
    """One row per edge over all windows; the last window wins."""
    cols = [c for c in window_edges.columns if c != "graph_id"]
    last = window_edges.groupBy("graph_id").agg(F.max_by(F.struct(*cols), F.col("window_index")).alias("r"))
    return last.select("graph_id", *[F.col(f"r.{c}").alias(c) for c in cols])


def scan_windows(window_edges: DataFrame, windows: DataFrame) -> DataFrame:
    """Per window: returned edges and whether any tile was visited."""
    n = window_edges.groupBy("window_index").agg(F.count(F.lit(1)).alias("returned"))
    return windows.join(n, "window_index", "left").select(
        "window_index", F.coalesce("returned", F.lit(0)).alias("returned"), (F.col("visited_tiles") > 0).alias("complete")
    )


def _continues(bit: int) -> Column:
    return F.exists(
        "outgoing",
        lambda o: (o["graph_id"] != F.col("opposing_id")) & (o["forward_access"].bitwiseAND(F.lit(bit)) != 0),
    )


def terminal_census(adjacency: DataFrame) -> DataFrame:
    """Per usable edge and mode: CONTINUES, TERMINAL (dead end) or STRANDED.

    Every answer lies in the row itself, so nothing is shuffled.
    """
    per_mode = F.array(
        *[
            F.when(
                F.col("forward_access").bitwiseAND(F.lit(bit)) != 0,
                F.struct(
                    F.lit(mode).alias("mode"),
                    F.when(_continues(bit), "CONTINUES").when(F.col("deadend"), "TERMINAL").otherwise("STRANDED").alias("status"),
                ),
            )
            for mode, bit in MODES.items()
        ]
    )
    return adjacency.select(
        F.col("source_id").alias("graph_id"),
        "end_node",
        "way_id",
        "end_lat",
        "end_lon",
        F.explode(F.array_compact(per_mode)).alias("m"),
    ).select("*", "m.mode", "m.status").drop("m")


def census_counts(census: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Counters of a census as (mode, counter, n) rows."""
    per_mode = census.groupBy("mode").agg(
        F.count(F.lit(1)).alias("usable"),
        F.count_if(F.col("status") == "TERMINAL").alias("terminal"),
        F.count_if(F.col("status") == "STRANDED").alias("stranded"),
    )
    total = adjacency.agg(
        F.lit("all").alias("mode"), F.count(F.lit(1)).alias("audited"), F.count_if(F.col("deadend")).alias("deadends")
    )

    def long(df: DataFrame, names: list[str]) -> DataFrame:
        return df.unpivot("mode", names, "counter", "n")

    return long(per_mode, ["usable", "terminal", "stranded"]).unionByName(long(total, ["audited", "deadends"]))


def final_edge_register(terminals: DataFrame) -> DataFrame:
    """One row per directed id with its modes; conflicting views are flagged.

    ``terminals``: graph_id, end_node, end_lat, end_lon, inside_peer, mode, status.
    """
    view = ["end_node", "end_lat", "end_lon", "inside_peer"]
    out = terminals.groupBy("graph_id").agg(
        F.array_sort(F.collect_set("mode")).alias("modes"),  # two modes at most
        *[F.min(c).alias(c) for c in view],
        *[F.max(c).alias(f"max_{c}") for c in view],
        F.min("status").alias("status"),
        F.max("status").alias("max_status"),
    )
    same = F.lit(True)
    for c in [*view, "status"]:
        same = same & F.col(c).eqNullSafe(F.col(f"max_{c}"))
    return out.select("graph_id", "modes", *view, "status", (~same).alias("conflicting"))


def options_by_node(edges: DataFrame) -> DataFrame:
    """(end_node, outgoing): the edges that leave a node, gathered once for all that end there.

    The array is bounded by the degree of the node.
    """
    option = F.struct(F.col("graph_id").alias("option_id"), F.col("forward_access").alias("option_access"))
    return edges.filter("start_node is not null").groupBy(F.col("start_node").alias("end_node")).agg(F.collect_list(option).alias("outgoing"))


def terminal_modes(sources: DataFrame, options: DataFrame) -> DataFrame:
    """Modes that end at an edge: access without the OR of all outgoing access.

    ``options``: source_id, option_id, option_access, ... one row per outgoing edge.  Or, as
    :func:`options_by_node` gives them, one row per node with all edges that leave it: sources
    have end_node and opposing_id then, and the reverse edge is no option.
    """
    if "outgoing" in options.columns:
        own = F.filter("outgoing", lambda o: o["option_id"] != F.col("opposing_id"))
        access = F.aggregate(own, F.lit(0).cast("long"), lambda acc, o: acc.bitwiseOR(F.coalesce(o["option_access"], F.lit(0).cast("long"))))
        return sources.join(options, "end_node", "left").withColumn(
            "terminal_modes", F.col("access").bitwiseAND(F.bitwise_not(F.coalesce(access, F.lit(0).cast("long"))))
        ).drop("outgoing")
    out = options.groupBy(F.col("source_id").alias("graph_id")).agg(F.bit_or("option_access").alias("outgoing_access"))
    return sources.join(out, "graph_id", "left").withColumn(
        "terminal_modes", F.col("access").bitwiseAND(F.bitwise_not(F.coalesce("outgoing_access", F.lit(0).cast("long"))))
    )


def cut_roots(cut: DataFrame) -> DataFrame:
    return cut.filter(F.col("orientation").isin("OUTWARD", "AMBIGUOUS"))


def _pending(roots: DataFrame) -> DataFrame:
    return roots.withColumn("pending", F.col("access").bitwiseAND(F.bitwise_not("terminal_modes"))).filter(F.col("pending") != 0)


def root_options(roots: DataFrame, options: DataFrame, tiles: DataFrame) -> DataFrame:
    """Immediate successors of the roots that still continue, with their eligibility."""
    o = options.withColumnRenamed("source_id", "graph_id").withColumn("tile", tile_id(F.col("option_id")))
    scoped = tiles.select(F.col("tile_id").alias("tile")).distinct().withColumn("in_scope", F.lit(True))
    rows = _pending(roots).select(F.col("graph_id"), "access", "pending").join(o, "graph_id").join(scoped, "tile", "left")
    eligible = (F.col("option_access").bitwiseAND(F.col("pending")) != 0) & ~F.col("shortcut") & ~F.col("transit")
    return rows.withColumnRenamed("graph_id", "root_id").withColumns(
        {"eligible": eligible, "in_scope": F.coalesce("in_scope", F.lit(False))}
    )


def one_hop_terminals(roots: DataFrame, options: DataFrame, sources: DataFrame, tiles: DataFrame, scope: DataFrame) -> DataFrame:
    """(terminal_id, root_id, modes): successors that end in the receiving area.

    Successors are looked at once and never followed.  ``sources`` carries the
    terminal modes of every edge, ``scope`` the ids whose end lies in the area.
    """
    return _hop_terminals(root_options(roots, options, tiles), sources, scope)


def _hop_terminals(opts: DataFrame, sources: DataFrame, scope: DataFrame) -> DataFrame:
    """The options of :func:`root_options` that end in the receiving area."""
    hops = opts.filter(F.col("eligible") & F.col("in_scope"))
    ends = sources.filter(F.col("terminal_modes") != 0).select(F.col("graph_id").alias("option_id"), F.col("terminal_modes").alias("available"))
    reached = hops.join(ends, "option_id").join(scope.select(F.col("graph_id").alias("option_id")), "option_id", "left_semi")
    modes = F.col("available").bitwiseAND(F.col("pending"))
    return reached.select(F.col("option_id").alias("terminal_id"), "root_id", modes.alias("modes")).filter(F.col("modes") != 0)


def terminal_links(roots: DataFrame, options: DataFrame, sources: DataFrame, tiles: DataFrame, scope: DataFrame) -> DataFrame:
    """Direct and one-hop terminal links with their kind."""
    return _links(roots, one_hop_terminals(roots, options, sources, tiles, scope))


def _links(roots: DataFrame, hop: DataFrame) -> DataFrame:
    direct = roots.filter(F.col("terminal_modes") != 0).select(
        F.col("graph_id").alias("terminal_id"),
        F.col("graph_id").alias("root_id"),
        F.col("terminal_modes").alias("modes"),
        F.lit("NATIVE_TERMINAL_AT_SHARED_CUT").alias("kind"),
    )
    return direct.unionByName(hop.withColumn("kind", F.lit("NATIVE_TERMINAL_ONE_IMMEDIATE_HOP_UNPROVEN")))


def mode_union(links: DataFrame) -> DataFrame:
    """One row per terminal: merged modes, kinds and number of cut roots."""
    return links.groupBy("terminal_id").agg(
        F.bit_or("modes").alias("modes"),
        F.array_sort(F.collect_set("kind")).alias("kinds"),  # a handful of kinds exist
        F.count_distinct("root_id").alias("root_count"),
    )


def select_terminals(roots: DataFrame, options: DataFrame, sources: DataFrame, tiles: DataFrame, scope: DataFrame) -> DataFrame:
    """Structural status of every root that continues past the cut.

    The options of the roots are worked out and written once, laid out by root;
    links are few, so they are written once too.
    """
    opts = stage_by(root_options(roots, options, tiles).select("root_id", "option_id", "pending", "eligible", "in_scope"), "root-options", "root_id")
    links = stage(_links(roots, _hop_terminals(opts, sources, scope)).select("terminal_id", "root_id", "modes"), "root-links")
    merged = links.groupBy("terminal_id").agg(F.bit_or("modes").alias("merged_modes"))
    per_root = opts.groupBy("root_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("option_id").alias("only_option"),
        F.bool_or("eligible").alias("any_eligible"),
    )
    rows = _pending(roots).select(F.col("graph_id").alias("root_id"), "pending").join(per_root, "root_id", "left")
    rows = rows.join(merged.withColumnRenamed("terminal_id", "only_option"), "only_option", "left")
    own = links.select(F.col("terminal_id").alias("only_option"), "root_id").distinct().withColumn("linked", F.lit(True))
    rows = rows.join(own, ["only_option", "root_id"], "left")
    single = (
        (F.col("n") == 1)
        & F.col("any_eligible")
        & (F.col("only_option") != F.col("root_id"))
        & (F.col("pending").bitwiseAND(F.bitwise_not("merged_modes")) == 0)
        & F.col("linked")
    )
    single = F.coalesce(single, F.lit(False))
    status = (
        F.when(single, "SINGLE_IMMEDIATE_NATIVE_TERMINAL")
        .when(F.col("n") > 1, "MULTIPLE_NATIVE_OUTGOING_UNRESOLVED")
        .otherwise("SINGLE_NATIVE_OUTGOING_UNRESOLVED")
    )
    return rows.select(
        "root_id",
        status.alias("structural_status"),
        F.when(single, F.col("only_option")).alias("unique_terminal_id"),
        F.when(single, F.col("pending")).otherwise(F.lit(0)).alias("verified_modes"),
    )


def coincidence_groups(terminals: DataFrame) -> DataFrame:
    """Members of groups that share an end node or the exact end point.

    One row per member, so a group of any size is spread over tasks; groups are
    flagged and never merged.
    """

    def members(kind: str, keys: list[str]) -> DataFrame:
        big = terminals.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size")).filter(F.col("group_size") > 1)
        key = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
        return terminals.join(big, keys).select(F.lit(kind).alias("kind"), key.alias("group_key"), "terminal_id", "group_size")

    return members("END_NODE", ["end_node"]).unionByName(members("EXACT_POINT", ["end_lat", "end_lon"]))


def _allowed(status: Column) -> Column:
    return status == "ALLOWED_NATIVE_IMMEDIATE"


def allowed_bits(car: Column, motorcycle: Column) -> Column:
    return F.when(_allowed(car), AUTO_BIT).otherwise(0).bitwiseOR(F.when(_allowed(motorcycle), MOTORCYCLE_BIT).otherwise(0)).cast("long")


def branch_topology(options: DataFrame) -> DataFrame:
    """Per root and mode one of seven states of its immediate branches.

    ``options``: root_id, option_id, car, motorcycle (costing results), end_node,
    dep_lat, dep_lon (departure point).
    """
    long = options.select(
        "root_id",
        "end_node",
        F.struct("dep_lat", "dep_lon").alias("departure"),
        (F.col("dep_lat").isNotNull() & F.col("dep_lon").isNotNull()).alias("has_departure"),
        F.explode(
            F.array(
                F.struct(F.lit("car").alias("mode"), F.col("car").alias("result")),
                F.struct(F.lit("motorcycle").alias("mode"), F.col("motorcycle").alias("result")),
            )
        ).alias("m"),
    )
    ok = _allowed(F.col("m.result"))
    agg = long.groupBy("root_id", F.col("m.mode").alias("mode")).agg(
        F.count_if(F.col("m.result") != "NOT_EVALUATED").alias("evaluated"),
        F.count_if(ok).alias("allowed"),
        F.count_if(F.startswith("m.result", F.lit("UNRESOLVED_"))).alias("unknown"),
        F.count_if(ok & F.col("has_departure") & F.col("end_node").isNotNull()).alias("placed"),
        F.count_distinct(F.when(ok, F.col("end_node"))).alias("nodes"),
        F.count_distinct(F.when(ok, F.col("departure"))).alias("departures"),
    )
    distinct = (F.col("placed") == F.col("allowed")) & (F.col("nodes") == F.col("allowed")) & (F.col("departures") == F.col("allowed"))
    unknown = F.col("unknown") > 0
    status = (
        F.when(F.col("evaluated") == 0, "NOT_EVALUATED")
        .when((F.col("allowed") >= 2) & distinct, "DISTINCT_NATIVE_GEOMETRIC_BRANCHES")
        .when(F.col("allowed") >= 2, "MULTIPLE_ALLOWED_OVERLAPPING_OR_UNKNOWN_GEOMETRY")
        .when((F.col("allowed") == 1) & unknown, "SINGLE_ALLOWED_WITH_UNKNOWN_ALTERNATIVES")
        .when(F.col("allowed") == 1, "SINGLE_STATIC_LEGAL_CONTINUATION")
        .when(unknown, "NO_CONFIRMED_WITH_UNKNOWN_ALTERNATIVES")
        .otherwise("NO_CONFIRMED_STATIC_CONTINUATION")
    )
    return agg.select("root_id", "mode", "allowed", "unknown", status.alias("status"))


def two_hop_recovery(
    roots: DataFrame, links: DataFrame, options: DataFrame, sources: DataFrame, tiles: DataFrame, scope: DataFrame, of_roots: DataFrame | None = None
) -> DataFrame:
    """One more bounded hop for roots that no terminal link names.

    Modes are AND-ed along the path; positive costing is needed at both steps.
    ``of_roots`` are the options of all roots, where they are known already.
    """
    missing = roots.join(links.select(F.col("root_id").alias("graph_id")).distinct(), "graph_id", "left_anti")
    bits = allowed_bits(F.col("car"), F.col("motorcycle"))
    # Options are chosen by their source before they are made or moved; tiles are looked up for the few that go on.
    own = options.join(_pending(missing).select(F.col("graph_id").alias("source_id")), "source_id", "left_semi") if of_roots is None else of_roots
    first = root_options(missing, own, tiles).filter(F.col("eligible") & F.col("in_scope") & ~F.col("via_hierarchy"))
    first = first.select(
        "root_id",
        F.col("option_id").alias("first_id"),
        bits.bitwiseAND(F.col("option_access")).bitwiseAND(F.col("access")).alias("m1"),
    ).filter(F.col("m1") != 0)
    first = stage(first, "first-hop")
    nxt = options.join(first.select(F.col("first_id").alias("source_id")), "source_id", "left_semi")
    nxt = nxt.filter(~F.col("via_hierarchy") & ~F.col("shortcut") & ~F.col("transit"))
    second = first.join(nxt.withColumnRenamed("source_id", "first_id"), "first_id").select(
        "root_id", "first_id", F.col("option_id").alias("terminal_id"), bits.bitwiseAND(F.col("m1")).bitwiseAND(F.col("option_access")).alias("m2")
    )
    second = second.filter(F.col("m2") != 0)
    # Ends are few, so they are met before the ids of the scope and the tiles.
    modes = sources.select(F.col("graph_id").alias("terminal_id"), "terminal_modes").filter(F.col("terminal_modes") != 0)
    out = second.join(modes, "terminal_id").withColumn("modes", F.col("m2").bitwiseAND(F.col("terminal_modes"))).filter(F.col("modes") != 0)
    out = out.join(scope.select(F.col("graph_id").alias("terminal_id")), "terminal_id", "left_semi").withColumn("tile_id", tile_id(F.col("terminal_id")))
    out = out.join(tiles.select("tile_id").distinct(), "tile_id", "left_semi")
    return out.select("root_id", "first_id", "terminal_id", "modes")


def predecessor_paths(finals: DataFrame, edges: DataFrame, cut: DataFrame, depth: int = MAX_HOPS, budget: int = MAX_VISITS) -> DataFrame:
    """Reverse paths from final edges to the first edge that crosses the cut.

    ``edges``: graph_id, start_node, end_node, opposing_id.  ``cut``: graph_id of
    crossing edges.  Cycles and truncations are rows too.  Every edge is written once
    with all that a step needs, laid out by its end node, so a hop moves the open paths
    once.  Only finals whose walks could exceed the budget are counted path by path; the
    walks are bounded over nodes first.  Bounds outside 1 to MAX_HOPS and 1 to MAX_VISITS
    are refused, not adjusted.
    """
    if not (1 <= depth <= MAX_HOPS and 1 <= budget <= MAX_VISITS):
        raise ValueError(f"depth {depth} or budget {budget} is out of range")
    degree = edges.groupBy(F.col("start_node").alias("at")).agg(F.count(F.lit(1)).alias("fanout"))
    starts = edges.select(F.col("graph_id").alias("edge_id"), F.col("start_node").alias("at"), "opposing_id").join(degree, "at")
    # As many entries as an id has rows, one as a rule.
    onward = starts.groupBy("edge_id").agg(F.collect_list(F.struct("at", "opposing_id", "fanout")).alias("onward"))
    onward = stage_by(onward, "onward", "edge_id")
    crossing = cut.select(F.col("graph_id").alias("edge_id")).distinct().withColumn("crosses", F.lit(True))
    into = edges.select(F.col("graph_id").alias("edge_id"), F.col("end_node").alias("at")).filter(F.col("edge_id").isNotNull() & F.col("at").isNotNull())
    into = stage_by(into.join(onward, "edge_id", "left").join(crossing, "edge_id", "left"), "into", "at")
    first = finals.select(F.col("graph_id").alias("edge_id")).join(onward, "edge_id")
    first = first.select(F.col("edge_id").alias("final_id"), F.array("edge_id").alias("path"), "onward")

    entries = into.groupBy("at").agg(F.count(F.lit(1)).cast("double").alias("walks"))
    walks = entries
    for _ in range(depth - 1):
        longer = into.select("at", F.explode("onward.at").alias("next")).join(walks.select(F.col("at").alias("next"), F.col("walks").alias("more")), "next")
        longer = longer.groupBy("at").agg(F.sum("more").alias("more"))
        walks = entries.join(longer, "at", "left").select("at", (F.col("walks") + F.coalesce("more", F.lit(0.0))).alias("walks"))
    most = first.select("final_id", F.explode("onward.at").alias("at")).join(walks, "at").groupBy("final_id").agg(F.sum("walks").alias("walks"))
    many = stage(most.filter(F.col("walks") > budget).select("final_id"), "many-paths")
    if many.isEmpty():
        return union_all(*_walk(first, into, depth))
    return union_all(
        *_walk(first.join(many, "final_id", "left_anti"), into, depth),
        *_walk(first.join(many, "final_id", "left_semi").withColumn("used", F.lit(0).cast("long")), into, depth, budget),
    )


def _walk(frontier: DataFrame, into: DataFrame, depth: int, budget: int | None = None) -> list[DataFrame]:
    """Rows of all hops of :func:`predecessor_paths`; visits are counted where a budget is given."""
    c, out = F.col, ["final_id", "edge_id", "depth", "status", "path"]
    counted = budget is not None
    used = ["used"] if counted else []
    rows = []
    for hop in range(1, depth + 1):
        placed = frontier.select("final_id", "path", *used, F.explode("onward").alias("o")).select("final_id", "path", *used, "o.*")
        wide = placed.filter(c("fanout") > MAX_FANOUT)
        rows.append(wide.select("final_id", F.element_at("path", -1).alias("edge_id"), F.lit(hop - 1).alias("depth"), F.lit("FANOUT_UNCERTAIN").alias("status"), "path"))
        step = placed.filter(c("fanout") <= MAX_FANOUT).join(into, "at").filter(c("edge_id") != c("opposing_id"))
        step = step.select(
            "final_id", "edge_id", "onward", "crosses", *used, F.array_contains("path", c("edge_id")).alias("cycle"), F.concat("path", F.array("edge_id")).alias("path")
        )
        kind = F.when(c("crosses"), "CROSSES_CUT").otherwise("PREDECESSOR")
        if counted:
            by_path = Window.partitionBy("final_id", "cycle").orderBy("path")
            step = step.withColumn("visit", c("used") + F.row_number().over(by_path))
            kind = F.when(c("visit") > budget, "BUDGET_EXHAUSTED").otherwise(kind)
        status = F.when(c("cycle"), "CYCLE").otherwise(kind)
        seen = step.select("final_id", "edge_id", F.lit(hop).alias("depth"), status.alias("status"), "path", "onward", *(["visit"] if counted else []))
        if not counted and hop == depth:
            # Written by nobody: a path that may go on is two rows at once.
            ends = F.when(c("status") == "PREDECESSOR", F.array("status", F.lit("DEPTH_REACHED"))).otherwise(F.array("status"))
            rows.append(seen.withColumn("status", F.explode(ends)).select(*out))
            break
        seen = stage(seen, "paths")
        rows.append(seen.select(*out))
        frontier = seen.filter(c("status") == "PREDECESSOR").drop("visit")
        if counted:
            spent = seen.filter(c("status") != "CYCLE").groupBy("final_id").agg(F.max("visit").alias("used"))
            frontier = frontier.join(spent.filter(c("used") <= budget), "final_id")
            if hop == depth:
                rows.append(frontier.withColumn("status", F.lit("DEPTH_REACHED")).select(*out))
    return rows


def hierarchy_reach(nodes: DataFrame, transitions: DataFrame) -> DataFrame:
    """Shortest level-transition depth of each listed node against its declared depth.

    nodes: root_id, node_id, depth.  transitions: root_id, node_id, target_id.
    Levels are followed until no new node is met, however deep that is.
    """
    reached = nodes.filter(F.col("node_id") == F.col("root_id")).select("root_id", "node_id", F.lit(0).alias("shortest"))
    frontier, hop = reached, 0
    while True:
        hop += 1
        nxt = (
            frontier.join(transitions, ["root_id", "node_id"])
            .select("root_id", F.col("target_id").alias("node_id"))
            .distinct()
            .join(reached, ["root_id", "node_id"], "left_anti")
            .withColumn("shortest", F.lit(hop))
        )
        frontier = cut_lineage(nxt)
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    both = nodes.join(reached, ["root_id", "node_id"], "full_outer")
    status = (
        F.when(F.col("depth").isNull(), "TARGET_NOT_LISTED")
        .when(F.col("shortest").isNull(), "DISCONNECTED")
        .when(F.col("shortest") != F.col("depth"), "DEPTH_MISMATCH")
        .otherwise("OK")
    )
    return both.select("root_id", "node_id", "depth", "shortest", status.alias("status"))


def adjacent_chain(chain: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Is each next edge of a chain a real successor, and is it the reverse?

    chain: chain_id, pos, graph_id.  A chain is a short nominated list.
    """
    window = Window.partitionBy("chain_id").orderBy("pos")
    steps = chain.withColumn("next_id", F.lead("graph_id").over(window))
    rows = steps.join(adjacency.select(F.col("source_id").alias("graph_id"), "opposing_id", "outgoing"), "graph_id", "left")
    hit = F.exists("outgoing", lambda o: o["graph_id"] == F.col("next_id"))
    return rows.select(
        "chain_id",
        "pos",
        "graph_id",
        "next_id",
        F.when(F.col("next_id").isNull(), "CHAIN_END").when(hit, "ADJACENT").otherwise("NOT_ADJACENT").alias("status"),
        (F.col("next_id") == F.col("opposing_id")).alias("is_reverse"),
        F.size("outgoing").alias("out_degree"),
    )


def receiver_candidates(near: DataFrame) -> DataFrame:
    """Same-way receiver ends that go on; ``near`` comes from ``nearby_incoming``."""
    return near.filter((F.col("source_way") == F.col("receiver_way")) & ~F.col("receiver_deadend"))


def handoff_pool(near: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Source end x receiver candidates with outgoing ids per mode, unique pairs."""
    rows = receiver_candidates(near).join(adjacency.select(F.col("source_id").alias("receiver_id"), "opposing_id", "outgoing"), "receiver_id")

    def out_ids(bit: int) -> Column:
        keep = F.filter(
            "outgoing",
            lambda o: (o["graph_id"] != F.col("opposing_id")) & o["is_road"] & ~o["is_shortcut"] & (o["forward_access"].bitwiseAND(F.lit(bit)) != 0),
        )
        return F.array_sort(F.transform(keep, lambda o: o["graph_id"]))

    return rows.select(
        "source_id", "receiver_id", *[out_ids(bit).alias(f"outgoing_{mode}") for mode, bit in MODES.items()]
    ).dropDuplicates(["source_id", "receiver_id"])


def receiver_adjacency(near: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Per source dead end and mode: is there a road onward in the receiver graph?"""
    pairs = receiver_candidates(near).join(adjacency.select(F.col("source_id").alias("receiver_id"), "opposing_id", "outgoing"), "receiver_id")

    def onward(bit: int) -> Column:
        both = (F.col("source_access").bitwiseAND(F.lit(bit)) != 0) & (F.col("receiver_access").bitwiseAND(F.lit(bit)) != 0)
        go = F.exists(
            "outgoing",
            lambda o: (o["graph_id"] != F.col("opposing_id")) & o["is_road"] & ~o["is_shortcut"] & (o["forward_access"].bitwiseAND(F.lit(bit)) != 0),
        )
        return both & go

    return pairs.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("relationships"),
        *[F.coalesce(F.bool_or(onward(bit)), F.lit(False)).alias(mode) for mode, bit in MODES.items()],
    )


def reciprocal_pairs(regions: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Region pairs where each side has exactly one fingerprint for the other.

    regions: region_id, source_id, package_version, graph_fingerprint.
    boundaries: region_id, neighbour_source_id, fingerprint.
    """
    single = (
        boundaries.groupBy("region_id", "neighbour_source_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fingerprint").alias("fingerprint"))
        .filter(F.col("n") == 1)
    )
    owned = single.join(regions, "region_id")

    def side(prefix: str) -> list[Column]:
        return [
            F.col("region_id").alias(f"{prefix}_region_id"),
            F.col("source_id").alias(f"{prefix}_source_id"),
            F.col("package_version").alias(f"{prefix}_package_version"),
            F.col("graph_fingerprint").alias(f"{prefix}_graph_fingerprint"),
            F.col("fingerprint").alias(f"{prefix}_boundary_fingerprint"),
        ]

    a = owned.select(*side("from"), F.col("neighbour_source_id").alias("to_source_id"))
    b = owned.select(*side("to"), F.col("neighbour_source_id").alias("from_source_id"))
    out = a.join(b, ["from_source_id", "to_source_id"]).filter(F.col("from_region_id") != F.col("to_region_id"))
    return out.withColumn("pair_id", F.concat_ws("__", "from_region_id", "to_region_id")).withColumn("validation_state", F.lit("UNPROVEN"))


def connector_matrix(anchors: DataFrame, results: DataFrame) -> DataFrame:
    """Entry x exit pairs per region and mode without self pairs, with results.

    anchors: region_id, mode, anchor_id, is_entry, is_exit.  The matrix is the
    product the job asks for; it is joined on region and mode, never crossed freely.
    """
    entry = anchors.filter("is_entry").select("region_id", "mode", F.col("anchor_id").alias("from_anchor_id"))
    exits = anchors.filter("is_exit").select("region_id", "mode", F.col("anchor_id").alias("to_anchor_id"))
    cells = entry.join(exits, ["region_id", "mode"]).filter(F.col("from_anchor_id") != F.col("to_anchor_id"))
    return cells.join(results, ["region_id", "mode", "from_anchor_id", "to_anchor_id"], "left").withColumn(
        "status", F.coalesce("status", F.lit("MISSING"))
    )
