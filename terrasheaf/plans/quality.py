"""Queries of the quality, refresh and publication jobs.

Documents are built from the given tables with planted faults; the comparison
SQL states which rows carry which fault.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import diff as D, match as M, quality as Q
from . import graph as PG, match as PM
from ..session import stage
from .registry import Tables, query

SHA = "concat('sha256:', repeat('a', 64))"


def faults(table: str, subject: str, **codes: str) -> str:
    """Comparison SQL: one row per subject and code where the condition holds."""
    parts = [f"select cast({subject} as varchar) as subject, '{code}' as code from {table} where {cond}" for code, cond in codes.items()]
    return " union ".join(parts)


# --- region configuration -------------------------------------------------


@query(
    "config_rules",
    faults(
        "customer",
        "concat('r', c_custkey)",
        search_file_name="c_custkey % 7 = 0",
        coverage_latitude="c_custkey % 11 = 0",
        country_code="c_custkey % 13 = 0",
        layer_threads="c_custkey % 17 = 0",
        layer_classes="c_custkey % 19 = 0 or c_custkey % 23 = 0",
        graph_buffer="c_custkey % 29 = 0",
        graph_mode="c_custkey % 31 = 0",
        primary_differs="c_custkey % 37 = 0",
        primary_not_listed="c_custkey % 37 = 0 or c_custkey % 41 = 0",
        target_limit="c_custkey % 43 = 0",
        source_record="c_custkey % 47 = 0",
        source_repeated="c_custkey % 53 = 0",
        border_route_missing="c_custkey % 59 = 0",
        route_kind="c_custkey % 61 = 0",
        route_point="c_custkey % 67 = 0",
    ).replace("c_custkey % 59 = 0", "(c_custkey % 59 = 0 or c_custkey % 61 = 0)"),
)
def _(t):
    c = t("customer").select("c_custkey")
    k = F.col("c_custkey")
    bad = lambda m, wrong, right: F.when(k % m == 0, F.lit(wrong)).otherwise(F.lit(right))
    classes = F.when(k % 19 == 0, F.array(F.lit("motorway"), F.lit("motorway"))).when(k % 23 == 0, F.array(F.lit("path"))).otherwise(F.array(F.lit("motorway"), F.lit("trunk")))
    region = F.concat(F.lit("r"), k.cast("string")).alias("region_id")
    yes = F.lit(True)
    configs = c.select(
        region,
        yes.alias("search_enabled"), yes.alias("layer_enabled"), yes.alias("graph_enabled"),
        bad(7, "places.db", "places.sqlite").alias("file_name"), F.lit("places.json").alias("manifest_name"),
        bad(11, 95.0, 44.0).alias("min_lat"), F.lit(47.0).alias("max_lat"), F.lit(10.0).alias("min_lng"), F.lit(13.0).alias("max_lng"),
        bad(13, "ITA", "IT").alias("country"),
        F.lit("https://x/a.osm.pbf").alias("layer_url"), F.lit("https://x/a.poly").alias("layer_polygon_url"), bad(17, 0, 8).alias("layer_threads"),
        F.lit("map-{version}.pmtiles").alias("layer_template"), classes.alias("major_classes"), F.lit(75.0).alias("border_tolerance"),
        F.lit("3.6.3").alias("engine_version"), bad(29, 0.0, 25.0).alias("buffer_km"), F.lit(4).alias("graph_threads"), F.lit("graph-{version}.tar").alias("graph_template"),
        bad(31, "other", "manual").alias("validation_mode"), F.lit("p0").alias("layer_primary_id"), bad(37, "p9", "p0").alias("graph_primary_id"),
    )
    targets = c.select(region, F.lit(0).alias("idx"), F.lit("Name").alias("name_equals"), F.lit("").alias("query"), bad(43, 99, 8).alias("limit"))
    p0 = c.select(region, bad(41, "p1", "p0").alias("source_id"), bad(47, "http://x", "https://x/a.osm.pbf").alias("url"))
    p1 = c.select(region, F.when(k % 53 == 0, bad(41, "p1", "p0")).otherwise(F.lit("p2")).alias("source_id"), F.lit("https://x/b.osm.pbf").alias("url"))
    kind = F.when(k % 61 == 0, "strange").when(k % 59 == 0, "interior").otherwise("border")
    routes = c.select(
        region, F.lit(0).alias("idx"), F.lit("route").alias("name"), kind.alias("kind"), bad(67, 91.0, 46.0).alias("start_lat"), F.lit(12.0).alias("start_lon"), F.lit(46.1).alias("end_lat"), F.lit(12.1).alias("end_lon"),
    )
    return Q.config_rules(configs, targets, p0.unionByName(p1), routes)


# --- catalogue audits -----------------------------------------------------

_EV = "select graph_id as source_id, end_node, end_lat as x_lat, end_lon as x_lon, forward_access as modes, case when deadend then 'X' else 'Y' end as correlation from v_edges_a"


@query(
    "audit_catalog",
    faults(
        "v_edges_a",
        "graph_id",
        end_node_changed="graph_id % 10 = 3",
        modes_changed="graph_id % 14 = 5",
        point_changed="graph_id % 15 = 2",
        source_repeated="graph_id % 22 = 7",
        source_omitted="graph_id % 9 = 0",
    ).replace("where", "where graph_id % 9 <> 0 and", 4)
    + " union select cast(source_id as varchar), 'option_suppressed' from v_opts where option_id % 12 = 0 and source_id % 9 <> 0"
    + " union select cast(source_id as varchar), 'option_modes_changed' from v_opts where option_id % 25 = 1 and option_id % 12 <> 0 and source_id % 9 <> 0"
    + " union select cast(source_id as varchar), 'option_invented' from v_opts where source_id % 9 = 0 and option_id % 12 <> 0"
    + " union select cast(end_node as varchar), 'receiver_owned_twice' from v_edges_a where graph_id % 9 <> 0 group by end_node having count(distinct graph_id) > 1",
)
def _(t):
    s = F.col("source_id")
    ev = t.sql(_EV)
    cat = ev.filter(s % 9 != 0).withColumns(
        {
            "end_node": F.col("end_node") + F.when(s % 10 == 3, 1).otherwise(0),
            "modes": F.col("modes").bitwiseXOR(F.when(s % 14 == 5, F.lit(2)).otherwise(F.lit(0))),
            "x_lat": F.col("x_lat") + F.when(s % 15 == 2, 0.001).otherwise(0.0),
        }
    )
    cat = cat.unionByName(cat.filter(s % 22 == 7))
    refs = t("v_opts").select("source_id", "option_id", F.col("option_access").alias("modes"), F.col("car").alias("relation"), F.col("motorcycle").alias("evidence"))
    opts = refs.filter("option_id % 12 <> 0").withColumn("modes", F.col("modes") + F.when(F.col("option_id") % 25 == 1, 4).otherwise(0))
    incoming = cat.select("source_id", F.col("end_node")).join(ev.select("source_id", F.col("end_node").alias("receiver_id")), "source_id")
    return Q.audit_catalog(cat, ev, opts, refs, incoming.select("source_id", "receiver_id"), ev.select("source_id"))


_ROOTS = """select o_orderkey as root_id, case when o_orderkey % 10 = 0 then 'ROOT_NO_TERMINAL_CANDIDATE_WITHIN_TWO_BOUNDED_HOPS' when o_orderkey % 10 < 6 then 'ROOT_HAS_NATIVE_RECEIVER_OPTIONS_SOURCE_LINEAGE_UNPROVEN'
  when o_orderkey % 97 = 9 then 'OTHER' else 'ROOT_TERMINAL_CANDIDATE_NO_CONFIRMED_RECEIVER' end as status from orders"""


@query(
    "root_audit",
    f"""with r as ({_ROOTS}) select cast(root_id as varchar) as subject, 'status_unknown' as code from r where status = 'OTHER'
    union all select cast(root_id as varchar), 'unlinked_with_terminal' from r where root_id % 10 = 0 and root_id % 3 = 0 union all select cast(root_id as varchar), 'linked_without_terminal' from r where root_id % 10 <> 0 and root_id % 7 = 0
    union all select cast(root_id as varchar), 'options_misclassified' from r where root_id % 10 <> 0 and root_id % 7 <> 0 and (status = 'ROOT_HAS_NATIVE_RECEIVER_OPTIONS_SOURCE_LINEAGE_UNPROVEN') <> (root_id % 2 = 0)
    union all select cast(root_id as varchar), 'unlinked_not_listed' from r where root_id % 10 = 0 and root_id % 4 = 0 union all select cast(root_id as varchar), 'listed_not_unlinked' from r where root_id % 10 <> 0 and root_id % 33 = 1
    union all select status, 'count_mismatch' from r where status = 'ROOT_TERMINAL_CANDIDATE_NO_CONFIRMED_RECEIVER' group by status""",
)
def _(t):
    r = t.sql(_ROOTS)
    k = F.col("root_id")
    links = r.filter(((k % 10 == 0) & (k % 3 == 0)) | ((k % 10 != 0) & (k % 7 != 0))).select("root_id", (k + 1).alias("terminal_id"))
    cands = r.filter(k % 2 == 0).select((k + 1).alias("source_id"))
    recorded = r.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    recorded = recorded.withColumn("n", F.col("n") + F.when(F.col("status") == "ROOT_TERMINAL_CANDIDATE_NO_CONFIRMED_RECEIVER", 1).otherwise(0))
    unlinked = r.filter(((k % 10 == 0) & (k % 4 != 0)) | ((k % 10 != 0) & (k % 33 == 1))).select("root_id")
    return Q.root_audit(r, links, cands, recorded, unlinked)


@query(
    "tile_scope_audit",
    faults(
        "orders",
        "o_orderkey",
        scope_unknown="o_orderkey % 31 = 0",
        sum_mismatch="o_orderkey % 7 = 0",
        indexed_exceeds_selected="o_orderkey % 11 = 0",
        id_count_mismatch="o_orderkey % 13 = 0",
        id_repeated="o_orderkey % 17 = 0 and o_orderkey % 13 <> 0",
        id_invalid="o_orderkey % 19 = 0",
    ),
)
def _(t):
    k = F.col("o_orderkey")
    one = F.lit(1).cast("bigint")
    ids = F.when(k % 13 == 0, F.array(one)).when(k % 17 == 0, F.array(one * 5, one * 9)).otherwise(F.array(one, one * 2))
    owner = F.when(k % 19 == 0, F.array(-one, one * 9)).when(k % 17 == 0, F.array(one * 9, one * 10)).otherwise(F.array(one * 11, one * 12))
    rows = t("orders").select(
        k.alias("pair_id"), F.when(k % 31 == 0, "WHOLE").otherwise("CUT_PLUS_ENDPOINT_AND_OWNER").alias("scope"), F.lit(2).alias("endpoint_tiles"), F.lit(2).alias("owner_tiles"), F.lit(10).alias("cut_tiles"),
        F.when(k % 7 == 0, 15).otherwise(14).alias("selected_tiles"), F.when(k % 11 == 0, 20).otherwise(9).alias("indexed_tiles"), ids.alias("endpoint_ids"), owner.alias("owner_ids"),
    )
    return Q.tile_scope_audit(rows)


@query(
    "preflight",
    """with m as (select * from d_match), s as (select source_id, modes from d_cand),
      d as (select source_id, modes + case when source_id % 9 = 0 then 2 else 0 end as d_modes from s where source_id % 7 <> 0), o as (select source_id, count(*) as n from m group by source_id)
    select cast(s.source_id as varchar) as subject, 'not_disposed' as code from s where source_id % 7 = 0
    union select cast(s.source_id as varchar), 'modes_differ' from s join d on d.source_id = s.source_id where modes <> d_modes
    union select cast(s.source_id as varchar), 'no_receiver_road' from s where source_id not in (select source_id from m)
    union select cast(source_id as varchar), 'road_invented' from m where receiver_id % 5 = 0
    union select cast(source_id as varchar), 'modes_wider' from m where modes = 0
    union select cast(receiver_id as varchar), 'receiver_repeated' from m group by receiver_id having count(*) > 1
    union select 'roads', 'count_mismatch'""",
)
def _(t):
    c = PM.candidates(t)
    m = stage(M.matched_roads(PM.overlaps(t), c).drop("code", "relationship"), "matched")
    s = F.col("source_id")
    per = m.groupBy("source_id").agg(F.max("x_m").alias("max_x_m"))
    disposed = c.select("source_id", "modes").join(per, "source_id", "left").filter(s % 7 != 0).withColumn("modes", F.col("modes") + F.when(s % 9 == 0, 2).otherwise(0))
    facts = m.filter("receiver_id % 5 <> 0").select("source_id", "receiver_id", "progress_m")
    counts = c.agg(F.lit("sources").alias("counter"), F.count(F.lit(1)).alias("n")).unionByName(m.agg(F.lit("roads").alias("counter"), (F.count(F.lit(1)) + 1).alias("n")))
    return Q.preflight(m, c.select("source_id", "modes"), disposed, facts, counts)


@query(
    "scan_audit",
    """with w as (select window_index as k, * from v_windows), b as (select * from w where k % 17 <> 0)
    select concat('to:', k) as subject, 'window_incomplete' as code from b where k % 9 = 0 union select concat('to:', k), 'window_unscanned' from b where k % 11 = 0
    union select concat('to:', k), 'window_bounds' from b where k % 13 = 0 union select cast(k as varchar), 'windows_not_aligned' from w where k % 13 = 0 or k % 17 = 0
    union select concat('to:', graph_id), 'access_mask' from v_edges_b where gid % 23 = 0 union select concat('to:', graph_id), 'edge_repeated' from v_edges_b where gid % 27 = 0
    union select concat('from:', min(k)), 'window_repeated' from w group by min_lat, max_lat, min_lon, max_lon having count(*) > 1
    union select concat('to:', min(k)), 'window_repeated' from b group by case when k % 13 = 0 then 89 else min_lat end, max_lat, min_lon, max_lon having count(*) > 1""",
)
def _(t):
    w = t("v_windows")
    k = F.col("window_index")
    base = {"complete": F.lit(True), "truncated": F.lit(False), "max_results": F.lit(None).cast("int"), "visited_tiles": F.lit(1), "visited_nodes": F.lit(5), "returned": F.lit(3)}
    a = w.withColumns(base).withColumn("side", F.lit("from"))
    b = w.filter(k % 17 != 0).withColumns(base).withColumns(
        {"side": F.lit("to"), "complete": k % 9 != 0, "visited_tiles": F.when(k % 11 == 0, 0).otherwise(1), "min_lat": F.when(k % 13 == 0, 89.0).otherwise(F.col("min_lat"))}
    )
    e = t("v_edges_b").withColumns({"side": F.lit("to"), "forward_access": F.when(F.col("gid") % 23 == 0, F.lit(-1)).otherwise(F.col("forward_access"))})
    e = e.unionByName(t("v_edges_b").filter("gid % 27 = 0").withColumns({"side": F.lit("to")}))
    return Q.scan_audit(a.unionByName(b), e).distinct()




# --- connectivity documents -----------------------------------------------


@query(
    "check_inventory",
    faults(
        "lineitem",
        "concat('fr-', l_orderkey, 'x', l_linenumber, 'x', l_partkey, 'x', l_suppkey)",
        heading="l_partkey % 31 = 0",
        overlap_missing="l_partkey % 2 = 0 and l_suppkey % 7 = 0",
        overlap_forbidden="l_partkey % 2 = 1 and l_suppkey % 7 = 1",
        highway_missing="l_partkey % 37 = 0",
        line_too_short="l_partkey % 41 = 0",
        graph_identity_leaked="l_partkey % 43 = 0",
    ),
)
def _(t):
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    rows = rows.select(
        F.lit("a__b").alias("pair_id"), F.concat(F.lit("fr-"), F.concat_ws("x", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("road_id"),
        (F.col("l_orderkey") * 100000 + p + 1).alias("way_id"), (F.col("l_linenumber") * 1000000 + s).cast("long").alias("crossing_index"),
        F.when(p % 2 == 0, "FRONTIER_OVERLAP").otherwise("CROSSING").alias("kind"), F.lit(46.0).alias("lat"), F.lit(12.0).alias("lon"), F.when(p % 31 == 0, 360.0).otherwise(90.0).alias("heading"),
        F.when((p % 2 == 0) & (s % 7 != 0), 12.5).when((p % 2 == 1) & (s % 7 == 1), 1.0).alias("overlap_m"), F.when(p % 37 == 0, " ").otherwise("primary").alias("highway"),
        F.when(p % 41 == 0, 1).otherwise(2).alias("vertices"), F.when(p % 43 == 0, "graphId").alias("graph_field"),
    )
    return Q.check_inventory(rows)


_SIDES = """select l_orderkey as side_id, count(*) as n, count(case when l_partkey % 3 = 0 then 1 end) as m from lineitem group by l_orderkey"""


@query(
    "check_correlations",
    f"""with c as (select l_orderkey as side_id, row_number() over (partition by l_orderkey order by case when l_partkey % 3 = 0 then 0 else 1 end, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as rk, l_partkey from lineitem), s as ({_SIDES})
    select cast(side_id as varchar) as subject, 'way_match_wrong' as code from c where l_partkey % 17 = 0 and l_partkey % 3 = 0 union select cast(side_id as varchar), 'percent' from c where l_partkey % 19 = 0
    union select cast(side_id as varchar), 'candidate_count' from s where side_id % 11 = 0 union select cast(side_id as varchar), 'same_way_count' from s where side_id % 13 = 0
    union select cast(side_id as varchar), 'rank_not_contiguous' from s where side_id % 23 = 0 union select cast(side_id as varchar), 'error_forbidden' from s where side_id % 29 = 0""",
)
def _(t):
    c = t.sql(
        """select l_orderkey as side_id, row_number() over (partition by l_orderkey order by case when l_partkey % 3 = 0 then 0 else 1 end, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as rank,
        l_partkey, l_partkey % 3 = 0 as way_match from lineitem"""
    )
    p, s = F.col("l_partkey"), F.col("side_id")
    cands = c.withColumns(
        {
            "rank": F.col("rank") + F.when(s % 23 == 0, 1).otherwise(0),
            "way_id": F.when(F.col("way_match") & (p % 17 != 0), s + 1).otherwise(F.lit(-5).cast("bigint")),
            "distance_m": F.lit(3.0),
            "percent": F.when(p % 19 == 0, 1.5).otherwise(0.5),
            "heading": F.lit(None).cast("double"),
        }
    )
    sides = t.sql(_SIDES).select(
        "side_id", (s + 1).alias("way_id"), F.lit("CORRELATED").alias("status"), (F.col("n") + F.when(s % 11 == 0, 1).otherwise(0)).alias("candidate_count"),
        (F.col("m") + F.when(s % 13 == 0, 1).otherwise(0)).alias("same_way_count"), F.when(s % 29 == 0, "boom").alias("error"),
    )
    return Q.check_correlations(sides, cands)


_LINES = "select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem"


@query(
    "check_candidates",
    f"""with l as ({_LINES}), c as (select *, concat_ws('x', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id, l_orderkey % 200 as pair from l)
    select id as subject, 'tier' as code from c where l_partkey % 13 = 0 union all select id, 'both_match_wrong' from c where l_partkey % 17 = 0 union all select id, 'same_way_wrong' from c where l_partkey % 19 = 0
    union all select id, 'heading_delta' from c where l_partkey % 23 = 0
    union all select cast(pair as varchar), 'road_count' from c where pair % 9 = 0 group by pair union all select cast(pair as varchar), 'candidate_count' from c where pair % 11 = 0 group by pair
    union all select cast(l_orderkey as varchar), 'resolved_and_unresolved' from c where l_orderkey % 31 = 0 group by l_orderkey
    union all select cast(pair as varchar), 'road_count' from c where pair % 9 <> 0 and l_orderkey % 31 = 0 group by pair""",
)
def _(t):
    l = t.sql(_LINES)
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    base = l.withColumns({"pair_id": o % 200, "road_id": o, "candidate_id": F.concat_ws("x", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")})
    fm, tm = p % 2 == 0, s % 2 == 0
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("road_id").orderBy("candidate_id")) - 1
    cands = base.withColumns(
        {
            "rank": rank, "tier": F.when(p % 13 == 0, 9).otherwise(2), "from_way_id": p, "to_way_id": s, "from_match": fm, "to_match": tm,
            "both_match": (fm & tm) != (p % 17 == 0), "one_match": fm | tm, "same_way": (p == s) != (p % 19 == 0), "separation_m": F.lit(2.0), "heading_delta": F.when(p % 23 == 0, 200.0),
        }
    )
    per = base.groupBy("pair_id").agg(F.count_distinct("road_id").alias("r"), F.count(F.lit(1)).alias("n"))
    k = F.col("pair_id")
    pairs = per.select("pair_id", (F.col("r") + F.when(k % 9 == 0, 1000).otherwise(0)).alias("road_count"), (F.col("n") + F.when(k % 11 == 0, 1).otherwise(0)).alias("candidate_count"), F.lit("UNPROVEN").alias("validation_state"))
    unresolved = base.filter(o % 31 == 0).select("pair_id", "road_id").distinct()
    return Q.check_candidates(pairs, cands, unresolved)


@query(
    "check_proofs",
    """with o as (select o_orderkey as k, o_custkey % 50 as pair from orders)
    select cast(k as varchar) as subject, 'edge_match_wrong' as code from o where k % 13 = 0 and k % 5 <> 0 union select cast(k as varchar), 'passed_without_match' from o where k % 13 = 0 and k % 5 <> 0
    union select cast(k as varchar), 'failed_without_error' from o where k % 17 = 0 and k % 5 = 0 union select cast(k as varchar), 'supported_wrong' from o where k % 19 = 0
    union select cast(k as varchar), 'state_wrong' from o where k % 23 = 0 union select cast(k as varchar), 'legs_missing' from o where k % 29 = 0
    union select cast(k as varchar), 'supported_wrong' from o where k % 29 = 0
    union select cast(pair as varchar), 'proven_count' from o where pair % 7 = 0""",
)
def _(t):
    k = F.col("proof_id")
    o = t("orders").select(F.col("o_orderkey").alias("proof_id"), (F.col("o_custkey") % 50).alias("pair_id"))
    combos = [F.struct(F.lit(m).alias("mode"), F.lit(d).alias("direction"), F.lit(g).alias("graph")) for m in ("CAR", "MOTORCYCLE") for d in ("FROM_TO", "TO_FROM") for g in ("A", "B")]
    legs = o.select("proof_id", F.explode(F.array(*combos)).alias("x")).select("proof_id", "x.*")
    legs = legs.filter(~((k % 29 == 0) & (F.col("mode") == "MOTORCYCLE")))
    fails = (k % 5 == 0) & (F.col("graph") == "B")
    odd = (k % 13 == 0) & (k % 5 != 0)
    legs = legs.withColumns(
        {
            "status": F.when(fails, F.when(k % 10 == 0, "ERROR").otherwise("FAILED")).otherwise("PASSED"),
            "expected_id": F.lit(7),
            "actual_id": F.when(fails, F.lit(None)).otherwise(F.lit(7)),
            "edge_matched": ~fails & ~odd,
            "error": F.when(fails & ~(k % 17 == 0), "no route"),
        }
    )
    names = ["CAR_FROM_TO", "CAR_TO_FROM", "MOTORCYCLE_FROM_TO", "MOTORCYCLE_TO_FROM"]
    full, none = F.array(*[F.lit(n) for n in names]), F.array().cast("array<string>")
    right = F.when(k % 5 == 0, none).otherwise(full)
    state = F.when(k % 5 != 0, "PROVEN").when(k % 10 == 0, "INCONCLUSIVE").otherwise("REJECTED")
    wrong = F.when(k % 5 != 0, "REJECTED").otherwise("PROVEN")
    short = (k % 29 == 0) & (k % 5 == 0)
    proofs = o.withColumns(
        {
            "state": F.when(k % 23 == 0, wrong).otherwise(state),
            "supported": F.when(k % 19 == 0, F.array(F.lit("CAR_FROM_TO"))).when(short, F.array(F.lit("CAR_TO_FROM"))).otherwise(right),
        }
    )
    now = proofs.groupBy("pair_id").agg(*[F.count_if(F.col("state") == s.upper()).alias(s) for s in ("proven", "rejected", "inconclusive")])
    totals = now.withColumn("proven", F.col("proven") + F.when(F.col("pair_id") % 7 == 0, 1).otherwise(0))
    return Q.check_proofs(legs, proofs, totals)


@query(
    "check_runtime",
    """with o as (select o_orderkey as k, o_custkey % 50 as pair from orders)
    select cast(k as varchar) as subject, 'metric_missing' as code from o where k % 7 = 0 and k % 17 <> 0 union select cast(k as varchar), 'metric_forbidden' from o where k % 11 = 0 or k % 17 = 0
    union select cast(k as varchar), 'way_id' from o where k % 13 = 0 union select cast(k as varchar), 'unsupported' from o where k % 17 = 0 union select cast(pair as varchar), 'support_count' from o where pair % 6 = 0""",
)
def _(t):
    from pyspark.sql import Window

    k = F.col("crossing_id")
    o = t("orders").select(F.col("o_orderkey").alias("crossing_id"), (F.col("o_custkey") % 50).alias("pair_id"))
    pos = F.row_number().over(Window.partitionBy("pair_id").orderBy("crossing_id")) - 1
    x = o.withColumns({"pos": pos, "tier": pos, "rank": F.lit(0), "way_id": F.when(k % 13 == 0, F.lit(-1)).otherwise(F.lit(5))})
    s1 = o.select("pair_id", "crossing_id", F.lit("CAR").alias("mode"), F.lit("FROM_TO").alias("direction"), (k % 17 != 0).alias("supported"), F.when(k % 7 != 0, 1.0).alias("km"), F.lit(2.0).alias("seconds"))
    s2 = o.select("pair_id", "crossing_id", F.lit("CAR").alias("mode"), F.lit("TO_FROM").alias("direction"), F.lit(False).alias("supported"), F.when(k % 11 == 0, 1.0).alias("km"), F.lit(None).cast("double").alias("seconds"))
    n = o.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(k % 17 != 0).alias("m"))
    pairs = n.select("pair_id", F.col("n").alias("crossing_count"), (F.col("m") + F.when(F.col("pair_id") % 6 == 0, 1).otherwise(0)).alias("support_count"), F.col("n").alias("candidate_count"), F.col("n").alias("proof_count"))
    return Q.check_runtime(pairs, x, s1.unionByName(s2)).distinct()




@query(
    "check_anchors",
    """with o as (select o_orderkey as k, o_custkey % 50 as r from orders)
    select concat('p', k) as subject, 'source_sha' as code from o where k % 41 = 0 union all select cast(k as varchar), 'pair_unknown' from o where k % 7 = 0 union all select cast(k as varchar), 'way_id' from o where k % 11 = 0
    union all select cast(k as varchar), 'role_unknown' from o where k % 13 = 0 and k % 17 <> 0 union all select cast(k as varchar), 'role_missing' from o where k % 17 = 0 union all select cast(k as varchar), 'role_repeated' from o where k % 19 = 0 and k % 13 <> 0 and k % 17 <> 0
    union all select cast(r as varchar), 'anchor_count' from o where r % 8 = 0 group by r""",
)
def _(t):
    from pyspark.sql import Window

    k = F.col("anchor_id")
    o = t("orders").select(F.col("o_orderkey").alias("anchor_id"), (F.col("o_custkey") % 50).cast("string").alias("region_id"))
    p = F.concat(F.lit("p"), k.cast("string"))
    sources = o.select("region_id", p.alias("pair_id"), F.lit("n").alias("neighbour_id"), F.when(k % 41 == 0, "x").otherwise(F.expr(SHA)).alias("sha256"))
    roles = (
        F.when(k % 17 == 0, F.array().cast("array<string>")).when(k % 13 == 0, F.array(F.lit("SIDE"))).when(k % 19 == 0, F.array(F.lit("ENTRY"), F.lit("ENTRY"))).otherwise(F.array(F.lit("ENTRY"), F.lit("EXIT")))
    )
    pos = F.row_number().over(Window.partitionBy("region_id").orderBy("anchor_id")) - 1
    anchors = o.withColumns(
        {
            "pos": pos, "way_id": F.when(k % 11 == 0, F.lit(0)).otherwise(F.lit(9)), "candidate_id": k, "neighbour_id": F.lit("n"), "pair_id": F.when(k % 7 == 0, "zz").otherwise(p),
            "roles_motorcycle": roles, "roles_car": F.array().cast("array<string>"),
        }
    )
    # The way id is part of the order key, so the order is by the sound ids here.
    anchors = anchors.withColumn("neighbour_id", F.format_string("n%012d", k))
    n = o.groupBy("region_id").agg(F.count(F.lit(1)).alias("n"))
    regions = n.select("region_id", (F.col("n") + F.when(F.col("region_id").cast("int") % 8 == 0, 1).otherwise(0)).alias("anchor_count"))
    return Q.check_anchors(regions, sources, anchors)


@query(
    "check_matrix",
    f"""with a as ({PG._ANCHORS}), c as (select e.region_id, e.mode, e.anchor_id as f, x.anchor_id as t, e.anchor_id + x.anchor_id as z from a e join a x on x.region_id = e.region_id and x.mode = e.mode where e.is_entry and x.is_exit and e.anchor_id <> x.anchor_id),
      g as (select region_id, mode, count(*) as n, count(case when z % 13 = 0 then 1 end) as gone from c group by region_id, mode)
    select concat_ws(':', region_id, mode, f, t) as subject, 'reachable_fields' as code from c where z % 3 = 0 and z % 7 = 0 and z % 13 <> 0 union all select concat_ws(':', region_id, mode, f, t), 'unreachable_fields' from c where z % 3 = 1 and z % 11 = 0 and z % 13 <> 0
    union all select concat_ws(':', region_id, mode, f, t), 'inconclusive_fields' from c where z % 3 = 2 and z % 5 = 0 and z % 13 <> 0 union all select concat_ws(':', region_id, mode), 'pair_count' from g where gone > 0""",
)
def _(t):
    a = t.sql(PG._ANCHORS)
    key = ["region_id", "mode"]
    # Parts of a region's entries meet its exits in tasks of their own: few rows make many pairs.
    part, parts = F.pmod(F.xxhash64("anchor_id"), F.lit(64)), F.explode(F.sequence(F.lit(0), F.lit(63)).cast("array<bigint>"))
    entries = a.filter("is_entry").select(*key, part.alias("part"), F.col("anchor_id").alias("from_id"))
    exits = a.filter("is_exit").select(*key, parts.alias("part"), F.col("anchor_id").alias("to_id"))
    n_tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    one, two = (df.repartition(n_tasks, *key, "part") for df in (entries, exits))
    pairs = one.join(two.hint("merge"), [*key, "part"]).filter("from_id <> to_id").drop("part")
    z = F.col("from_id") + F.col("to_id")
    r, u = z % 3 == 0, z % 3 == 1
    cells = pairs.filter(z % 13 != 0).withColumns(
        {
            "status": F.when(r, "REACHABLE").when(u, "UNREACHABLE").otherwise("INCONCLUSIVE"),
            "km": F.when((r & (z % 7 != 0)) | (u & (z % 11 == 0)), 1.0),
            "seconds": F.when(r, 1.0),
            "matrix_km": F.when(~u, 1.0),
            "matrix_seconds": F.when(~u, 1.0),
            "from_graph_id": F.when(r, 1),
            "to_graph_id": F.when(r, 1),
            "error": F.when(~r & ~u & (z % 5 != 0), "why"),
        }
    )
    n = pairs.groupBy(*key).agg(F.count(F.lit(1)).alias("pair_count"))
    c = cells.groupBy(*key).agg(*[F.count_if(F.col("status") == s.upper()).alias(s) for s in ("reachable", "unreachable", "inconclusive")])
    return Q.check_matrix(n.join(c, key, "left").na.fill(0), cells, a)


_CH = "select o_orderkey as k, o_custkey % 100 as p, row_number() over (partition by o_custkey % 100 order by o_orderkey) - 1 as r from orders"


@query(
    "check_chain_plan",
    f"""with c as ({_CH}) select cast(k as varchar) as subject, 'region_cycle' as code from c where k % 7 = 0 union select cast(k as varchar), 'endpoints' from c where k % 7 = 0
    union select cast(k as varchar), 'hop_count' from c where k % 11 = 0 union select cast(k as varchar), 'score' from c where k % 13 = 0 union select cast(k as varchar), 'hop_regions' from c where k % 17 = 0 or (k % 7 = 0 and k % 11 <> 0)
    union select cast(k as varchar), 'option_rank' from c where k % 19 = 0 union select cast(k as varchar), 'hop_without_option' from c where k % 23 = 0 and k % 11 <> 0
    union select cast(p as varchar), 'found_without_chain' from (select distinct p + 1000 as p from c) x""",
)
def _(t):
    c = t.sql(_CH)
    k = F.col("k")
    regions = F.when(k % 7 == 0, F.array(F.lit("a"), F.lit("m"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("m"), F.lit("z")))
    score = (F.col("r") + 1).cast("double")
    chains = c.select(
        F.col("p").alias("plan_id"), k.alias("chain_id"), F.col("r").alias("rank"), regions.alias("regions"), (score + F.when(k % 13 == 0, 0.25).otherwise(0.0)).alias("score"), F.lit(3.0).alias("km"), score.alias("seconds"),
    )
    p = c.select(F.col("p").alias("plan_id")).distinct()
    plans = p.unionByName(p.select((F.col("plan_id") + 1000).alias("plan_id"))).withColumns(
        {"route_style": F.lit("FASTER"), "max_hops": F.lit(4), "from_region": F.lit("a"), "to_region": F.lit("z"), "status": F.lit("FOUND")}
    )
    hop = lambda i, a, b: F.struct(F.lit(i).alias("pos"), F.lit(a).alias("from_region"), F.lit(b).alias("to_region"))
    hops = c.select(k.alias("chain_id"), F.explode(F.when(k % 11 == 0, F.array(hop(0, "a", "m"))).when(k % 17 == 0, F.array(hop(0, "a", "q"), hop(1, "m", "z"))).otherwise(F.array(hop(0, "a", "m"), hop(1, "m", "z")))).alias("h")).select("chain_id", "h.*")
    two = hops.join(c.select(k.alias("chain_id"), (k % 11 == 0).alias("one"), (k % 17 == 0).alias("q")), "chain_id")
    two = two.withColumn("from_region", F.when(F.col("one") & F.col("q"), "q").otherwise(F.col("from_region"))).drop("one", "q")
    opts = hops.filter(~((F.col("chain_id") % 23 == 0) & (F.col("pos") == 1))).select(
        "chain_id", F.col("pos").alias("hop_pos"), F.lit("c").alias("candidate_id"), F.when(F.col("chain_id") % 19 == 0, 1).otherwise(0).alias("rank"), F.lit(1.0).alias("km"), F.lit(1.0).alias("seconds"),
        F.lit(0).alias("tier"), F.lit(0).alias("source_rank"), F.lit(1).alias("way_id"), F.lit("FASTER").alias("route_style"),
    )
    return Q.check_chain_plan(plans, chains, two, opts)


@query(
    "check_hierarchical_plan",
    f"""with c as ({_CH}) select cast(k as varchar) as subject, 'distance_total' as code from c where k % 7 = 0 union select cast(k as varchar), 'score' from c where k % 13 = 0
    union select cast(k as varchar), 'entry_anchor' from c where k % 17 = 0 union select cast(k as varchar), 'exit_anchor' from c where k % 19 = 0 union select cast(k as varchar), 'region_without_matrix' from c where k % 3 = 0
    union select cast(k as varchar), 'traversal_metric' from c where k % 23 = 0 union select cast(k as varchar), 'distance_total' from c where k % 23 = 0 union select cast(k as varchar), 'rank' from c where p % 9 = 0""",
)
def _(t):
    c = t.sql(_CH)
    k, score = F.col("k"), (F.col("r") + 1).cast("double")
    mid = F.when(k % 3 == 0, "n").otherwise("m")
    chains = c.select(
        F.col("p").alias("plan_id"), k.alias("chain_id"), (F.col("r") + F.when(F.col("p") % 9 == 0, 1000000).otherwise(0)).alias("rank"), F.array(F.lit("a"), mid, F.lit("z")).alias("regions"), F.lit("FASTER").alias("route_style"),
        F.when(k % 7 == 0, 9.5).otherwise(2.5).alias("km"), score.alias("seconds"), (score + F.when(k % 13 == 0, 0.25).otherwise(0.0)).alias("score"),
    )
    x = lambda i, a, b: F.struct(F.lit(i).alias("pos"), a.alias("from_region"), b.alias("to_region"), F.concat(F.lit(f"x{i}-"), k.cast("string")).alias("exit_anchor"), F.concat(F.lit(f"e{i}-"), k.cast("string")).alias("entry_anchor"))
    crossings = c.select(k.alias("chain_id"), F.explode(F.array(x(0, F.lit("a"), mid), x(1, mid, F.lit("z")))).alias("c")).select("chain_id", "c.*")
    trav = c.select(
        k.alias("chain_id"), F.lit(0).alias("pos"), mid.alias("region_id"), F.when(k % 17 == 0, F.lit("q")).otherwise(F.concat(F.lit("e0-"), k.cast("string"))).alias("entry_anchor"),
        F.when(k % 19 == 0, F.lit("q")).otherwise(F.concat(F.lit("x1-"), k.cast("string"))).alias("exit_anchor"), F.when(k % 23 == 0, -1.0).otherwise(2.5).alias("km"), score.alias("seconds"),
    )
    return Q.check_hierarchical_plan(chains, crossings, trav, c.select(F.lit("m").alias("region_id")))


@query(
    "check_pair_metadata",
    """with o as (select o_orderkey as k, o_custkey as c from orders), p as (select c_custkey as c, concat('a', c_custkey, '__b') as id from customer)
    select cast(k as varchar) as subject, 'evidence_empty' as code from o where k % 7 = 0 union all select cast(k as varchar), 'separation' from o where k % 11 = 0 union all select cast(k as varchar), 'proof_state' from o where k % 13 = 0
    union all select id, 'version_missing' from p where c % 9 = 0 union all select id, 'to_boundary_fingerprint' from p where c % 10 = 0 union all select id, 'binding_state' from p where c % 11 = 0
    union all select id, 'validated_empty' from p where c % 2 = 0 and c not in (select c from o)
    union all select id, 'validated_without_proof' from p where c % 2 = 0 and c in (select c from o) and c not in (select c from o where k % 5 = 0)""",
)
def _(t):
    k = F.col("o_orderkey")
    name = lambda c: F.concat(F.lit("a"), c.cast("string"))
    c = F.col("c_custkey")
    fp = F.expr(SHA)
    pairs = t("customer").select(
        F.concat(name(c), F.lit("__b")).alias("pair_id"), name(c).alias("from_region"), F.lit("b").alias("to_region"), F.when(c % 9 == 0, " ").otherwise("v1").alias("from_version"), F.lit("v1").alias("to_version"),
        fp.alias("from_graph_fp"), fp.alias("to_graph_fp"), fp.alias("from_boundary_fp"), F.when(c % 10 == 0, "sha256:1").otherwise(fp).alias("to_boundary_fp"),
        F.when(c % 11 == 0, "LOOSE").otherwise("STABLE_PHYSICAL").alias("binding_state"), F.when(c % 2 == 0, "VALIDATED").otherwise("UNPROVEN").alias("validation_state"),
    )
    cu = F.col("o_custkey")
    state = F.when(k % 5 == 0, "VALID").otherwise("NOT_RUN")
    cands = t("orders").select(
        F.concat(name(cu), F.lit("__b")).alias("pair_id"), k.alias("candidate_id"), name(cu).alias("from_region"), F.lit("b").alias("to_region"),
        F.when(k % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("SAME_WAY"))).alias("evidence"), F.when(k % 11 == 0, -1.0).otherwise(1.0).alias("separation_m"),
        F.array(state, state, state, F.when(k % 13 == 0, "MAYBE").otherwise("NOT_RUN")).alias("states"),
    )
    return Q.check_pair_metadata(pairs, cands)


# --- refresh, publication, packs ------------------------------------------

_BOUND = """select concat('p', cast(o_orderkey as varchar(20))) as pair_id, o_orderkey as k, concat('c', cast(o_custkey as varchar(20))) as from_region, concat('c', cast((o_custkey + 1) % 100 as varchar(20))) as to_region from orders"""


def current_graphs(t: Tables) -> DataFrame:
    """One current graph per customer below 1400 with a boundary to one neighbour."""
    c = F.col("c_custkey").cast("string")
    cat = lambda p: F.concat(F.lit(p), c)
    return t("customer").filter("c_custkey % 15 <> 4").select(cat("c").alias("region_id"), cat("g").alias("graph_fp"), F.create_map(F.lit("n"), cat("b")).alias("boundaries"), cat("s").alias("source_id"), F.lit("v1").alias("version"))


_RP = f"""with b as (select *, try_cast(substr(from_region, 2) as bigint) as f, try_cast(substr(to_region, 2) as bigint) as g from ({_BOUND}) x),
  r as (select pair_id, list_filter([case when f % 15 = 4 then 'FROM_GRAPH_MISSING' when k % 5 = 0 then 'FROM_GRAPH_CHANGED' end, case when f % 15 <> 4 and k % 7 = 0 then 'FROM_BOUNDARY_CHANGED' end,
    case when g % 15 = 4 then 'TO_GRAPH_MISSING' end, case when g % 15 <> 4 and k % 11 = 0 then 'TO_BOUNDARY_MISSING' end], lambda z: z is not null) as reasons from b)
  select pair_id, array_to_string(reasons, ',') as reasons, case when len(list_filter(reasons, lambda z: z like '%GRAPH_MISSING')) > 0 then 'UNRESOLVED' when len(reasons) > 0 then 'STALE' else 'CURRENT' end as status,
    case when len(list_filter(reasons, lambda z: z like '%GRAPH_MISSING')) > 0 then 'WAIT_FOR_GRAPH' when len(list_filter(reasons, lambda z: z like '%BOUNDARY%')) > 0 then 'REDISCOVER_BOUNDARY' when len(reasons) > 0 then 'REBIND_GRAPH' else 'NONE' end as action from r"""


@query("refresh_pairs", _RP)
def _(t):
    k = F.col("k")
    num = lambda s: F.substring(f"{s}_region", 2, 20)
    rows = t.sql(_BOUND).withColumns(
        {
            "from_neighbour": F.lit("n"), "to_neighbour": F.when(k % 11 == 0, "other").otherwise("n"),
            "from_graph_fp": F.concat(F.lit("g"), num("from"), F.when(k % 5 == 0, "old").otherwise("")), "to_graph_fp": F.concat(F.lit("g"), num("to")),
            "from_boundary_fp": F.concat(F.lit("b"), num("from"), F.when(k % 7 == 0, "old").otherwise("")), "to_boundary_fp": F.concat(F.lit("b"), num("to")),
        }
    )
    return Q.refresh_pairs(rows, current_graphs(t)).withColumn("reasons", F.array_join("reasons", ","))


@query(
    "refresh_connectors",
    """select concat('c', k) as region_id, case action when 'NONE' then 'CURRENT' when 'BUILD_MATRIX' then 'MISSING' when 'BUILD_INVENTORY_AND_MATRIX' then 'MISSING' else 'STALE' end as status, action from (
      select c_custkey as k, case when c_custkey % 7 = 0 then 'BUILD_INVENTORY_AND_MATRIX' when c_custkey % 5 = 0 or c_custkey % 11 = 0 then 'REBUILD_INVENTORY_AND_MATRIX' when c_custkey % 13 = 0 then 'BUILD_MATRIX'
        when c_custkey % 17 = 0 or c_custkey % 19 = 0 then 'REBUILD_MATRIX' else 'NONE' end as action from customer where c_custkey % 15 <> 4) x""",
)
def _(t):
    g = current_graphs(t)
    k = F.substring("region_id", 2, 20).cast("long")
    inv = g.filter(k % 7 != 0).select("region_id", F.concat(F.lit("i"), "region_id").alias("sha256"), F.concat("graph_fp", F.when(k % 5 == 0, "old").otherwise("")).alias("graph_fp"), F.lit(3).alias("anchor_count"))
    src = inv.select("sha256", F.lit("n").alias("neighbour"), F.concat(F.lit("b"), F.substring("region_id", 2, 20), F.when(k % 11 == 0, "old").otherwise("")).alias("boundary_fp"))
    mat = g.filter(k % 13 != 0).select(
        "region_id", F.concat("graph_fp", F.when(k % 17 == 0, "old").otherwise("")).alias("graph_fp"), F.concat(F.lit("i"), "region_id").alias("source_sha256"), F.when(k % 19 == 0, 4).otherwise(3).alias("anchor_count")
    )
    return Q.refresh_connectors(g, inv, src, mat)


@query(
    "refresh_layers",
    """select concat('c', c_custkey) as region_id, case reason when 'SOURCE_CHANGED' then 'REBUILD_SOURCE' when 'PROFILE_CHANGED' then 'REBUILD_PROFILE' else case when reason is null then 'NONE' else 'REVALIDATE_ROADS' end end as action, reason from (
      select c_custkey, case when c_custkey % 5 = 0 then 'SOURCE_CHANGED' when c_custkey % 7 = 0 then 'PROFILE_CHANGED' when c_custkey % 11 = 0 then 'ROAD_INDEX_MISSING' when c_custkey % 13 = 0 or c_custkey % 17 = 0 then 'ROAD_VALIDATION_CHANGED' end as reason from customer) x""",
)
def _(t):
    k = F.col("c_custkey")
    region = F.concat(F.lit("c"), k.cast("string")).alias("region_id")
    has = k % 11 != 0
    manifests = t("customer").select(
        region, F.when(k % 5 == 0, "s0").otherwise("s1").alias("source_fp"), F.when(k % 7 == 0, "p0").otherwise("p1").alias("profile_fp"), F.lit("l").alias("layer_fp"),
        F.when(has, F.when(k % 5 == 0, "s0").otherwise("s1")).alias("index_source_fp"), F.when(has, F.lit("l")).alias("index_layer_fp"), F.when(has, F.array(F.lit("trunk"), F.lit("motorway"))).alias("index_classes"),
        F.when(has, F.when(k % 13 == 0, 80.0).otherwise(75.0)).alias("index_tolerance"), F.when(has, F.when(k % 17 == 0, 2).otherwise(0)).alias("index_missing"),
    )
    current = t("customer").select(region, F.lit("s1").alias("source_fp"), F.lit("p1").alias("profile_fp"), F.array(F.lit("motorway"), F.lit("trunk")).alias("classes"), F.lit(75.0).alias("tolerance"))
    return Q.refresh_layers(manifests, current)


_FILES = """select concat('c', cast(o_custkey as varchar(20))) as region_id, concat('v', cast(o_orderkey % 3 as varchar(20))) as version, case o_orderkey % 2 when 0 then 'ARTIFACT' else 'MANIFEST' end as role,
  concat('f', cast(o_orderkey as varchar(20))) as file_name, o_orderkey * 10 as size_bytes, concat('sha256:', cast(o_orderkey as varchar(20))) as sha256 from orders"""
_MANI = f"select distinct 'ROUTING' as kind, 'routing' as prefix, region_id, version, concat('2024-', version) as built_at from ({_FILES}) f"
_OBJ = "string_agg(concat_ws(',', role, concat_ws('/', 'routing', region_id, version, file_name), size_bytes, sha256), ';' order by role, file_name)"


@query(
    "publish_plan",
    f"""with r as (select region_id, version, {_OBJ} as objects from ({_FILES}) f group by region_id, version)
    select 'ROUTING' as kind, region_id, version, concat('2024-', version) as built_at, objects, concat_ws('/', 'routing', region_id, version, 'release.json') as release_key, concat_ws('/', 'routing', region_id, 'latest.json') as latest_key,
      concat('sha256:', sha256(concat('{{"builtAt":"2024-', version, '","kind":"ROUTING","objects":"', objects, '","prefix":"routing/', region_id, '/', version, '","regionId":"', region_id, '","version":"', version, '"}}'))) as release_sha256 from r""",
)
def _(t):
    out = Q.publish_plan(t.sql(_MANI), t.sql(_FILES))
    return out.withColumn("objects", F.array_join(F.transform("objects", lambda o: F.concat_ws(",", o["role"], o["key"], o["size_bytes"], o["sha256"])), ";"))


_KEYS = """select concat('p', cast(s_suppkey % 40 as varchar(20))) as plan_id, s_suppkey as k, concat(case when s_suppkey % 13 = 0 then 'elsewhere' else concat('routing/p', cast(s_suppkey % 40 as varchar(20))) end, '/f', cast(s_suppkey as varchar(20))) as key,
  'ARTIFACT' as role, concat('f', cast(s_suppkey as varchar(20))) as file_name, s_suppkey * 3 + 1 as size_bytes, concat('h', cast(s_suppkey as varchar(20))) as sha256, 'x/tar' as content_type from supplier"""


@query(
    "publish_plan_audit",
    f"""with k as ({_KEYS}), p as (select distinct plan_id, cast(substr(plan_id, 2) as int) as n from k)
    select plan_id as subject, 'release_sha' as code from p where n % 7 = 0 union select plan_id, 'latest_inside_prefix' from p where n % 9 = 0 union select plan_id, 'latest_sha' from p where n % 11 = 0
    union select key, 'key_outside_prefix' from k where k % 13 = 0 union select key, 'not_published' from k where k % 5 = 0 union select key, 'no_source' from k where k % 6 = 0 and k % 5 <> 0
    union select key, 'size_bytes_mismatch' from k where k % 4 = 1 and k % 5 <> 0 and k % 6 <> 0""".replace("from k where k % 13 = 0", "from k where k % 13 = 0 and k % 5 <> 0").replace("from k where k % 5 = 0", "from k where k % 5 = 0 and k % 6 <> 0"),
)
def _(t):
    keys = t.sql(_KEYS)
    k = F.col("k")
    n = F.substring("plan_id", 2, 9).cast("int")
    pre = F.concat(F.lit("routing/"), F.col("plan_id"))
    plans = keys.select("plan_id").distinct().select(
        "plan_id", pre.alias("prefix"), F.concat(pre, F.lit("/release.json")).alias("release_key"), F.when(n % 9 == 0, F.concat(pre, F.lit("/latest.json"))).otherwise(F.lit("routing/latest.json")).alias("latest_key"),
        F.lit("h").alias("release_sha256"), F.when(n % 7 == 0, "q").otherwise("h").alias("computed_sha256"), F.concat(pre, F.lit("/release.json")).alias("latest_release_key"), F.when(n % 11 == 0, "z").otherwise("h").alias("latest_sha256"),
    )
    published = keys.filter(k % 5 != 0)
    sources = keys.filter(k % 6 != 0).withColumn("size_bytes", F.col("size_bytes") + F.when(k % 4 == 1, 1).otherwise(0))
    return Q.publish_plan_audit(plans, published, sources)


@query(
    "publish_reconcile",
    f"""with k as ({_KEYS}), a as (select plan_id, key, case when k % 3 = 0 then 'CREATE' when k % 7 = 0 then 'CONFLICT' else 'CONFIRM' end as action from k)
    select *, not bool_or(action = 'CONFLICT') over (partition by plan_id) as pointer_may_move from a""",
)
def _(t):
    keys = t.sql(_KEYS)
    k = F.col("k")
    store = keys.filter(k % 3 != 0).select("key", "size_bytes", F.when(k % 7 == 0, "other").otherwise(F.col("sha256")).alias("sha256"))
    return Q.publish_reconcile(keys.select("plan_id", "key", "size_bytes", "sha256"), store)


@query(
    "activate_release",
    f"""with k as ({_KEYS}), p as (select plan_id, bool_or(k % 17 = 0) as broken from k group by plan_id)
    select concat('routing/', plan_id, '/release.json') as release_key, 'routing/latest.json' as latest_key, 'h' as release_sha256, plan_id as region_id, 'v' as version, 'ROUTING' as kind, '2024' as built_at from p where not broken""",
)
def _(t):
    keys = t.sql(_KEYS)
    pre = F.concat(F.lit("routing/"), F.col("plan_id"))
    rel = keys.select("plan_id").distinct().select(
        F.concat(pre, F.lit("/release.json")).alias("release_key"), pre.alias("prefix"), F.col("plan_id").alias("region_id"), F.lit("v").alias("version"), F.lit("ROUTING").alias("kind"), F.lit("2024").alias("built_at"), F.lit("h").alias("release_sha256"),
    )
    objects = keys.select(F.concat(pre, F.lit("/release.json")).alias("release_key"), "key", "size_bytes", "sha256")
    return Q.activate_release(rel, objects, keys.filter("k % 17 <> 0"))


@query(
    "check_graph_pack",
    faults(
        "customer",
        "concat('g', c_custkey)",
        file_name="c_custkey % 7 = 0",
        sha_mismatch="c_custkey % 11 = 0",
        tile_count="c_custkey % 13 = 0",
        source_size="c_custkey % 17 = 0",
        route_failed="c_custkey % 19 = 0",
        border_route_missing="c_custkey % 19 = 0",
    ),
)
def _(t):
    k = F.col("c_custkey")
    pack = F.concat(F.lit("g"), k.cast("string")).alias("pack_id")
    sha = F.expr("repeat('a', 64)")
    c = t("customer")
    man = c.select(
        pack, F.when(k % 7 == 0, "g.zip").otherwise("g.tar").alias("file_name"), F.lit(10).alias("size_bytes"), sha.alias("sha256"), F.when(k % 13 == 0, 3).otherwise(2).alias("tile_count"), F.concat(F.lit("sha256:"), sha).alias("graph_fp"),
        F.lit(25.0).alias("buffer_km"), F.lit(10).alias("actual_size"), F.when(k % 11 == 0, "x").otherwise(sha).alias("actual_sha256"),
    )
    tiles = c.select(pack, F.explode(F.array(F.lit("0/1.gph"), F.lit("0/2.gph"), F.lit("index.bin"))).alias("path"))
    src = c.select(pack, F.lit("p").alias("source_id"), F.when(k % 17 == 0, 0).otherwise(5).alias("size_bytes"), sha.alias("sha256"))
    routes = c.select(pack, F.lit("border").alias("kind"), (k % 19 != 0).alias("passed"))
    return Q.check_graph_pack(man, tiles, src, routes)


@query(
    "identity_audit",
    """with o as (select o_orderkey as k, concat('p', o_orderkey) as id, o_custkey % 15 = 4 as gone, ((o_custkey + 1) % 100) % 15 = 4 as gone_b from orders)
    select id as subject, 'from_graph_missing' as code from o where gone union all select id, 'to_graph_missing' from o where gone_b
    union all select id, 'from_version_stale' from o where k % 5 = 0 and not gone union all select id, 'from_boundary_stale' from o where k % 7 = 0 and not gone union all select id, 'to_graph_stale' from o where k % 11 = 0 and not gone_b
    union all select id, 'from_source_mismatch' from o where not gone union all select id, 'to_source_mismatch' from o where not gone_b""",
)
def _(t):
    k = F.col("k")
    num = lambda s: F.substring(f"{s}_region", 2, 20)
    rows = t.sql(_BOUND).withColumns(
        {
            "from_version": F.when(k % 5 == 0, "v0").otherwise("v1"), "to_version": F.lit("v1"), "from_graph_fp": F.concat(F.lit("g"), num("from")), "to_graph_fp": F.concat(F.lit("g"), num("to"), F.when(k % 11 == 0, "old").otherwise("")),
            "from_boundary_fp": F.concat(F.lit("b"), num("from"), F.when(k % 7 == 0, "old").otherwise("")), "to_boundary_fp": F.concat(F.lit("b"), num("to")), "from_boundary_source": F.lit("n"), "to_boundary_source": F.lit("n"),
        }
    )
    return Q.identity_audit(rows, current_graphs(t))


@query(
    "check_layer_pack",
    faults(
        "customer",
        "concat('m', c_custkey)",
        size_mismatch="c_custkey % 7 = 0",
        required_not_declared="c_custkey % 11 = 0",
        layer_not_recorded="c_custkey % 11 = 0",
        forbidden_declared="c_custkey % 13 = 0",
        tile_count="c_custkey % 17 = 0",
        roads_missing="c_custkey % 19 = 0",
        index_missing_count="c_custkey % 19 = 0",
        index_version="c_custkey % 23 = 0",
    ),
)
def _(t):
    k = F.col("c_custkey")
    pack = F.concat(F.lit("m"), k.cast("string")).alias("pack_id")
    sha = F.expr("repeat('a', 64)")
    names = lambda *n: F.array(*[F.lit(x) for x in n])
    layers = F.when(k % 11 == 0, names("place")).otherwise(names("place", "water"))
    layers = F.when(k % 13 == 0, F.concat(layers, names("poi"))).otherwise(layers)
    base = [F.lit("r").alias("region_id"), F.lit("s").alias("source_fp"), F.concat(F.lit("sha256:"), sha).alias("layer_fp"), F.lit(5).alias("road_count")]
    c = t("customer")
    man = c.select(
        pack, *base, F.lit("v1").alias("version"), F.lit(0).alias("missing_count"), F.lit(10).alias("size_bytes"), sha.alias("sha256"), F.when(k % 7 == 0, 11).otherwise(10).alias("actual_size"), sha.alias("actual_sha256"),
        F.when(k % 17 == 0, 4).otherwise(3).alias("tile_count"), F.lit(3).alias("min_zoom"), F.lit(14).alias("max_zoom"), layers.alias("layers"), names("water").alias("required"),
    )
    idx = c.select(pack, *base, F.when(k % 23 == 0, "v0").otherwise("v1").alias("version"), F.when(k % 19 == 0, 2).otherwise(0).alias("missing_count"))
    obs = c.select(pack, names("place", "water").alias("layers"), F.lit(3).alias("tiles"), F.lit(3).alias("min_zoom"), F.lit(14).alias("max_zoom"))
    return Q.check_layer_pack(man, idx, obs, D.FORBIDDEN_LAYERS)
