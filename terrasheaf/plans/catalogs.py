"""Queries over regions, sources, releases, layers and recorded routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import catalog as C, graph as G, routes as R, spatial as X
from .registry import Tables, query
from .spatial import _POLY_CELLS, _SQUARE_CELLS, shape_of, squares


@query(
    "region_ancestry",
    """with n as (select id, nullif(parent, '') as parent, iso from v_regions),
      a as (select n.id, n.parent as p1, m.parent as p2, n.iso as i0, m.iso as i1, m.id is not null as known from n left join n m on m.id = n.parent),
      p as (select id, list_filter([p2, p1, id], lambda x: x is not null) as path, coalesce(i0, i1) as first_iso, case when i0 is not null then id when i1 is not null then p1 end as country_id,
        upper(case when length(i0) = 2 then i0 when length(i1) = 2 then i1 end) as country_iso from a)
    select id, array_to_string(case when len(path) > 1 and path[1] in ('africa','asia','australia-oceania','central-america','europe','north-america','south-america') then path[2:] else path end, '/') as canonical_id,
      country_id, country_iso from p""",
)
def _(t):
    return C.region_ancestry(t("v_regions"))


@query(
    "leaf_regions",
    "select id from v_regions r where url <> '' and not exists (select 1 from v_regions c where c.parent = r.id and c.url <> '')",
)
def _(t):
    return C.leaf_regions(t("v_regions")).select("id")


def _buffer(t: Tables) -> DataFrame:
    return X.area_cells(t("v_poly"), 0.01)


@query(
    "source_cover",
    f"""with c as (select s.region_id as source_id, s.cy, s.cx, q.side from ({_SQUARE_CELLS}) s join (select concat('o', o_orderkey) as r, o_custkey % 3 as side, o_orderkey as k from orders) q on q.r = s.region_id
        where (s.cy, s.cx) in (select (cy, cx) from ({_POLY_CELLS}) p where region_id = 'rb')),
      f as (select cy, cx, min_by(source_id, (case when source_id = 'o1' then 0 else 1000000 + side * 100000 end)::varchar || source_id) as s from c group by cy, cx),
      n as (select s, count(*) as n from f group by s)
    select d.source_id, coalesce(n, 0) as own_cells, d.source_id = 'o1' or coalesce(n, 0) > 0 as selected from (select distinct source_id from c) d left join n on n.s = d.source_id""",
)
def _(t):
    order = t("orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("source_id"), (F.col("o_custkey") % 3).alias("size_order"))
    cells = X.area_cells(squares(t), 0.01).withColumnRenamed("region_id", "source_id").join(order, "source_id")
    cells = cells.join(_buffer(t).filter("region_id = 'rb'").select("cy", "cx"), ["cy", "cx"], "left_semi")
    rows = cells.withColumns({"region_id": F.lit("rb"), "is_primary": F.col("source_id") == "o1"})
    return C.source_cover(rows).select("source_id", "own_cells", "selected")


@query(
    "source_preview",
    f"""select p.region_id, s.region_id as source_id, count(*) as overlap_cells, s.region_id = case p.region_id when 'ra' then 'o2' else 'o3' end as is_primary
    from ({_SQUARE_CELLS}) s join ({_POLY_CELLS}) p on p.cy = s.cy and p.cx = s.cx group by 1, 2""",
)
def _(t):
    leaves = X.area_cells(squares(t), 0.01).withColumnRenamed("region_id", "source_id")
    buffer = _buffer(t).withColumn("primary_id", F.when(F.col("region_id") == "ra", "o2").otherwise("o3"))
    return C.source_preview(leaves, buffer)


_OSM = """select case o_orderkey % 3 when 0 then 'n' when 1 then 'w' else 'r' end as type, o_orderkey % 5000 as id, o_orderkey as version, o_custkey as timestamp, o_orderstatus <> 'P' as visible, o_orderpriority as tag from orders"""


@query(
    "latest_versions",
    f"""select type, id, version, timestamp, visible, tag from (
      select *, row_number() over (partition by type, id order by version desc, timestamp desc) as rn from ({_OSM}) o) x where rn = 1 and visible""",
)
def _(t):
    return C.latest_versions(t.sql(_OSM))


_REL = """select concat('r', cast(s_nationkey as varchar(20))) as region_id, case s_suppkey % 3 when 0 then 'SEARCH' when 1 then 'ROUTING' else 'VISUAL' end as kind,
  concat('v', cast(s_suppkey as varchar(20))) as version, concat('2024-', cast(10 + s_suppkey % 3 as varchar(20))) as built_at, s_name as key from supplier"""


@query(
    "release_history",
    f"""select *, row_number() over (partition by region_id, kind order by built_at desc, version desc) = 1 as latest from ({_REL}) r""",
)
def _(t):
    return C.release_history(t.sql(_REL))


# Tagged objects: values chosen from the part columns.
_TAGS = """select p_partkey as id, p_partkey % 4 = 0 as is_node, p_size % 2 = 0 as is_closed,
  case p_partkey % 12 when 0 then 'city' when 4 then 'village' else '' end as place, case when p_partkey % 12 = 8 then 'peak' when p_partkey % 10 = 3 then 'water' else '' end as natural_,
  case p_partkey % 5 when 1 then 'motorway' when 2 then 'residential' when 3 then 'proposed' else '' end as highway, case when p_size % 3 = 0 then '' else p_name end as name,
  case when p_size % 4 = 0 then concat('A', cast(p_size as varchar(20))) else '' end as ref, case when p_partkey % 7 = 1 then 'river' else '' end as waterway,
  case when p_partkey % 9 = 1 then 'administrative' else '' end as boundary, cast(p_size % 13 as varchar(20)) as admin_level, case when p_partkey % 11 = 2 then cast(p_size % 9 as bigint) end as relation_level,
  case when p_size % 5 = 0 then 'yes' when p_size % 5 = 1 then 'no' else '' end as bridge, cast(p_retailprice as varchar(30)) as ele
  from part"""


def _attr(*pairs: tuple[str, str]) -> str:
    """Comparison SQL: filled attributes as sorted ``key=value`` text."""
    items = ", ".join(f"case when {v} <> '' then '{k}=' || {v} end" for k, v in sorted(pairs))
    return f"concat_ws(';', {items})"


@query(
    "layer_classify",
    f"""with t as ({_TAGS}), lv as (select *, least(case when boundary = 'administrative' then admin_level::int else 99 end, coalesce(relation_level, 99)) as level from t)
    select id, 'place' as layer, case place when 'city' then 5 else 10 end as min_zoom, place as class, null as subclass, {_attr(('name', 'name'))} as attributes from t where is_node and place <> ''
    union all select id, 'mountain_peak', 9, natural_, null, {_attr(('name', 'name'), ('ele', "floor(ele::double)::bigint::varchar"))} from t where is_node and place = '' and natural_ = 'peak'
    union all select id, 'transportation', case highway when 'motorway' then 4 else 12 end, case highway when 'motorway' then 'motorway' else 'minor' end, highway,
      {_attr(('ref', 'ref'), ('bridge', "case when bridge = 'yes' then 'yes' else '' end"))} from t where not is_node and highway in ('motorway', 'residential')
    union all select id, 'transportation_name', case highway when 'motorway' then 7 else 12 end, case highway when 'motorway' then 'motorway' else 'minor' end, highway, {_attr(('ref', 'ref'), ('name', 'name'))}
      from t where not is_node and highway in ('motorway', 'residential') and (name <> '' or ref <> '')
    union all select id, 'waterway', 8, 'river', null, {_attr(('name', 'name'))} from t where not is_node and waterway = 'river'
    union all select id, 'water', 6, 'lake', null, {_attr(('name', 'name'))} from t where not is_node and is_closed and natural_ = 'water'
    union all select id, 'boundary', case when level <= 4 then 3 when level <= 6 then 8 when level = 7 then 10 else 12 end, null, null, concat('admin_level=', level, ';disputed=0')
      from lv where not is_node and (boundary = 'administrative' or relation_level is not null) and level <= 10""",
)
def _(t):
    tags = {"place": "place", "natural": "natural_", "highway": "highway", "name": "name", "ref": "ref", "waterway": "waterway", "boundary": "boundary", "admin_level": "admin_level", "bridge": "bridge", "ele": "ele"}
    kv = [x for k, c in tags.items() for x in (F.lit(k), F.col(c))]
    out = C.layer_classify(t.sql(_TAGS).withColumn("tags", F.create_map(*kv)))
    text = F.array_sort(F.transform(F.map_entries("attributes"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return out.withColumn("attributes", F.array_join(text, ";"))


# --- recorded routes ------------------------------------------------------


@query(
    "best_route",
    """select journey as journey_id, 'FASTER' as style, min_by(route_id, seconds * 10000000 + route_id) as candidate_id from v_routes where success and length_km is not null group by journey
    union all select journey, 'SHORTER', min_by(route_id, round(length_km * 100) * 10000000 + route_id) from v_routes where success and length_km is not null group by journey""",
)
def _(t):
    rows = t("v_routes").filter("length_km is not null").select(F.col("journey").alias("journey_id"), F.col("route_id").alias("candidate_id"), "seconds", F.col("length_km").alias("km"), "success")
    return R.best_route(rows)


_H = "2*{r}*asin(least(1.0e0, sqrt(pow(sin(radians({c}-{a})/2),2) + cos(radians({a}))*cos(radians({c}))*pow(sin(radians({d}-{b})/2),2))))"
_SO = _H.format(r="6371000.0e0", a="start_lat", b="start_lon", c="actual_start_lat", d="actual_start_lon")
_EO = _H.format(r="6371000.0e0", a="end_lat", b="end_lon", c="actual_end_lat", d="actual_end_lon")


@query(
    "route_arrival_audit",
    f"""with o as (select *, {_SO} as s, {_EO} as e from v_routes), f as (select *, case when status <> 0 then 'route_status' when length_km is null then 'missing_route_summary' when s > 150 or e > 150 then 'route_endpoints_mismatch' end as failure from o)
    select route_id, round(s, 3) + 0.0e0 as start_offset_m, round(e, 3) + 0.0e0 as end_offset_m, failure, failure is null as passed from f""",
)
def _(t):
    out = R.route_arrival_audit(t("v_routes"))
    return out.withColumns({c: F.round(c, 3) for c in ("start_offset_m", "end_offset_m")})


@query(
    "border_endpoints",
    """select s.route_id, s.inside as start_in, e.inside as end_in, s.inside <> e.inside as valid from d_route_in s join d_route_in e on e.route_id = s.route_id and e.which = 'end' where s.which = 'start'""",
)
def _(t):
    return R.border_endpoints(t("v_routes"), t("v_poly").filter("region_id = 'ra'"))


@query(
    "route_crossing_audit",
    """with p as (select route_id, bool_or(inside) filter (where which = 'start') as s, bool_or(inside) filter (where which = 'end') as e, bool_or(inside) filter (where which = 'a') as a, bool_or(inside) filter (where which = 'z') as z from d_route_in group by route_id),
      x as (select distinct r.route_id from v_routes r join v_poly q on q.region_id = 'ra'
        where sign((ex-ax)*(actual_start_lat-ay)-(ey-ay)*(actual_start_lon-ax)) <> sign((ex-ax)*(actual_end_lat-ay)-(ey-ay)*(actual_end_lon-ax))
        and sign((actual_end_lon-actual_start_lon)*(ay-actual_start_lat)-(actual_end_lat-actual_start_lat)*(ax-actual_start_lon)) <> sign((actual_end_lon-actual_start_lon)*(ey-actual_start_lat)-(actual_end_lat-actual_start_lat)*(ex-actual_start_lon))),
      f as (select r.route_id, case when sqrt(pow((actual_start_lon-start_lon)*111.3e0*cos(radians(start_lat)),2)+pow((actual_start_lat-start_lat)*111.3e0,2)) > 5
          or sqrt(pow((actual_end_lon-end_lon)*111.3e0*cos(radians(end_lat)),2)+pow((actual_end_lat-end_lat)*111.3e0,2)) > 5 then 'snapped_far'
        when coalesce(length_km, 0) > 80 then 'too_long' when x.route_id is null then 'no_crossing' when s = e then 'same_side_requested' when a <> s or z <> e then 'other_side_driven' end as reason
        from v_routes r join p on p.route_id = r.route_id left join x on x.route_id = r.route_id)
    select route_id, reason is null as proven, reason from f""",
)
def _(t):
    rows = t("v_routes").withColumn("shape", shape_of(("actual_start_lat", "actual_start_lon"), ("actual_end_lat", "actual_end_lon")))
    return R.route_crossing_audit(rows, t("v_poly").filter("region_id = 'ra'"))


def proposals(t: Tables) -> DataFrame:
    return G.crossing_proposals(t("v_edges_b"), t("v_edges_a"), "a__b", "sha256:aa", "sha256:bb", "from-to")


_PROP = "select concat('nf8gps-', substr(sha256(concat_ws('|', 'a__b', 'sha256:aa', 'sha256:bb', 'from-to', graph_id)), 1, 24)) as id, graph_id, inner_lat as lat, inner_lon as lon from v_edges_b"
_D1 = _H.format(r="6371008.8e0", a="46.02e0", b="12.001e0", c="lat", d="lon")
_D2 = _H.format(r="6371008.8e0", a="lat", b="lon", c="46.08e0", d="12.02e0")


@query(
    "diverse_proposals",
    f"""with p as (select *, {_D1} + {_D2} as d from ({_PROP}) q), c as (select *, row_number() over (partition by floor(lat/0.015e0), floor(lon/0.015e0) order by round(d, 6), id) as n from p)
    select id, graph_id as receiver_graph_id from c where n <= 2 order by round(d, 6), id limit 10""",
)
def _(t):
    return R.diverse_proposals(proposals(t), (46.02, 12.001), (46.08, 12.02), 10).select("id", "receiver_graph_id")


@query(
    "ordinal_page",
    f"""with p as (select *, row_number() over (order by graph_id) - 1 as ordinal, count(*) over () as total from ({_PROP}) q)
    select ordinal, id, graph_id as receiver_graph_id, total, case when 132 < total then 132 end as next_cursor, true as bound from p where ordinal between 100 and 131""",
)
def _(t):
    return R.ordinal_page(proposals(t), 100, 32, ("a__b", "sha256:aa", "sha256:bb"))


_RANKED = "select l_orderkey as grp, l_linenumber - 1 + case when l_partkey % 29 = 0 then 1 else 0 end as rk, cast(l_linenumber * 10 + case when l_suppkey % 23 = 0 then 50 else 0 end as bigint) as k1, l_partkey as k2, l_suppkey as k3 from lineitem"


@query(
    "rank_contiguity",
    f"""with r as (select *, count(*) over (partition by grp) as n, count(*) over (partition by grp, rk) as d from ({_RANKED}) x),
      p as (select grp, rk + 1 as rk, max_by(k1, k1 * 1000000000000 + k2 * 1000000 + k3) as p1, max_by(k2, k1 * 1000000000000 + k2 * 1000000 + k3) as p2, max_by(k3, k1 * 1000000000000 + k2 * 1000000 + k3) as p3 from r group by grp, rk)
    select cast(grp as varchar) as subject, code, count(*) as n from (select grp, 'rank_not_contiguous' as code from r where rk < 0 or rk >= n or d > 1
      union all select r.grp, 'order_broken' from r join p on p.grp = r.grp and p.rk = r.rk where p1 > k1 or (p1 = k1 and (p2 > k2 or (p2 = k2 and p3 > k3)))) v group by 1, 2""",
)
def _(t):
    out = R.rank_contiguity(t.sql(_RANKED), "grp", "rk", ["k1", "k2", "k3"], F.col("grp"))
    return out.groupBy("subject", "code").agg(F.count(F.lit(1)).alias("n"))


_LEGS = """select o_orderkey as case_id, o_orderkey as source_id, o_orderkey + 1 as receiver_id, case when o_orderkey % 2 = 0 then 1 else 1024 end as mode_bit,
  case when o_orderkey % 31 = 0 then 0 else 1025 end as source_access, 1025 as receiver_access, case when o_orderkey % 37 = 0 then 2.5e0 else 0.2e0 end as node_gap_m,
  case when o_orderkey % 41 = 0 then 'FAILED' when o_orderkey % 43 = 0 then 'INCONCLUSIVE' else 'SUCCEEDED' end as a_status, case when o_orderkey % 47 = 0 then 40.0e0 else 3.0e0 end as a_start_m, 0.3e0 as a_end_m,
  o_orderkey % 7 = 0 as a_none, o_orderkey % 11 = 0 as a_other, case when o_orderkey % 13 = 0 then 'INCONCLUSIVE' else 'SUCCEEDED' end as b_status, 0.4e0 as b_start_m, 5.0e0 as b_end_m,
  case when o_orderkey % 17 = 0 then 1.7e0 else 0.1e0 end as handoff_m, o_orderkey % 19 = 0 as b_none, o_orderkey % 3 as b_kind, cast(o_custkey as double) as a_seconds, 10.0e0 as b_seconds, 1.5e0 as a_km, 2.5e0 as b_km from orders"""


@query(
    "two_leg_verdict",
    f"""with v as (select *, case when a_status <> 'SUCCEEDED' then 'leg_a_failed' when a_start_m > 25 then 'leg_a_not_at_terminal' when a_none then 'leg_a_trace_missing' when a_other then 'leg_a_other_last_edge'
        when b_status <> 'SUCCEEDED' then 'leg_b_failed' when handoff_m > 1 then 'leg_b_not_at_terminal' when b_none then 'leg_b_trace_missing' when b_kind = 2 then 'leg_b_does_not_continue'
        when source_access = 0 then 'access_unsupported' when node_gap_m > 1 then 'nodes_not_colocated' end as reason from ({_LEGS}) x)
    select case_id, reason, case when reason is null then 'GRAPH_LOCAL_TRACES_MATCHED_FOR_THIS_JOURNEY' when reason in ('leg_a_trace_missing', 'leg_b_trace_missing') or (reason = 'leg_a_failed' and a_status = 'INCONCLUSIVE') or reason = 'leg_b_failed' then 'INCONCLUSIVE' else 'UNPROVEN' end as status,
      case when reason is null then a_seconds + b_seconds end as seconds, case when reason is null then a_km + b_km end as km from v""",
)
def _(t):
    c = F.col
    none = F.array().cast("array<bigint>")
    rows = t.sql(_LEGS).withColumns(
        {
            "outgoing": F.array(c("receiver_id") + 1, c("receiver_id") + 2),
            "a_edges": F.when(c("a_none"), none).otherwise(F.array(F.lit(7).cast("bigint"), c("source_id") + c("a_other").cast("int"))),
            "b_edges": F.when(c("b_none"), none)
            .when(c("b_kind") == 0, F.array(c("receiver_id") + 1))
            .when(c("b_kind") == 1, F.array(c("receiver_id"), c("receiver_id") + 2))
            .otherwise(F.array(c("receiver_id"), c("receiver_id") + 9)),
        }
    )
    return R.two_leg_verdict(rows)


@query(
    "route_edge_audit",
    """with x as (select l_orderkey as route_id, list(l_partkey + 1 order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as edges from lineitem group by l_orderkey),
      r as (select *, len(edges) + case when route_id % 5 = 0 then 2 else 1 end as node_count, edges[1] + case when route_id % 7 = 0 then 1 else 0 end as first_id, edges[-1] as last_id, edges[-1] + case when route_id % 11 = 0 then 100000000 else 0 end as expected_last,
        case when route_id % 13 = 0 then 0.0e0 else 5.0e0 end as seconds, case when route_id % 17 = 0 then 4.0e0 else 0.5e0 end as start_m from x)
    select route_id, code from r, unnest([case when node_count <> len(edges) + 1 then 'node_count' end, case when first_id <> edges[1] then 'first_id' end, case when seconds <= 0 then 'cost_not_positive' end,
      case when last_id <> expected_last then 'not_expected_edge' end, case when start_m > 1 then 'snap_too_far' end, case when expected_last - 1 not in (select p_partkey from part where p_size % 6 <> 0) then 'edge_not_registered' end]) as u(code) where code is not null""",
)
def _(t):
    rows = t("lineitem").groupBy(F.col("l_orderkey").alias("route_id")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))).alias("s")
    )
    rows = rows.withColumn("edges", F.transform("s", lambda x: x["l_partkey"] + 1))
    r, last = F.col("route_id"), F.element_at("edges", -1)
    pick = lambda m, a, b: F.when(r % m == 0, F.lit(a)).otherwise(F.lit(b))
    rows = rows.withColumns(
        {
            "node_count": F.size("edges") + pick(5, 2, 1),
            "first_id": F.element_at("edges", 1) + pick(7, 1, 0),
            "last_id": last,
            "expected_last": last + pick(11, 100000000, 0),
            "seconds": pick(13, 0.0, 5.0),
            "km": F.lit(1.0),
            "start_m": pick(17, 4.0, 0.5),
            "end_m": F.lit(0.5),
        }
    )
    register = t("part").filter("p_size % 6 <> 0").select((F.col("p_partkey") + 1).alias("graph_id"))
    return R.route_edge_audit(rows, register)


_PROOF_OF = """select o_orderkey as final_id, '{0}' as mode, case when o_orderkey % 5 = 0 then 'ONE_HOP' else 'DIRECT' end as method, o_orderkey % 7 <> 0 or '{0}' = 'auto' as proven,
  o_orderkey + 1 as predecessor_id, o_orderkey % 11 = 0 as wrong_tail, case when o_orderkey % 13 = 0 then 3.0e0 else 0.5e0 end as start_m, case when o_orderkey % 15 = 0 then 1 else 2 end as declared_count
  from orders"""
_PROOF = _PROOF_OF.format("auto") + " union all " + _PROOF_OF.format("motorcycle")
_PATH = "select o_orderkey as final_id, concat('k', cast(case when o_orderkey % 17 = 0 then 0 else {} end as varchar(20))) as path_key, case when o_orderkey % 19 = 0 then 3 else 2 end as expected from orders"
_PATHS = _PATH.format(0) + " union all " + _PATH.format(1)


@query(
    "trace_proof_audit",
    f"""with p as ({_PROOF}) select distinct cast(final_id as varchar) as subject, 'proven_without_suffix' as code from p where proven and (wrong_tail or start_m > 1)
    union select cast(final_id as varchar), 'one_hop_count_mismatch' from p where method = 'ONE_HOP' group by final_id having count(case when proven then 1 end) <> max(declared_count)
    union select cast(final_id as varchar), 'mode_without_proof' from p group by final_id having count(distinct case when proven then mode end) < 2
    union select cast(o_orderkey as varchar), 'path_repeated' from orders where o_orderkey % 17 = 0 union select cast(o_orderkey as varchar), 'witness_count_mismatch' from orders where o_orderkey % 19 = 0""",
)
def _(t):
    c = F.col
    tail = c("final_id") + F.when(c("wrong_tail"), 5).otherwise(0)
    rows = t.sql(_PROOF).withColumns({"trace": F.array(F.lit(3).cast("bigint"), c("predecessor_id"), tail), "end_m": F.lit(0.2)})
    return R.trace_proof_audit(rows, t.sql(_PATHS))
