"""Queries that match source finals of one graph to roads of the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import graph as G, match as M
from . import graph as PG, spatial as PS
from .registry import Tables, query
from .spatial import _H, _LEN, _MEET, shape_of, shapes
from .views import VIEWS, projection


def r3(expr: str, digits: int = 3) -> str:
    return f"round({expr}, {digits}) + 0.0e0"


def candidates(t: Tables) -> DataFrame:
    return t.held("candidates", lambda: _candidates(t, PG.sources(t)))


def _candidates(t: Tables, sources: DataFrame | None = None) -> DataFrame:
    sources = PG.find_sources(t) if sources is None else sources
    # The shape's end and approach are looked up for the few edges that end; no edge moves for that, as edges lie by gid.
    ends = t("v_edges_a").select(
        F.col("gid").alias("of_gid"),
        F.col("graph_id").alias("of_id"),
        F.col("forward_access").alias("access"),
        "end_node",
        F.col("end_lat").alias("x_lat"),
        F.col("end_lon").alias("x_lon"),
        F.when(F.col("gid") % 43 != 0, F.col("inner_lat")).alias("app_lat"),
        F.col("inner_lon").alias("app_lon"),
        "layer",
        "bridge",
        "tunnel",
    )
    modes = F.col("terminal_modes").bitwiseAND(F.lit(1025)).alias("modes")
    found = sources.filter("graph_id is not null").select("gid", F.col("graph_id").alias("source_id"), modes).filter("modes <> 0")
    # The id decides between the few edges of a gid; as a key of its own it would move all edges.
    same = (F.col("gid") == F.col("of_gid")) & F.col("source_id").between(F.col("of_id"), F.col("of_id"))
    return found.join(ends, same).select("source_id", "modes", *ends.columns[2:])


def overlaps(t: Tables) -> DataFrame:
    return t.held("overlaps", lambda: _overlaps(t))


def _overlaps(t: Tables) -> DataFrame:
    c = candidates(t)
    r = shapes(t, "v_shape_b").withColumns({f"r_{x}": F.col(x) for x in ("layer", "bridge", "tunnel")}).withColumn("r_access", F.col("forward_access"))
    # What the comparison reads travels with the search, so that no pair is moved again.
    met = M.edges_at_point(
        c, r, of_point=["access", "x_lat", "x_lon", "app_lat", "app_lon", "layer", "bridge", "tunnel"], of_edge=["gid", "r_access", "r_layer", "r_bridge", "r_tunnel", "shape"]
    ).withColumnRenamed("shape", "r_shape")
    return M.directed_overlap(met).select(
        "source_id", "receiver_id", "status", "common_modes", "same_structure", "x_m", "approach_m", "progress_m", "segment_m", "remaining_m", "gid"
    )


def correlated(t: Tables) -> dict[str, DataFrame]:
    return t.held_all("correlated", lambda: _correlated(t))


def _correlated(t: Tables) -> dict[str, DataFrame]:
    found = overlaps(t)
    # Only receivers that end at the point are asked for what follows them.
    ends = found.filter(F.col("status") == M.ENDS_AT_X).select("gid", F.col("receiver_id").alias("graph_id")).distinct()
    return M.correlate(candidates(t), found, t.starting_at("v_optb", ends))


def catalog(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    found = correlated(t)
    return M.handoff_catalog(candidates(t), found), found


def ab_pairs(t: Tables) -> DataFrame:
    # Both edges of a pair are of one gid, by which the edges lie.
    ab = t.sql(VIEWS["v_ab"].replace("select ", "select a.gid as gid, ", 1))
    return ab.select(
        "gid",
        F.col("a_id").alias("source_id"),
        F.col("b_id").alias("receiver_id"),
        F.col("a_way").alias("source_way"),
        F.col("b_way").alias("receiver_way"),
        shape_of(("aa0", "ao0"), ("aa1", "ao1"), ("aa2", "ao2")).alias("shape"),
        shape_of(("ba0", "bo0"), ("ba1", "bo1"), ("ba2", "bo2")).alias("r_shape"),
    )


_TOPO = """select a.graph_id as source_id, count(n.receiver_id) as nearby, count(case when source_way = receiver_way then 1 end) as same_way,
  count(case when source_way = receiver_way and not receiver_deadend then 1 end) as continuing,
  coalesce(bool_or(source_way = receiver_way and not receiver_deadend and distance_m <= 0.25), false) as submetre
  from v_edges_a a left join d_near n on n.source_id = a.graph_id where a.deadend group by a.graph_id"""


@query(
    "receiver_topology",
    f"""select *, case when continuing > 0 then 'PROVISIONAL_SAME_WAY_NON_DEADEND_RECEIVER' when same_way > 0 then 'UNRESOLVED_RECEIVER_ALSO_DEADEND'
      when nearby > 0 then 'UNRESOLVED_DIFFERENT_WAY_NEARBY' else 'UNRESOLVED_NO_NEARBY_RECEIVER_INCOMING' end as status from ({_TOPO}) x""",
)
def _(t):
    return M.receiver_topology(t("v_edges_a"), PG.near(t))


@query(
    "topology_counts",
    f"""with x as ({_TOPO}), s as (select count(*) as dead_ends, sum(nearby)::bigint as nearby_occurrences, sum(same_way)::bigint as same_way_occurrences, sum(continuing)::bigint as continuing_occurrences,
      count(case when nearby > 0 then 1 end) as with_nearby, count(case when same_way > 0 then 1 end) as with_same_way, count(case when continuing > 0 then 1 end) as with_continuation,
      count(case when continuing > 1 then 1 end) as ambiguous_continuations, count(case when continuing > 0 and submetre then 1 end) as submetre_colocated,
      count(case when continuing = 0 and same_way > 0 then 1 end) as only_dead_end_receiver, count(case when same_way = 0 and nearby > 0 then 1 end) as only_other_way,
      count(case when nearby = 0 then 1 end) as none_nearby from x)
    select counter, n from (unpivot s on columns(*) into name counter value n)""",
)
def _(t):
    return M.topology_counts(M.receiver_topology(t("v_edges_a"), PG.near(t)))


_ENDS = "select graph_id, gid % 9 <> 1 as matched, deadend from v_edges_a where gid % 21 <> 2"
_PROBES = "select graph_id, gid % 4 <> 0 as found, gid % 4 <> 0 and gid % 5 <> 0 as continues from v_edges_a where gid % 6 <> 3 and (deadend or gid % 77 = 5)"


@query(
    "terminal_evidence",
    f"""with n as ({_ENDS}), p as ({_PROBES})
    select e.graph_id, case when not coalesce(n.matched, false) then 'UNRESOLVED_ENDPOINT' when not n.deadend and found is not null then 'PROBE_WITHOUT_DEAD_END'
      when not n.deadend then 'NOT_A_DEAD_END' when found is null then 'UNRESOLVED_PROBE' when not found then 'NO_NEIGHBOUR'
      when not continues then 'NEIGHBOUR_ALSO_STOPS' else 'PROVISIONAL_TERMINAL' end as status
    from v_edges_a e left join n on n.graph_id = e.graph_id left join p on p.graph_id = e.graph_id""",
)
def _(t):
    return M.terminal_evidence(t("v_edges_a"), t.sql(_ENDS), t.sql(_PROBES))


@query(
    "clip_terminals",
    """with o as (select source_id, bool_or((option_access & 1) <> 0) as a, bool_or((option_access & 1024) <> 0) as m from v_out_a where option_id <> opposing_id group by source_id),
      r as (select e.graph_id, mode, deadend and (forward_access & bit) <> 0 and not coalesce(case when mode = 'auto' then a else m end, false) as local_terminal
        from v_edges_a e cross join (select 'auto' as mode, 1 as bit union all select 'motorcycle', 1024) b left join o on o.source_id = e.graph_id where e.graph_id in (select source_id from v_out_a)),
      b as (select min(d) as outline_m, graph_id from (
        select graph_id, 111320.0e0*sqrt(pow(qx-u*dx,2)+pow(qy-u*dy,2)) as d from (
          select *, greatest(0.0e0, least(1.0e0, (qx*dx+qy*dy)/(dx*dx+dy*dy))) as u from (
            select e.graph_id, (ex-ax)*cos(radians(end_lat)) as dx, ey-ay as dy, (end_lon-ax)*cos(radians(end_lat)) as qx, end_lat-ay as qy
            from v_edges_a e cross join v_poly where region_id = 'ra' and e.graph_id in (select graph_id from r where local_terminal)) x) y) z group by graph_id)
    select r.graph_id, mode, local_terminal, local_terminal and coalesce(i.inside, false) as candidate, round(outline_m, 1) as outline_m,
      case when local_terminal and coalesce(i.inside, false) and outline_m <= 200 then 'NATIVE_MODE_LOCAL_TERMINAL_IN_PEER_BUFFER_NEAR_OWN_OUTLINE'
        when local_terminal and coalesce(i.inside, false) then 'NATIVE_MODE_LOCAL_TERMINAL_IN_PEER_BUFFER_OUTLINE_FARTHER' else 'NOT_VERIFIED_AS_CLIP_TERMINAL' end as status
    from r left join d_in i on i.graph_id = r.graph_id and i.region_id = 'rb' left join b on b.graph_id = r.graph_id""",
)
def _(t):
    poly = t("v_poly")
    out = M.clip_terminals(PG.adjacency(t), poly.filter("region_id = 'ra'"), poly.filter("region_id = 'rb'"))
    return out.withColumn("outline_m", F.round("outline_m", 1))


@query(
    "cut_orientation",
    f"""with m as ({_MEET}), s as (select p.graph_id, s.ring_no, bool_or(is_hole) as is_hole,
        count(case when (ay > lat) <> (ey > lat) and lon < ax + (lat - ay) * (ex - ax) / (ey - ay) then 1 end) % 2 = 1 as inside
        from v_edges_a p cross join v_poly s where region_id = 'ra' group by p.graph_id, s.ring_no),
      si as (select graph_id, bool_or(inside and not is_hole) and not bool_or(inside and is_hole) as inside from s group by graph_id),
      f as (select m.graph_id, si.inside as s, i.inside as e from m join si on si.graph_id = m.graph_id join d_in i on i.graph_id = m.graph_id and i.region_id = 'ra' where m.region_id = 'ra')
    select graph_id, case when s and not e then 'OUTWARD_FROM_ORIGINAL_SOURCE_BUFFER' when e and not s then 'INWARD_TOWARD_ORIGINAL_SOURCE_BUFFER'
      when s then 'BOTH_ENDPOINTS_WITHIN_BUFFER_CUT_INTERSECTION' else 'BOTH_ENDPOINTS_OUTSIDE_BUFFER_CUT_INTERSECTION' end as travel,
      case when s and not e then 'OUTWARD' when e and not s then 'INWARD' else 'AMBIGUOUS' end as orientation from f""",
)
def _(t):
    return M.cut_orientation(shapes(t, "v_shape_a"), t("v_poly").filter("region_id = 'ra'"))


@query("edges_at_point", f"select source_id, receiver_id, {r3('distance_m')} as distance_m from d_atx")
def _(t):
    out = M.edges_at_point(candidates(t), shapes(t, "v_shape_b"))
    return out.withColumn("distance_m", F.round("distance_m", 3))


@query(
    "directed_overlap",
    f"""select source_id, receiver_id, status, common_modes, same_structure, {r3('x_m')} as x_m, {r3('approach_m')} as approach_m, {r3('progress_m')} as progress_m,
      {r3('segment_m')} as segment_m, {r3('remaining_m')} as remaining_m from d_ov""",
)
def _(t):
    return overlaps(t).drop("gid")


@query("successor_relation", "select source_id, option_id, modes, relation, array_to_string(preds, ',') as predecessors, evidence from d_opt")
def _(t):
    out = correlated(t)["options"]
    return out.select("source_id", "option_id", "modes", "relation", F.array_join("predecessors", ",").alias("predecessors"), "evidence")


@query("correlate", "select source_id, status, n_options, n_predecessors, n_inside, n_unknown from d_corr")
def _(t):
    return correlated(t)["status"].select("source_id", "status", "n_options", "n_predecessors", "n_inside", "n_unknown")


@query(
    "matched_roads",
    f"select source_id, receiver_id, relationship, position, modes, {r3('x_m')} as x_m, {r3('progress_m')} as progress_m, case when modes = 0 then 'no_shared_mode' end as code from d_match",
)
def _(t):
    return M.matched_roads(overlaps(t), candidates(t))


_KIND = """select c.source_id, c.status as correlation, case when n_options > 0 then 'CANDIDATE' else 'UNRESOLVED' end as kind, n_unknown, c.modes,
  case when n_options = 0 then case when n_unknown > 0 then 'ORIGINAL_B_CONDITIONAL_HIERARCHY_OR_PATH_CONTEXT_UNRESOLVED' else 'NO_ORIGINAL_B_NATIVE_ALLOWED_FORWARD_CONTINUATION' end end as reason
  from d_corr c"""


@query(
    "handoff_catalog",
    f"""with o as (select source_id, string_agg(concat_ws(':', option_id, modes, evidence, relation), ';' order by option_id) as options from d_opt group by source_id)
    select k.source_id, correlation, kind, reason, n_unknown, coalesce(options, '') as options from ({_KIND}) k left join o on o.source_id = k.source_id""",
)
def _(t):
    rows, _found = catalog(t)
    text = F.transform("options", lambda o: F.concat_ws(":", o["option_id"], o["modes"], o["evidence"], o["relation"]))
    return rows.select("source_id", "correlation", "kind", "reason", "n_unknown", F.coalesce(F.array_join(text, ";"), F.lit("")).alias("options"))


@query(
    "root_coverage",
    """with p as (select l.root_id, count(distinct l.terminal_id) as finals, bool_or(l.terminal_id in (select source_id from d_opt)) as good from d_links l group by l.root_id)
    select r.graph_id as root_id, coalesce(finals, 0) as finals, case when good then 'ROOT_HAS_NATIVE_RECEIVER_OPTIONS_SOURCE_LINEAGE_UNPROVEN'
      when finals > 0 then 'ROOT_TERMINAL_CANDIDATE_NO_CONFIRMED_RECEIVER' else 'ROOT_NO_TERMINAL_CANDIDATE_WITHIN_ONE_NATIVE_HOP' end as status
    from d_roots r left join p on p.root_id = r.graph_id""",
)
def _(t):
    args = PG.search_args(t)
    return M.root_coverage(args[0], G.terminal_links(*args), correlated(t)["options"], hops=1)


_DISP = """case when kind = 'CANDIDATE' and n_unknown > 0 then 'NATIVE_LEGAL_B_BRANCHES_WITH_CONDITIONAL_UNCERTAINTY' when kind = 'CANDIDATE' then 'NATIVE_LEGAL_B_BRANCHES_NO_KNOWN_UNCERTAINTY'
  when n_unknown > 0 then 'NO_NATIVE_ALLOWED_B_BRANCH_WITH_CONDITIONAL_UNCERTAINTY' else 'NO_NATIVE_ALLOWED_B_BRANCH_AT_CHECKED_CONTEXT' end"""


@query(
    "dispositions",
    f"""with m as (select source_id, count(*) as incoming, {r3('max(x_m)')} as max_x_m, {r3('max(progress_m)')} as max_progress_m from d_match group by source_id)
    select k.source_id, {_DISP} as disposition, coalesce(incoming, 0) as incoming, max_x_m, max_progress_m, kind <> 'CANDIDATE' as must_not_connect
    from ({_KIND}) k left join m on m.source_id = k.source_id""",
)
def _(t):
    rows, _found = catalog(t)
    return M.dispositions(rows, M.matched_roads(overlaps(t), candidates(t)))


@query(
    "handoff_projection",
    f"""select k.source_id, case when kind = 'CANDIDATE' then 'BRANCH' else 'EXCEPTION' end as row_kind, o.option_id as receiver_id, o.relation,
      case coalesce(o.modes, k.modes) when 0 then '' when 1 then 'auto' when 1024 then 'motorcycle' else 'auto+motorcycle' end as travel_modes, reason
    from ({_KIND}) k left join d_opt o on o.source_id = k.source_id""",
)
def _(t):
    return M.handoff_projection(catalog(t)[0])


@query(
    "conditional_uncertainty",
    f"""with u as (select u.*, k.kind, o.modes as fm, o.preds from d_unk u join ({_KIND}) k on k.source_id = u.source_id left join d_opt o on o.source_id = u.source_id and o.option_id = u.option_id)
    select 'matched_sources_with_unknown' as counter, count(distinct case when kind = 'CANDIDATE' then source_id end) as n from u
    union all select 'unknown_on_matched', count(case when kind = 'CANDIDATE' then 1 end) from u union all select 'unknown_on_unmatched', count(case when kind = 'UNRESOLVED' then 1 end) from u
    union all select 'mode_conflicts', count(case when
      (coalesce(car = 'ALLOWED_NATIVE_IMMEDIATE', false) and not coalesce((fm & 1) <> 0, false)) or (not coalesce(car = 'ALLOWED_NATIVE_IMMEDIATE', false) and coalesce((fm & 1) <> 0, false) and len(preds) = 1 and preds[1] = predecessor_id)
      or (coalesce(motorcycle = 'ALLOWED_NATIVE_IMMEDIATE', false) and not coalesce((fm & 1024) <> 0, false)) or (not coalesce(motorcycle = 'ALLOWED_NATIVE_IMMEDIATE', false) and coalesce((fm & 1024) <> 0, false) and len(preds) = 1 and preds[1] = predecessor_id)
      then 1 end) from u""",
)
def _(t):
    rows, found = catalog(t)
    return M.conditional_uncertainty(rows, found["unknowns"], found["options"])


@query(
    "connection_catalog",
    f"""select m.source_id, x_lat, x_lon, receiver_id, position, m.modes, {r3('x_m')} as x_m, {r3('progress_m')} as progress_m
    from d_match m join d_cand c on c.source_id = m.source_id""",
)
def _(t):
    c = candidates(t)
    return M.connection_catalog(M.matched_roads(overlaps(t), c), c)[0]


@query(
    "connection_violations",
    """select cast(c.source_id as varchar) as subject, 'no_receiver_road' as code from d_cand c where c.source_id not in (select source_id from d_match)
    union all select distinct cast(source_id as varchar), 'modes_exceed_source' from d_match where modes = 0
    union all select cast(receiver_id as varchar), 'receiver_repeated' from d_match group by receiver_id having count(*) > 1""",
)
def _(t):
    c = candidates(t)
    return M.connection_catalog(M.matched_roads(overlaps(t), c), c)[1]


_TAIL = f"""with s as ({_LEN}), n as (select *, least(20.0e0, l1+l2) as tail, greatest(1, least(32, ceil(least(20.0e0, l1+l2)/2.0e0)))::int as steps from s),
  e as (select *, unnest(range(0, steps + 1)) as i from n), w as (select *, tail*i/steps as back from e),
  t as (select graph_id, i, case when back <= l2 and l2 > 1e-7 then ra + (qa-ra)*back/l2 when back - l2 <= l1 and l1 > 1e-7 then qa + (pa-qa)*(back-l2)/l1 else pa end as sa,
    case when back <= l2 and l2 > 1e-7 then ro + (qo-ro)*back/l2 when back - l2 <= l1 and l1 > 1e-7 then qo + (po-qo)*(back-l2)/l1 else po end as so from w),
  j as (select v.a_id, v.b_id, t.i, sa, so, ba0 as b0a, bo0 as b0o, ba1 as b1a, bo1 as b1o, ba2 as b2a, bo2 as b2o from v_ab v join t on t.graph_id = v.a_id),
  p as {projection("j", "a_id, b_id, i", "sa", "so", "sa", "111195.0e0", "x")}"""


@query(
    "tail_direction",
    f"""{_TAIL}, q as (select a_id, b_id, i, x_m, x_along, case when x_m <= 1 then 1 else 0 end as near from p),
      g as (select *, lag(x_along) over (partition by a_id, b_id order by i) as prev from q where near = 1),
      h as (select a_id, b_id, count(*) as matched, count(case when prev is not null and not (prev > x_along + 0.25e0) then 1 end) as nf, count(case when prev is not null and not (prev + 0.25e0 < x_along) then 1 end) as nr from g group by a_id, b_id),
      k as (select a_id, b_id, count(*) as samples, max(x_m) as mx from q group by a_id, b_id)
    select k.a_id as source_id, k.b_id as receiver_id, samples, coalesce(matched, 0) as matched, {r3('mx')} as max_gap_m,
      case when coalesce(matched, 0) < 2 then 'INSUFFICIENT_SAMPLED_SEGMENT_OVERLAP' when nf = 0 then 'SAMPLED_DIRECTED_ORDER_ALIGNED_ONLY'
        when nr = 0 then 'SAMPLED_DIRECTED_ORDER_OPPOSED_ONLY' else 'AMBIGUOUS_SAMPLED_DIRECTED_ORDER' end as state
    from k left join h on h.a_id = k.a_id and h.b_id = k.b_id""",
)
def _(t):
    return M.tail_direction(ab_pairs(t)).withColumn("max_gap_m", F.round("max_gap_m", 3))


@query(
    "tail_coverage",
    f"""{_TAIL}, q as (select a_id, i, min(x_m) as gap from p group by a_id, i)
    select a_id as source_id, count(*) as samples, count(case when gap <= 1 then 1 end) as covered, {r3('max(gap)')} as max_gap_m from q group by a_id""",
)
def _(t):
    return M.tail_coverage(ab_pairs(t), laid_by=["gid"]).withColumn("max_gap_m", F.round("max_gap_m", 3))


@query(
    "terminal_geometry",
    f"""with p as {projection("(select a_id, b_id, aa2, ao2, ba0 as b0a, bo0 as b0o, ba1 as b1a, bo1 as b1o, ba2 as b2a, bo2 as b2o from v_ab) v", "a_id, b_id", "aa2", "ao2", "aa2", "111195.0e0", "x")},
      h as (select *, (ao2-ao1)*cos(radians(aa2)) as hx, aa2-aa1 as hy from v_ab)
    select h.a_id as source_id, h.b_id as receiver_id, a_way = b_way as same_way, {r3(_H.format(a='pp_', b='qq_').replace('pp_a', 'aa2').replace('pp_o', 'ao2').replace('qq_a', 'ba2').replace('qq_o', 'bo2'))} as end_gap_m,
      {r3('x_m')} as line_gap_m, {r3('(hx*x_tx+hy*x_ty)/sqrt(hx*hx+hy*hy)', 4)} as tangent_cosine from h join p on p.a_id = h.a_id and p.b_id = h.b_id""",
)
def _(t):
    out = M.terminal_geometry(ab_pairs(t))
    return out.select(
        "source_id", "receiver_id", "same_way", F.round("end_gap_m", 3).alias("end_gap_m"), F.round("line_gap_m", 3).alias("line_gap_m"), F.round("tangent_cosine", 4).alias("tangent_cosine")
    )


_TRACE = """select l_orderkey as route_id, l_linenumber as pos, l_partkey as edge_id from lineitem"""


@query(
    "chain_in_trace",
    """with x as (select l_orderkey as route_id, list(l_partkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as trace from lineitem group by l_orderkey),
      c as (select route_id, trace, case when route_id % 3 = 0 then list_reverse(trace[1:2]) else trace[2:3] end as chain from x),
      h as (select *, list_filter(range(1, len(trace) - len(chain) + 2), lambda i: trace[i:i+len(chain)-1] = chain)[1] - 1 as first_index from c)
    select route_id, len(trace) as trace_length, first_index, case when first_index is null then 'UNPROVEN_FOR_THIS_ROUTE' else 'B_GRAPH_DIRECTED_CHAIN_TRACED_FOR_THIS_LOCAL_ROUTE' end as status from h""",
)
def _(t):
    rows = t("lineitem").groupBy(F.col("l_orderkey").alias("route_id")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))).alias("s")
    )
    rows = rows.withColumn("trace", F.transform("s", lambda x: x["l_partkey"])).withColumn(
        "chain", F.when(F.col("route_id") % 3 == 0, F.reverse(F.slice("trace", 1, 2))).otherwise(F.slice("trace", 2, 2))
    )
    return M.chain_in_trace(rows).select("route_id", F.size("trace").alias("trace_length"), "first_index", "status")


@query(
    "handoff_geometry",
    f"""with v as (select *, aa2 + 0.000003e0 * (a_id % 5) as ha, ao2 as ho, ba2 as ga, bo2 as go from v_ab),
      pa as {projection("(select a_id, b_id, ha, ho, aa0 as b0a, ao0 as b0o, aa1 as b1a, ao1 as b1o, aa2 as b2a, ao2 as b2o from v) v1", "a_id, b_id", "ha", "ho", "ha", "111195.0e0", "a")},
      pb as {projection("(select a_id, b_id, ga, go, ba0 as b0a, bo0 as b0o, ba1 as b1a, bo1 as b1o, ba2 as b2a, bo2 as b2o from v) v2", "a_id, b_id", "ga", "go", "ga", "111195.0e0", "b")},
      g as (select v.*, {_H.format(a='pp_', b='qq_').replace('pp_a', 'ha').replace('pp_o', 'ho').replace('qq_a', 'ga').replace('qq_o', 'go')} as gap from v)
    select concat(g.a_id, '-', g.b_id) as pair_id, {r3('gap')} as gap_m, {r3('a_m')} as a_off_m, {r3('b_m')} as b_off_m, {r3('a_along')} as a_along_m, {r3('b_along')} as b_along_m,
      a_m <= 1 and b_m <= 1 and gap <= 1 as colocated from g join pa on pa.a_id = g.a_id and pa.b_id = g.b_id join pb on pb.a_id = g.a_id and pb.b_id = g.b_id""",
)
def _(t):
    ab = t("v_ab")
    rows = ab.select(
        F.concat(F.col("a_id").cast("string"), F.lit("-"), F.col("b_id").cast("string")).alias("pair_id"),
        (F.col("aa2") + F.lit(0.000003) * (F.col("a_id") % 5)).alias("a_lat"),
        F.col("ao2").alias("a_lon"),
        F.col("ba2").alias("b_lat"),
        F.col("bo2").alias("b_lon"),
        shape_of(("aa0", "ao0"), ("aa1", "ao1"), ("aa2", "ao2")).alias("shape"),
        shape_of(("ba0", "bo0"), ("ba1", "bo1"), ("ba2", "bo2")).alias("r_shape"),
    )
    out = M.handoff_geometry(rows)
    return out.select("pair_id", *[F.round(c, 3).alias(c) for c in ("gap_m", "a_off_m", "b_off_m", "a_along_m", "b_along_m")], "colocated")


_HNODES = """select e.end_node as root_node, e.end_node * 10 + o.k as node_id, o.option_id as edge_id, o.acc as access from
  (select distinct end_node from v_edges_a) e join (select start_node, graph_id as option_id, forward_access as acc, gid % 2 as k from v_edges_a) o on o.start_node = e.end_node"""


@query(
    "hierarchy_end_status",
    f"""with n as ({_HNODES}), c as (select e.graph_id, e.end_node, e.opposing_id, mode, bit from v_edges_a e cross join (select 'auto' as mode, 1 as bit union all select 'motorcycle', 1024) m),
      j as (select c.graph_id, mode, count(case when (access & bit) <> 0 and node_id <> end_node * 10 then 1 end) as other_level,
        count(case when (access & bit) <> 0 and node_id = end_node * 10 and edge_id <> opposing_id then 1 end) as same_node from c left join n on n.root_node = c.end_node group by c.graph_id, mode)
    select *, case when same_node > 0 then 'VIOLATION_ROOT_CONTINUATION' when other_level > 0 then 'HIERARCHY_MODE_ACCESSIBLE_ALTERNATIVES_UNRESOLVED' else 'NO_OTHER_NATIVE_MODE_ACCESSIBLE_HIERARCHY_OUTGOING' end as status from j""",
)
def _(t):
    c = t.sql("select graph_id, end_node * 10 as root_node, opposing_id, mode from v_edges_a lateral view explode(array('auto', 'motorcycle')) m as mode")
    n = t.sql(_HNODES).withColumn("root_node", F.col("root_node") * 10)
    return M.hierarchy_end_status(c, n)


@query(
    "outer_reconcile",
    """select graph_id, case when gid % 3 = 0 then 'PRIOR_ONLY' when gid % 7 = 0 and forward_access <= 0 then 'CONFLICT_NOT_TERMINAL' when gid % 7 = 0 then 'ADDED'
      when gid % 11 = 0 then 'CONFLICT' else 'CONFIRMED' end as status from v_edges_a""",
)
def _(t):
    base = "graph_id, end_node, end_lat, end_lon, forward_access as access, forward_access as terminal_modes, forward_access as vehicle_modes"
    prior = t.sql(f"select {base} from v_edges_a where gid % 7 <> 0 or gid % 3 = 0")
    inv = t.sql(
        "select graph_id, end_node + case when gid % 11 = 0 then 1 else 0 end as end_node, end_lat, end_lon, forward_access as access, forward_access as terminal_modes from v_edges_a where gid % 3 <> 0"
    )
    return M.outer_reconcile(prior, inv)


@query(
    "cut_coverage",
    """select 'from' as side, graph_id, case when gid % 3 <> 0 and gid % 8 = 0 then 'VIOLATION_DIRECT_NOT_OBSERVED' when gid % 3 <> 0 then 'MISSING_PREDECESSOR'
      when gid % 8 = 0 or gid % 5 = 0 then 'COVERED' when gid % 2 = 0 then 'UNLINKED_OUTWARD' else 'UNLINKED' end as status
    from v_edges_a where gid % 3 = 0 or gid % 8 = 0 or gid % 5 = 0""",
)
def _(t):
    cut = t.sql(
        "select 'from' as side, graph_id, case when gid % 2 = 0 then 'OUTWARD_FROM_ORIGINAL_SOURCE_BUFFER' else 'INWARD_TOWARD_ORIGINAL_SOURCE_BUFFER' end as travel from v_edges_a where gid % 3 = 0"
    )
    direct = t.sql("select 'from' as side, graph_id from v_edges_a where gid % 8 = 0")
    beyond = t.sql("select 'from' as side, graph_id as predecessor_id, gid from v_edges_a where gid % 5 = 0")
    return M.cut_coverage(cut, direct, beyond)
