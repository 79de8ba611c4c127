"""Queries over the two directed road graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import mode_names
from ..operators import graph as G, spatial as X
from .registry import Tables, query
from .views import VIEWS

PAIR = ("a__b", "sha256:aa", "sha256:bb")


def adjacency(t: Tables, side: str = "a") -> DataFrame:
    """Adjacency rows with their outgoing array, as a reader would give them."""
    return t.held(f"adjacency_{side}", lambda: _adjacency(t, side))


def _adjacency(t: Tables, side: str) -> DataFrame:
    # Edges leaving a node are the same for all edges that end there, so they are gathered by node.
    edges = t(f"v_edges_{side}")
    option = F.struct("graph_id", "end_node", "forward_access", "is_road", "is_shortcut")
    kept = edges.columns if side == "a" else ["graph_id", "opposing_id", "end_node"]  # of receivers nothing else is read
    out = edges.filter("start_node is not null").groupBy(F.col("start_node").alias("end_node")).agg(F.collect_list(option).alias("outgoing"))
    rows = edges.select(*kept).withColumnRenamed("graph_id", "source_id").join(out, "end_node")
    return rows.select("source_id", *[c for c in kept if c != "graph_id"], "outgoing")


def sources(t: Tables) -> DataFrame:
    return t.held("sources", lambda: find_sources(t))


def find_sources(t: Tables) -> DataFrame:
    # What the searches read of a source, and the key by which its other columns are found again.
    # The options of v_opts are gathered by node, so that they do not become rows of their own for each source.
    edges = t("v_edges_a")
    own = edges.select("gid", "graph_id", "opposing_id", "end_node", F.col("forward_access").alias("access"))
    return G.terminal_modes(own, G.options_by_node(edges)).drop("opposing_id", "end_node")


def root_opts(t: Tables) -> DataFrame:
    """The options of the roots, as rows of ``v_opts``."""
    t.starting_at("v_out_a", roots(t)).createOrReplaceTempView("v_out_a_roots")
    return t.spark.sql(VIEWS["v_opts"].replace("from v_out_a ", "from v_out_a_roots "))


def roots(t: Tables) -> DataFrame:
    return t.held("roots", lambda: G.cut_roots(t("v_cutsel")).select("graph_id").join(sources(t), "graph_id"))


def near(t: Tables) -> DataFrame:
    ends = ["graph_id", "way_id", "end_lat", "end_lon", "end_node", "deadend", "forward_access"]
    return t.held("near", lambda: X.nearby_incoming(t("v_edges_a").select(*ends).filter("deadend"), t("v_edges_b").select(*ends)))


def search_args(t: Tables):
    return roots(t), root_opts(t), sources(t), t("v_tilesel"), t("v_scope")


@query(
    "drivable_edges",
    """select graph_id from v_edges_a where not is_shortcut and not is_transit and (is_road or is_ferry)
      and ((forward_access | reverse_access) & 1025) <> 0 and way_id <> 0""",
)
def _(t):
    return G.drivable_edges(t("v_edges_a")).select("graph_id")


@query(
    "mode_names",
    """select graph_id, case forward_access when 0 then '' when 1 then 'auto' when 1024 then 'motorcycle' else 'auto,motorcycle' end as modes,
      graph_id % 4 <> 0 as valid from v_edges_a""",
)
def _(t):
    extra = F.when(F.col("graph_id") % 4 == 0, F.lit(2)).otherwise(F.lit(0))
    return t("v_edges_a").select(
        "graph_id",
        F.array_join(mode_names(F.col("forward_access")), ",").alias("modes"),
        mode_names(F.col("forward_access").bitwiseOR(extra)).isNotNull().alias("valid"),
    )


_KEYS = "way_id, round_even(lat*1000000e0, 0) as k1, round_even(lon*1000000e0, 0) as k2, round_even(inner_lat*1000000e0, 0) as k3, round_even(inner_lon*1000000e0, 0) as k4"


@query(
    "physical_peers",
    f"""with a as (select graph_id as from_graph_id, {_KEYS} from v_edges_a), b as (select graph_id as to_graph_id, {_KEYS} from v_edges_b)
    select concat('nf8peer-', substr(sha256(concat_ws('|', 'a__b', 'sha256:aa', 'sha256:bb', from_graph_id, to_graph_id)), 1, 24)) as id, way_id, from_graph_id, to_graph_id
    from a join b using (way_id, k1, k2, k3, k4)""",
)
def _(t):
    return G.physical_peers(t("v_edges_a"), t("v_edges_b"), *PAIR)


@query(
    "unpaired_edges",
    f"""with a as (select graph_id, {_KEYS} from v_edges_a), b as (select graph_id, {_KEYS} from v_edges_b)
    select 'from' as side, graph_id, way_id from a where not exists (select 1 from b where b.way_id=a.way_id and b.k1=a.k1 and b.k2=a.k2 and b.k3=a.k3 and b.k4=a.k4)
    union all
    select 'to', graph_id, way_id from b where not exists (select 1 from a where b.way_id=a.way_id and b.k1=a.k1 and b.k2=a.k2 and b.k3=a.k3 and b.k4=a.k4)""",
)
def _(t):
    return G.unpaired_edges(t("v_edges_a"), t("v_edges_b"))


_PGROUP = "concat('key-', substr(sha256(concat_ws('|', way_id, k1::bigint, k2::bigint, k3::bigint, k4::bigint)), 1, 24))"


@query(
    "crossing_proposals",
    f"""with a as (select *, {_PGROUP} as peer_group from (select graph_id, {_KEYS} from v_edges_a) x),
      b as (select *, {_PGROUP} as peer_group from (select graph_id, inner_lat, inner_lon, {_KEYS} from v_edges_b) x),
      n as (select peer_group, count(*) as n from a group by peer_group)
    select concat('nf8gps-', substr(sha256(concat_ws('|', 'a__b', 'sha256:aa', 'sha256:bb', 'from-to', graph_id)), 1, 24)) as id, 'from-to' as direction,
      graph_id as receiver_graph_id, way_id as receiver_way_id, inner_lat as lat, inner_lon as lon, b.peer_group, coalesce(n, 0) as peer_count
    from b left join n on n.peer_group = b.peer_group""",
)
def _(t):
    return G.crossing_proposals(t("v_edges_b"), t("v_edges_a"), *PAIR, "from-to")


@query("peer_members", f"select graph_id, {_PGROUP} as peer_group from (select graph_id, {_KEYS} from v_edges_a) x")
def _(t):
    return G.peer_members(t("v_edges_a"))


@query(
    "endpoint_join",
    """with n as (select graph_id, way_id + case when gid % 50 = 7 then 1 else 0 end as way_id, forward_access from v_edges_a where gid % 40 <> 3
        union all select graph_id, way_id, forward_access from v_edges_a where gid % 60 = 11 union all select graph_id * -1, way_id, forward_access from v_edges_a where gid % 70 = 1)
    select cast(e.graph_id as varchar) as subject, 'endpoint_missing' as code from v_edges_a e where e.graph_id not in (select graph_id from n)
    union all select cast(graph_id as varchar), 'edge_missing' from n where graph_id < 0
    union all select distinct cast(e.graph_id as varchar), 'way_mismatch' from v_edges_a e join n on n.graph_id = e.graph_id where n.way_id <> e.way_id
    union all select cast(graph_id as varchar), 'endpoint_repeated' from n group by graph_id having count(*) > 1""",
)
def _(t):
    ends = t.sql(
        """select graph_id as source_id, way_id + case when gid % 50 = 7 then 1 else 0 end as way_id, forward_access, reverse_access from v_edges_a where gid % 40 <> 3
        union all select graph_id, way_id, forward_access, reverse_access from v_edges_a where gid % 60 = 11
        union all select graph_id * -1, way_id, forward_access, reverse_access from v_edges_a where gid % 70 = 1"""
    )
    return G.endpoint_join(t("v_edges_a"), ends)


@query("distinct_scan", "select graph_id, max(w) as window_index, max(w) * 10 + graph_id as tag from (select graph_id, unnest([gid % 7, gid % 5]) as w from v_edges_a) x group by graph_id")
def _(t):
    rows = t("v_edges_a").select("graph_id", F.explode(F.array(F.col("gid") % 7, F.col("gid") % 5)).alias("window_index"))
    return G.distinct_scan(rows.withColumn("tag", F.col("window_index") * 10 + F.col("graph_id")))


@query(
    "scan_windows",
    """with w as (select gid % 97 as window_index, min(gid % 3) as visited_tiles from v_seg group by gid % 97)
    select w.window_index, (select count(*) from v_edges_a e where e.gid % 101 = w.window_index) as returned, visited_tiles > 0 as complete from w""",
)
def _(t):
    windows = t.sql("select gid % 97 as window_index, min(gid % 3) as visited_tiles from v_seg group by gid % 97")
    return G.scan_windows(t("v_edges_a").select((F.col("gid") % 101).alias("window_index")), windows)


_CENSUS = """select e.graph_id, m.mode, case when c.n > 0 then 'CONTINUES' when e.deadend then 'TERMINAL' else 'STRANDED' end as status, e.end_node, e.end_lat, e.end_lon
  from v_edges_a e cross join (select 'auto' as mode, 1 as bit union all select 'motorcycle', 1024) m
  left join (select source_id, mode, count(*) as n from v_out_a cross join (select 'auto' as mode, 1 as bit union all select 'motorcycle', 1024) b
     where option_id <> opposing_id and (option_access & bit) <> 0 group by source_id, mode) c on c.source_id = e.graph_id and c.mode = m.mode
  where (e.forward_access & m.bit) <> 0 and e.graph_id in (select source_id from v_out_a)"""


@query("terminal_census", f"select graph_id, mode, status from ({_CENSUS}) c")
def _(t):
    return G.terminal_census(adjacency(t)).select("graph_id", "mode", "status")


@query(
    "census_counts",
    f"""with c as ({_CENSUS}) select mode, 'usable' as counter, count(*) as n from c group by mode
    union all select mode, 'terminal', count(case when status = 'TERMINAL' then 1 end) from c group by mode
    union all select mode, 'stranded', count(case when status = 'STRANDED' then 1 end) from c group by mode
    union all select 'all', 'audited', count(*) from v_edges_a where graph_id in (select source_id from v_out_a)
    union all select 'all', 'deadends', count(*) from v_edges_a where deadend and graph_id in (select source_id from v_out_a)""",
)
def _(t):
    adj = adjacency(t)
    return G.census_counts(G.terminal_census(adj), adj)


@query(
    "final_edge_register",
    f"""with c as (select *, graph_id % 6 = 0 and mode = 'auto' as inside_peer from ({_CENSUS}) x where status <> 'CONTINUES')
    select graph_id, string_agg(distinct mode, ',' order by mode) as modes, min(end_node) as end_node, min(status) as status,
      count(distinct concat(status, inside_peer)) > 1 as conflicting from c group by graph_id""",
)
def _(t):
    c = G.terminal_census(adjacency(t)).filter("status <> 'CONTINUES'")
    c = c.withColumn("inside_peer", (F.col("graph_id") % 6 == 0) & (F.col("mode") == "auto"))
    out = G.final_edge_register(c)
    return out.select("graph_id", F.array_join("modes", ",").alias("modes"), "end_node", "status", "conflicting")


@query("terminal_modes", "select graph_id, terminal_modes from d_term")
def _(t):
    return sources(t).select("graph_id", "terminal_modes")


@query("root_options", "select root_id, option_id, eligible, in_scope from d_ropts")
def _(t):
    return G.root_options(roots(t), root_opts(t), t("v_tilesel")).select("root_id", "option_id", "eligible", "in_scope")


@query("one_hop_terminals", "select terminal_id, root_id, modes from d_links where kind like '%ONE_IMMEDIATE%'")
def _(t):
    return G.one_hop_terminals(*search_args(t))


@query(
    "mode_union",
    "select terminal_id, bit_or(modes) as modes, string_agg(distinct kind, ',' order by kind) as kinds, count(distinct root_id) as root_count from d_links group by terminal_id",
)
def _(t):
    return G.mode_union(G.terminal_links(*search_args(t))).withColumn("kinds", F.array_join("kinds", ","))


@query(
    "select_terminals",
    """with m as (select terminal_id, bit_or(modes) as mm from d_links group by terminal_id),
      p as (select root_id, count(*) as n, min(option_id) as only_option, bool_or(eligible) as el from d_ropts group by root_id),
      j as (select r.graph_id as root_id, r.pending, p.n, p.only_option, coalesce(p.n = 1 and p.el and p.only_option <> r.graph_id and (r.pending & ~m.mm) = 0
        and exists (select 1 from d_links l where l.terminal_id = p.only_option and l.root_id = r.graph_id), false) as single
        from d_roots r left join p on p.root_id = r.graph_id left join m on m.terminal_id = p.only_option where r.pending <> 0)
    select root_id, case when single then 'SINGLE_IMMEDIATE_NATIVE_TERMINAL' when n > 1 then 'MULTIPLE_NATIVE_OUTGOING_UNRESOLVED' else 'SINGLE_NATIVE_OUTGOING_UNRESOLVED' end as structural_status,
      case when single then only_option end as unique_terminal_id, case when single then pending else 0 end as verified_modes from j""",
)
def _(t):
    return G.select_terminals(*search_args(t))


@query(
    "coincidence_groups",
    """with u as (select distinct l.terminal_id, s.end_node, s.end_lat, s.end_lon from d_links l join v_src s on s.graph_id = l.terminal_id)
    select 'END_NODE' as kind, terminal_id, n as group_size from (select *, count(*) over (partition by end_node) as n from u) x where n > 1
    union all select 'EXACT_POINT', terminal_id, n from (select *, count(*) over (partition by end_lat, end_lon) as n from u) x where n > 1""",
)
def _(t):
    ids = G.terminal_links(*search_args(t)).select(F.col("terminal_id").alias("graph_id")).distinct()
    points = t("v_src").join(ids, "graph_id", "left_semi").withColumnRenamed("graph_id", "terminal_id")
    return G.coincidence_groups(points).select("kind", "terminal_id", "group_size")


@query(
    "branch_topology",
    """with o as (select root_id, mode, case when mode = 'car' then car else motorcycle end as r, end_node, dep_lat, dep_lon
        from d_ropts cross join (select 'car' as mode union all select 'motorcycle') m),
      a as (select root_id, mode, count(case when r <> 'NOT_EVALUATED' then 1 end) as ev, count(case when r = 'ALLOWED_NATIVE_IMMEDIATE' then 1 end) as allowed,
        count(case when starts_with(r, 'UNRESOLVED_') then 1 end) as unknown,
        count(case when r = 'ALLOWED_NATIVE_IMMEDIATE' and dep_lon is not null then 1 end) as placed,
        count(distinct case when r = 'ALLOWED_NATIVE_IMMEDIATE' then end_node end) as nodes,
        count(distinct case when r = 'ALLOWED_NATIVE_IMMEDIATE' then concat_ws(',', dep_lat, coalesce(dep_lon, -1)) end) as deps from o group by root_id, mode)
    select root_id, mode, allowed, unknown, case when ev = 0 then 'NOT_EVALUATED' when allowed >= 2 and placed = allowed and nodes = allowed and deps = allowed then 'DISTINCT_NATIVE_GEOMETRIC_BRANCHES'
      when allowed >= 2 then 'MULTIPLE_ALLOWED_OVERLAPPING_OR_UNKNOWN_GEOMETRY' when allowed = 1 and unknown > 0 then 'SINGLE_ALLOWED_WITH_UNKNOWN_ALTERNATIVES'
      when allowed = 1 then 'SINGLE_STATIC_LEGAL_CONTINUATION' when unknown > 0 then 'NO_CONFIRMED_WITH_UNKNOWN_ALTERNATIVES' else 'NO_CONFIRMED_STATIC_CONTINUATION' end as status from a""",
)
def _(t):
    return G.branch_topology(G.root_options(roots(t), root_opts(t), t("v_tilesel")))


_BITS = "(case when car = 'ALLOWED_NATIVE_IMMEDIATE' then 1 else 0 end | case when motorcycle = 'ALLOWED_NATIVE_IMMEDIATE' then 1024 else 0 end)"


@query(
    "two_hop_recovery",
    f"""with f as (select root_id, option_id as first_id, {_BITS} & option_access & access as m1 from d_ropts
        where eligible and in_scope and not via_hierarchy and root_id not in (select root_id from d_links)),
      s as (select f.root_id, f.first_id, o.option_id as terminal_id, {_BITS} & m1 & option_access as m2 from f join v_opts o on o.source_id = f.first_id
        where m1 <> 0 and not via_hierarchy and not shortcut and not transit and (o.option_id & 33554431) in (select tile_id from v_tilesel))
    select root_id, first_id, terminal_id, m2 & t.terminal_modes as modes from s join d_term t on t.graph_id = s.terminal_id
    where (m2 & t.terminal_modes) <> 0 and terminal_id in (select graph_id from v_scope)""",
)
def _(t):
    args = search_args(t)
    return G.two_hop_recovery(args[0], G.terminal_links(*args), t("v_opts"), *args[2:], of_roots=args[1])


@query(
    "predecessor_paths",
    """with recursive c as (select graph_id from v_cutsel where orientation = 'INWARD'),
      p as (select e.graph_id as final_id, e.graph_id as edge_id, 0 as depth, [e.graph_id] as path, 'PREDECESSOR' as status from v_edges_a e where e.deadend
        union all
        select p.final_id, i.graph_id, p.depth + 1, list_append(p.path, i.graph_id), case when list_contains(p.path, i.graph_id) then 'CYCLE' when i.graph_id in (select graph_id from c) then 'CROSSES_CUT' else 'PREDECESSOR' end
        from p join v_edges_a k on k.graph_id = p.edge_id join v_edges_a i on i.end_node = k.start_node and i.graph_id <> k.opposing_id
        where p.status = 'PREDECESSOR' and p.depth < 3)
    select final_id, edge_id, depth, status, array_to_string(path, '>') as path from p where depth > 0
    union all select final_id, edge_id, depth, 'DEPTH_REACHED', array_to_string(path, '>') from p where depth = 3 and status = 'PREDECESSOR'""",
)
def _(t):
    finals = t("v_edges_a").filter("deadend")
    out = G.predecessor_paths(finals, t("v_edges_a"), t("v_cutsel").filter("orientation = 'INWARD'"), depth=3)
    return out.withColumn("path", F.array_join("path", ">"))


@query(
    "hierarchy_reach",
    """with n as (select gid as root_id, gid * 10 + k as node_id, case when gid % 9 = 0 and k = 2 then 1 else k end as depth from v_seg, (select unnest([0, 1, 2]) as k) x
         union all select gid, gid * 10 + 9, 3 from v_seg where gid % 8 = 0)
    select root_id * 10 as root_id, node_id, depth, case when node_id % 10 = 9 then null else node_id % 10 end as shortest,
      case when node_id % 10 = 9 then 'DISCONNECTED' when node_id % 10 <> depth then 'DEPTH_MISMATCH' else 'OK' end as status from n
    union all select gid * 10, gid * 10 + 3, null, 3, 'TARGET_NOT_LISTED' from v_seg where gid % 6 = 0""",
)
def _(t):
    nodes = t.sql(
        """select gid * 10 as root_id, gid * 10 + k as node_id, case when gid % 9 = 0 and k = 2 then 1 else k end as depth
        from v_seg lateral view explode(array(0, 1, 2)) x as k
        union all select gid * 10, gid * 10 + 9, 3 from v_seg where gid % 8 = 0"""
    )
    links = t.sql(
        """select gid * 10 as root_id, gid * 10 + k as node_id, gid * 10 + k + 1 as target_id from v_seg lateral view explode(array(0, 1)) x as k
        union all select gid * 10, gid * 10 + 2, gid * 10 + 3 from v_seg where gid % 6 = 0 union all select gid * 10, gid * 10 + 2, gid * 10 from v_seg"""
    )
    return G.hierarchy_reach(nodes, links)


_CHAIN = """select gid as chain_id, 0 as pos, graph_id from v_edges_a where dir = 0
  union all select gid, 1, opposing_id from v_edges_a where dir = 0 and gid % 2 = 0
  union all select gid, 1, graph_id + 40 from v_edges_a where dir = 0 and gid % 2 = 1"""


@query(
    "adjacent_chain",
    f"""with c as ({_CHAIN}), s as (select *, lead(graph_id) over (partition by chain_id order by pos) as next_id from c),
      o as (select source_id, count(*) as deg from v_out_a group by source_id)
    select s.chain_id, s.pos, s.graph_id, s.next_id, case when next_id is null then 'CHAIN_END' when exists (select 1 from v_out_a v where v.source_id = s.graph_id and v.option_id = s.next_id)
      then 'ADJACENT' else 'NOT_ADJACENT' end as status, next_id = e.opposing_id as is_reverse, o.deg as out_degree
    from s left join v_edges_a e on e.graph_id = s.graph_id left join o on o.source_id = s.graph_id""",
)
def _(t):
    return G.adjacent_chain(t.sql(_CHAIN), adjacency(t))


@query(
    "handoff_pool",
    """with c as (select * from d_near where source_way = receiver_way and not receiver_deadend and receiver_id in (select source_id from v_out_b))
    select source_id, receiver_id,
      coalesce((select string_agg(option_id, ',' order by option_id) from v_out_b o where o.source_id = c.receiver_id and o.option_id <> o.opposing_id and is_road and not is_shortcut and (option_access & 1) <> 0), '') as outgoing_auto,
      coalesce((select string_agg(option_id, ',' order by option_id) from v_out_b o where o.source_id = c.receiver_id and o.option_id <> o.opposing_id and is_road and not is_shortcut and (option_access & 1024) <> 0), '') as outgoing_motorcycle
    from c""",
)
def _(t):
    out = G.handoff_pool(near(t), adjacency(t, "b"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("outgoing_auto", "outgoing_motorcycle")})


@query(
    "receiver_adjacency",
    """with c as (select * from d_near where source_way = receiver_way and not receiver_deadend and receiver_id in (select source_id from v_out_b)),
      o as (select source_id, bool_or((option_access & 1) <> 0) as a, bool_or((option_access & 1024) <> 0) as m from v_out_b where option_id <> opposing_id and is_road and not is_shortcut group by source_id)
    select c.source_id, count(*) as relationships, bool_or((source_access & receiver_access & 1) <> 0 and coalesce(a, false)) as auto,
      bool_or((source_access & receiver_access & 1024) <> 0 and coalesce(m, false)) as motorcycle from c left join o on o.source_id = c.receiver_id group by c.source_id""",
)
def _(t):
    return G.receiver_adjacency(near(t), adjacency(t, "b"))


@query(
    "reciprocal_pairs",
    """with r as (select n_name as region_id, concat('s', n_nationkey) as source_id, n_nationkey as k from nation),
      b as (select r.region_id, r.source_id, concat('s', (k + d) % 25) as nb, concat('f', k, '-', d, '-', z) as fp
        from r, (select unnest([1, 24, 2]) as d) x, (select unnest([0, 1]) as z) y where z = 0 or (k % 6 = 0 and d = 1)),
      one as (select region_id, source_id, nb, min(fp) as fp from b group by all having count(*) = 1)
    select concat_ws('__', a.region_id, b.region_id) as pair_id, a.region_id as from_region_id, b.region_id as to_region_id,
      a.fp as from_boundary_fingerprint, b.fp as to_boundary_fingerprint, 'UNPROVEN' as validation_state
    from one a join one b on a.nb = b.source_id and b.nb = a.source_id where a.region_id <> b.region_id""",
)
def _(t):
    regions = t.sql("select n_name as region_id, concat('s', cast(n_nationkey as varchar(20))) as source_id, 'v1' as package_version, concat('g', n_name) as graph_fingerprint from nation")
    bounds = t.sql(
        """select n_name as region_id, concat('s', cast((n_nationkey + d) % 25 as varchar(20))) as neighbour_source_id,
          concat('f', cast(n_nationkey as varchar(20)), '-', cast(d as varchar(20)), '-', cast(z as varchar(20))) as fingerprint
        from nation lateral view explode(array(1, 24, 2)) x as d lateral view explode(array(0, 1)) y as z
        where z = 0 or (n_nationkey % 6 = 0 and d = 1)"""
    )
    cols = "pair_id from_region_id to_region_id from_boundary_fingerprint to_boundary_fingerprint validation_state".split()
    return G.reciprocal_pairs(regions, bounds).select(*cols)


_ANCHOR = """select concat('r', cast(s_nationkey as varchar(20))) as region_id, '{}' as mode, s_suppkey as anchor_id, s_suppkey % 3 <> 0 as is_entry, s_suppkey % 4 <> 0 as is_exit from supplier"""
_ANCHORS = _ANCHOR.format("auto") + " union all " + _ANCHOR.format("motorcycle")


@query(
    "connector_matrix",
    f"""with a as ({_ANCHORS}) select e.region_id, e.mode, e.anchor_id as from_anchor_id, x.anchor_id as to_anchor_id,
      case when (e.anchor_id + x.anchor_id) % 5 = 0 then 'MISSING' when (e.anchor_id + x.anchor_id) % 5 = 1 then 'UNREACHABLE' else 'REACHABLE' end as status
    from a e join a x on x.region_id = e.region_id and x.mode = e.mode where e.is_entry and x.is_exit and e.anchor_id <> x.anchor_id""",
)
def _(t):
    anchors = t.sql(_ANCHORS)
    pairs = anchors.select("region_id", "mode", F.col("anchor_id").alias("from_anchor_id")).join(
        anchors.select("region_id", "mode", F.col("anchor_id").alias("to_anchor_id")), ["region_id", "mode"]
    )
    total = (F.col("from_anchor_id") + F.col("to_anchor_id")) % 5
    results = pairs.filter(total != 0).withColumn("status", F.when(total == 1, "UNREACHABLE").otherwise("REACHABLE"))
    return G.connector_matrix(anchors, results)
