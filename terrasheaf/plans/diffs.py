"""Queries that compare builds, scans, ways and artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import diff as D, spatial as X
from .registry import Tables, query
from .spatial import shape_of


def tiles(t: Tables, view: str) -> DataFrame:
    return t(view).withColumn("boundaries", F.filter(F.split("neighbours", ","), lambda x: x != ""))


_FP = """with e as (select *, concat(path, ':', sha256) as line from {v}), x as (
    select region_id, 'graph' as kind, null as source_id, line from e
    union all select region_id, 'internal', null, case when neighbours = '' then line end from e
    union all select region_id, 'boundary', unnest(string_split(neighbours, ',')), line from e where neighbours <> '')
  select region_id, kind, source_id, concat('sha256:', sha256(coalesce(string_agg(line || chr(10), '' order by line), ''))) as fingerprint, count(line) as tile_count
  from x group by region_id, kind, source_id"""


@query("tile_fingerprints", _FP.format(v="v_tiles_old"))
def _(t):
    return D.tile_fingerprints(tiles(t, "v_tiles_old"))


@query(
    "diff_tiles",
    "select region_id, path, status, array_to_string(bs, ',') as boundaries, case when len(bs) = 0 then 'internal' else 'boundary' end as scope from d_tilediff",
)
def _(t):
    out = D.diff_tiles(tiles(t, "v_tiles_old"), tiles(t, "v_tiles_new"))
    return out.withColumn("boundaries", F.array_join("boundaries", ","))


@query(
    "diff_tile_counts",
    "select region_id, status, case when len(bs) = 0 then 'internal' else 'boundary' end as scope, count(*) as tiles from d_tilediff group by all",
)
def _(t):
    return D.diff_tile_counts(D.diff_tiles(tiles(t, "v_tiles_old"), tiles(t, "v_tiles_new")))


@query(
    "diff_boundaries",
    f"""with a as (select * from ({_FP.format(v='v_tiles_old')}) f where kind = 'boundary'), b as (select * from ({_FP.format(v='v_tiles_new')}) f where kind = 'boundary'),
      n as (select region_id, s, count(*) as n from (select region_id, unnest(bs) as s from d_tilediff) x group by region_id, s)
    select coalesce(a.region_id, b.region_id) as region_id, coalesce(a.source_id, b.source_id) as source_id, a.fingerprint is distinct from b.fingerprint as requires_refresh, coalesce(n.n, 0) as changed_tiles
    from a full join b on a.region_id = b.region_id and a.source_id = b.source_id
    left join n on n.region_id = coalesce(a.region_id, b.region_id) and n.s = coalesce(a.source_id, b.source_id)""",
)
def _(t):
    a, b = tiles(t, "v_tiles_old"), tiles(t, "v_tiles_new")
    return D.diff_boundaries(D.tile_fingerprints(a), D.tile_fingerprints(b), D.diff_tiles(a, b))


def ways(t: Tables, view: str) -> DataFrame:
    return t(view).withColumn("shape", shape_of(("la0", "lo0"), ("la1", "lo1")))


_MIC = "floor({0}*1000000+0.5)::bigint"
_PT = "concat_ws(',', " + _MIC.format("lo{0}") + ", " + _MIC.format("la{0}") + ")"
_GEO = f"least(concat_ws(';', {_PT.format(0)}, {_PT.format(1)}), concat_ws(';', {_PT.format(1)}, {_PT.format(0)}))"
_SIG = f"""select distinct way_id, 'attributes' as part, concat('{{"road_class":"', road_class, '","name":"', name, '","surface":"', surface, '"}}') as signature from {{v}}
  union select distinct way_id, 'geometry', {_GEO} from {{v}}"""
_ATTRS = ["road_class", "name", "surface"]


@query("way_signatures", _SIG.replace('{v}', 'v_way_a'))
def _(t):
    return D.way_signatures(ways(t, "v_way_a"), _ATTRS)


_CMP = """with a as ({a}), b as ({b}), j as (select coalesce(a.way_id, b.way_id) as way_id, a.way_id is not null as ina, b.way_id is not null as inb from a full join b on a.way_id = b.way_id and a.part = b.part and a.signature = b.signature)
  select way_id, case when not bool_or(ina) then 'added' when not bool_or(inb) then 'removed' when bool_or(not ina or not inb) then 'changed' else 'unchanged' end as status from j group by way_id"""


@query("diff_ways", _CMP.format(a=_SIG.replace('{v}', 'v_way_a'), b=_SIG.replace('{v}', 'v_way_b')))
def _(t):
    return D.diff_ways(D.way_signatures(ways(t, "v_way_a"), _ATTRS), D.way_signatures(ways(t, "v_way_b"), _ATTRS))


_LSIG = "select distinct way_id, 'feature' as part, concat_ws('|', road_class, name, surface, lo0, la0, lo1, la1) as signature from {v}"


@query("diff_layer_roads", _CMP.format(a=_LSIG.format(v="v_way_a"), b=_LSIG.format(v="v_way_b")))
def _(t):
    return D.diff_layer_roads(D.layer_signatures(ways(t, "v_way_a"), _ATTRS), D.layer_signatures(ways(t, "v_way_b"), _ATTRS))


_NAT = "select 'from' as side, graph_id, gid, lat, lon from v_edges_a union all select 'to', graph_id, gid, lat, lon from v_edges_b"
_COR = f"select side, graph_id from ({_NAT}) n where gid % 6 <> 1"
_CAND = """select concat('c', cast(a.graph_id as varchar(20))) as candidate_id, case when a.gid % 31 = 0 then cast(null as bigint) else a.graph_id end as from_id, b.graph_id as to_id, a.gid
  from v_edges_a a join v_edges_b b on b.gid = a.gid and b.dir = a.dir"""
_PROV = """select a.graph_id as from_id, b.graph_id + case when a.gid % 9 = 0 then 1 else 0 end as to_id, 'auto' as mode, 'from-to' as direction
  from v_edges_a a join v_edges_b b on b.gid = a.gid and b.dir = a.dir where a.deadend"""
_WIN = """select 'from' as side, window_index, case when window_index % 5 = 0 then cast(null as bigint) else 4096 end as requested, (window_index * 37) % 600 as returned,
  window_index % 4 <> 0 as complete, false as truncated from v_windows"""


@query(
    "edge_parity",
    f"""with n as ({_NAT}), co as ({_COR}), ca as ({_CAND}), pr as ({_PROV}), w as ({_WIN}),
      held as (select 'from' as side, from_id as graph_id from ca where from_id is not null union all select 'to', to_id from ca where from_id is not null)
    select concat(side, ':', graph_id) as subject, 'MISSING_FROM_CORRELATIONS' as reason from n where (side, graph_id) not in (select (side, graph_id) from co)
    union all select concat(side, ':', graph_id), 'MISSING_FROM_CANDIDATES' from n where (side, graph_id) not in (select (side, graph_id) from held)
    union all select candidate_id, 'CANDIDATE_WITHOUT_IDS' from ca where from_id is null
    union all select distinct concat(from_id, '>', to_id), 'PROVEN_NOT_IN_SCAN' from pr where to_id not in (select graph_id from v_edges_b)
    union all select concat(from_id, '>', to_id), 'PROVEN_NOT_A_CANDIDATE' from pr where (from_id, to_id) not in (select (from_id, to_id) from ca where from_id is not null)
    union all select concat(side, ':', window_index), case when requested is null then 'WINDOW_WITHOUT_LIMIT' when returned > 512 then 'WINDOW_RETURNED_INVALID' else 'WINDOW_NOT_PROVEN_COMPLETE' end
      from w where requested is null or returned > 512 or not complete or returned >= 512""",
)
def _(t):
    return D.edge_parity(t.sql(_NAT), t.sql(_COR), t.sql(_CAND), t.sql(_PROV), t.sql(_WIN))


@query(
    "window_parity",
    """with e as (select w.window_index, a.graph_id, a.gid from v_edges_a a join v_windows w on a.lat between min_lat and max_lat and a.lon between min_lon and max_lon),
      r as (select window_index, graph_id, gid from e where gid % 10 <> 3 union all select window_index, 0 - window_index, 1 from v_windows where window_index % 6 = 0),
      j as (select coalesce(e.window_index, r.window_index) as window_index, e.graph_id is not null as n, r.graph_id is not null as r, coalesce(r.gid, 0) % 4 <> 0 as g from e full join r on r.window_index = e.window_index and r.graph_id = e.graph_id),
      p as (select window_index, count(case when n then 1 end) as native_edges, count(case when r then 1 end) as returned, count(case when not r then 1 end) as missing, count(case when not n then 1 end) as unknown,
        count(case when r and not g then 1 end) as grouped_away from j group by window_index)
    select w.window_index, coalesce(native_edges, 0) as native_edges, coalesce(returned, 0) as returned, coalesce(missing, 0) as missing, coalesce(unknown, 0) as unknown, coalesce(grouped_away, 0) as grouped_away,
      coalesce(returned, 0) >= 60 as saturated, coalesce(missing, 0) = 0 and coalesce(unknown, 0) = 0 and coalesce(grouped_away, 0) = 0 and coalesce(returned, 0) < 60 as lossless
    from v_windows w left join p on p.window_index = w.window_index""",
)
def _(t):
    hits = X.window_edges(t("v_edges_a").select("graph_id", "gid", "lat", "lon"), t("v_windows"), 0.002).select("window_index", "graph_id", "gid")
    extra = t.sql("select window_index, 0 - window_index as graph_id, 1 as gid from v_windows where window_index % 6 = 0")
    raw = hits.filter("gid % 10 <> 3").unionByName(extra)
    return D.window_parity(t("v_edges_a"), t("v_windows").withColumn("requested", F.lit(60)), raw, raw.filter("gid % 4 <> 0"))




def _point_segment(px: str, py: str, ax: str, ay: str, ex: str, ey: str) -> str:
    """SQL of the planar metres between a point and a segment."""
    k = f"cos(radians({py}))"
    dx, dy, qx, qy = f"(({ex} - {ax}) * {k})", f"({ey} - {ay})", f"(({px} - {ax}) * {k})", f"({py} - {ay})"
    on = f"greatest(0.0e0, least(1.0e0, ({qx} * {dx} + {qy} * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
    return f"111320.0e0 * sqrt(pow({qx} - {on} * {dx}, 2) + pow({qy} - {on} * {dy}, 2))"


def _turn(o: str, p: str, q: str) -> str:
    return f"sign(({p}x - {o}x) * ({q}y - {o}y) - ({p}y - {o}y) * ({q}x - {o}x))"


_APART = ", ".join(
    _point_segment(f"{p}x", f"{p}y", f"{a}x", f"{a}y", f"{e}x", f"{e}y") for p, a, e in (("w", "o", "q"), ("v", "o", "q"), ("o", "w", "v"), ("q", "w", "v"))
)
_MEET = f"{_turn('o', 'q', 'w')} * {_turn('o', 'q', 'v')} <= 0 and {_turn('w', 'v', 'o')} * {_turn('w', 'v', 'q')} <= 0"
# Ways of two classes are required wherever they are, others within 75 m of the outline, one class never.
_MAJOR, _ROADS = ["ECONOMY", "PROMO"], ["ECONOMY", "PROMO", "STANDARD", "MEDIUM", "SMALL"]
_REQUIRED = f"""with s as (select distinct way_id, lo0 as wx, la0 as wy, lo1 as vx, la1 as vy from v_way_a),
      o as (select ax as ox, ay as oy, ex as qx, ey as qy from v_poly where region_id = 'ra'),
      b as (select distinct way_id from s, o where least({_APART}) <= 75.0e0 or ({_MEET})),
      r as (select way_id, bool_or(road_class in ('ECONOMY', 'PROMO')) as major from v_way_a where road_class <> 'LARGE' group by way_id),
      c as (select r.way_id, concat_ws(',', case when b.way_id is not null then 'BORDER' end, case when major then 'MAJOR' end) as categories, r.way_id % 9 <> 0 as present
        from r left join b on b.way_id = r.way_id where major or b.way_id is not null)"""


def coverage(t: Tables) -> DataFrame:
    f = t("v_way_a").withColumn("highway", F.col("road_class"))
    near = D.near_outline(ways(t, "v_way_a"), t("v_poly").filter("region_id = 'ra'"), 75.0, "way_id")
    return D.layer_coverage(D.required_roads(f, _MAJOR, near, _ROADS), t("v_way_a").filter("way_id % 9 <> 0"))


@query("layer_coverage", f"{_REQUIRED} select way_id, categories, present from c")
def _(t):
    return coverage(t).select("way_id", F.array_join("categories", ",").alias("categories"), "present")


@query(
    "layer_coverage_counts",
    f"""{_REQUIRED} select 'source' as counter, count(*) as n from c union all select 'major', count(*) from c where categories like '%MAJOR%'
      union all select 'border', count(*) from c where categories like '%BORDER%' union all select 'observed', count(*) from c where present
      union all select 'missing', count(*) from c where not present""",
)
def _(t):
    return D.layer_coverage_counts(coverage(t))


_TF = """select concat('p', cast(l_suppkey % 20 as varchar(20))) as pack_id, cast(4 + l_linenumber as bigint) as zoom, concat(cast(l_linenumber as varchar(20)), '/', cast(l_partkey as varchar(20))) as tile_key,
  case l_partkey % 6 when 0 then 'water' when 1 then 'place' when 2 then 'boundary' when 3 then case when l_suppkey % 20 = 7 then 'poi' else 'waterway' end else 'transportation' end as layer,
  46.0e0 + (l_partkey % 100) * 0.01e0 as min_lat, 46.01e0 + (l_partkey % 100) * 0.01e0 as max_lat, 12.0e0 + (l_suppkey % 50) * 0.01e0 as min_lon, 12.01e0 + (l_suppkey % 50) * 0.01e0 as max_lon
  from lineitem"""


@query(
    "layer_observations",
    f"""with f as ({_TF}), g as (select pack_id, list_sort(list_distinct(list(layer))) as ls, count(distinct tile_key) as tiles, min(zoom) as min_zoom, max(zoom) as max_zoom, min(min_lat) as min_lat, max(max_lat) as max_lat,
        min(min_lon) as min_lon, max(max_lon) as max_lon from f group by pack_id)
    select pack_id, array_to_string(ls, ',') as layers, array_to_string(list_filter(['mountain_peak', 'transportation', 'water'], lambda x: not list_contains(ls, x)), ',') as missing_layers,
      array_to_string(list_filter(ls, lambda x: x in ('building', 'poi', 'poi_detail')), ',') as forbidden_layers, tiles, min_zoom, max_zoom, min_lat, max_lat, min_lon, max_lon from g""",
)
def _(t):
    out = D.layer_observations(t.sql(_TF), ["mountain_peak", "transportation", "water"])
    return out.withColumns({c: F.array_join(c, ",") for c in ("layers", "missing_layers", "forbidden_layers")})


# One event per recorded artifact; kind, binding and points follow from its values.
_ART = """select event_id as id, event_type, user_id, concat('r', cast(user_id % 9 as varchar(20))) as from_region_id, concat('r', cast((user_id + 1) % 9 as varchar(20))) as to_region_id,
  concat('g', cast(user_id % 9 as varchar(20)), case when event_id % 5 = 0 then 'old' else '' end) as from_graph_fp, concat('g', cast((user_id + 1) % 9 as varchar(20))) as to_graph_fp,
  case when event_id % 3 = 0 then cast(null as varchar(20)) else concat('b', cast(user_id % 9 as varchar(20)), case when event_id % 7 = 0 then 'old' else '' end) end as from_boundary_fp,
  cast(null as varchar(20)) as to_boundary_fp, concat('s', cast(user_id % 9 as varchar(20))) as from_source_id,
  case when event_id % 11 = 0 then cast(null as varchar(20)) else concat('s', cast((user_id + 1) % 9 as varchar(20))) end as to_source_id,
  46.0e0 + event_id % 100 * 0.01e0 as from_lat, 12.0e0 as from_lon, case when event_id % 13 = 0 then cast(null as double) else 46.1e0 end as to_lat, 12.1e0 as to_lon, event_id % 4 as tier, event_id % 2 = 0 as flag
  from events"""
_ART_STATUS = f"""select *, case when event_id5 and bound_ok then 'CURRENT' else 'STALE' end as status from (
  select *, id % 5 <> 0 as event_id5, case when from_boundary_fp is null then true when to_source_id is null then false else id % 7 <> 0 end as bound_ok from ({_ART}) a) b"""


def artifacts(t: Tables) -> DataFrame:
    rows = t.sql(_ART)
    k = F.col("user_id") % 9
    name = lambda p, v: F.concat(F.lit(p), v.cast("string"))
    current = t("events").select((F.col("user_id") % 9).alias("k")).distinct()
    current = current.select(
        name("r", F.col("k")).alias("region_id"), name("g", F.col("k")).alias("graph_fp"),
        F.create_map(name("s", (F.col("k") + 1) % 9), name("b", F.col("k"))).alias("boundaries"),
    )
    return D.artifact_currency(rows, current)


def items(t: Tables) -> DataFrame:
    a = artifacts(t)
    flags = {f"{m}_{d}": F.col("flag") if m == "car" else ~F.col("flag") for m in ("motorcycle", "car") for d in ("from_to", "to_from")}
    kinds = a.withColumn("k", F.col("id") % 6).withColumns({"both_match_way": F.col("flag"), "same_way": ~F.col("flag"), **flags})
    kinds = kinds.withColumns({"modes": F.array(F.lit("CAR")), "evidence": F.array(F.lit("NEAR")), "mode": F.lit("CAR")})
    return D.handoff_items(*[kinds.filter(F.col("k") == i) for i in range(6)])


_KIND = "case id % 6 when 0 then 'candidate' when 1 then 'accepted' when 2 then 'candidate' when 3 then 'accepted' when 4 then 'learned' else 'manual' end"


@query(
    "handoff_items",
    f"""select id, {_KIND} as kind, status, from_region_id, to_region_id,
      case id % 6 when 0 then '' when 1 then case when flag then 'CAR_FROM_TO,CAR_TO_FROM' else 'MOTORCYCLE_FROM_TO,MOTORCYCLE_TO_FROM' end when 5 then 'MOTORCYCLE,CAR' else 'CAR' end as modes,
      case id % 6 when 0 then concat('GENERATED_CANDIDATE,EVIDENCE_TIER_', tier, case when flag then ',BOTH_MATCH_STABLE_OSM_WAY' else ',SAME_CORRELATED_OSM_WAY' end)
        when 1 then concat('VALHALLA_PROVEN_RUNTIME,EVIDENCE_TIER_', tier) when 3 then 'VALHALLA_PROVEN_BOUND_TRANSITION' when 5 then 'MANUAL_VALHALLA_PROOF' else 'NEAR' end as evidence
    from ({_ART_STATUS}) a where to_lat is not null""",
)
def _(t):
    out = items(t).withColumns({c: F.array_join(c, ",") for c in ("modes", "evidence")})
    return out.select("id", "kind", "status", "from_region_id", "to_region_id", "modes", "evidence")


@query("handoff_counts", f"select concat({_KIND}, '.', status) as key, count(*) as n from ({_ART_STATUS}) a where to_lat is not null group by 1")
def _(t):
    return D.handoff_counts(items(t))
