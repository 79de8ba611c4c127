"""Test views over the given tables.

The text is read by Spark and by the comparison engine alike, so it keeps to SQL
both understand.  Names start with ``v_``; names starting with ``d_`` are
helpers of the comparison SQL only.  A view may use the views before it.
"""

VIEWS: dict[str, str] = {}

# --- place feed and pack -------------------------------------------------

VIEWS["v_cust"] = """
select c_custkey as k, c_custkey as ord, 0 as dup, c_nationkey as nat, c_mktsegment as seg, c_acctbal as bal from customer
union all
select c_custkey as k, c_custkey + 10000000 as ord, 1 as dup, c_nationkey as nat, c_mktsegment as seg, c_acctbal as bal
from customer where c_custkey % 10 = 0
"""

# A flat feature: one row per line of a place feed, with gaps and repeats.
VIEWS["v_feature"] = """
select ord, k,
  case when k % 23 = 0 then '' else concat('c', cast(k as varchar(20))) end as pid,
  case when ord % 29 = 0 then '  ' else concat(p_name, '  ', n_name, case when dup = 1 then ' two' else '' end) end as name,
  case when k % 37 = 0 then '' else concat('Street ', cast(k % 50 as varchar(20))) end as freeform,
  case when k % 7 = 0 then '' else cast(10000 + k % 90 as varchar(20)) end as postcode,
  n_name as locality,
  case when k % 3 = 0 then lower(n_name) else concat('R', cast(k % 11 as varchar(20))) end as region,
  case k % 5 when 0 then '' when 1 then 'at' when 2 then 'AT' else 'IT' end as country,
  cast(10.4e0 + (k * 53 % 3000) * 0.001e0 as varchar(30)) as lon,
  case when k % 41 = 0 then 'north' else cast(44.5e0 + (k * 37 % 2300) * 0.001e0 as varchar(30)) end as lat,
  case when k % 13 = 0 then '' when k % 43 = 0 then 'high' else cast((k % 101) / 100.0e0 as varchar(30)) end as conf,
  case when k % 17 = 0 then 'permanently_closed' else 'open' end as status,
  seg as basic,
  case when k % 6 = 0 then '' else p_type end as prim,
  case when k % 4 = 0 then '' else seg end as hier1,
  case when k % 9 = 0 then p_type else lower(p_type) end as hier2,
  case when k % 8 = 0 then '' else p_brand end as alt1,
  p_type as legacy_prim,
  'Legacy' as legacy_alt,
  concat('prov', cast(k % 3 as varchar(20))) as s1_provider, concat('set', cast(k % 4 as varchar(20))) as s1_dataset,
  concat('rec', cast(k as varchar(20))) as s1_record, cast((k % 10) / 10.0e0 as varchar(30)) as s1_conf,
  concat('prov', cast(k % 5 as varchar(20))) as s2_provider, 'x' as s2_record,
  case when k % 11 = 0 then '' else cast((k % 7) / 10.0e0 as varchar(30)) end as s2_conf,
  k % 31 <> 0 as has_address,
  k % 47 <> 0 as has_position
from v_cust join nation on nat = n_nationkey join part on p_partkey = k % 200
"""

VIEWS["v_places"] = """
select c_custkey as ord, concat('c', cast(c_custkey as varchar(20))) as place_id,
  concat(p_name, ' ', n_name) as name,
  lower(concat(p_name, ' ', replace(n_name, '_', ' '))) as name_norm,
  concat('Street ', cast(c_custkey % 50 as varchar(20)), ', ', n_name) as address,
  lower(concat('street ', cast(c_custkey % 50 as varchar(20)), ' ', replace(n_name, '_', ' '))) as address_norm,
  44.5e0 + (c_custkey * 37 % 2300) * 0.001e0 as latitude, 10.4e0 + (c_custkey * 53 % 3000) * 0.001e0 as longitude,
  (c_custkey % 101) / 100.0e0 as confidence,
  c_mktsegment as basic_category, p_type as taxonomy_primary, p_brand as alt,
  case when c_custkey % 17 = 0 then 'permanently_closed' else 'open' end as operating_status,
  concat('r', cast(c_custkey % 90 as varchar(20))) as source_record_id,
  n_name as locality
from customer join nation on c_nationkey = n_nationkey join part on p_partkey = c_custkey % 200
"""

# A later state of the same places: some gone, some renamed, some new.
VIEWS["v_places2"] = """
select place_id, case when ord % 13 = 0 then concat(name, ' new') else name end as name, address, latitude, longitude,
  source_record_id, operating_status, basic_category, taxonomy_primary, alt
from v_places where ord % 11 <> 0
union all
select concat(place_id, 'x') as place_id, name, address, latitude, longitude, source_record_id, operating_status,
  basic_category, taxonomy_primary, alt
from v_places where ord % 19 = 0
"""

VIEWS["v_cats"] = """
select row_number() over (order by name) as id, name, lower(replace(name, '#', ' ')) as name_norm
from (
  select distinct basic_category as name from v_places union
  select distinct taxonomy_primary as name from v_places union
  select distinct alt as name from v_places
) n
"""

VIEWS["v_bridge"] = """
select place_id, id as category_id, 0 as relation, 0 as ordinal from v_places join v_cats on v_cats.name = basic_category
union all
select place_id, id as category_id, 1 as relation, 1 as ordinal from v_places join v_cats on v_cats.name = taxonomy_primary
union all
select place_id, id as category_id, 1 as relation, 0 as ordinal from v_places join v_cats on v_cats.name = basic_category
union all
select place_id, id as category_id, 2 as relation, 0 as ordinal from v_places join v_cats on v_cats.name = alt
"""

VIEWS["v_queries"] = """
select cast(1 as bigint) as query_id, 'red widget' as text, '' as category, cast(null as double) as lat, cast(null as double) as lon
union all select 2, '', 'machinery', 45.2e0, 11.1e0
union all select 3, 'widget nation', '', 45.7e0, 12.9e0
union all select 4, 'n s', '', cast(null as double), cast(null as double)
union all select 5, 'zzz qqq', '', cast(null as double), cast(null as double)
union all select 6, 'g', 'economy', 46.0e0, 11.0e0
union all select 100 + n_nationkey, concat('ring ', n_name),
  case when n_nationkey % 3 = 0 then 'Building' else '' end,
  case when n_nationkey % 2 = 0 then 45.0e0 + n_nationkey * 0.05e0 end,
  case when n_nationkey % 2 = 0 then 11.0e0 + n_nationkey * 0.05e0 end
from nation
"""

# Normal form and terms of the queries, written out for the comparison SQL.
VIEWS["d_query"] = """
select *, lower(regexp_replace(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g'), '^ | $', '', 'g')) as q_norm,
  lower(category) as cat_norm,
  list_filter(string_split(lower(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) >= 2) as toks
from v_queries
"""

VIEWS["d_terms"] = """
select query_id, unnest(case when len(toks) > 0 then toks when q_norm <> '' then [q_norm] else [] end) as term from d_query
"""

VIEWS["d_tokcand"] = """
select distinct query_id, place_id from d_terms join v_places
on contains(name_norm, term) or contains(address_norm, term)
"""

VIEWS["d_catcand"] = """
select distinct query_id, place_id from d_query join v_cats on cat_norm = v_cats.name_norm join v_bridge on category_id = id
where cat_norm <> ''
"""

VIEWS["d_cand2"] = """
select t.query_id, t.place_id from d_tokcand t join d_query q on q.query_id = t.query_id where q.cat_norm = ''
union all
select t.query_id, t.place_id from d_tokcand t join d_query q on q.query_id = t.query_id
  join d_catcand c on c.query_id = t.query_id and c.place_id = t.place_id
union all
select c.query_id, c.place_id from d_catcand c join d_query q on q.query_id = c.query_id where q.q_norm = ''
"""

VIEWS["d_found2"] = """
select q.query_id, p.place_id, p.name, p.address, name_norm, address_norm, confidence, latitude, longitude, q.lat, q.lon, q_norm, cat_norm, toks,
  basic_category, taxonomy_primary,
  case when q_norm = '' then 0 when name_norm = coalesce(toks[1], q_norm) then 0
    when starts_with(name_norm, coalesce(toks[1], q_norm)) then 1 else 2 end as klass
from d_cand2 c join d_query q on q.query_id = c.query_id join v_places p on p.place_id = c.place_id
where operating_status <> 'permanently_closed'
"""

VIEWS["d_ret2"] = """
select query_id, place_id, min(pos) as pos from (
  select query_id, place_id, row_number() over (partition by query_id
    order by (latitude-lat)*(latitude-lat)+(longitude-lon)*(longitude-lon), confidence desc, place_id) as pos
  from d_found2 where lat is not null and abs(latitude-lat) <= 150/111.32e0
    and abs(longitude-lon) <= 150/(111.32e0*greatest(0.15e0, cos(radians(lat))))
  qualify pos <= 3000
  union all
  select query_id, place_id, 3000 + row_number() over (partition by query_id order by klass, confidence desc, place_id) as pos
  from d_found2 qualify pos <= 3900
) u group by query_id, place_id
"""

VIEWS["d_rank2"] = """
select query_id, rank, place_id, title, address, round(dist, 3) as distance_m, score, s_confidence, s_exact, s_prefix, s_contains,
  s_brand_first, s_tokens, s_category, s_proximity
from (
  select *, s_confidence+s_exact+s_prefix+s_contains+s_brand_first+s_tokens+s_category+s_proximity as score,
    row_number() over (partition by query_id order by s_confidence+s_exact+s_prefix+s_contains+s_brand_first+s_tokens+s_category+s_proximity desc,
      confidence desc, dist asc nulls last, part, near, place_id) as rank
  from (
    select *, case when lat is null then 0 else greatest(0, 900 - floor(least(dist/1000.0e0, 100.0e0)*9.0e0)::bigint) end as s_proximity
    from (
      select f.query_id, f.place_id, f.name as title, f.address, confidence, lat, case when boxed then 0 else 1 end as part,
        case when boxed then (latitude-lat)*(latitude-lat)+(longitude-lon)*(longitude-lon) else klass end as near,
        2*6371008.8e0*asin(least(1.0e0, sqrt(pow(sin(radians(latitude-lat)/2),2)
          + cos(radians(lat))*cos(radians(latitude))*pow(sin(radians(longitude-lon)/2),2)))) as dist,
        floor(confidence*100.0e0)::bigint as s_confidence,
        case when q_norm <> '' and name_norm = q_norm then 4000 else 0 end as s_exact,
        case when q_norm <> '' and starts_with(name_norm, q_norm) then 2000 else 0 end as s_prefix,
        case when q_norm <> '' and contains(name_norm, q_norm) then 1000 else 0 end as s_contains,
        case when len(toks) > 1 and name_norm = toks[1] then 2500 else 0 end as s_brand_first,
        250*len(list_filter(toks, lambda t: list_contains(string_split(concat(name_norm, ' ', address_norm), ' '), t))) as s_tokens,
        case when cat_norm = '' then 0 when lower(basic_category) = cat_norm or lower(taxonomy_primary) = cat_norm then 1800 else 1000 end as s_category
      from (select *, coalesce(abs(latitude-lat) <= 150/111.32e0 and abs(longitude-lon) <= 150/(111.32e0*greatest(0.15e0, cos(radians(lat)))), false) as boxed from d_found2) f
    ) a
  ) b
) c where rank <= 8
"""

VIEWS["d_kept"] = """
select *, try_cast(lat as double) as latitude, try_cast(lon as double) as longitude,
  case when conf = '' then 0.0e0 else try_cast(conf as double) end as confidence,
  trim(regexp_replace(name, '\\s+', ' ', 'g')) as cname,
  array_to_string(list_filter([freeform, postcode, locality,
     case when lower(region) = lower(locality) then '' else region end, upper(country)], lambda x: x <> ''), ', ') as address_up,
  array_to_string(list_filter([freeform, postcode, locality,
     case when lower(region) = lower(locality) then '' else region end, country], lambda x: x <> ''), ', ') as address
from v_feature
where trim(name) <> '' and has_address and has_position and try_cast(lat as double) is not null
  and (conf = '' or try_cast(conf as double) is not null) and (country = '' or upper(country) = 'AT')
"""

VIEWS["d_rec"] = """
select *, case when pid <> '' then pid else
    concat(lower(replace(cname, '_', ' ')), ':', printf('%.6f', latitude), ':', printf('%.6f', longitude)) end as place_id,
  case when prim <> '' then prim else legacy_prim end as tprim,
  list_filter([hier1, hier2], lambda x: x <> '') as hraw,
  case when alt1 <> '' then [alt1] else [legacy_alt] end as talts,
  case when cast(s1_conf as double) > coalesce(try_cast(s2_conf as double), -1) or
     (cast(s1_conf as double) = coalesce(try_cast(s2_conf as double), -1) and s1_provider >= s2_provider) then true else false end as first_src
from d_kept
"""

VIEWS["d_tax"] = """
select *, case when list_contains(hraw, tprim) then hraw else list_append(hraw, tprim) end as thier,
  case when first_src then s1_provider else s2_provider end as provider,
  case when first_src then s1_dataset else '' end as dataset,
  case when first_src then s1_record else s2_record end as record_id,
  case when first_src then '1' else '' end as version
from d_rec
"""

VIEWS["d_acc"] = """
select * from d_tax qualify row_number() over (partition by place_id order by ord) = 1
"""

VIEWS["d_catseen"] = """
select name, ord, slot from (
  select basic as name, ord, 0 as slot from d_tax union all select tprim, ord, 1 from d_tax union all
  select unnest(list_concat(thier, talts)), ord, 1 + generate_subscripts(list_concat(thier, talts), 1) from d_acc
) s where name <> '' qualify row_number() over (partition by name order by ord, slot) = 1
"""

VIEWS["d_catid"] = """
select row_number() over (order by ord, slot) as id, name from d_catseen
"""

# --- directed road graphs ------------------------------------------------

VIEWS["v_seg"] = """
select l_orderkey * 8 + l_linenumber as gid, min(l_partkey) as pk, min(l_suppkey) as sk
from lineitem group by l_orderkey * 8 + l_linenumber
"""

# A segment joins two nodes of one block of 1000; where the block ends, it leads backwards.
VIEWS["v_span"] = """
select gid, pk, sk, near_node, near_node + case when near_node % 1000 + pk % 5 + 1 < 1000 then pk % 5 + 1 else 0 - (pk % 5 + 1) end as far_node
from (select gid, pk, sk, cast(floor(gid / 4) as bigint) as near_node from v_seg) s
"""

# Each segment gives a forward and a reverse edge; nodes link nearby segments.
VIEWS["v_half"] = """
select gid, pk, sk, 0 as dir, near_node as start_node, far_node as end_node from v_span
union all
select gid, pk, sk, 1 as dir, far_node as start_node, near_node as end_node from v_span
"""

VIEWS["v_edges_a"] = """
select gid * 2 + dir + 1 as graph_id, gid * 2 + 2 - dir as opposing_id, pk + 1 as way_id, gid, dir, start_node, end_node,
  46.0e0 + (start_node % 1000) * 0.0001e0 as lat, 12.0e0 + cast(floor(start_node / 1000) as bigint) * 0.0003e0 as lon,
  46.0e0 + (end_node % 1000) * 0.0001e0 as end_lat, 12.0e0 + cast(floor(end_node / 1000) as bigint) * 0.0003e0 as end_lon,
  46.00003e0 + (start_node % 1000) * 0.0001e0 as inner_lat, 12.0001e0 + (pk % 7) * 0.00001e0 + cast(floor(start_node / 1000) as bigint) * 0.0003e0 as inner_lon,
  cast(case (gid + dir) % 6 when 0 then 0 when 1 then 1 when 2 then 1024 else 1025 end as bigint) as forward_access,
  cast(case (gid + 1 - dir) % 6 when 0 then 0 when 1 then 1 when 2 then 1024 else 1025 end as bigint) as reverse_access,
  (gid + dir) % 3 = 0 as deadend, gid % 5 <> 4 as is_road, gid % 11 = 0 as is_shortcut, gid % 17 = 0 as is_transit, gid % 5 = 4 and gid % 2 = 0 as is_ferry,
  cast(gid % 8 as int) as road_class, cast(gid % 4 as int) as road_use, cast(gid % 3 as int) as layer, gid % 13 = 0 as bridge, gid % 19 = 0 as tunnel
from v_half
"""

VIEWS["v_edges_b"] = """
select graph_id * 3 + 7 as graph_id, opposing_id * 3 + 7 as opposing_id, way_id + case when gid % 29 = 0 then 1 else 0 end as way_id, gid, dir,
  start_node + 5 as start_node, end_node + 5 as end_node,
  lat + case when gid % 7 = 0 then 0.001e0 else 0.0e0 end as lat, lon,
  end_lat + case when gid % 9 = 0 then 0.00003e0 else 0.0e0 end as end_lat, end_lon, inner_lat, inner_lon,
  forward_access, reverse_access, (gid + dir) % 4 = 0 as deadend, is_road, is_shortcut, is_transit, is_ferry,
  road_class, road_use, layer, bridge, tunnel
from v_edges_a where gid % 5 <> 0
"""

# Outgoing edges at the end node of each edge, one row per outgoing edge.
VIEWS["v_out_a"] = """
select e.graph_id as source_id, e.opposing_id, e.deadend, o.graph_id as option_id, o.forward_access as option_access, o.end_node,
  o.is_road, o.is_shortcut, o.start_node, o.end_lat, o.end_lon, o.inner_lat as dep_lat,
  case when o.gid % 23 = 0 then cast(null as double) else o.inner_lon end as dep_lon,
  case when o.gid % 10 = 3 then 'NOT_EVALUATED' when o.gid % 10 = 4 then 'UNRESOLVED_CONDITIONAL'
    when (o.forward_access & 1) <> 0 then 'ALLOWED_NATIVE_IMMEDIATE' else 'DENIED' end as car,
  case when o.gid % 10 = 3 then 'NOT_EVALUATED' when o.gid % 10 = 5 then 'UNRESOLVED_TIME'
    when (o.forward_access & 1024) <> 0 then 'ALLOWED_NATIVE_IMMEDIATE' else 'DENIED' end as motorcycle
from v_edges_a e join v_edges_a o on o.start_node = e.end_node
"""

VIEWS["v_out_b"] = """
select e.graph_id as source_id, e.opposing_id, o.graph_id as option_id, o.forward_access as option_access, o.end_node, o.is_road, o.is_shortcut
from v_edges_b e join v_edges_b o on o.start_node = e.end_node
"""

# Options in the sense of the terminal search: the reverse edge is not one.
VIEWS["v_opts"] = """
select source_id, option_id, option_access, is_shortcut as shortcut, option_id % 37 = 0 as transit, option_id % 41 = 0 as via_hierarchy,
  start_node as from_node, end_node, end_lat, end_lon, dep_lat, dep_lon, car, motorcycle
from v_out_a where option_id <> opposing_id
"""

VIEWS["v_src"] = """
select graph_id, forward_access as access, end_node, end_lat, end_lon, road_class, road_use, layer, bridge, tunnel from v_edges_a
"""

VIEWS["d_term"] = """
select s.graph_id, s.access, s.end_node, s.end_lat, s.end_lon, s.access & ~coalesce(o.oa, 0) as terminal_modes
from v_src s left join (select source_id, bit_or(option_access) as oa from v_opts group by source_id) o on o.source_id = s.graph_id
"""

# Edges that meet the cut, with an orientation.
VIEWS["v_cutsel"] = """
select graph_id, case graph_id % 4 when 0 then 'OUTWARD' when 1 then 'AMBIGUOUS' else 'INWARD' end as orientation from v_edges_a where gid % 3 = 0
"""

VIEWS["v_tilesel"] = """
select graph_id & 33554431 as tile_id from v_edges_a where graph_id % 5 <> 0
"""

VIEWS["v_scope"] = """
select graph_id from v_edges_a where graph_id % 7 <> 0
"""

VIEWS["d_roots"] = """
select t.*, t.access & ~t.terminal_modes as pending from d_term t join v_cutsel c on c.graph_id = t.graph_id where c.orientation in ('OUTWARD', 'AMBIGUOUS')
"""

VIEWS["d_ropts"] = """
select r.graph_id as root_id, r.access, r.pending, o.*,
  (o.option_access & r.pending) <> 0 and not o.shortcut and not o.transit as eligible,
  (o.option_id & 33554431) in (select tile_id from v_tilesel) as in_scope
from d_roots r join v_opts o on o.source_id = r.graph_id where r.pending <> 0
"""

VIEWS["d_links"] = """
select graph_id as terminal_id, graph_id as root_id, terminal_modes as modes, 'NATIVE_TERMINAL_AT_SHARED_CUT' as kind from d_roots where terminal_modes <> 0
union all
select option_id, root_id, t.terminal_modes & o.pending, 'NATIVE_TERMINAL_ONE_IMMEDIATE_HOP_UNPROVEN'
from d_ropts o join d_term t on t.graph_id = o.option_id
where eligible and in_scope and option_id in (select graph_id from v_scope) and (t.terminal_modes & o.pending) <> 0
"""

# Source dead ends and nearby receiver ends within 8 m (planar).
VIEWS["d_near"] = """
select a.graph_id as source_id, b.graph_id as receiver_id, a.way_id as source_way, b.way_id as receiver_way, b.deadend as receiver_deadend,
  a.forward_access as source_access, b.forward_access as receiver_access,
  111320.0e0*sqrt(pow(b.end_lat-a.end_lat, 2) + pow((b.end_lon-a.end_lon)*cos(radians((a.end_lat+b.end_lat)/2)), 2)) as distance_m
from (select *, end_node + 5 + unnest([-2, -1, 0, 1, 2]) as near_end from v_edges_a where deadend) a join v_edges_b b on b.end_node = a.near_end
where 111320.0e0*sqrt(pow(b.end_lat-a.end_lat, 2) + pow((b.end_lon-a.end_lon)*cos(radians((a.end_lat+b.end_lat)/2)), 2)) <= 8.0e0
"""

# --- outlines, windows, tiles --------------------------------------------

# Two regions whose outlines lie over the test graph: a square with a hole and
# a shifted square.  Vertices avoid every coordinate the graph views can take.
VIEWS["v_poly"] = """
select 'ra' as region_id, 0 as ring_no, false as is_hole, 0 as seq, 12.000151e0 as ax, 46.010007e0 as ay, 12.000153e0 as ex, 46.070013e0 as ey
union all select 'ra', 0, false, 1, 12.000153e0, 46.070013e0, 12.400017e0, 46.070011e0
union all select 'ra', 0, false, 2, 12.400017e0, 46.070011e0, 12.400013e0, 46.010003e0
union all select 'ra', 0, false, 3, 12.400013e0, 46.010003e0, 12.000151e0, 46.010007e0
union all select 'ra', 1, true, 0, 12.000091e0, 46.030007e0, 12.000093e0, 46.040013e0
union all select 'ra', 1, true, 1, 12.000093e0, 46.040013e0, 12.200017e0, 46.040011e0
union all select 'ra', 1, true, 2, 12.200017e0, 46.040011e0, 12.200013e0, 46.030003e0
union all select 'ra', 1, true, 3, 12.200013e0, 46.030003e0, 12.000091e0, 46.030007e0
union all select 'rb', 0, false, 0, 11.900051e0, 46.050007e0, 11.900053e0, 46.090013e0
union all select 'rb', 0, false, 1, 11.900053e0, 46.090013e0, 12.300017e0, 46.090011e0
union all select 'rb', 0, false, 2, 12.300017e0, 46.090011e0, 12.300013e0, 46.050003e0
union all select 'rb', 0, false, 3, 12.300013e0, 46.050003e0, 11.900051e0, 46.050007e0
"""

# Even-odd test of graph ends, per ring, written out for the comparison SQL.
VIEWS["d_inring"] = """
select p.graph_id, s.region_id, s.ring_no, bool_or(is_hole) as is_hole,
  count(case when (ay > end_lat) <> (ey > end_lat) and end_lon < ax + (end_lat - ay) * (ex - ax) / (ey - ay) then 1 end) % 2 = 1 as inside
from v_edges_a p cross join v_poly s group by p.graph_id, s.region_id, s.ring_no
"""

VIEWS["d_in"] = """
select graph_id, region_id, bool_or(inside and not is_hole) and not bool_or(inside and is_hole) as inside from d_inring group by graph_id, region_id
"""

VIEWS["v_windows"] = """
select w as window_index, 46.0e0 + (w % 97) * 0.001e0 as min_lat, 46.0021e0 + (w % 97) * 0.001e0 as max_lat,
  12.0e0 + cast(floor(w / 100) as bigint) * 0.0003e0 as min_lon, 12.0004e0 + cast(floor(w / 100) as bigint) * 0.0003e0 as max_lon
from (select distinct cast(floor(gid / 40) as bigint) as w from v_seg) x
"""

# Tiles of level 2 on and around the outlines, from the orders table.
VIEWS["v_tiles"] = """
select distinct 2 as level, (544 + o_orderkey % 5 - 2) * 1440 + 768 + cast(floor(o_orderkey / 5) as bigint) % 40 - 20 as tile_index from orders
union
select distinct 1 as level, (136 + o_orderkey % 3 - 1) * 360 + 192 + cast(floor(o_orderkey / 3) as bigint) % 9 - 4 as tile_index from orders
"""

VIEWS["v_tilebox"] = """
select level, tile_index, cast(floor(tile_index / w) as bigint) * size - 90.0e0 as min_lat, cast(floor(tile_index / w) as bigint) * size - 90.0e0 + size as max_lat,
  (tile_index % w) * size - 180.0e0 as min_lon, (tile_index % w) * size - 180.0e0 + size as max_lon
from (select level, tile_index, case level when 2 then 1440 else 360 end as w, case level when 2 then 0.25e0 else 1.0e0 end as size from v_tiles) t
"""

# --- shapes --------------------------------------------------------------

VIEWS["v_shape_a"] = """
select graph_id, opposing_id, gid, dir, way_id, forward_access, deadend, road_class, road_use, layer, bridge, tunnel,
  lat as la0, lon as lo0, inner_lat as la1, inner_lon as lo1, end_lat as la2, end_lon as lo2 from v_edges_a
"""

VIEWS["v_shape_b"] = """
select graph_id, opposing_id, gid, dir, way_id, forward_access, deadend, road_class, road_use, case when gid % 31 = 0 then layer + 1 else layer end as layer, bridge, tunnel,
  is_shortcut, is_transit, start_node, end_node, lat as la0, lon as lo0, inner_lat as la1, inner_lon as lo1,
  end_lat + (end_lat - inner_lat) * (gid % 3) * 0.5e0 as la2, end_lon + (end_lon - inner_lon) * (gid % 3) * 0.5e0 as lo2 from v_edges_b
"""

# Source and receiver shapes of the same segment, both directions.
VIEWS["v_ab"] = """
select a.graph_id as a_id, b.graph_id as b_id, a.forward_access as a_access, b.forward_access as b_access,
  a.way_id as a_way, b.way_id as b_way, a.layer as a_layer, b.layer as b_layer, a.bridge as a_bridge, b.bridge as b_bridge, a.tunnel as a_tunnel, b.tunnel as b_tunnel,
  a.la0 as aa0, a.lo0 as ao0, a.la1 as aa1, a.lo1 as ao1, a.la2 as aa2, a.lo2 as ao2,
  b.la0 as ba0, b.lo0 as bo0, b.la1 as ba1, b.lo1 as bo1,
  b.la2 as ba2, b.lo2 as bo2
from v_shape_a a join v_shape_b b on a.gid = b.gid
"""

# Receiver options after a predecessor, with costing and attributes.
VIEWS["v_optb"] = """
select e.graph_id as predecessor_id, o.graph_id as option_id, o.forward_access as option_access, o.lat as start_lat, o.lon as start_lon,
  case when o.gid % 10 = 3 then 'NOT_EVALUATED' when o.gid % 20 = 4 then 'UNRESOLVED_CONDITIONAL'
    when (o.forward_access & 1) <> 0 then 'ALLOWED_NATIVE_IMMEDIATE' else 'DENIED' end as car,
  case when o.gid % 10 = 3 then 'NOT_EVALUATED' when o.gid % 20 = 5 then 'UNRESOLVED_TIME'
    when (o.forward_access & 1024) <> 0 then 'ALLOWED_NATIVE_IMMEDIATE' else 'DENIED' end as motorcycle,
  e.road_class as p_class, o.road_class as n_class, e.road_use as p_use, o.road_use as n_use, e.layer as p_layer, o.layer as n_layer,
  e.bridge as p_bridge, o.bridge as n_bridge, e.tunnel as p_tunnel, o.tunnel as n_tunnel
from v_edges_b e join v_edges_b o on o.start_node = e.end_node where o.graph_id <> e.opposing_id
"""

# Source finals with their exact end point and approach.
VIEWS["d_cand"] = """
select s.graph_id as source_id, t.terminal_modes & 1025 as modes, s.forward_access as access, t.end_node, s.la2 as x_lat, s.lo2 as x_lon,
  case when s.gid % 43 = 0 then null else s.la1 end as app_lat, s.lo1 as app_lon, s.layer, s.bridge, s.tunnel
from v_shape_a s join d_term t on t.graph_id = s.graph_id where (t.terminal_modes & 1025) <> 0
"""

VIEWS["d_atx"] = """
select source_id, receiver_id, min(m) as distance_m from (
  select *, 111320.0e0*sqrt(pow(qx-u*dx, 2) + pow(qy-u*dy, 2)) as m from (
    select *, greatest(0.0e0, least(1.0e0, (qx*dx+qy*dy)/(dx*dx+dy*dy))) as u from (
      select c.source_id, b.graph_id as receiver_id, k.s, (case s when 0 then lo1-lo0 else lo2-lo1 end)*cos(radians(x_lat)) as dx, case s when 0 then la1-la0 else la2-la1 end as dy,
        (x_lon - case s when 0 then lo0 else lo1 end)*cos(radians(x_lat)) as qx, x_lat - case s when 0 then la0 else la1 end as qy
      from d_cand c join v_shape_b b on floor((b.end_node-5)/1000) = floor(c.end_node/1000) and b.end_node-5 between c.end_node-25 and c.end_node+25
        and not b.is_shortcut and not b.is_transit and (b.forward_access & 1025) <> 0
      cross join (select 0 as s union all select 1) k) a) b) d where m <= 4.0e0 group by source_id, receiver_id
"""

VIEWS["d_pairx"] = """
select c.*, a.receiver_id, b.forward_access as r_access, b.layer as r_layer, b.bridge as r_bridge, b.tunnel as r_tunnel,
  b.la0 as b0a, b.lo0 as b0o, b.la1 as b1a, b.lo1 as b1o, b.la2 as b2a, b.lo2 as b2o
from d_atx a join d_cand c on c.source_id = a.source_id join v_shape_b b on b.graph_id = a.receiver_id
"""


def projection(relation: str, key: str, lat: str, lon: str, ref: str, scale: str, name: str) -> str:
    """Comparison SQL: nearest place of a point on the two segments b0-b1-b2."""
    best = "m * 10 + s * 1e-9"
    return f"""(select {key}, min_by(m, {best}) as {name}_m, min_by(t * len + before, {best}) as {name}_along, min_by(s, {best}) as {name}_seg,
      min_by(dx / len, {best}) as {name}_tx, min_by(dy / len, {best}) as {name}_ty, sum(len) as {name}_len from (
      select *, sqrt(pow(qx - t*dx, 2) + pow(qy - t*dy, 2)) as m, coalesce(lag(len) over (partition by {key} order by s), 0) as before from (
        select *, greatest(0.0e0, least(1.0e0, (qx*dx+qy*dy)/(dx*dx+dy*dy))) as t, sqrt(dx*dx+dy*dy) as len from (
          select {key}, s, (case s when 0 then b1o-b0o else b2o-b1o end)*{scale}*cos(radians({ref})) as dx, (case s when 0 then b1a-b0a else b2a-b1a end)*{scale} as dy,
            ({lon} - case s when 0 then b0o else b1o end)*{scale}*cos(radians({ref})) as qx, ({lat} - case s when 0 then b0a else b1a end)*{scale} as qy
          from {relation} cross join (select 0 as s union all select 1) k) p0 where dx*dx+dy*dy >= 1e-10) p1) p2 group by {key})"""


VIEWS["d_ov"] = f"""
select source_id, receiver_id, common_modes, x_m, approach_m, progress_m, segment_m, remaining_m, same_structure,
  case when common_modes = 0 then 'REJECTED_NO_SHARED_VEHICLE_MODE' when app_lat is null then 'UNRESOLVED_SOURCE_APPROACH_MISSING'
    when x_m <= 0.75 and approach_m <= 0.75 and progress_m <= -0.5 then 'REJECTED_OPPOSITE_DIRECTED_SHAPE'
    when x_m <= 0.75 and approach_m <= 0.75 and ((progress_m >= 1 and segment_m >= 1)
      or (segment_m >= 0.5 and segment_m < 1 and x_m <= 0.1 and approach_m <= 0.1 and progress_m >= 0.5 and progress_m >= segment_m - 0.12)) then
        case when not same_structure then 'UNRESOLVED_NATIVE_LEVEL_OR_STRUCTURE_CONFLICT' when remaining_m < 1 then 'B_PREDECESSOR_ENDS_AT_X_NEEDS_NATIVE_SUCCESSOR'
          else 'MATCHED_DIRECTED_SOURCE_GEOMETRY_OVERLAP' end
    else 'UNRESOLVED_NO_DIRECTED_SOURCE_OVERLAP' end as status
from (
  select q.source_id, q.receiver_id, q.app_lat, q.access & q.r_access & 1025 as common_modes, x.x_m, a.a_m as approach_m, x.x_along - a.a_along as progress_m,
    111320.0e0*sqrt(pow((q.app_lon-q.x_lon)*cos(radians(q.x_lat)), 2) + pow(q.app_lat-q.x_lat, 2)) as segment_m, x.x_len - x.x_along as remaining_m,
    q.layer = q.r_layer and q.bridge = q.r_bridge and q.tunnel = q.r_tunnel as same_structure
  from d_pairx q join {projection("d_pairx", "source_id, receiver_id", "x_lat", "x_lon", "x_lat", "111320.0e0", "x")} x
    on x.source_id = q.source_id and x.receiver_id = q.receiver_id
  join {projection("d_pairx", "source_id, receiver_id", "app_lat", "app_lon", "x_lat", "111320.0e0", "a")} a
    on a.source_id = q.source_id and a.receiver_id = q.receiver_id) v
"""

_ALLOWED = "((case when car = 'ALLOWED_NATIVE_IMMEDIATE' then 1 else 0 end) | (case when motorcycle = 'ALLOWED_NATIVE_IMMEDIATE' then 1024 else 0 end))"

VIEWS["d_tried"] = f"""
select c.source_id, c.x_lat, c.x_lon, u.receiver_id as predecessor_id, o.* exclude (predecessor_id), {_ALLOWED} & c.modes & o.option_access as m
from d_ov u join d_cand c on c.source_id = u.source_id left join v_optb o on o.predecessor_id = u.receiver_id
where u.status = 'B_PREDECESSOR_ENDS_AT_X_NEEDS_NATIVE_SUCCESSOR'
"""

VIEWS["d_node"] = """
select source_id, option_id, bit_or(m) as modes, min(relation) as relation, list_sort(list_distinct(list(predecessor_id))) as preds from (
  select *, case when 111320.0e0*sqrt(pow((start_lon-x_lon)*cos(radians(x_lat)), 2) + pow(start_lat-x_lat, 2)) > 0.75 then 'START_NOT_AT_X'
    when not (p_layer = n_layer and p_bridge = n_bridge and p_tunnel = n_tunnel) then 'NATIVE_STRUCTURE_CHANGE_PHYSICAL_IDENTITY_UNVERIFIED'
    when not (p_class = n_class and p_use = n_use) then 'NATIVE_CLASS_OR_USE_CHANGE_PHYSICAL_IDENTITY_UNVERIFIED'
    else 'CONSISTENT_NATIVE_ROAD_ATTRIBUTES_PHYSICAL_IDENTITY_UNVERIFIED' end as relation
  from d_tried where m <> 0) r group by source_id, option_id
"""

VIEWS["d_opt"] = """
select source_id, option_id, modes, relation, preds, 'VERIFIED_B_ORIGINAL_SAME_NODE_LEGAL_BRANCH' as evidence from d_node
union all
select o.source_id, o.receiver_id, o.common_modes & c.modes, 'INTERIOR_B_EDGE_OVERLAP_PHYSICAL_IDENTITY_UNVERIFIED', [], 'VERIFIED_B_DIRECTED_INTERIOR_SOURCE_OVERLAP'
from d_ov o join d_cand c on c.source_id = o.source_id where o.status = 'MATCHED_DIRECTED_SOURCE_GEOMETRY_OVERLAP'
  and not exists (select 1 from d_node n where n.source_id = o.source_id and n.option_id = o.receiver_id)
"""

VIEWS["d_unk"] = """
select source_id, predecessor_id, option_id, car, motorcycle from d_tried
where option_id is null or starts_with(car, 'UNRESOLVED_') or starts_with(motorcycle, 'UNRESOLVED_')
"""

VIEWS["d_corr"] = """
select *, case when n_unknown > 0 then 'B_NODE_CONTINUATION_PARTIALLY_UNRESOLVED'
  when n_options > 0 and n_predecessors <= 1 and n_inside <= 1 then 'B_NATIVE_DIRECTIONAL_CONTINUATIONS_IDENTIFIED'
  when n_options > 0 then 'B_MULTIPLE_OVERLAPPING_PREDECESSORS_UNRESOLVED' when n_predecessors > 0 then 'NO_PROVEN_B_NATIVE_OUTGOING_AFTER_X'
  else 'NO_PROVEN_CORRESPONDING_B_DIRECTION' end as status
from (select c.source_id, c.modes, coalesce(o.n, 0) as n_options, coalesce(v.p, 0) as n_predecessors, coalesce(v.i, 0) as n_inside, coalesce(k.n, 0) as n_unknown
  from d_cand c left join (select source_id, count(*) as n from d_opt group by source_id) o on o.source_id = c.source_id
  left join (select source_id, count(case when status = 'B_PREDECESSOR_ENDS_AT_X_NEEDS_NATIVE_SUCCESSOR' then 1 end) as p,
     count(case when status = 'MATCHED_DIRECTED_SOURCE_GEOMETRY_OVERLAP' then 1 end) as i from d_ov group by source_id) v on v.source_id = c.source_id
  left join (select source_id, count(*) as n from d_unk group by source_id) k on k.source_id = c.source_id) q
"""

VIEWS["d_match"] = """
select o.source_id, o.receiver_id, o.status as relationship, case when remaining_m < 1 then 'END_NODE' else 'INTERIOR' end as position,
  o.common_modes & c.modes & 1025 as modes, x_m, progress_m
from d_ov o join d_cand c on c.source_id = o.source_id
where o.status in ('B_PREDECESSOR_ENDS_AT_X_NEEDS_NATIVE_SUCCESSOR', 'MATCHED_DIRECTED_SOURCE_GEOMETRY_OVERLAP')
"""

# --- tiled builds, layers, regions, routes -------------------------------

VIEWS["v_tiles_old"] = """
select concat('g', cast(o_custkey % 40 as varchar(20))) as region_id, concat('2/', cast(o_orderkey as varchar(20)), '.gph') as path,
  concat('h', cast(o_totalprice as varchar(30))) as sha256,
  case when o_orderpriority = '1-URGENT' then 'n1' when o_orderpriority = '2-HIGH' then 'n1,n2' when o_orderpriority = '3-MEDIUM' then 'n3' else '' end as neighbours
from orders
"""

VIEWS["v_tiles_new"] = """
select region_id, path, case when length(sha256) % 7 = 0 then concat(sha256, 'x') else sha256 end as sha256,
  case when length(path) % 5 = 0 and neighbours = '' then 'n2' else neighbours end as neighbours
from v_tiles_old where sha256 not like '%7'
"""

VIEWS["d_tilediff"] = """
select coalesce(a.region_id, b.region_id) as region_id, coalesce(a.path, b.path) as path,
  case when a.path is null then 'added' when b.path is null then 'removed' else 'changed' end as status,
  list_sort(list_distinct(list_filter(list_concat(string_split(coalesce(a.neighbours, ''), ','), string_split(coalesce(b.neighbours, ''), ',')), lambda x: x <> ''))) as bs
from v_tiles_old a full join v_tiles_new b on a.region_id = b.region_id and a.path = b.path
where a.path is null or b.path is null or a.sha256 <> b.sha256
"""

# Way features: several per way, some drawn backwards in the later state.
VIEWS["v_way_a"] = """
select l_partkey as way_id, l_orderkey as f, p_type as road_class, case when p_size % 3 = 0 then '' else p_name end as name, cast(p_size % 5 as varchar(20)) as surface,
  46.0e0 + (l_suppkey % 100) * 0.001e0 as la0, 12.0e0 + (l_partkey % 200) * 0.001e0 as lo0,
  46.0005e0 + (l_suppkey % 100) * 0.001e0 as la1, 12.0005e0 + (l_partkey % 200) * 0.001e0 as lo1
from lineitem join part on p_partkey = l_partkey
"""

VIEWS["v_way_b"] = """
select way_id, f, road_class, case when way_id % 11 = 0 then concat(name, ' new') else name end as name, surface,
  case when way_id % 2 = 0 then la1 else la0 end as la0, case when way_id % 2 = 0 then lo1 else lo0 end as lo0,
  case when way_id % 2 = 0 then la0 else la1 end as la1, case when way_id % 2 = 0 then lo0 else lo1 end as lo1
from v_way_a where way_id % 13 <> 0
union all
select way_id + 10000000, f, road_class, name, surface, la0, lo0, la1, lo1 from v_way_a where way_id % 17 = 0
"""

# Regions: continent -> country -> area; some areas cannot be downloaded.
VIEWS["v_regions"] = """
select lower(r_name) as id, '' as parent, cast(null as varchar(20)) as iso, '' as url from region
union all
select lower(n_name), lower(r_name), case when n_nationkey % 5 = 0 then null when n_nationkey % 7 = 0 then 'XXX' else concat(chr(97 + n_nationkey), 'z') end,
  case when n_nationkey % 3 = 0 then '' else concat('u', n_name) end
from nation join region on r_regionkey = n_regionkey
union all
select concat('a', cast(c_custkey as varchar(20))), case when c_custkey % 50 = 0 then 'nowhere' else lower(n_name) end, cast(null as varchar(20)),
  case when c_custkey % 4 = 0 then '' else concat('u', c_name) end
from customer join nation on n_nationkey = c_nationkey
"""

VIEWS["v_routes"] = """
select o_orderkey as route_id, case when o_orderkey % 13 = 0 then 2 else 0 end as status, case when o_orderkey % 17 = 0 then cast(null as double) else (o_orderkey % 900) * 0.1e0 + 0.05e0 end as length_km,
  46.0e0 + (o_orderkey % 97) * 0.001e0 as start_lat, 12.0e0 + (o_custkey % 89) * 0.0011e0 as start_lon,
  46.0e0 + (o_orderkey % 83) * 0.0012e0 as end_lat, 12.2e0 + (o_custkey % 79) * 0.0011e0 as end_lon,
  46.0001e0 + (o_orderkey % 97) * 0.001e0 + case when o_orderkey % 19 = 0 then 0.05e0 else 0.0e0 end as actual_start_lat, 12.0e0 + (o_custkey % 89) * 0.0011e0 as actual_start_lon,
  46.0e0 + (o_orderkey % 83) * 0.0012e0 + (o_custkey % 3) * 0.001e0 as actual_end_lat, 12.2e0 + (o_custkey % 79) * 0.0011e0 as actual_end_lon,
  60.0e0 + o_orderkey % 700 as seconds, o_custkey % 500 as journey, o_orderstatus <> 'P' as success
from orders
"""

# Is a point of a route in region ra?
VIEWS["d_route_in"] = """
select route_id, which, bool_or(inside and not is_hole) and not bool_or(inside and is_hole) as inside from (
  select p.route_id, p.which, s.ring_no, bool_or(is_hole) as is_hole,
    count(case when (ay > plat) <> (ey > plat) and plon < ax + (plat - ay) * (ex - ax) / (ey - ay) then 1 end) % 2 = 1 as inside
  from (select route_id, 'start' as which, start_lat as plat, start_lon as plon from v_routes union all select route_id, 'end', end_lat, end_lon from v_routes
    union all select route_id, 'a', actual_start_lat, actual_start_lon from v_routes union all select route_id, 'z', actual_end_lat, actual_end_lon from v_routes) p
  cross join v_poly s where s.region_id = 'ra' group by p.route_id, p.which, s.ring_no) r group by route_id, which
"""
