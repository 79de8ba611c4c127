"""Queries of the readers and sinks, on text that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import graph as G, places as P
from ..session import run_dir
from ..sources import readers as R, sinks as W
from .graph import PAIR, adjacency
from .places import feed
from .registry import Tables, query


def json_lines(df: DataFrame, order: str) -> DataFrame:
    return df.select(F.col(order).alias("ord"), F.to_json(F.struct(*[c for c in df.columns if c != order])).alias("line"))


@query(
    "read_place_features",
    "select ord, case when pid = '' then null else pid end as pid, name, case when has_position then lon end as lon, has_address, s1_provider from v_feature",
)
def _(t):
    got = R.parse_place_features(json_lines(feed(t), "ord"))
    p = F.col("properties")
    return got.select(
        "ord", F.nullif(p["id"], F.lit("")).alias("pid"), p["names"]["primary"].alias("name"), F.get("geometry.coordinates", F.lit(0)).alias("lon"),
        p["addresses"].isNotNull().alias("has_address"), F.get(p["sources"], F.lit(1))["provider"].alias("s1_provider"),
    )


@query(
    "read_road_features",
    "select f as ord, way_id, highway, la0, lo0 from (select l_orderkey as f, l_partkey as way_id, 'primary' as highway, 46.0e0 + l_suppkey * 0.25e0 as la0, 12.0e0 + l_linenumber * 0.5e0 as lo0 from lineitem where l_partkey > 0 and l_suppkey % 7 <> 0) x",
)
def _(t):
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    ident = F.when(p % 3 == 0, F.to_json(F.struct(p.alias("id")))).when(p % 3 == 1, F.to_json(F.struct(F.concat(F.lit("w"), p.cast("string")).alias("id"))))
    head = F.regexp_replace(F.coalesce(ident, F.lit('{"id":"x"}')), "}$", "")
    attr = F.when(p % 3 == 2, F.concat(F.lit(',"@id":"w'), p.cast("string"), F.lit('"'))).otherwise(F.lit(""))
    kind = F.when(s % 7 == 0, "Point").otherwise("LineString")
    coords = F.concat(F.lit("[["), (12.0 + F.col("l_linenumber") * 0.5).cast("string"), F.lit(","), (46.0 + s * 0.25).cast("string"), F.lit("],[12.5,46.5]]"))
    line = F.concat(F.lit("\x1e"), head, F.lit(',"properties":{"highway":"primary"'), attr, F.lit('},"geometry":{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}}"))
    got = R.parse_road_features(t("lineitem").select(F.col("l_orderkey").alias("ord"), line.alias("line")))
    first = F.element_at("shape", 1)
    return got.select("ord", "way_id", "highway", first["lat"].alias("la0"), first["lon"].alias("lo0"))


@query(
    "read_edge_scan",
    "select gid % 50 as window_index, gid % 50 <> 7 as whole, graph_id, way_id, forward_access, road_class from v_edges_a",
)
def _(t):
    e = t("v_edges_a")
    edge = F.struct(F.col("graph_id").alias("graphId"), F.col("way_id").alias("wayId"), "lat", "lon", F.col("forward_access").alias("forwardAccess"), F.col("road_class").alias("roadClass"))
    docs = e.groupBy((F.col("gid") % 50).cast("int").alias("index")).agg(F.collect_list(edge).alias("edges"))
    docs = docs.withColumns({"complete": F.lit(True), "truncated": F.col("index") == 7, "returned": F.size("edges"), "visitedTiles": F.lit(1)})
    return R.parse_edge_scan(docs.select(F.to_json(F.struct("*")).alias("line"))).select("window_index", "whole", "graph_id", "way_id", "forward_access", "road_class")


@query("read_adjacency", "select source_id, option_id, option_access, is_road from v_out_a")
def _(t):
    out = F.transform("outgoing", lambda o: F.struct(o["graph_id"].alias("graphId"), o["end_node"].alias("endNodeGraphId"), o["forward_access"].alias("forwardAccess"), o["is_road"].alias("isRoad"), o["is_shortcut"].alias("isShortcut")))
    doc = F.struct(F.col("source_id").alias("sourceGraphId"), F.col("end_node").alias("endNodeGraphId"), "deadend", F.col("way_id").alias("wayId"), out.alias("outgoingDirectedEdges"))
    got = R.parse_adjacency(adjacency(t).select(F.to_json(doc).alias("line")))
    return got.select("source_id", F.explode("outgoing").alias("o")).select("source_id", F.col("o.graph_id").alias("option_id"), F.col("o.forward_access").alias("option_access"), "o.is_road")


@query(
    "read_polygons",
    """with o as (select o_orderkey as k, 10.0e0 + o_custkey * 0.5e0 as x, 40.0e0 + (o_orderkey % 40) * 0.25e0 as y from orders)
    select concat('f', k) as region_id, r as ring_no, r = 1 as is_hole, s as seq, x + case when s in (1, 2) then 0.25e0 else 0.0e0 end as ax, y + case when s >= 2 then 0.25e0 else 0.0e0 end as ay,
      x + case when s in (0, 1) then 0.25e0 else 0.0e0 end as ex, y + case when s in (1, 2) then 0.25e0 else 0.0e0 end as ey
    from o, (select unnest([0, 1]) as r) a, (select unnest([0, 1, 2, 3]) as s) b where r = 0 or k % 3 = 0""",
)
def _(t):
    k = F.col("o_orderkey")
    x, y = 10.0 + F.col("o_custkey") * 0.5, 40.0 + (k % 40) * 0.25
    dot = lambda a, b: F.concat(F.lit("   "), (x + a).cast("string"), F.lit("  "), (y + b).cast("string"))
    ring = [dot(0.0, 0.0), dot(0.25, 0.0), dot(0.25, 0.25), dot(0.0, 0.25)]
    closed = F.array(F.lit("1"), *ring, ring[0], F.lit("END"))
    hole = F.array(F.lit("!2"), *ring, F.lit("END"))
    tiny = F.array(F.lit("3"), ring[0], ring[1], F.lit("END"))
    text = F.concat(F.array(F.lit("name")), closed, F.when(k % 3 == 0, hole).otherwise(tiny), F.array(F.lit("END")))
    lines = t("orders").select(F.concat(F.lit("f"), k.cast("string")).alias("file"), F.posexplode(text).alias("ord", "line"))
    return R.parse_polygons(lines)


@query("read_region_index", "select id, parent, upper(iso) as iso, url, length(id) % 2 = 0 as empty_geometry from v_regions")
def _(t):
    r = t("v_regions")
    props = F.struct("id", "parent", F.col("id").alias("name"), F.struct(F.col("url").alias("pbf")).alias("urls"), F.when(F.col("iso").isNotNull(), F.array(F.upper("iso"))).alias("iso3166-1:alpha2"))
    geom = F.when(F.char_length("id") % 2 == 0, F.array(F.array(F.array().cast("array<double>")))).otherwise(F.array(F.array(F.array(F.lit(1.5), F.lit(2.5)))))
    f = F.struct(props.alias("properties"), F.struct(F.lit("MultiPolygon").alias("type"), geom.alias("coordinates")).alias("geometry"))
    docs = r.select(F.to_json(F.struct(F.array(f).alias("features"))).alias("line"))
    return R.parse_region_index(docs).select("id", "parent", "iso", "url", "empty_geometry")


@query(
    "artifact_inventory",
    """with d as (select o_orderkey as k, concat('{"schema":"', case when o_orderkey % 4 = 0 then 'other' else 'known' end, '","version":', o_orderkey % 3, ',"roads":[', case o_orderkey % 3 when 0 then '' when 1 then '1' else '1,2' end, ']',
        case when o_orderkey % 5 = 0 then '' else '}' end) as x from orders)
    select concat('p', k) as path, case when k % 5 = 0 then 'INVALID' when k % 4 = 0 then 'OTHER' else 'MATCH' end as state, case when k % 5 <> 0 then k % 3 end as version, length(x) as bytes, length(x) > 40 as oversize, sha256(x) as sha256, case when k % 5 <> 0 then k % 3 end as roads from d""",
)
def _(t):
    k = F.col("o_orderkey")
    body = F.concat(
        F.lit('{"schema":"'), F.when(k % 4 == 0, "other").otherwise("known"), F.lit('","version":'), (k % 3).cast("string"), F.lit(',"roads":['),
        F.when(k % 3 == 0, "").when(k % 3 == 1, "1").otherwise("1,2"), F.lit("]"), F.when(k % 5 == 0, "").otherwise("}"),
    )
    files = t("orders").select(F.concat(F.lit("p"), k.cast("string")).alias("path"), F.encode(body, "UTF-8").alias("content"))
    out = R.inventory_documents(files, ["known"], ["roads", "cells"], 40)
    return out.select("path", "state", "version", "bytes", "oversize", "sha256", F.try_element_at("array_lengths", F.lit("roads")).alias("roads"))


_WORDS = ["the", "ment", "http", "License"]


@query(
    "literal_mentions",
    " union all ".join(f"select '{w}' as literal, count(*) as files from documents where contains(text, '{w}') having count(*) > 0" for w in _WORDS)
    + " union all select '(checked)', count(*) from documents union all select '(matching)', count(*) from documents where "
    + " or ".join(f"contains(text, '{w}')" for w in _WORDS)
    + " having count(*) > 0",
)
def _(t):
    return R.literal_mentions(t("documents").select(F.col("doc_id").alias("path"), "text"), _WORDS)


@query(
    "tile_file_inventory",
    """with f as (select o_orderkey as k, o_orderkey % 4 as l, lpad(cast(o_orderkey as varchar), 9, '0') as d, cast(o_totalprice as varchar) as c from orders)
    select concat(l, '/', substr(d, 1, 3), '/', substr(d, 4, 3), '/', substr(d, 7, 3), '.gph') as path, l as level, k as tile_index, case when l = 3 then 'unsupported_path' end as problem,
      case when l < 3 then floor(k / case l when 0 then 90 when 1 then 360 else 1440 end) * case l when 0 then 4 when 1 then 1 else 0.25e0 end - 90 end as min_lat from f""",
)
def _(t):
    k = F.col("o_orderkey")
    d = F.lpad(k.cast("string"), 9, "0")
    path = F.concat(F.lit("/data/tiles/"), (k % 4).cast("string"), F.lit("/"), F.substring(d, 1, 3), F.lit("/"), F.substring(d, 4, 3), F.lit("/"), F.substring(d, 7, 3), F.lit(".gph"))
    files = t("orders").select(path.alias("path"), F.encode(F.col("o_totalprice").cast("string"), "UTF-8").alias("content"))
    return R.tile_files(files, "/data/tiles").select("path", "level", "tile_index", "problem", "min_lat")


@query("write_pack", "select place_id as id, cname as name, latitude, longitude from d_acc")
def _(t):
    pack = P.build_pack(feed(t), "AT")
    base = W.write_pack(pack, run_dir(t.spark, "pack"), "region", "v1", {"places": ["latitude", "longitude"]})
    return W.read_pack(t.spark, base, ["places"])["places"].select("id", "name", "latitude", "longitude")


_K = "way_id, round_even(lat*1000000e0, 0) as k1, round_even(lon*1000000e0, 0) as k2, round_even(inner_lat*1000000e0, 0) as k3, round_even(inner_lon*1000000e0, 0) as k4"


@query(
    "write_ledgers",
    f"""with a as (select graph_id, {_K} from v_edges_a), b as (select graph_id, {_K} from v_edges_b)
    select 'physical-peers' as ledger, count(*) as n from a join b using (way_id, k1, k2, k3, k4)
    union all select 'unpaired-from', count(*) from a where not exists (select 1 from b where b.way_id=a.way_id and b.k1=a.k1 and b.k2=a.k2 and b.k3=a.k3 and b.k4=a.k4)
    union all select 'unpaired-to', count(*) from b where not exists (select 1 from a where b.way_id=a.way_id and b.k1=a.k1 and b.k2=a.k2 and b.k3=a.k3 and b.k4=a.k4)""",
)
def _(t):
    a, b = t("v_edges_a"), t("v_edges_b")
    path = W.write_ledgers(G.physical_peers(a, b, *PAIR), G.unpaired_edges(a, b), run_dir(t.spark, "ledgers"))
    return W.ledger_counts(t.spark, path)
