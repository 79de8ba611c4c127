"""Queries of the spatial joins and of tiles, windows and outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import geo, lines as L
from ..operators import spatial as X
from .registry import Tables, query
from .views import projection


def shape_of(*names: tuple[str, str]):
    return F.array(*[L.point(F.col(a), F.col(b)) for a, b in names])


def shapes(t: Tables, view: str) -> DataFrame:
    return t(view).withColumn("shape", shape_of(("la0", "lo0"), ("la1", "lo1"), ("la2", "lo2")))


@query(
    "window_edges",
    "select window_index, graph_id from v_edges_a join v_windows on lat between min_lat and max_lat and lon between min_lon and max_lon",
)
def _(t):
    return X.window_edges(t("v_edges_a").select("graph_id", "lat", "lon"), t("v_windows"), 0.002).select("window_index", "graph_id")


@query("nearby_incoming", "select source_id, receiver_id, round(distance_m, 3) as distance_m from d_near")
def _(t):
    from .graph import near

    return near(t).select("source_id", "receiver_id", F.round("distance_m", 3).alias("distance_m"))


@query("points_in_polygon", "select graph_id, region_id, true as strictly from d_in where inside")
def _(t):
    points = t("v_edges_a").select("graph_id", "end_lat", "end_lon")
    return X.points_in_polygon(points, t("v_poly"), lat="end_lat", lon="end_lon").select("graph_id", "region_id", "strictly")


_MEET = """with s as (select graph_id, lo0 as ax, la0 as ay, lo1 as ex, la1 as ey from v_shape_a union all select graph_id, lo1, la1, lo2, la2 from v_shape_a),
  x as (select s.graph_id, p.region_id, s.ax, s.ay, s.ex, s.ey, p.ax as cx, p.ay as cy, p.ex as dx, p.ey as dy from s join v_poly p
    on least(s.ax, s.ex) <= greatest(p.ax, p.ex) and greatest(s.ax, s.ex) >= least(p.ax, p.ex) and least(s.ay, s.ey) <= greatest(p.ay, p.ey) and greatest(s.ay, s.ey) >= least(p.ay, p.ey))
select distinct graph_id, region_id from x
where sign((dx-cx)*(ay-cy)-(dy-cy)*(ax-cx)) <> sign((dx-cx)*(ey-cy)-(dy-cy)*(ex-cx)) and sign((ex-ax)*(cy-ay)-(ey-ay)*(cx-ax)) <> sign((ex-ax)*(dy-ay)-(ey-ay)*(dx-ax))"""


@query("cut_crossings", _MEET)
def _(t):
    return X.cut_crossings(shapes(t, "v_shape_a"), t("v_poly"))


_TILEHIT = """select distinct level, tile_index from v_tilebox t join v_poly p
  on least(ax, ex) <= max_lon and greatest(ax, ex) >= min_lon and least(ay, ey) <= max_lat and greatest(ay, ey) >= min_lat
  and ((ax between min_lon and max_lon and ay between min_lat and max_lat) or (
    least((ex-ax)*(min_lat-ay)-(ey-ay)*(min_lon-ax), (ex-ax)*(min_lat-ay)-(ey-ay)*(max_lon-ax), (ex-ax)*(max_lat-ay)-(ey-ay)*(max_lon-ax), (ex-ax)*(max_lat-ay)-(ey-ay)*(min_lon-ax)) <= 0 and
    greatest((ex-ax)*(min_lat-ay)-(ey-ay)*(min_lon-ax), (ex-ax)*(min_lat-ay)-(ey-ay)*(max_lon-ax), (ex-ax)*(max_lat-ay)-(ey-ay)*(max_lon-ax), (ex-ax)*(max_lat-ay)-(ey-ay)*(min_lon-ax)) >= 0))"""


@query("tile_boundary", _TILEHIT)
def _(t):
    return X.tile_boundary(X.tile_box(t("v_tiles")), t("v_poly")).select("level", "tile_index")


@query(
    "tile_ring",
    f"""with h as (select level, tile_index, case level when 2 then 1440 else 360 end as w from ({_TILEHIT}) a ),
      n as (select distinct level, (tile_index // w + dy) * w + tile_index % w + dx as tile_index from h, (select unnest([-1,0,1]) as dy) a, (select unnest([-1,0,1]) as dx) b
        where tile_index // w + dy >= 0 and tile_index % w + dx between 0 and w - 1)
    select v.level, v.tile_index from v_tiles v join n on n.level = v.level and n.tile_index = v.tile_index""",
)
def _(t):
    tiles = X.tile_box(t("v_tiles"))
    return X.tile_ring(X.tile_boundary(tiles, t("v_poly")), tiles).select("level", "tile_index")


@query("tile_bounds", "select level, tile_index, min_lat, max_lat, min_lon, max_lon from v_tilebox")
def _(t):
    return X.tile_box(t("v_tiles")).select("level", "tile_index", "min_lat", "max_lat", "min_lon", "max_lon")


_SQUARES = """select concat('o', cast(o_orderkey as varchar(20))) as region_id, 12.0e0 + (o_orderkey % 50) * 0.01e0 as x, 46.0e0 + cast(floor(o_orderkey / 50) as bigint) % 10 * 0.01e0 as y,
  0.013e0 + (o_custkey % 3) * 0.01e0 as side from orders"""

_SQUARE_CELLS = f"""select region_id, cy, cx from (select *, unnest(range(floor(y/0.01e0)::bigint - 1, floor((y+side)/0.01e0)::bigint + 2)) as cy from ({_SQUARES}) q) a,
  lateral (select unnest(range(floor(x/0.01e0)::bigint - 1, floor((x+side)/0.01e0)::bigint + 2)) as cx) b
  where (cy + 0.5e0)*0.01e0 > y and (cy + 0.5e0)*0.01e0 < y + side and (cx + 0.5e0)*0.01e0 > x and (cx + 0.5e0)*0.01e0 < x + side"""


def squares(t: Tables) -> DataFrame:
    """One square outline per order, as segments."""
    q = t.sql(_SQUARES)
    x0, y0, x1, y1 = F.col("x"), F.col("y"), F.col("x") + F.col("side"), F.col("y") + F.col("side")
    corner = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    sides = [
        F.struct(F.lit(i).alias("seq"), corner[i][0].alias("ax"), corner[i][1].alias("ay"), corner[(i + 1) % 4][0].alias("ex"), corner[(i + 1) % 4][1].alias("ey"))
        for i in range(4)
    ]
    return q.select("region_id", F.lit(0).alias("ring_no"), F.lit(False).alias("is_hole"), F.explode(F.array(*sides)).alias("s")).select(
        "region_id", "ring_no", "is_hole", "s.*"
    )


_POLY_CELLS = """select 'rb' as region_id, cy, cx from (select unnest(range(4604, 4611)) as cy) a, (select unnest(range(1189, 1232)) as cx) b
  where (cy + 0.5e0)*0.01e0 between 46.050007e0 and 46.0900112e0 and (cx + 0.5e0)*0.01e0 between 11.900053e0 and 12.300015e0
union all select 'ra', cy, cx from (select unnest(range(4600, 4609)) as cy) a, (select unnest(range(1198, 1242)) as cx) b
  where (cy + 0.5e0)*0.01e0 between 46.010007e0 and 46.070011e0 and (cx + 0.5e0)*0.01e0 between 12.000153e0 and 12.400013e0
  and not ((cy + 0.5e0)*0.01e0 between 46.030007e0 and 46.040011e0 and (cx + 0.5e0)*0.01e0 between 12.000093e0 and 12.200013e0)"""


@query("overlap_windows", f"select distinct cy*0.01e0 as min_lat, (cy+1)*0.01e0 as max_lat, cx*0.01e0 as min_lon, (cx+1)*0.01e0 as max_lon from ({_SQUARE_CELLS}) s where (cy, cx) in (select (cy, cx) from ({_POLY_CELLS}) p where region_id = 'rb')")
def _(t):
    cells = X.area_cells(t("v_poly"), 0.01).filter("region_id = 'rb'")
    return X.overlap_windows(X.area_cells(squares(t), 0.01), cells, 0.01)


@query(
    "endpoint_domain_tiles",
    f"""with c as ({_POLY_CELLS}), d as (select distinct cy, cx from c where region_id = 'rb' except select cy, cx from c where region_id = 'ra')
    select distinct level, tile_index, tile_index % 3 <> 0 as extra from v_tilebox t join d on (cy+0.5e0)*0.01e0 between min_lat and max_lat and (cx+0.5e0)*0.01e0 between min_lon and max_lon""",
)
def _(t):
    cells = X.area_cells(t("v_poly"), 0.01)
    tiles = X.tile_box(t("v_tiles"))
    return X.endpoint_domain_tiles(
        tiles, t("v_tiles").filter("tile_index % 3 = 0"), cells.filter("region_id = 'ra'"), cells.filter("region_id = 'rb'"), 0.01
    )


@query(
    "bbox_touch",
    """with f as (select graph_id as feature_id, least(lat, end_lat) as a, greatest(lat, end_lat) as b, least(lon, end_lon) as c, greatest(lon, end_lon) as d from v_edges_a)
    select feature_id from f where exists (select 1 from v_windows w where a <= max_lat and b >= min_lat and c <= max_lon and d >= min_lon)""",
)
def _(t):
    f = t("v_edges_a").select(
        F.col("graph_id").alias("feature_id"),
        F.least("lat", "end_lat").alias("min_lat"),
        F.greatest("lat", "end_lat").alias("max_lat"),
        F.least("lon", "end_lon").alias("min_lon"),
        F.greatest("lon", "end_lon").alias("max_lon"),
    )
    return X.bbox_touch(f, t("v_windows"), 0.005).select("feature_id")


@query("haversine_m", """select graph_id, round(2*6371000e0*asin(least(1.0e0, sqrt(pow(sin(radians(end_lat-lat)/2),2) + cos(radians(lat))*cos(radians(end_lat))*pow(sin(radians(end_lon-lon)/2),2)))), 3) as metres from v_edges_a""")
def _(t):
    d = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("end_lat"), F.col("end_lon"), geo.EARTH_VERIFY_M)
    return t("v_edges_a").select("graph_id", F.round(d, 3).alias("metres"))


@query("planar_m", "select graph_id, round(111195e0*sqrt(pow((end_lon-lon)*cos(radians((lat+end_lat)/2)),2) + pow(end_lat-lat,2)), 3) as metres from v_edges_a")
def _(t):
    d = geo.planar_m(F.col("lat"), F.col("lon"), F.col("end_lat"), F.col("end_lon"), geo.PLANAR_TERMINAL)
    return t("v_edges_a").select("graph_id", F.round(d, 3).alias("metres"))


@query(
    "bounds_of",
    "select graph_id, least(la0, la1, la2) as min_lat, greatest(la0, la1, la2) as max_lat, least(lo0, lo1, lo2) as min_lon, greatest(lo0, lo1, lo2) as max_lon from v_shape_a",
)
def _(t):
    return shapes(t, "v_shape_a").select("graph_id", geo.bounds_struct(F.col("shape")).alias("b")).select("graph_id", "b.*")


VIEWS_AB = "(select a_id, b_id, aa2 as pa, ao2 as po, ba0 as b0a, bo0 as b0o, ba1 as b1a, bo1 as b1o, ba2 as b2a, bo2 as b2o from v_ab) ab"


@query(
    "project_on_line",
    f"select a_id, b_id, round(x_m, 3) as metres, round(x_along, 3) as along, x_seg as segment from {projection(VIEWS_AB, 'a_id, b_id', 'pa', 'po', 'pa', '111320.0e0', 'x')} p",
)
def _(t):
    ab = t("v_ab").withColumn("shape", shape_of(("ba0", "bo0"), ("ba1", "bo1"), ("ba2", "bo2")))
    p = L.project_on_line(F.col("aa2"), F.col("ao2"), F.col("shape"), geo.PLANAR_TOPOLOGY)
    return ab.withColumn("p", p).select("a_id", "b_id", F.round("p.metres", 3).alias("metres"), F.round("p.along", 3).alias("along"), "p.segment")


_H = "2*6371008.8e0*asin(least(1.0e0, sqrt(pow(sin(radians({b}a-{a}a)/2),2) + cos(radians({a}a))*cos(radians({b}a))*pow(sin(radians({b}o-{a}o)/2),2))))"
_HL = "select graph_id, la0 as pa, lo0 as po, la1 as qa, lo1 as qo, la2 as ra, lo2 as ro from v_shape_a"
_LEN = f"select *, {_H.format(a='p', b='q')} as l1, {_H.format(a='q', b='r')} as l2 from ({_HL}) v"


@query(
    "tail_samples",
    f"""with s as ({_LEN}), n as (select *, least(20.0e0, l1+l2) as tail, greatest(1, least(32, ceil(least(20.0e0, l1+l2)/2.0e0)))::int as steps from s),
      e as (select *, unnest(range(0, steps + 1)) as i from n), w as (select *, tail*i/steps as back from e)
    select graph_id, i, round(case when back <= l2 and l2 > 1e-7 then ra + (qa-ra)*back/l2 when back - l2 <= l1 and l1 > 1e-7 then qa + (pa-qa)*(back-l2)/l1 else pa end, 6) as lat,
      round(case when back <= l2 and l2 > 1e-7 then ro + (qo-ro)*back/l2 when back - l2 <= l1 and l1 > 1e-7 then qo + (po-qo)*(back-l2)/l1 else po end, 6) as lon from w""",
)
def _(t):
    s = shapes(t, "v_shape_a").select("graph_id", F.posexplode(L.tail_samples(F.col("shape"))).alias("i", "p"))
    return s.select("graph_id", "i", F.round("p.lat", 6).alias("lat"), F.round("p.lon", 6).alias("lon"))


@query(
    "point_along",
    f"""with s as ({_LEN}), w as (select *, least(20.0e0, (l1+l2)*0.5e0) as m from s)
    select graph_id, round(case when l1+l2 < 2 then null when m <= l1 and l1 > 0.001 then pa + (qa-pa)*m/l1 else qa + (ra-qa)*(m-l1)/l2 end, 6) as lat,
      round(case when l1+l2 < 2 then null when m <= l1 and l1 > 0.001 then po + (qo-po)*m/l1 else qo + (ro-qo)*(m-l1)/l2 end, 6) as lon from w""",
)
def _(t):
    p = L.probe_point(F.col("shape"), incoming=False)
    return shapes(t, "v_shape_a").select("graph_id", p.alias("p")).select("graph_id", F.round("p.lat", 6).alias("lat"), F.round("p.lon", 6).alias("lon"))


@query(
    "terminal_heading",
    """with h as (select graph_id, (lo2-lo1)*cos(radians(la2))*111195e0 as x1, (la2-la1)*111195e0 as y1, (lo2-lo0)*cos(radians(la2))*111195e0 as x0, (la2-la0)*111195e0 as y0 from v_shape_a),
      c as (select graph_id, case when sqrt(x1*x1+y1*y1) >= 0.01 then x1 else x0 end as x, case when sqrt(x1*x1+y1*y1) >= 0.01 then y1 else y0 end as y from h)
    select graph_id, round(x/sqrt(x*x+y*y), 5) as x, round(y/sqrt(x*x+y*y), 5) as y from c""",
)
def _(t):
    h = shapes(t, "v_shape_a").select("graph_id", L.terminal_heading(F.col("shape")).alias("h"))
    return h.select("graph_id", F.round("h.x", 5).alias("x"), F.round("h.y", 5).alias("y"))


@query(
    "refused_ends",
    "select c_custkey as graph_id from customer where c_custkey % 7 = 0 or c_custkey % 11 = 0",
)
def _(t):
    ends = t.sql(
        """select c_custkey as graph_id, case when c_custkey % 7 = 0 then 81.5e0 else 46.0e0 end as end_lat,
        case when c_custkey % 11 = 0 then cast(null as double) else 12.0e0 end as end_lon from customer"""
    )
    return X.refused_ends(ends).select("graph_id")


@query("boundary_samples")
def _(t):
    out = X.boundary_samples(squares(t), 25_000.0)
    return out.select("region_id", "sample", "offset_m", "inside_point.lat", "inside_point.lon")


@query(
    "cut_geometry",
    f"""with m as ({_MEET}) select e.graph_id, concat('sha256:', sha256(concat_ws(';', concat_ws(',', la0, lo0), concat_ws(',', la1, lo1), concat_ws(',', la2, lo2)))) as shape_hash,
      3 as vertices, e.graph_id in (select graph_id from m where region_id = 'ra') as meets_cut from v_shape_a e where e.deadend""",
)
def _(t):
    from ..operators.match import cut_geometry

    out = cut_geometry(shapes(t, "v_shape_a").filter("deadend"), t("v_poly").filter("region_id = 'ra'"))
    return out.select("graph_id", "shape_hash", "vertices", "meets_cut")


@query(
    "nearest_outline",
    """with d as (select graph_id, lo2 as px, la2 as py, ax, ay, ex, ey, (ex-ax)*cos(radians(la2)) as dx, ey-ay as dy, (lo2-ax)*cos(radians(la2)) as qx, la2-ay as qy
        from v_shape_a cross join v_poly where region_id = 'ra' and deadend),
      u as (select *, greatest(0.0e0, least(1.0e0, (qx*dx+qy*dy)/(dx*dx+dy*dy))) as u from d)
    select graph_id, round(min(111320.0e0*sqrt(pow(qx-u*dx,2)+pow(qy-u*dy,2))), 1) as outline_m from u group by graph_id""",
)
def _(t):
    ends = t("v_shape_a").filter("deadend").select("graph_id", F.col("lo2").alias("ax"), F.col("la2").alias("ay"), F.col("lo2").alias("ex"), F.col("la2").alias("ey"))
    out = X.nearest_outline(ends, t("v_poly").filter("region_id = 'ra'"), "graph_id")
    return out.withColumn("outline_m", F.round("outline_m", 1))


@query("metres_outside")
def _(t):
    out = X.metres_outside(shapes(t, "v_shape_a"), t("v_poly").filter("region_id = 'ra'"), laid_by="gid")
    return out.withColumn("outside_m", F.round("outside_m", 2))
