"""Measures along one directed polyline, as columns over its vertex array.

A shape is ``array<struct<lat,lon>>`` of at most a few thousand vertices, so each
measure stays inside its row and no shuffle is needed.  Measures of the many samples
of a tail, and of the two places of an overlap, are worked out with numpy, a batch of
shapes at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession, functions as F, types as T

from ..session import ship
from .geo import EARTH_SEARCH_M, PLANAR_TERMINAL, haversine_m

# Sampling of a directed tail and local probes.
TAIL_METRES = 20.0
TAIL_STEP = 2.0
TAIL_MAX_STEPS = 32
PROBE_METRES = 20.0


def point(lat: Column, lon: Column) -> Column:
    return F.struct(lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pairs(shape: Column, make) -> Column:
    """``make(a, b)`` for each consecutive pair of vertices."""
    n = F.size(shape)
    return F.zip_with(F.slice(shape, F.lit(1), n - 1), F.slice(shape, F.lit(2), n - 1), make)


def lengths(shape: Column, radius: float = EARTH_SEARCH_M) -> Column:
    return pairs(shape, lambda a, b: haversine_m(a["lat"], a["lon"], b["lat"], b["lon"], radius))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def line_length(shape: Column) -> Column:
    return total(lengths(shape))


def planar_length(shape: Column, ref_lat: Column, scale: float) -> Column:
    k = F.cos(F.radians(ref_lat))
    return total(pairs(shape, lambda a, b: F.lit(scale) * F.hypot((b["lon"] - a["lon"]) * k, b["lat"] - a["lat"])))


def project_on_line(
    lat: Column, lon: Column, shape: Column, scale: float = PLANAR_TERMINAL, ref_lat: Column | None = None
) -> Column:
    """Nearest place on the shape: metres, segment, fraction, along, tx, ty.

    Degenerate segments are skipped; the first of equally near segments wins.
    """
    ref = lat if ref_lat is None else ref_lat
    kx, ky = F.lit(scale) * F.cos(F.radians(ref)), F.lit(scale)

    def raw(a: Column, b: Column) -> Column:
        return F.struct(
            ((b["lon"] - a["lon"]) * kx).alias("dx"),
            ((b["lat"] - a["lat"]) * ky).alias("dy"),
            ((lon - a["lon"]) * kx).alias("qx"),
            ((lat - a["lat"]) * ky).alias("qy"),
        )

    def fraction(s: Column) -> Column:
        len2 = s["dx"] * s["dx"] + s["dy"] * s["dy"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (s["qx"] * s["dx"] + s["qy"] * s["dy"]) / len2))
        return F.when(len2 >= 1e-10, F.struct(s["dx"].alias("dx"), s["dy"].alias("dy"), s["qx"].alias("qx"), s["qy"].alias("qy"), t.alias("t"), F.sqrt(len2).alias("len")))

    def gap(s: Column) -> Column:
        return F.when(
            s.isNotNull(),
            F.struct(
                F.hypot(s["qx"] - s["t"] * s["dx"], s["qy"] - s["t"] * s["dy"]).alias("m"),
                s["t"].alias("t"),
                s["len"].alias("len"),
                (s["dx"] / s["len"]).alias("tx"),
                (s["dy"] / s["len"]).alias("ty"),
            ),
        )

    measured = F.transform(F.transform(pairs(shape, raw), fraction), gap)
    none = F.lit(None).cast("double")
    start = F.struct(
        none.alias("metres"), F.lit(-1).alias("segment"), none.alias("fraction"), none.alias("along"), none.alias("tx"), none.alias("ty"),
        F.lit(0.0).alias("done"), F.lit(0).alias("i"),
    )

    def merge(acc: Column, s: Column) -> Column:
        better = s.isNotNull() & (acc["metres"].isNull() | (s["m"] < acc["metres"]))

        def pick(new: Column, old: Column, name: str) -> Column:
            return F.when(better, new).otherwise(old).alias(name)

        return F.struct(
            pick(s["m"], acc["metres"], "metres"),
            pick(acc["i"], acc["segment"], "segment"),
            pick(s["t"], acc["fraction"], "fraction"),
            pick(acc["done"] + s["t"] * s["len"], acc["along"], "along"),
            pick(s["tx"], acc["tx"], "tx"),
            pick(s["ty"], acc["ty"], "ty"),
            (acc["done"] + F.coalesce(s["len"], F.lit(0.0))).alias("done"),
            (acc["i"] + 1).alias("i"),
        )

    return F.when(lat.isNotNull() & lon.isNotNull(), F.aggregate(measured, start, merge))


def _mix(a: Column, b: Column, f: Column) -> Column:
    return point(a["lat"] + (b["lat"] - a["lat"]) * f, a["lon"] + (b["lon"] - a["lon"]) * f)


def _pieces(shape: Column) -> Column:
    """Segments with end points, length and the length before them."""
    seg = pairs(shape, lambda a, b: F.struct(a.alias("a"), b.alias("b"), haversine_m(a["lat"], a["lon"], b["lat"], b["lon"]).alias("len")))
    empty = F.array().cast("array<struct<a:struct<lat:double,lon:double>,b:struct<lat:double,lon:double>,len:double,before:double>>")
    start = F.struct(F.lit(0.0).alias("sum"), empty.alias("out"))

    def step(acc: Column, s: Column) -> Column:
        row = F.struct(s["a"].alias("a"), s["b"].alias("b"), s["len"].alias("len"), acc["sum"].alias("before"))
        return F.struct((acc["sum"] + s["len"]).alias("sum"), F.concat(acc["out"], F.array(row)).alias("out"))

    return F.aggregate(seg, start, step, lambda acc: acc["out"])


def _walk(pieces: Column, last: Column, metres: Column, tiny: float) -> Column:
    """Point at ``metres`` along the pieces; the last vertex when none holds it."""
    hit = F.get(F.filter(pieces, lambda p: (metres - p["before"] <= p["len"]) & (p["len"] > tiny)), F.lit(0))
    return let(hit, lambda h: F.when(h.isNull(), last).otherwise(_mix(h["a"], h["b"], (metres - h["before"]) / h["len"])))


def _measured(shape: Column) -> Column:
    return F.struct(_pieces(shape).alias("pieces"), line_length(shape).alias("whole"))


def _at(m: Column, shape: Column, metres: Column, tiny: float = 0.001) -> Column:
    return F.when((metres >= 0) & (metres <= m["whole"]), _walk(m["pieces"], F.element_at(shape, -1), metres, tiny))


def point_along(shape: Column, metres: Column) -> Column:
    """Point at a distance from the start; NULL outside the shape."""
    return let(_measured(shape), lambda m: _at(m, shape, metres))


def probe_point(shape: Column, incoming: bool) -> Column:
    """Local probe: 20 m or half the length from the near end; NULL under 2 m."""

    def place(m: Column) -> Column:
        offset = F.least(F.lit(PROBE_METRES), m["whole"] * 0.5)
        return F.when(m["whole"] >= 2.0, _at(m, shape, m["whole"] - offset if incoming else offset))

    return let(_measured(shape), place)


# Types are objects: workers import this module and have no session to parse text with.
_POINT = T.StructType([T.StructField(n, T.DoubleType()) for n in ("lat", "lon")])
_ORDER = T.StructType(
    [
        T.StructField(n, kind())
        for n, kind in (("samples", T.IntegerType), ("matched", T.IntegerType), ("max_gap_m", T.DoubleType), ("falls", T.BooleanType), ("rises", T.BooleanType))
    ]
)
_COVER = T.StructType(
    [
        T.StructField(n, kind)
        for n, kind in (("samples", T.IntegerType()), ("covered", T.IntegerType()), ("max_gap_m", T.DoubleType()), ("gaps", T.ArrayType(T.DoubleType())))
    ]
)
_PLACES = T.StructType([T.StructField(n, T.DoubleType()) for n in ("x_m", "x_along", "a_m", "a_along", "length")])


def _on_workers(udf, *args: Column) -> Column:
    session = SparkSession.getActiveSession()
    if session is not None:
        ship(session)
    return udf(*args)


class _Lines:
    """Vertices of a batch of shapes: where each begins, how many it has, which lack a coordinate."""

    def __init__(self, shape: pa.Array):
        lat, lon = (pc.struct_field(shape.values, c) for c in ("lat", "lon"))
        ends = shape.offsets.to_numpy(zero_copy_only=False).astype("int64")
        self.null = shape.is_null().to_numpy(zero_copy_only=False)
        self.first, self.n = ends[:-1], np.where(self.null, 0, np.diff(ends))
        self.bad = np.logical_or(*(c.is_null().to_numpy(zero_copy_only=False) for c in (lat, lon)))
        self.lat, self.lon = (c.to_numpy(zero_copy_only=False).astype("float64") for c in (lat, lon))


def _haversine(lat1, lon1, lat2, lon2):
    half_phi, half_lam = np.sin(np.radians(lat2 - lat1) / 2), np.sin(np.radians(lon2 - lon1) / 2)
    a = half_phi * half_phi + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * half_lam * half_lam
    return 2.0 * EARTH_SEARCH_M * np.arcsin(np.fmin(1.0, np.sqrt(a)))


def _samples(s: _Lines):
    """Samples of all shapes in a row: row, lat, lon; and their number per shape.

    Segments are met one after the other for the whole batch, so that memory follows
    the vertices and samples.  As in ``haversine_m``, a segment that lacks a coordinate is half
    the earth's girth long, so its samples lack that coordinate too.
    """
    if (~s.null & (s.n == 0)).any():
        raise ValueError("a shape needs a vertex")
    last = s.first + s.n - 1
    before = np.zeros(len(s.n))
    steps_of = []
    for j in range(max(int(s.n.max(initial=0)) - 1, 0)):
        rows = np.flatnonzero(s.n - 1 > j)
        a, b = last[rows] - j, last[rows] - j - 1
        length = _haversine(s.lat[a], s.lon[a], s.lat[b], s.lon[b])
        steps_of.append((rows, a, b, length, before[rows]))
        before[rows] += length
    tail = np.fmin(TAIL_METRES, before)
    steps = np.maximum(1, np.minimum(TAIL_MAX_STEPS, np.ceil(tail / TAIL_STEP).astype("int64")))
    count = np.where(s.null, 0, steps + 1)
    row = np.repeat(np.arange(len(count)), count)
    start = np.cumsum(count) - count
    metres = tail[row] * (np.arange(len(row)) - start[row]) / steps[row]
    lat, lon, open_ = s.lat[s.first[row]], s.lon[s.first[row]], np.ones(len(row), bool)
    place = np.full(len(count), -1)
    for rows, a, b, length, done in steps_of:
        place[:] = -1
        place[rows] = np.arange(len(rows))
        at = np.flatnonzero(open_ & (place[row] >= 0))
        if not len(at):
            continue
        k = place[row[at]]
        rest, size = metres[at] - done[k], length[k]
        hit = (rest <= size) & (size > 1e-7)
        at, k, f = at[hit], k[hit], rest[hit] / size[hit]
        lat[at] = s.lat[a[k]] + (s.lat[b[k]] - s.lat[a[k]]) * f
        lon[at] = s.lon[a[k]] + (s.lon[b[k]] - s.lon[a[k]]) * f
        open_[at] = False
    return row, lat, lon, np.isnan(lat) | np.isnan(lon), count


def _nearest(row, lat, lon, gone, line: _Lines, kx=None, ky=PLANAR_TERMINAL):
    """Metres to the nearest place of the line of its row and metres along it; NaN where ``none``.

    As :func:`project_on_line`: degenerate segments are skipped, the first of equally near ones wins.
    ``kx`` and ``ky`` are metres for a degree, at the sample's latitude if not given.
    """
    kx = PLANAR_TERMINAL * np.cos(np.radians(lat)) if kx is None else kx
    metres, along, done = (np.full(len(row), x) for x in (np.nan, np.nan, 0.0))
    none = np.ones(len(row), bool)
    segments = line.n[row] - 1
    for j in range(max(int(segments.max(initial=0)), 0)):
        at = np.flatnonzero((segments > j) & ~gone)
        a = line.first[row[at]] + j
        at, a = at[keep := ~(line.bad[a] | line.bad[a + 1])], a[keep]
        dx, dy = (line.lon[a + 1] - line.lon[a]) * kx[at], (line.lat[a + 1] - line.lat[a]) * ky
        keep = ~(dx * dx + dy * dy < 1e-10)
        at, a, dx, dy = at[keep], a[keep], dx[keep], dy[keep]
        qx, qy = (lon[at] - line.lon[a]) * kx[at], (lat[at] - line.lat[a]) * ky
        len2 = dx * dx + dy * dy
        t, size = np.maximum(0.0, np.fmin(1.0, (qx * dx + qy * dy) / len2)), np.sqrt(len2)
        m = np.hypot(qx - t * dx, qy - t * dy)
        better = none[at] | (m < metres[at]) | (np.isnan(metres[at]) & ~np.isnan(m))
        metres[at[better]], along[at[better]], none[at[better]] = m[better], (done[at] + t * size)[better], False
        done[at] += size
    return metres, along, none


@F.arrow_udf(T.ArrayType(_POINT))
def _tail_points(shape: pa.Array) -> pa.Array:
    s = _Lines(shape)
    _, lat, lon, _, count = _samples(s)
    lat, lon = (pa.array(x, mask=np.isnan(x)) for x in (lat, lon))
    points = pa.StructArray.from_arrays([lat, lon], ["lat", "lon"])
    ends = pa.array(np.concatenate([[0], np.cumsum(count)]).astype("int32"))
    return pa.ListArray.from_arrays(ends, points, mask=pa.array(s.null))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _tail_gaps(shape: pa.Array, line: pa.Array) -> pa.Array:
    s = _Lines(shape)
    row, lat, lon, gone, count = _samples(s)
    metres, _, none = _nearest(row, lat, lon, gone, _Lines(line))
    ends = pa.array(np.concatenate([[0], np.cumsum(count)]).astype("int32"))
    return pa.ListArray.from_arrays(ends, pa.array(metres, mask=none), mask=pa.array(s.null))


@F.arrow_udf(_COVER)
def _tail_cover(pairs: pa.Array, near: pa.Array, full: pa.Array) -> pa.Array:
    s = _Lines(pc.struct_field(pairs.values, "shape"))
    row, lat, lon, gone, count = _samples(s)
    metres, _, none = _nearest(row, lat, lon, gone, _Lines(pc.struct_field(pairs.values, "r_shape")))
    ends = pairs.offsets.to_numpy(zero_copy_only=False).astype("int64")
    group = np.repeat(np.arange(len(pairs)), np.diff(ends))
    if len(group):  # pairs of a slice begin at its first offset
        s_group = np.full(len(s.n), -1)
        s_group[ends[0] : ends[-1]] = group
        group = s_group
    i = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    gaps = np.full((len(pairs), TAIL_MAX_STEPS + 1), np.nan)
    known = np.zeros(gaps.shape, bool)
    use = ~none & (group[row] >= 0)
    np.fmin.at(gaps, (group[row][use], i[use]), metres[use])
    known[group[row][use], i[use]] = True
    samples = np.zeros(len(pairs), "int64")
    np.maximum.at(samples, group[group >= 0], count[group >= 0])
    most = np.where(known, gaps, -np.inf).max(axis=1, initial=-np.inf)
    open_ = np.diff(ends) >= full[0].as_py()
    parts = {
        "samples": pa.array(samples.astype("int32")),
        "covered": pa.array((known & (gaps <= near[0].as_py())).sum(axis=1).astype("int32")),
        "max_gap_m": pa.array(most, mask=~known.any(axis=1)),
        "gaps": pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(np.where(open_, TAIL_MAX_STEPS + 1, 0))]).astype("int32")),
            pa.array(gaps[open_].ravel(), mask=~known[open_].ravel()),
            mask=pa.array(~open_),
        ),
    }
    return pa.StructArray.from_arrays(list(parts.values()), list(parts))


@F.arrow_udf(_ORDER)
def _tail_order(shape: pa.Array, line: pa.Array, near: pa.Array, slack: pa.Array) -> pa.Array:
    s = _Lines(shape)
    row, lat, lon, gone, count = _samples(s)
    metres, along, none = _nearest(row, lat, lon, gone, _Lines(line))
    most, known = np.full(len(count), -np.inf), np.bincount(row[~none], minlength=len(count)) > 0
    np.maximum.at(most, row[~none], metres[~none])
    met = np.flatnonzero(~none & (metres <= near[0].as_py()))
    a, b, same = along[met][:-1], along[met][1:], row[met][:-1] == row[met][1:]
    by = slack[0].as_py()

    def every(holds):
        return np.bincount(row[met][:-1][same & ~holds], minlength=len(count)) == 0

    parts = {
        "samples": pa.array(count.astype("int32")),
        "matched": pa.array(np.bincount(row[met], minlength=len(count)).astype("int32")),
        "max_gap_m": pa.array(most, mask=~known),
        "falls": pa.array(every(a > b + by)),
        "rises": pa.array(every(a + by < b)),
    }
    return pa.StructArray.from_arrays(list(parts.values()), list(parts), mask=pa.array(s.null))


@F.arrow_udf(_PLACES)
def _two_places(x_lat: pa.Array, x_lon: pa.Array, a_lat: pa.Array, a_lon: pa.Array, k: pa.Array, scale: pa.Array, shape: pa.Array) -> pa.Array:
    s = _Lines(shape)
    if (~s.null & (s.n == 0)).any():
        raise ValueError("a shape needs a vertex")
    x_lat, x_lon, a_lat, a_lon, k = (
        (v.to_numpy(zero_copy_only=False).astype("float64"), v.is_null().to_numpy(zero_copy_only=False)) for v in (x_lat, x_lon, a_lat, a_lon, k)
    )
    by, row, found = scale[0].as_py(), np.arange(len(s.n)), []
    for lat, lon in ((x_lat, x_lon), (a_lat, a_lon)):
        metres, along, none = _nearest(row, lat[0], lon[0], lat[1] | lon[1] | k[1], s, by * k[0], by)
        found += [pa.array(metres, mask=none), pa.array(along, mask=none)]
    whole, unknown = np.zeros(len(s.n)), s.null.copy()
    for j in range(max(int(s.n.max(initial=0)) - 1, 0)):
        at = np.flatnonzero(s.n - 1 > j)
        a = s.first[at] + j
        unknown[at] |= s.bad[a] | s.bad[a + 1] | k[1][at]
        whole[at] += by * np.hypot((s.lon[a + 1] - s.lon[a]) * k[0][at], s.lat[a + 1] - s.lat[a])
    return pa.StructArray.from_arrays([*found, pa.array(whole, mask=unknown)], _PLACES.names)


def two_places(x: tuple[Column, Column], approach: tuple[Column, Column], shape: Column, scale: float) -> Column:
    """What :func:`project_on_line` says of two places (lat, lon), and the :func:`planar_length`, in the plane at x.

    x_m, x_along, a_m, a_along and length.
    """
    return _on_workers(_two_places, *x, *approach, F.cos(F.radians(x[0])), F.lit(scale), shape)


def tail_samples(shape: Column) -> Column:
    """Points about every 2 m back from the end over the last 20 m at most."""
    return _on_workers(_tail_points, shape)


def tail_gaps(shape: Column, line: Column) -> Column:
    """Metres from each point of ``tail_samples(shape)`` to its nearest place on the line."""
    return _on_workers(_tail_gaps, shape, line)


def tail_cover(pairs: Column, near: Column, full: Column) -> Column:
    """Of an array of (shape, r_shape): of each sample of the tails the least gap to any of the lines.

    samples, covered (within ``near``), max_gap_m, and all gaps where there are ``full`` pairs.
    """
    return _on_workers(_tail_cover, pairs, near, full)


def tail_order(shape: Column, line: Column, near: float, slack: float) -> Column:
    """Of the points of ``tail_samples(shape)``: how many, how many within ``near`` of the line, the largest gap.

    ``falls`` and ``rises`` tell whether the near ones, from the end backwards, meet the line ever
    farther back or ahead by more than ``slack``.
    """
    return _on_workers(_tail_order, shape, line, F.lit(near), F.lit(slack))


def terminal_heading(shape: Column, scale: float = PLANAR_TERMINAL) -> Column:
    """Unit vector (x, y) of the last part that is at least one centimetre long."""
    end = F.element_at(shape, -1)
    k = F.cos(F.radians(end["lat"]))
    steps = F.transform(
        F.reverse(F.slice(shape, F.lit(1), F.size(shape) - 1)),
        lambda p: F.struct(((end["lon"] - p["lon"]) * k * scale).alias("x"), ((end["lat"] - p["lat"]) * scale).alias("y")),
    )
    hit = F.get(F.filter(steps, lambda s: F.hypot(s["x"], s["y"]) >= 0.01), F.lit(0))
    size = F.hypot(hit["x"], hit["y"])
    return F.struct((hit["x"] / size).alias("x"), (hit["y"] / size).alias("y"))
