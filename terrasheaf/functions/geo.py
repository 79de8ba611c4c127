"""Distances, tile arithmetic and polyline measures as columns.

The earth model is a parameter of every function because the jobs use several.
A shape is ``array<struct<lat double, lon double>>``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Earth models of the individual jobs.
EARTH_SEARCH_M = 6_371_008.8
EARTH_VERIFY_M = 6_371_000.0
PLANAR_TOPOLOGY = 111_320.0
PLANAR_TERMINAL = 111_195.0

# Tile edge length in degrees per hierarchy level.
TILE_DEGREES = {0: 4.0, 1: 1.0, 2: 0.25}

# Access bits of the two travel modes.
AUTO_BIT = 1
MOTORCYCLE_BIT = 1024
MODES = {"auto": AUTO_BIT, "motorcycle": MOTORCYCLE_BIT}


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_SEARCH_M) -> Column:
    half_phi = F.sin(F.radians(lat2 - lat1) / 2)
    half_lam = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_phi * half_phi + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lam * half_lam
    return F.lit(2.0 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def planar_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, scale: float = PLANAR_TOPOLOGY) -> Column:
    dx = (lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2))
    dy = lat2 - lat1
    return F.lit(scale) * F.sqrt(dx * dx + dy * dy)


def tile_id(graph_id: Column) -> Column:
    """The low 25 bits of a packed id name its tile."""
    return graph_id.bitwiseAND(F.lit((1 << 25) - 1))


def _tile_size(level: Column) -> Column:
    size = F.lit(None).cast("double")
    for lvl, deg in TILE_DEGREES.items():
        size = F.when(level == lvl, F.lit(deg)).otherwise(size)
    return size


def tile_bounds(level: Column, index: Column) -> Column:
    """Struct of four bounds; NULL fields for a level that does not exist."""
    size = _tile_size(level)
    width = F.floor(F.lit(360.0) / size)
    row = F.floor(index / width)
    col = index - row * width
    lat = row * size - 90.0
    lon = col * size - 180.0
    return F.struct(
        lat.alias("min_lat"), (lat + size).alias("max_lat"), lon.alias("min_lon"), (lon + size).alias("max_lon")
    )


def mode_names(mask: Column) -> Column:
    """``auto`` and ``motorcycle`` for their bits; NULL when any other bit is set."""
    known = AUTO_BIT | MOTORCYCLE_BIT
    names = F.array_compact(
        F.array(*[F.when(mask.bitwiseAND(F.lit(bit)) != 0, F.lit(name)) for name, bit in MODES.items()])
    )
    return F.when((mask >= 0) & (mask.bitwiseAND(F.lit(~known)) == 0), names)


def bounds_struct(shape: Column) -> Column:
    """Bounds of one vertex array; NULL fields for an empty one."""
    lats = F.transform(shape, lambda p: p["lat"])
    lons = F.transform(shape, lambda p: p["lon"])
    return F.struct(
        F.array_min(lats).alias("min_lat"),
        F.array_max(lats).alias("max_lat"),
        F.array_min(lons).alias("min_lon"),
        F.array_max(lons).alias("max_lon"),
    )
