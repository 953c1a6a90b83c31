"""Geometry as Spark Column expressions (no UDFs).

Coordinates are WGS84 degrees.  Distances and tile covers are plain
arithmetic and stay inside whole-stage codegen; only the ray cast walks ring
arrays with higher-order functions, and it runs on candidate pairs only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in metres (IUGG), used by every distance.
EARTH_RADIUS_M = 6371008.8
# Metres per degree of latitude on that sphere.
M_PER_DEG = math.pi * EARTH_RADIUS_M / 180.0
_EPS_DEG = 1e-9


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def wrap_lon_delta(d: Column) -> Column:
    """Longitude difference folded into [-180, 180)."""
    return F.pmod(d + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def cell_distance_m(lat, lon, cy, cx, half_h, half_w) -> Column:
    """Distance on the sphere from a point to the nearest point of a lat/lon
    cell; zero when the point lies in the closed cell.

    The nearest point lies on the point's own meridian if the cell spans it,
    else on the cell's nearer edge meridian.  On a meridian ``gap`` degrees
    away the distance is least at latitude atan2(sin p, cos p cos gap) and
    grows to both sides, so the cell's latitudes nearest to it on either way
    round decide: that latitude clamped to the cell, or one of its corners.
    """
    lat, lon, cy, cx, half_h, half_w = map(_c, (lat, lon, cy, cx, half_h, half_w))
    gap = F.greatest(F.abs(wrap_lon_delta(lon - cx)) - half_w, F.lit(0.0))
    lo, hi = F.greatest(cy - half_h, F.lit(-90.0)), F.least(cy + half_h, F.lit(90.0))
    p = F.radians(lat)
    # within the cell's longitudes the best latitude is the point's own, exactly
    best = F.when(gap == 0, lat).otherwise(F.degrees(F.atan2(F.sin(p), F.cos(p) * F.cos(F.radians(gap)))))
    at = lambda y: haversine_m(lat, F.lit(0.0), y, gap)
    return F.least(at(F.least(F.greatest(best, lo), hi)), at(lo), at(hi))


def cell_contains(lat, lon, cy, cx, half_h, half_w) -> Column:
    """Half-open containment, so a point on a shared edge is in one cell."""
    lat, lon, cy, cx, half_h, half_w = map(_c, (lat, lon, cy, cx, half_h, half_w))
    dlon = wrap_lon_delta(lon - cx)
    return ((lat >= cy - half_h) & (lat < cy + half_h)
            & (dlon >= -half_w) & (dlon < half_w))


def cell_area_m2(cy, half_h, half_w) -> Column:
    """Area of a lat/lon cell on the sphere, in square metres."""
    cy, half_h, half_w = map(_c, (cy, half_h, half_w))
    top = F.least(cy + half_h, F.lit(90.0))
    bottom = F.greatest(cy - half_h, F.lit(-90.0))
    return (F.lit(EARTH_RADIUS_M ** 2) * F.radians(2 * half_w)
            * (F.sin(F.radians(top)) - F.sin(F.radians(bottom))))


# ---------------------------------------------------------------- tiles

def tile_size(requested_deg: float) -> float:
    """Tile edge in degrees, rounded down so that 360 is a whole number of tiles."""
    requested_deg = min(max(float(requested_deg), 1e-4), 180.0)
    return 360.0 / math.ceil(360.0 / requested_deg)


def n_lon_tiles(tile_deg: float) -> int:
    return int(round(360.0 / tile_deg))


def n_lon_tiles_col(tile_deg) -> Column:
    return F.round(F.lit(360.0) / tile_deg).cast("int") if isinstance(tile_deg, Column) else F.lit(n_lon_tiles(tile_deg))


def tile_size_col(requested_deg: Column) -> Column:
    """``tile_size`` of a column."""
    deg = F.least(F.greatest(requested_deg, F.lit(1e-4)), F.lit(180.0))
    return F.lit(360.0) / F.ceil(F.lit(360.0) / deg)


def tile_x(lon, tile_deg) -> Column:
    """Longitude tile of a point (wraps, so -180 and 180 share a tile)."""
    return F.floor(F.pmod(_c(lon) + F.lit(180.0), F.lit(360.0)) / _c(tile_deg)).cast("int")


def tile_y(lat, tile_deg) -> Column:
    return F.floor((F.least(_c(lat), F.lit(90.0 - 1e-12)) + F.lit(90.0)) / _c(tile_deg)).cast("int")


def morton(tx: Column, ty: Column) -> Column:
    """Place of a tile on the Z-order curve: the bits of both indices (below 2**16) interleaved."""
    def spread(x: Column) -> Column:
        x = x.cast("long")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return x
    return spread(tx).bitwiseOR(F.shiftleft(spread(ty), 1))


def disc_tile_ranges(lat, lon, radius_m, pad_deg, tile_deg, pad_h=None):
    """Tile index ranges that may hold the centre of a cell touching the disc:
    (ty_lo, ty_hi, tx_lo, tx_hi) as int Columns, ``pad_deg`` being the largest
    cell half-size.  Longitude indices are unwrapped (take them modulo
    ``n_lon_tiles``); a cap reaching a pole, or wider than the circle, spans
    every longitude tile.

    Latitude span is radius / metres-per-degree; longitude span is the exact
    half-width of a spherical cap, asin(sin r / cos lat).  Plain arithmetic,
    so it stays in generated code (a higher-order function would not).  The
    radius, the padding and the tile size may be columns.

    With ``pad_h`` the other way round: (lat, lon) is a cell's centre, ``pad_h``
    and ``pad_deg`` its half height and half width, and the tiles are those of
    the points whose disc touches it; the cap is widest at the cell's poleward edge.
    """
    lat, lon = _c(lat), _c(lon)
    angle = radius_m / EARTH_RADIUS_M  # angular radius, radians
    by_row = isinstance(angle, Column)
    r_deg, r_sin = (F.degrees(angle), F.sin(angle)) if by_row else (F.lit(math.degrees(angle)), F.lit(math.sin(angle)))
    pad = _c(pad_deg) + F.lit(_EPS_DEG)
    high = pad if pad_h is None else _c(pad_h) + F.lit(_EPS_DEG)
    ty_lo = tile_y(F.greatest(lat - r_deg - high, F.lit(-90.0)), tile_deg)
    ty_hi = tile_y(F.least(lat + r_deg + high, F.lit(90.0)), tile_deg)
    if pad_h is not None:
        lat = F.least(F.abs(lat) + high, F.lit(90.0))

    nx = n_lon_tiles_col(tile_deg)
    reaches_pole = F.abs(lat) + r_deg >= F.lit(90.0 - 1e-9)
    cap = F.degrees(F.asin(F.least(F.lit(1.0), r_sin / F.cos(F.radians(lat)))))
    dlon = cap + pad
    full = reaches_pole | (dlon >= F.lit(180.0))
    lo = F.floor((lon - dlon + F.lit(180.0)) / _c(tile_deg)).cast("int")
    hi = F.floor((lon + dlon + F.lit(180.0)) / _c(tile_deg)).cast("int")
    tx_lo = F.when(full, F.lit(0)).otherwise(lo)
    tx_hi = F.when(full, nx - 1).otherwise(F.least(hi, lo + nx - 1))
    return ty_lo, ty_hi, tx_lo, tx_hi


def bbox_tile_ranges(xmin, ymin, xmax, ymax, tile_deg: float):
    """(ty_lo, ty_hi, tx_lo, tx_hi) of the tiles a planar bounding box covers;
    longitude indices unwrapped (take them modulo ``n_lon_tiles``)."""
    nx = n_lon_tiles(tile_deg)
    x_lo = F.floor((_c(xmin) + F.lit(180.0)) / F.lit(tile_deg)).cast("int")
    x_hi = F.least(F.floor((_c(xmax) + F.lit(180.0)) / F.lit(tile_deg)).cast("int"), x_lo + F.lit(nx - 1))
    return (tile_y(F.greatest(_c(ymin), F.lit(-90.0)), tile_deg),
            tile_y(F.least(_c(ymax), F.lit(90.0)), tile_deg), x_lo, x_hi)


# ------------------------------------------------------- point in polygon

def _segments(ring: Column, fn) -> Column:
    """Apply ``fn(p, q)`` to each edge (p, q) of a closed ring; ARRAY<result>."""
    n = F.size(ring)
    idx = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: fn(F.get(ring, i), F.get(ring, i + 1)))


def ring_crosses_odd(ring: Column, px: Column, py: Column) -> Column:
    """Even-odd ray cast (ray towards +x) for one closed ring."""
    def crosses(p, q):
        straddles = (p["y"] > py) != (q["y"] > py)
        # `straddles` implies q.y != p.y, and CASE only evaluates the division then
        x_at = F.when(straddles, (q["x"] - p["x"]) * (py - p["y"]) / (q["y"] - p["y"]) + p["x"])
        return F.coalesce(straddles & (px < x_at), F.lit(False))

    return F.aggregate(_segments(ring, crosses), F.lit(False), lambda acc, c: acc != c)


def ring_touches(ring: Column, px: Column, py: Column) -> Column:
    """True when the point lies on an edge or vertex of the ring."""
    def on_edge(p, q):
        cross = (q["x"] - p["x"]) * (py - p["y"]) - (q["y"] - p["y"]) * (px - p["x"])
        return ((cross == 0)
                & (px >= F.least(p["x"], q["x"])) & (px <= F.greatest(p["x"], q["x"]))
                & (py >= F.least(p["y"], q["y"])) & (py <= F.greatest(p["y"], q["y"])))

    return F.exists(_segments(ring, on_edge), lambda b: b)


def point_in_rings(rings: Column, px, py) -> Column:
    """Intersects test for a polygon given as rings (outer + holes).

    Parity over all rings makes holes fall out; the boundary counts as a hit.
    NULL coordinates give NULL (treated as no hit by a join condition).
    """
    px, py = _c(px), _c(py)
    inside = F.aggregate(rings, F.lit(False), lambda acc, ring: acc != ring_crosses_odd(ring, px, py))
    touches = F.exists(rings, lambda ring: ring_touches(ring, px, py))
    return inside | touches


def rings_bbox(rings: Column) -> Column:
    """STRUCT<xmin,ymin,xmax,ymax> of all ring vertices."""
    pts = F.flatten(rings)
    xs = F.transform(pts, lambda p: p["x"])
    ys = F.transform(pts, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def ring_distance_m(ring: Column, px: Column, py: Column) -> Column:
    """Shortest distance in metres from the point to the edges of a ring, in
    the point's local equirectangular plane (x scaled by cos(latitude)); the
    ring's coordinates are taken as planar degrees, as in ``point_in_rings``."""
    kx = F.lit(M_PER_DEG) * F.cos(F.radians(py))
    ky = F.lit(M_PER_DEG)

    def seg(p, q):
        ax, ay = (p["x"] - px) * kx, (p["y"] - py) * ky
        bx, by = (q["x"] - px) * kx, (q["y"] - py) * ky
        dx, dy = bx - ax, by - ay
        den = dx * dx + dy * dy
        t = F.when(den > 0, F.least(F.greatest(-(ax * dx + ay * dy) / den, F.lit(0.0)), F.lit(1.0))) \
            .otherwise(F.lit(0.0))
        return F.sqrt(F.pow(ax + t * dx, 2) + F.pow(ay + t * dy, 2))

    return F.array_min(_segments(ring, seg))


def rings_within_m(rings: Column, px, py, radius_m: float) -> Column:
    """The polygon touches the disc: it holds the point, or an edge comes
    within ``radius_m``."""
    px, py = _c(px), _c(py)
    near = F.exists(rings, lambda ring: ring_distance_m(ring, px, py) <= F.lit(float(radius_m)))
    return point_in_rings(rings, px, py) | near
