"""Spatial joins re-expressed as tile equi-joins plus an exact residual test.

Neither join ever compares every point with every cell or polygon: both
sides are keyed by a grid tile, Catalyst plans a hash join on the tile (plus
any other equality keys), and the exact geometric predicate runs only on the
pairs that share a tile.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covspark import session
from covspark.functions import geo


# Tile edges in degrees of the polygon joins: a polygon is keyed at the finest
# one that its box spans in a few tiles, a point at each of them.
LEVELS = (10.0, 1.0, 0.1)
_TILES_ACROSS = 4
# Tiles of a cell store: 36 by 18 over the globe.
COARSE_TILE_DEG = 10.0
# Most bytes of a join side that is broadcast, and of one partition of a side that is hashed.
BROADCAST_BYTES = 32 << 20
HASH_BYTES = 64 << 20
# Tiles that a disc usually spans: a tile is as wide as the disc.
TILES_PER_DISC = 4


# Levels of the Z-order key: tiles of 360 / 2**level degrees, of a cell and of what a disc asks for.
Z_LEVEL, Z_ASK_LEVEL = 14, 8
_Z_SHIFT = 2 * (Z_LEVEL - Z_ASK_LEVEL)


def z_place(lat, lon) -> dict:
    """Tile (_zx, _zy) of a cell's centre at the level of the Z-order key: made columns before the bits are interleaved, which
    names each sixteen times."""
    size = 360.0 / (1 << Z_LEVEL)
    return {"_zx": geo.tile_x(lon, size), "_zy": geo.tile_y(lat, size)}


def z_tiles(points: DataFrame, lat: str, lon: str, radius_m, cell_deg) -> DataFrame:
    """(z_tile): the distinct tiles, at the level asked for, that some disc may touch; at most 2**15."""
    p = disc_tiles(points, lat, lon, radius_m, cell_deg, 360.0 / (1 << Z_ASK_LEVEL))
    return p.select(geo.morton(F.col("tx"), F.col("ty")).alias("z_tile")).distinct()


def z_codes(tiles: DataFrame) -> list[int]:
    """The tiles' numbers in ascending order: the driver gets at most 2**15."""
    return sorted(r.z_tile for r in tiles.collect())


def z_ranges(tiles: DataFrame | list[int], most: int = 128) -> list[tuple[int, int]]:
    """``tiles`` (or their ``z_codes``) as closed ranges of Z-order keys, runs of neighbours joined and then the smallest
    gaps, to at most ``most`` ranges."""
    codes = tiles if isinstance(tiles, list) else z_codes(tiles)
    gaps = sorted((b - a for a, b in zip(codes, codes[1:])), reverse=True)
    joined = max(1, gaps[most - 1]) if len(gaps) >= most else 1
    out: list[list[int]] = []
    for c in codes:
        if out and c - out[-1][1] <= joined:
            out[-1][1] = c
        else:
            out.append([c, c])
    return [(a << _Z_SHIFT, ((b + 1) << _Z_SHIFT) - 1) for a, b in out]


def in_z_ranges(zkey, ranges: list[tuple[int, int]]):
    """Whether a key lies in one of ``z_ranges``: their ends are those of tiles, so one look into a table with a byte a tile
    tells it, however many ranges there are."""
    table = bytearray(1 << (2 * Z_ASK_LEVEL))
    for lo, hi in ranges:
        table[lo >> _Z_SHIFT:(hi >> _Z_SHIFT) + 1] = b"\x01" * ((hi >> _Z_SHIFT) - (lo >> _Z_SHIFT) + 1)
    return F.substring(F.lit(bytes(table)), F.shiftright(zkey, _Z_SHIFT).cast("int") + 1, F.lit(1)) == F.lit(b"\x01")


def coarse_tile_id(ty, tx):
    """One number for a coarse tile."""
    return ty * F.lit(geo.n_lon_tiles(geo.tile_size(COARSE_TILE_DEG))) + tx


def coarse_tile(lat, lon):
    """The coarse tile of a cell's centre."""
    t = geo.tile_size(COARSE_TILE_DEG)
    return coarse_tile_id(geo.tile_y(lat, t), geo.tile_x(lon, t))


def default_tile_deg(radius_m: float, cell_deg: float = 0.0) -> float:
    """A tile about as wide as the disc and never narrower than two cells: each
    point then needs a few tiles and each tile holds few cells beyond it."""
    span = math.degrees(radius_m / geo.EARTH_RADIUS_M)
    return geo.tile_size(max(2.0 * span, 2.0 * cell_deg, 0.01))


def cell_half_sizes(cells: DataFrame):
    """(half_h, half_w) columns of a cells table: ``half_h``/``half_w`` if
    present, else one square ``half_deg``."""
    cols = set(cells.columns)
    if {"half_h", "half_w"} <= cols:
        return F.col("half_h").cast("double"), F.col("half_w").cast("double")
    return F.col("half_deg").cast("double"), F.col("half_deg").cast("double")


def largest_cell_deg(cells: DataFrame) -> float:
    """Edge of the largest cell in degrees: one aggregate over the size columns."""
    half_h, half_w = cell_half_sizes(cells)
    got = cells.agg(F.max(F.greatest(half_h, half_w))).first()[0]
    return 2.0 * (got or 0.0)


def default_tile_col(radius_m, cell_deg):
    """``default_tile_deg`` of columns."""
    span = F.degrees(radius_m / F.lit(geo.EARTH_RADIUS_M))
    return geo.tile_size_col(F.greatest(2.0 * span, 2.0 * cell_deg, F.lit(0.01)))


def estimated_bytes(df: DataFrame) -> float:
    """What the planner takes ``df`` to hold, without a job; four times that, as files are compressed."""
    return 4.0 * float(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def sized(df: DataFrame, most_bytes: float) -> DataFrame:
    """The side of a join that an explode has made, hinted by the most bytes it can hold (the planner sizes it
    like its input, and would broadcast too much): broadcast, hashed where a partition's share fits in a task's
    memory (AQE splits a hot one), else sorted, which spills.  The other side is never sorted for a small one."""
    if most_bytes <= BROADCAST_BYTES:
        return F.broadcast(df)
    share = most_bytes / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash" if share <= HASH_BYTES else "merge")


def disc_tiles(points: DataFrame, lat: str, lon: str, radius_m, cell_deg, tile_deg) -> DataFrame:
    """``points`` (NULL coordinates dropped) once per tile (tx, ty) that may hold
    the centre of a cell touching the disc.  The sizes may be columns of ``points``."""
    nx = geo.n_lon_tiles_col(tile_deg)
    ty_lo, ty_hi, tx_lo, tx_hi = geo.disc_tile_ranges(F.col(lat), F.col(lon), radius_m, cell_deg / 2, tile_deg)
    return (points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
            .withColumn("ty", F.explode(F.sequence(ty_lo, ty_hi)))
            .withColumn("tx", F.explode(F.sequence(tx_lo, tx_hi)))
            .withColumn("tx", F.pmod(F.col("tx"), nx)))


def cell_tiles(cells: DataFrame, radius_m, tile_deg) -> DataFrame:
    """``cells`` (cy, cx, _hh, _hw) once per tile (tx, ty) that may hold a point whose disc touches the cell."""
    ty_lo, ty_hi, tx_lo, tx_hi = geo.disc_tile_ranges(F.col("cy"), F.col("cx"), radius_m, F.col("_hw"), tile_deg, F.col("_hh"))
    return (cells.withColumn("ty", F.explode(F.sequence(ty_lo, ty_hi))).withColumn("tx", F.explode(F.sequence(tx_lo, tx_hi)))
            .withColumn("tx", F.pmod(F.col("tx"), geo.n_lon_tiles_col(tile_deg))))


def cells_in_radius(points: DataFrame, cells: DataFrame, radius_m: float, *,
                    keys=("covariate_id", "item_date"), lat: str = "latitude",
                    lon: str = "longitude", tile_deg: float | None = None,
                    cell_deg: float = 0.0, repeat_points: bool = False) -> DataFrame:
    """Pairs (point, cell) where the cell touches the disc of ``radius_m``
    round the point; ``radius_m == 0`` means the one cell holding the point
    (half-open, so exactly one cell on a regular grid).

    ``points`` must hold ``lat``, ``lon`` and the equality ``keys``; the result
    has the point columns plus the cell columns (``band``, ``value``, ...)
    and ``cell_area_m2``.

    Tile join: of the two sides the one with fewer estimated bytes is repeated
    per tile, so each pair meets once.  A cell has one tile, its centre's, and a
    point every tile that may hold the centre of a cell touching its disc, i.e.
    the disc's bounding box (exact cap width, full circle at the poles, wrap at
    180 degrees) widened by the largest half cell; or a point has one tile, and
    a cell those of its own box widened by the disc.  ``cell_deg`` is the edge
    of the largest cell; if it isn't given, it is read from the cells' size
    columns.  ``repeat_points`` tells that the points are few without an estimate.  A tile is never smaller than a cell.  ``sized`` picks the join by
    the bytes of the repeated side; a small one is broadcast, which leaves the
    other unshuffled.
    """
    if radius_m < 0:
        raise ValueError("radius must be >= 0")
    cell_deg = float(cell_deg) or largest_cell_deg(cells)
    tile_deg = default_tile_deg(radius_m, cell_deg) if tile_deg is None else geo.tile_size(max(tile_deg, cell_deg))
    keys = list(keys)

    half_h, half_w = cell_half_sizes(cells)
    c = cells.withColumn("_hh", half_h).withColumn("_hw", half_w)
    p = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    few, many = estimated_bytes(points), estimated_bytes(cells)
    if repeat_points or few <= many:
        p = sized(disc_tiles(p, lat, lon, radius_m, cell_deg, tile_deg), TILES_PER_DISC * few)
        c = c.withColumn("tx", geo.tile_x(F.col("cx"), tile_deg)).withColumn("ty", geo.tile_y(F.col("cy"), tile_deg))
    else:
        c = sized(cell_tiles(c, radius_m, tile_deg), TILES_PER_DISC * many)
        p = p.withColumn("tx", geo.tile_x(F.col(lon), tile_deg)).withColumn("ty", geo.tile_y(F.col(lat), tile_deg))
    cell = (F.col(lat), F.col(lon), F.col("cy"), F.col("cx"), F.col("_hh"), F.col("_hw"))
    if radius_m == 0:
        hit = geo.cell_contains(*cell)
    else:
        # a cell of other latitudes is out of reach: told without the distance, which costs much more and has the last word
        away = F.abs(F.col(lat) - F.col("cy")) > F.col("_hh") + F.lit(math.degrees(radius_m / geo.EARTH_RADIUS_M) + 1e-6)
        hit = ~F.coalesce(away, F.lit(False)) & (geo.cell_distance_m(*cell) <= F.lit(float(radius_m)))
    out = c.join(p, on=[*keys, "tx", "ty"], how="inner").where(hit)
    out = out.withColumn("cell_area_m2", geo.cell_area_m2(F.col("cy"), F.col("_hh"), F.col("_hw")))
    rest = [x for x in cells.columns if x not in points.columns]
    return out.select(*[F.col(x) for x in points.columns], *rest, "cell_area_m2")


def deal_regions(places: DataFrame, cells: DataFrame, radius_m: float, cell_deg: float, era, eras, lat: str = "latitude",
                 lon: str = "longitude") -> tuple[DataFrame, DataFrame, list[str]]:
    """``places`` and ``cells`` dealt by regions (tiles twice as wide as a disc) and eras, and the columns by which: what is near
    a place in an era lies in one partition with it.  A place has one region, a cell each that may hold a place whose disc
    touches it; ``era`` is a column of places, ``eras`` an array of the cells' eras.  What discs and windows make of them is
    grouped and joined where it lies; only cells of regions and eras with a place are shuffled."""
    tile = geo.tile_size(2.0 * default_tile_deg(radius_m, cell_deg))
    by = ["_era", "_ry", "_rx"]
    p = places.withColumns({"_era": era, "_ry": geo.tile_y(F.col(lat), tile), "_rx": geo.tile_x(F.col(lon), tile)})
    half_h, half_w = cell_half_sizes(cells)
    c = cell_tiles(cells.withColumns({"_hh": half_h, "_hw": half_w}), radius_m, tile)
    c = c.drop("_hh", "_hw").withColumnsRenamed({"ty": "_ry", "tx": "_rx"}).withColumn("_era", F.explode(eras))
    c = c.join(F.broadcast(p.select(*by).distinct()), by, "left_semi")  # regions of the globe x eras at most
    n = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = lambda df: df.withColumn("_at", F.xxhash64(*by)).repartition(n, "_at")
    session.join_where_dealt(places.sparkSession)
    return deal(p), deal(c), ["_at", *by]


def _levels(tile_deg: float | None) -> list[float]:
    return [geo.tile_size(t) for t in (LEVELS if tile_deg is None else (tile_deg,))]


def _polygon_tiles(poly: DataFrame, box: str, levels: list[float]) -> DataFrame:
    """(_pid, box, level, tx, ty): the tiles of each polygon's box at the level
    that suits its extent, so neither a tiny nor an ocean-sized polygon makes
    many rows or crowded tiles."""
    b = lambda c: F.col(f"{box}.{c}")
    extent = F.greatest(b("xmax") - b("xmin"), b("ymax") - b("ymin"))
    level = F.lit(0)
    for k, t in enumerate(levels[1:], 1):
        level = F.when(extent <= _TILES_ACROSS * t, F.lit(k)).otherwise(level)
    names = ("ty_lo", "ty_hi", "tx_lo", "tx_hi", "nx")
    ranges = None
    for k, t in enumerate(levels):
        one = F.struct(*[c.alias(n) for c, n in zip(
            (*geo.bbox_tile_ranges(b("xmin"), b("ymin"), b("xmax"), b("ymax"), t), F.lit(geo.n_lon_tiles(t))), names)])
        ranges = F.when(F.col("level") == k, one) if ranges is None else ranges.when(F.col("level") == k, one)
    return (poly.select("_pid", box).withColumn("level", level).withColumn("_r", ranges)
            .withColumn("ty", F.explode(F.sequence("_r.ty_lo", "_r.ty_hi")))
            .withColumn("tx", F.explode(F.sequence("_r.tx_lo", "_r.tx_hi")))
            .withColumn("tx", F.pmod(F.col("tx"), F.col("_r.nx"))).drop("_r").distinct())


def _point_tiles(points: DataFrame, lat: str, lon: str, levels: list[float]) -> DataFrame:
    """``points`` (NULL coordinates dropped) once per level, with its tile."""
    tiles = [F.struct(F.lit(k).alias("level"), geo.tile_x(F.col(lon), t).alias("tx"), geo.tile_y(F.col(lat), t).alias("ty"))
             for k, t in enumerate(levels)]
    return (points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
            .withColumn("_t", F.explode(F.array(*tiles))).select("*", "_t.*").drop("_t"))


def _with_ids(polygons: DataFrame, rings: str) -> DataFrame:
    """Polygons with ``_pid`` (equal rows share one) and their box ``_bb``."""
    return (polygons.withColumn("_pid", F.xxhash64(F.struct(*[F.col(c) for c in polygons.columns])))
            .withColumn("_bb", geo.rings_bbox(F.col(rings))))


def point_in_polygon(points: DataFrame, polygons: DataFrame, *, lat: str = "latitude",
                     lon: str = "longitude", rings: str = "rings",
                     tile_deg: float | None = None) -> DataFrame:
    """Pairs (point, polygon) where the polygon intersects the point
    (interior or boundary; holes excluded by even-odd parity).

    Two joins keep the rings out of the tile fan-out: (1) polygon tiles
    carrying only an id and the bounding box meet the points on their tile;
    (2) the surviving candidates fetch their polygon's rings by id and run
    the ray cast.  Both are sorted joins, which split hot keys and need no
    side in memory.  Planar in degrees, as a geometry engine on EPSG:4326 is.
    ``tile_deg`` replaces the tile levels by one tile size.
    """
    levels = _levels(tile_deg)
    poly = _with_ids(polygons, rings)
    # identical polygon rows share an id: distinct tiles keep one candidate per
    # id, and the join back on the id restores one row per polygon row
    tiles = _polygon_tiles(poly, "_bb", levels)
    x, y = F.col(lon), F.col(lat)
    in_box = ((x >= F.col("_bb.xmin")) & (x <= F.col("_bb.xmax"))
              & (y >= F.col("_bb.ymin")) & (y <= F.col("_bb.ymax")))
    cand = (_point_tiles(points, lat, lon, levels).join(tiles.hint("merge"), on=["level", "tx", "ty"], how="inner")
            .where(in_box).drop("level", "tx", "ty", "_bb"))
    joined = cand.join(poly.drop("_bb").hint("merge"), on="_pid", how="inner")
    return joined.where(geo.point_in_rings(F.col(rings), x, y)).drop("_pid")


def polygons_in_radius(points: DataFrame, polygons: DataFrame, radius_m: float, *,
                       lat: str = "latitude", lon: str = "longitude", rings: str = "rings",
                       tile_deg: float | None = None) -> DataFrame:
    """Pairs (point, polygon) where the polygon touches the disc of
    ``radius_m`` round the point (holds it, or an edge is within reach).

    Polygon bounding boxes are widened by the disc's span in degrees (the
    longitude widening taken at the box's most poleward latitude, the whole
    circle when that reaches a pole) and keyed by tile; each point has one
    tile a level, so each pair appears once.  A box that reaches across 180
    degrees is tested with the point's longitude moved by a full circle, and
    the distance is taken from there.  Rings join back by id after the
    bounding-box filter, as in ``point_in_polygon``.
    """
    levels = _levels(tile_deg)
    r_deg = math.degrees(radius_m / geo.EARTH_RADIUS_M) + 1e-9
    poly = _with_ids(polygons, rings)
    far = F.greatest(F.abs(F.col("_bb.ymin")), F.abs(F.col("_bb.ymax"))) + F.lit(r_deg)
    wlon = F.when(far >= 90.0, F.lit(360.0)).otherwise(
        F.least(F.lit(360.0), F.lit(r_deg) / F.cos(F.radians(far))))
    wide = F.struct((F.col("_bb.xmin") - wlon).alias("xmin"), (F.col("_bb.ymin") - r_deg).alias("ymin"),
                    (F.col("_bb.xmax") + wlon).alias("xmax"), (F.col("_bb.ymax") + r_deg).alias("ymax"))
    poly = poly.withColumn("_wb", wide)
    tiles = _polygon_tiles(poly, "_wb", levels)
    x, y = F.col(lon), F.col(lat)
    inside = lambda v: (v >= F.col("_wb.xmin")) & (v <= F.col("_wb.xmax"))
    turns = F.filter(F.array(x, x + 360.0, x - 360.0), inside)
    cand = (_point_tiles(points, lat, lon, levels).join(tiles.hint("merge"), on=["level", "tx", "ty"], how="inner")
            .where((y >= F.col("_wb.ymin")) & (y <= F.col("_wb.ymax")))
            .withColumn("_turns", turns).where(F.size("_turns") > 0).drop("level", "tx", "ty", "_wb"))
    joined = cand.join(poly.drop("_bb", "_wb").hint("merge"), on="_pid", how="inner")
    near = F.exists("_turns", lambda v: geo.rings_within_m(F.col(rings), v, y, radius_m))
    return joined.where(near).drop("_pid", "_turns")
