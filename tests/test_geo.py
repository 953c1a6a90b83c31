import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from covspark.functions import geo
from covspark.operators.spatial import cells_in_radius, point_in_polygon

D = dt.date(2020, 1, 1)


def _cells(spark, rows, half=0.5):
    return spark.createDataFrame(
        [("c", D, 1, float(cy), float(cx), half, float(v) if v is not None else None)
         for cy, cx, v in rows],
        "covariate_id string, item_date date, band int, cy double, cx double, half_deg double, value double")


def _pts(spark, rows):
    return spark.createDataFrame([("c", D, float(a), float(b)) for a, b in rows],
                                 "covariate_id string, item_date date, latitude double, longitude double")


def test_haversine_one_degree(spark):
    d = spark.range(1).select(geo.haversine_m(0.0, 0.0, 1.0, 0.0).alias("d")).first()["d"]
    assert d == pytest.approx(math.pi * geo.EARTH_RADIUS_M / 180, rel=1e-9)


def test_half_open_containment(spark):
    cells = _cells(spark, [(0.5, 0.5, 1), (1.5, 0.5, 2)])
    hits = cells_in_radius(_pts(spark, [(1.0, 0.5)]), cells, 0.0)
    assert [r["value"] for r in hits.collect()] == [2.0]


def test_small_radius_sees_containing_cell(spark):
    cells = _cells(spark, [(10.5, 20.5, 7), (11.5, 20.5, 8)])
    hits = cells_in_radius(_pts(spark, [(10.2, 20.3)]), cells, 10.0)
    assert [r["value"] for r in hits.collect()] == [7.0]


def test_disc_over_antimeridian(spark):
    cells = _cells(spark, [(0.5, 179.5, 1), (0.5, -179.5, 2), (0.5, 170.5, 3)])
    hits = cells_in_radius(_pts(spark, [(0.5, 179.9)]), cells, 100000.0)
    assert sorted(r["value"] for r in hits.collect()) == [1.0, 2.0]


def _xyz(lat, lon):
    lat, lon = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=-1)


def _boundary_distance(la, lo, cells, half=0.5, n=801):
    """Distance from a point to each cell: 0 inside, else the least over densely
    sampled edges, measured as chords in space."""
    t = np.linspace(-half, half, n)
    at = _xyz(la, lo)
    out = []
    for cy, cx, _ in cells:
        lo_, hi_ = max(cy - half, -90.0), min(cy + half, 90.0)
        if lo_ <= la <= hi_ and abs(((lo - cx + 180) % 360) - 180) <= half:
            out.append(0.0)
            continue
        lat = np.clip(np.concatenate([cy + t, cy + t, np.full(n, lo_), np.full(n, hi_)]), -90, 90)
        lon = np.concatenate([np.full(n, cx - half), np.full(n, cx + half), cx + t, cx + t])
        chord = np.sqrt(((_xyz(lat, lon) - at) ** 2).sum(axis=1)).min()
        out.append(2 * geo.EARTH_RADIUS_M * math.asin(min(1.0, chord / 2)))
    return out


def _brute(points, cells, radius):
    """Pairs within the radius; none of the fixtures' pairs is within a metre of it."""
    out = set()
    for la, lo in points:
        for (_, _, v), d in zip(cells, _boundary_distance(la, lo, cells)):
            if d <= radius:
                out.add((la, lo, v))
    return out


@pytest.mark.parametrize("lat,lon,cy,cx", [(89.9, 10.0, 89.5, -169.5), (-89.95, 0.0, -89.5, 179.5), (85.0, 0.0, 85.5, 40.5),
                                           (70.0, 0.0, 60.5, 120.5), (1.0, 179.0, -89.5, 0.5), (0.2, 0.2, 0.5, 0.5)])
def test_cell_distance_against_sampled_edges(spark, lat, lon, cy, cx):
    d = spark.range(1).select(geo.cell_distance_m(lat, lon, cy, cx, 0.5, 0.5).alias("d")).first()["d"]
    assert d == pytest.approx(_boundary_distance(lat, lon, [(cy, cx, 0)])[0], abs=2.0)


def test_cell_over_the_pole_is_seen(spark):
    cells = _cells(spark, [(89.5, -169.5, 1), (89.5, 10.5, 2), (80.5, 10.5, 3)])
    hits = cells_in_radius(_pts(spark, [(89.9, 10.0)]), cells, 12000.0)
    assert sorted(r["value"] for r in hits.collect()) == [1.0, 2.0]


def test_polygon_across_180_degrees(spark):
    from covspark.operators.spatial import polygons_in_radius
    ring = [[{"x": x, "y": y} for x, y in ((-179.9, -1.0), (-178.0, -1.0), (-178.0, 1.0), (-179.9, 1.0), (-179.9, -1.0))]]
    poly = spark.createDataFrame([(1, ring)], "pid int, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(0.0, 179.99)], "latitude double, longitude double")
    assert polygons_in_radius(pts, poly, 13000.0).count() == 1
    assert polygons_in_radius(pts, poly, 12000.0).count() == 0


def test_polygon_levels_from_tiny_to_ocean(spark):
    """Polygons of every size meet their points once, on whatever level."""
    rnd = random.Random(5)
    rows, boxes = [], []
    for k in range(60):
        w = 10 ** rnd.uniform(-3, 2)
        x, y = rnd.uniform(-170, 170 - min(w, 300)), rnd.uniform(-80, 80)
        x1, y1 = min(x + w, 179.0), min(y + w, 89.0)
        boxes.append((x, y, x1, y1))
        rows.append((k, [[{"x": a, "y": b} for a, b in ((x, y), (x1, y), (x1, y1), (x, y1), (x, y))]]))
    poly = spark.createDataFrame(rows, "pid int, rings array<array<struct<x:double,y:double>>>")
    pts = [((b[1] + b[3]) / 2, (b[0] + b[2]) / 2) for b in boxes]
    got = sorted((r["pid"], r["latitude"], r["longitude"]) for r in point_in_polygon(
        spark.createDataFrame(pts, "latitude double, longitude double"), poly).collect())
    want = sorted((k, la, lo) for k, b in enumerate(boxes) for la, lo in pts if b[0] <= lo <= b[2] and b[1] <= la <= b[3])
    assert got == want


@pytest.mark.parametrize("radius,seed", [(50000.0, 1), (300000.0, 2), (1500000.0, 3)])
def test_tile_join_equals_brute_force(spark, radius, seed):
    rnd = random.Random(seed)
    cells = [(rnd.randrange(-90, 90) + 0.5, rnd.randrange(-180, 180) + 0.5, i) for i in range(400)]
    # include polar and antimeridian sites
    points = [(rnd.uniform(-89.9, 89.9), rnd.uniform(-180, 180)) for _ in range(60)]
    points += [(89.9, 10.0), (-89.95, -170.0), (45.0, 179.99), (-10.0, -179.99)]
    hits = cells_in_radius(_pts(spark, points), _cells(spark, cells), radius)
    got = {(r["latitude"], r["longitude"], r["value"]) for r in hits.collect()}
    assert got == _brute(points, cells, radius)


def test_tile_size_divides_circle():
    for t in (0.3, 1.0, 7.0, 11.0, 200.0):
        ts = geo.tile_size(t)
        assert ts <= max(t, 1e-4) or t > 180
        assert abs(360 / ts - round(360 / ts)) < 1e-9


SQUARE_WITH_HOLE = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)],
                    [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0), (4.0, 4.0)]]


@pytest.mark.parametrize("lon,lat,hit", [
    (5.0, 1.0, True),      # inside
    (5.0, 5.0, False),     # in the hole
    (10.0, 5.0, True),     # on an edge
    (0.0, 0.0, True),      # on a vertex
    (5.0, 0.0, True),      # on a horizontal edge
    (4.0, 5.0, True),      # on the hole's edge (boundary)
    (11.0, 5.0, False),    # outside
    (-3.0, 0.0, False),    # on the line of a horizontal edge, outside
])
def test_point_in_polygon_cases(spark, lon, lat, hit):
    poly = spark.createDataFrame(
        [(1, [[{"x": x, "y": y} for x, y in ring] for ring in SQUARE_WITH_HOLE])],
        "pid int, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(lat, lon)], "latitude double, longitude double")
    assert (point_in_polygon(pts, poly, tile_deg=3.0).count() == 1) is hit


def test_point_in_polygon_null_coordinates(spark):
    poly = spark.createDataFrame(
        [(1, [[{"x": x, "y": y} for x, y in SQUARE_WITH_HOLE[0]]])],
        "pid int, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(None, 5.0), (1.0, 1.0)], "latitude double, longitude double")
    assert point_in_polygon(pts, poly).count() == 1


@pytest.mark.parametrize("tile_deg,radius", [(0.3, 80000.0), (1.0, 0.0), (7.0, 20000.0)])
def test_tile_join_any_tile_size(spark, tile_deg, radius):
    """Cells larger or smaller than tiles: every pair exactly once."""
    rnd = random.Random(7)
    cells = [(rnd.randrange(-60, 60) + 0.5, rnd.randrange(-180, 180) + 0.5, i) for i in range(300)]
    points = [(cy + rnd.uniform(-0.9, 0.9), cx + rnd.uniform(-0.9, 0.9)) for cy, cx, _ in cells[:80]]
    hits = cells_in_radius(_pts(spark, points), _cells(spark, cells), radius, tile_deg=tile_deg)
    rows = [(r["latitude"], r["longitude"], r["value"]) for r in hits.collect()]
    assert len(rows) == len(set(rows))
    if radius > 0:
        assert set(rows) == _brute(points, cells, radius)
    else:  # half-open containment: each point in at most one 1-degree cell of this sparse grid
        for la, lo, v in rows:
            cy, cx, _ = cells[int(v)]
            assert cy - 0.5 <= la < cy + 0.5 and -0.5 <= ((lo - cx + 180) % 360) - 180 < 0.5


@pytest.mark.parametrize("lon,radius,hit", [(10.5, 60000.0, True), (10.5, 50000.0, False),
                                            (5.0, 0.0, True), (5.0, 1.0, False)])
def test_polygons_in_radius(spark, lon, radius, hit):
    """Distance to the nearest edge decides; a point in the hole is 100+ km from any edge."""
    from covspark.operators.spatial import polygons_in_radius
    poly = spark.createDataFrame(
        [(1, [[{"x": x, "y": y} for x, y in ring] for ring in SQUARE_WITH_HOLE])],
        "pid int, rings array<array<struct<x:double,y:double>>>")
    lat = 5.0 if lon != 5.0 else (1.0 if radius == 0.0 else 5.0)
    pts = spark.createDataFrame([(lat, lon)], "latitude double, longitude double")
    assert (polygons_in_radius(pts, poly, radius, tile_deg=3.0).count() == 1) is hit


def test_identical_polygon_rows_each_hit(spark):
    ring = [[{"x": x, "y": y} for x, y in SQUARE_WITH_HOLE[0]]]
    poly = spark.createDataFrame([(1, ring), (1, ring), (2, ring)],
                                 "pid int, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(1.0, 1.0)], "latitude double, longitude double")
    assert sorted(r["pid"] for r in point_in_polygon(pts, poly).collect()) == [1, 1, 2]
    from covspark.operators.spatial import polygons_in_radius
    assert polygons_in_radius(pts, poly, 10.0).count() == 3
