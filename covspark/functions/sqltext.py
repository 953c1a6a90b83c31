"""The geometry of ``covspark.functions.geo`` written as SQL text.

Used by the DuckDB oracle queries: the same definitions, evaluated by a
different engine with a brute-force join instead of tiles.
"""

from __future__ import annotations

from covspark.functions.geo import EARTH_RADIUS_M


def wrap(d: str) -> str:
    return f"((((({d}) + 180.0) % 360.0) + 360.0) % 360.0 - 180.0)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(2 * {EARTH_RADIUS_M} * asin(sqrt(least(1.0, "
            f"pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * "
            f"pow(sin(radians(({lon2}) - ({lon1})) / 2), 2)))))")


def _xyz(lat: str, lon: str) -> tuple[str, str, str]:
    return (f"(cos(radians({lat})) * cos(radians({lon})))", f"(cos(radians({lat})) * sin(radians({lon})))", f"sin(radians({lat}))")


def cell_distance(lat: str, lon: str, cy: str, cx: str, h: str) -> str:
    """Chord lengths in space: 0 in the cell, the parallels within its
    longitudes, else the least over both edge meridians, each at its corners and
    where the plane through the meridian is nearest (if that lies in the cell)."""
    top, bottom = f"least({cy} + {h}, 90.0)", f"greatest({cy} - {h}, -90.0)"
    x, y, z = _xyz(lat, lon)

    def chord(lat2: str, lon2: str) -> str:
        u, v, w = _xyz(lat2, lon2)
        return f"(pow({x} - {u}, 2) + pow({y} - {v}, 2) + pow({z} - {w}, 2))"

    parts = []
    for edge in (f"({cx} - {h})", f"({cx} + {h})"):
        along = f"({x} * cos(radians({edge})) + {y} * sin(radians({edge})))"
        foot = f"degrees(atan2({z}, {along}))"
        parts += [chord(top, edge), chord(bottom, edge), f"case when {foot} between {bottom} and {top} then {chord(foot, edge)} else 4.0 end"]
    within = f"abs({wrap(f'{lon} - {cx}')}) <= {h}"
    own = f"case when {lat} between {bottom} and {top} then 0.0 else least({chord(top, lon)}, {chord(bottom, lon)}) end"
    least = f"least({', '.join(parts)})"
    return f"(2 * {EARTH_RADIUS_M} * asin(least(1.0, sqrt(case when {within} then least({own}, {least}) else {least} end) / 2)))"


def cell_area(cy: str, h: str) -> str:
    return (f"({EARTH_RADIUS_M}^2 * radians(2 * {h}) * "
            f"(sin(radians(least({cy} + {h}, 90.0))) - sin(radians(greatest({cy} - {h}, -90.0)))))")
