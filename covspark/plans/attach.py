"""Attach the attributes of the polygons that contain each sample event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covspark.operators.spatial import point_in_polygon

# Geometry-like columns never returned as attributes.
GEOMETRY_COLS = ("rings", "geometry", "geom", "bbox")


def attach_polygons(se: DataFrame, polygons: DataFrame, columns=None, *,
                    lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Left-attach polygon attributes to every event (several hits -> several
    rows, no hit -> NULL attributes, identical events all kept).

    The point-in-polygon test runs once per distinct location; results join
    back on the location, so a site sampled a million times costs one test.
    """
    attrs = [c for c in polygons.columns if c not in GEOMETRY_COLS]
    if columns is not None:
        columns = [columns] if isinstance(columns, str) else list(columns)
        unknown = [c for c in columns if c not in attrs]
        if unknown:
            raise ValueError(f"the layer has no column {', '.join(unknown)}; it has: {', '.join(attrs)}")
        attrs = columns
    clash = [c for c in attrs if c in se.columns]
    if clash:
        raise ValueError(f"polygon attribute(s) {clash} clash with event columns")
    pts = se.select(F.col(lat).alias("_py"), F.col(lon).alias("_px")).distinct()
    hits = point_in_polygon(pts, polygons.select(*attrs, "rings"), lat="_py", lon="_px").select("_py", "_px", *attrs)
    out = se.join(hits, (se[lat] == hits["_py"]) & (se[lon] == hits["_px"]), how="left")
    return out.drop("_py", "_px")


def unmatched_events(se: DataFrame, polygons: DataFrame, *, lat: str = "latitude",
                     lon: str = "longitude") -> DataFrame:
    """Events inside no polygon (left anti join on the location)."""
    pts = se.select(F.col(lat).alias("_py"), F.col(lon).alias("_px")).distinct()
    hits = point_in_polygon(pts, polygons.select("rings"), lat="_py", lon="_px").select("_py", "_px").distinct()
    return se.join(hits, (se[lat] == hits["_py"]) & (se[lon] == hits["_px"]), how="left_anti")
