"""Regions as well-known text, parsed and tested by column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A polygon or several, with or without heights and measures, nothing before or after it.
_NUMBER = r"\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*"
_POINT = rf"{_NUMBER}(\s{_NUMBER}){{1,3}}"
_RING = rf"\s*\({_POINT}(,{_POINT}){{2,}}\)\s*"
_POLYGON = rf"\s*\({_RING}(,{_RING})*\)\s*"
READABLE = rf"(?i)^\s*(POLYGON\s*(Z|M|ZM)?{_POLYGON}|MULTIPOLYGON\s*(Z|M|ZM)?\s*\({_POLYGON}(,{_POLYGON})*\))\s*$"

def rings(wkt: Column) -> Column:
    """The rings of all polygons, holes among them: arrays of points (lon, lat), in their order.

    NULL for a text that is no polygon. The points of a ring are as written, so the last one
    usually repeats the first.
    """
    def point(text: Column) -> Column:
        numbers = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")
        return F.struct(F.get(numbers, 0).try_cast("double").alias("lon"),
                        F.get(numbers, 1).try_cast("double").alias("lat"))

    parts = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), 1)
    return F.when(wkt.rlike(READABLE), F.transform(parts, lambda ring: F.transform(F.split(ring, ","), point)))


def _segments(found: Column) -> Column:
    """From each point of each ring to the next one; an open ring is closed."""
    def of_ring(ring: Column) -> Column:
        following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(ring, following, lambda a, b: F.struct(
            a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")))

    return F.flatten(F.transform(found, of_ring))


def edges(found: Column) -> Column:
    """The edges of all rings that are not level: start, end latitude, and longitude per degree
    of latitude."""
    sloping = F.filter(_segments(found), lambda s: s["y1"] != s["y2"])
    return F.transform(sloping, lambda s: F.struct(
        s["x1"], s["y1"], s["y2"], ((s["x2"] - s["x1"]) / (s["y2"] - s["y1"])).alias("slope")))


def level_edges(found: Column) -> Column:
    """The level edges of all rings, which no ray crosses: latitude, west and east end."""
    level = F.filter(_segments(found), lambda s: s["y1"] == s["y2"])
    return F.transform(level, lambda s: F.struct(
        s["y1"].alias("lat"), F.least(s["x1"], s["x2"]).alias("west"), F.greatest(s["x1"], s["x2"]).alias("east")))


def box(found: Column) -> Column:
    """The extremes of all rings' points."""
    points = F.flatten(found)
    lat, lon = F.transform(points, lambda p: p["lat"]), F.transform(points, lambda p: p["lon"])
    return F.struct(F.array_min(lat).alias("min_lat"), F.array_max(lat).alias("max_lat"),
                    F.array_min(lon).alias("min_lon"), F.array_max(lon).alias("max_lon"))


def crossed(lat: Column, lon: Column, edge: Column) -> Column:
    """Whether a ray to the east crosses an edge."""
    at = edge["x1"] + (lat - edge["y1"]) * edge["slope"]
    return ((edge["y1"] > lat) != (edge["y2"] > lat)) & (lon < at)


def inside(lat: Column, lon: Column, region_edges: Column) -> Column:
    """Even-odd test: inside an outer ring and in no hole. One fold over the edges."""
    return F.aggregate(region_edges, F.lit(False), lambda odd, edge: odd != crossed(lat, lon, edge))
