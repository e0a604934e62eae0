"""Planar geometry in degrees: boxes, polygons, distances."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The study region in degrees.
REGION_LATITUDE = (8.0, 37.0)
REGION_LONGITUDE = (68.0, 97.0)
REGION_WKT = "POLYGON((68 8, 97 8, 97 37, 68 37, 68 8))"


def in_box(lat: Column, lon: Column, lat_range: Sequence[float] = REGION_LATITUDE,
           lon_range: Sequence[float] = REGION_LONGITUDE) -> Column:
    """Inside the box or on its edge. Two ranges, so Parquet statistics can prune."""
    return lat.between(*lat_range) & lon.between(*lon_range)


def in_polygon(lat: Column, lon: Column, ring: Sequence[tuple[float, float]]) -> Column:
    """Even-odd test against a simple polygon given as (lon, lat) corners.

    One comparison per edge, folded with exclusive or: plain column arithmetic.
    The polygon's own bounding box comes first, as that much can be pushed down.
    """
    corners = list(ring)
    if corners[0] == corners[-1]:
        corners.pop()
    lons, lats = [x for x, _ in corners], [y for _, y in corners]

    def crosses(a: tuple[float, float], b: tuple[float, float]) -> Column:
        (ax, ay), (bx, by) = a, b
        at = F.lit(ax) + (lat - F.lit(ay)) * F.lit((bx - ax) / (by - ay))
        return ((F.lit(ay) > lat) != (F.lit(by) > lat)) & (lon < at)

    edges = [(a, b) for a, b in zip(corners, corners[1:] + corners[:1]) if a[1] != b[1]]
    odd = reduce(lambda x, y: x != y, [crosses(a, b) for a, b in edges])
    return in_box(lat, lon, (min(lats), max(lats)), (min(lons), max(lons))) & odd


def squared_distance(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Squared Euclidean distance in degrees; longitudes do not wrap."""
    dy, dx = lat_a - lat_b, lon_a - lon_b
    return dy * dy + dx * dx
