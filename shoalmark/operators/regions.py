"""Which points lie in which regions: a join of points to polygons through a cover of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalmark.functions.geo import in_box
from shoalmark.functions.numbers import nan_to_null
from shoalmark.functions.wkt import box, edges, inside, level_edges, rings
from shoalmark.operators.joins import sized_join
from shoalmark.session import stage

CELL = 0.5  # degrees; smaller cells test fewer points against edges and need more rows
CELL_BYTES = 96  # of a covered cell in a broadcast relation, without its edges
EDGE_BYTES = 40


def _cell(degrees: Column, cell: float) -> Column:
    return F.floor(degrees / F.lit(cell)).cast("int")


def region_edges(regions: DataFrame, region_id: str, wkt: str) -> DataFrame:
    """(region_id, box, edges, level) of the regions whose text can be read."""
    found = regions.select(F.col(region_id).alias("region_id"), rings(F.col(wkt)).alias("rings")).where("rings is not null")
    return found.select("region_id", box(F.col("rings")).alias("box"), edges(F.col("rings")).alias("edges"),
                        level_edges(F.col("rings")).alias("level"))


def unreadable_regions(regions: DataFrame, wkt: str) -> DataFrame:
    """The rows of ``regions`` that ``region_join`` leaves out."""
    return regions.where(F.col(wkt).isNull() | rings(F.col(wkt)).isNull())


def cover(regions: DataFrame, cell: float = CELL) -> DataFrame:
    """The cells each region touches: (region_id, i_lat, i_lon, whole, edges).

    A ``whole`` cell lies inside. The others have the edges that meet their band of latitude and
    do not end west of them, all that a ray to the east can cross. A band's edges are gathered
    first and spread over its cells then, so a region is taken apart into bands at once.
    """
    bands = regions.withColumn("i_lat", F.explode(F.sequence(
        _cell(F.col("box.min_lat"), cell), _cell(F.col("box.max_lat"), cell))))
    low, high = F.col("i_lat") * F.lit(cell), (F.col("i_lat") + 1) * F.lit(cell)
    met = F.filter("edges", lambda e: (F.least(e["y1"], e["y2"]) <= high) & (F.greatest(e["y1"], e["y2"]) >= low))

    def at(edge: Column, lat: Column) -> Column:
        """Longitude of an edge at the latitude of it that is nearest to ``lat``."""
        inner = F.greatest(F.least(lat, F.greatest(edge["y1"], edge["y2"])), F.least(edge["y1"], edge["y2"]))
        return edge["x1"] + (inner - edge["y1"]) * edge["slope"]

    margin = F.lit(cell * 1e-6)  # far more than the rounding of an edge's longitude
    spans = F.transform(met, lambda e: F.struct(
        e.alias("edge"), (F.least(at(e, low), at(e, high)) - margin).alias("west"),
        (F.greatest(at(e, low), at(e, high)) + margin).alias("east")))
    level = F.filter("level", lambda e: (e["lat"] >= low) & (e["lat"] <= high))
    bands = stage(bands.select("region_id", "box", "i_lat", spans.alias("met"), level.alias("level")), "region-bands")
    cells = bands.withColumn("i_lon", F.explode(F.sequence(
        _cell(F.col("box.min_lon"), cell), _cell(F.col("box.max_lon"), cell))))
    left, right = F.col("i_lon") * F.lit(cell), (F.col("i_lon") + 1) * F.lit(cell)
    touched = (F.exists("met", lambda m: (m["west"] <= right) & (m["east"] >= left))
               | F.exists("level", lambda m: (m["west"] <= right) & (m["east"] >= left)))
    needed = F.transform(F.filter("met", lambda m: m["east"] >= left), lambda m: m["edge"])
    tested = cells.select("region_id", "i_lat", "i_lon", touched.alias("touched"), needed.alias("edges"))
    middle = [(F.col(i) + 0.5) * F.lit(cell) for i in ("i_lat", "i_lon")]
    tested = tested.where(F.col("touched") | inside(*middle, F.col("edges")))
    return tested.select("region_id", "i_lat", "i_lon", (~F.col("touched")).alias("whole"),
                         F.when(F.col("touched"), F.col("edges")).alias("edges"))


def region_join(points: DataFrame, regions: DataFrame, region_id: str = "region_id", wkt: str = "wkt",
                lat: str = "decimalLatitude", lon: str = "decimalLongitude", cell: float = CELL) -> DataFrame:
    """Each point with the id of each region it lies in, as ``region_id``; points in no region are
    left out, and a point in several regions is there several times.

    Regions are well-known text (polygons with holes, or several); those that cannot be read match
    nothing, see ``unreadable_regions``. Points meet regions by equality of cells: the cover is
    broadcast if it is measured to fit, else cells with many points are split. Only points in cells
    that an edge touches are tested against edges. Points without coordinates match nothing.
    """
    covered = stage(cover(region_edges(regions, region_id, wkt), cell), "region-cover").withColumnsRenamed(
        {"i_lat": "__i_lat", "i_lon": "__i_lon", "region_id": "__region", "whole": "__whole", "edges": "__edges"})
    size = covered.agg(F.sum(F.coalesce(F.size("__edges"), F.lit(0)) * EDGE_BYTES + CELL_BYTES)).first()[0] or 0
    there = [nan_to_null(F.col(c).cast("double")).isNotNull() for c in (lat, lon)]
    placed = points.where(there[0] & there[1]).withColumns(
        {"__i_lat": _cell(F.col(lat), cell), "__i_lon": _cell(F.col(lon), cell)})
    near = sized_join(placed, covered, ["__i_lat", "__i_lon"], size)
    hit = F.col("__whole") | inside(F.col(lat), F.col(lon), F.coalesce("__edges", F.array()))
    return near.where(hit).select(*[f"`{c}`" for c in points.columns], F.col("__region").alias("region_id"))


def within_wkt(points: DataFrame, wkt: str, lat: str = "decimalLatitude", lon: str = "decimalLongitude") -> DataFrame:
    """The points inside one region given as text. Its box is compared first, as that much
    reaches the scan."""
    one = points.sparkSession.range(1).select(rings(F.lit(wkt)).alias("rings"))
    found = one.select(box(F.col("rings")).alias("box"), edges(F.col("rings")).alias("edges")).first()
    if found.edges is None:
        raise ValueError(f"not a polygon: {wkt[:80]!r}")
    limits = (found.box.min_lat, found.box.max_lat), (found.box.min_lon, found.box.max_lon)
    corners = F.array(*[F.struct(*[F.lit(value).alias(name) for name, value in edge.asDict().items()]) for edge in found.edges])
    return points.where(in_box(F.col(lat), F.col(lon), *limits) & inside(F.col(lat), F.col(lon), corners))
