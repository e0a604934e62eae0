"""Exact nearest-neighbour join of points to ocean coordinates, per year or over all years.

The ocean is first reduced to one row per coordinate (and year), then packed into a
shallow tree of bounding boxes kept as ordinary tables (sort-tile-recursive packing):
coordinates are cut by longitude into slices and each slice by latitude into nodes of
``NODE_SIZE``, and nodes are packed the same way until each scope (one year, or all of
them) has few enough for one row. Every node holds at most ``NODE_SIZE`` entries however
dense the data are.

A query point walks down the tree once, one equi-join on the node id per level. What it
still has to look at, its frontier, is staged before each level. Boxes are tight, so each
one tells a distance within which it has a coordinate for sure; the least of these bounds
the answer from above, and boxes farther than the bound leave the frontier. The last step
looks at the coordinates themselves. It cannot miss the nearest one, nor one at equal
distance.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoalmark.functions.geo import squared_distance
from shoalmark.operators.joins import sized_join
from shoalmark.session import broadcast_budget, stage

NODE_SIZE = 32
ROWS_PER_TASK = 250_000
LEAST_QUERIES_PER_TASK, MOST_QUERIES_PER_TASK = 5_000, 1_000_000
# Sizes in a broadcast relation, rounded up: one node entry, one result row.
ENTRY_BYTES, RESULT_BYTES, FIRST_BYTES, YEAR_BYTES = 96, 192, 64, 64

# Scope of the coordinates of all years together; not a calendar year.
ALL_YEARS = -1_000_000

KEYS = ("q_lat", "q_lon", "q_scope")
MATCHED = ("temperature_C", "salinity_PSU", "depth", "ocean_time")


@dataclass(frozen=True)
class OceanIndex:
    """Tables of the box tree; ``levels`` goes from below the root to just above the leaves."""

    roots: DataFrame  # q_scope, entries: the scope's topmost boxes
    levels: list[DataFrame]  # node, entries: boxes one level further down
    leaves: DataFrame  # node, entries: coordinates with their ocean rows
    root_bytes: int
    level_bytes: list[int]
    leaf_bytes: int
    years: DataFrame  # q_year, q_scope (equal): the years that have ocean rows


def representatives(ocean: DataFrame) -> DataFrame:
    """First ocean row of each coordinate and year, in the order of the result's ``first`` column.

    Rows without a time come last; ties go to the smaller depth, temperature, salinity.

    The ocean table is reduced to the first time of each coordinate and year by a hash
    aggregate. Only the rows at that time, one unless there are ties, are put in order.
    """
    keys = ["latitude", "longitude", "__scope"]
    rows = ocean.na.drop(subset=["latitude", "longitude"]).select(
        (F.col("latitude") + F.lit(0.0)).alias("latitude"), (F.col("longitude") + F.lit(0.0)).alias("longitude"),
        "time", "depth", "temperature_C", "salinity_PSU",
        F.coalesce(F.year("time"), F.lit(ALL_YEARS)).alias("__scope"))
    first = stage(rows.groupBy(*keys).agg(F.min("time").alias("__first"), F.count(F.lit(1)).alias("n")), "first-times")
    at_first = sized_join(rows, first.drop("n"), keys, first.count() * FIRST_BYTES, counted=first.select(*keys, "n")).where(
        F.col("time").eqNullSafe(F.col("__first")))
    order = F.struct(
        F.col("time").isNull().alias("untimed"), F.col("time").alias("ocean_time"),
        "depth", "temperature_C", "salinity_PSU",
    )
    return at_first.groupBy("latitude", "longitude", F.year("time").alias("year")).agg(F.min(order).alias("first"))


def _numbered(rows: DataFrame, tasks: int, *order: str) -> DataFrame:
    """Rows in order, numbered from 0 in each task (``here``) and apart overall (``position``)."""
    spread = rows.coalesce(1) if tasks == 1 else rows.repartitionByRange(tasks, *order)
    position = F.col("position")
    # The generated number counts rows in its low 33 bits and tasks in those above.
    return (
        spread.sortWithinPartitions(*order)
        .withColumn("position", F.monotonically_increasing_id())
        .withColumn("here", position.bitwiseAND(F.lit((1 << 33) - 1)))
    )


def _packed(entries: DataFrame, sizes: DataFrame, scopes: int, rows: int, entry: Column) -> DataFrame:
    """Group the entries of each scope into nodes of at most NODE_SIZE in compact boxes.

    A slice takes as many entries as make its nodes about as wide as high.
    """
    tasks = max(1, math.ceil(rows / ROWS_PER_TASK))
    slice_size = F.ceil(F.sqrt(F.col("n") / NODE_SIZE)) * NODE_SIZE
    position, here = F.col("position"), F.col("here")
    numbered = _numbered(entries, tasks, "scope", "west", "south", "id")
    sliced = (
        sized_join(numbered, sizes, ["scope"], scopes * YEAR_BYTES, counted=sizes)
        .withColumn("slice", position - here % slice_size)
        .drop("n", "position", "here")
    )
    return (
        _numbered(sliced, tasks, "scope", "slice", "south", "west", "id")
        .groupBy("scope", "slice", (position - here % NODE_SIZE).alias("run"))
        .agg(
            F.min("position").alias("id"), F.collect_list(entry).alias("entries"),
            F.min("south").alias("south"), F.max("north").alias("north"),
            F.min("west").alias("west"), F.max("east").alias("east"),
        )
        .drop("slice", "run")
    )


def build_index(ocean: DataFrame, by_year: bool = True) -> OceanIndex:
    """Reduce and pack the ocean rows; ``by_year=False`` leaves out the single-year scopes."""
    reps = stage(representatives(ocean), "ocean-representatives")
    lat, lon = F.col("latitude"), F.col("longitude")
    points = (
        reps.groupBy("latitude", "longitude").agg(F.min("first").alias("first"))
        .withColumn("scope", F.lit(ALL_YEARS))
    )
    if by_year:
        points = points.unionByName(
            reps.where("year is not null").withColumnRenamed("year", "scope"))
    entries = stage(points.select(
        "scope", lat.alias("south"), lat.alias("north"), lon.alias("west"), lon.alias("east"),
        F.lit(0).cast("bigint").alias("id"), "first"), "ocean-points")

    entry = F.struct(F.col("south").alias("lat"), F.col("west").alias("lon"), "first")
    tables: list[DataFrame] = []
    table_bytes: list[int] = []
    while True:
        sizes = entries.groupBy("scope").agg(F.count(F.lit(1)).alias("n"))
        total = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("scopes")).first()
        if total.most is None:
            raise ValueError("the ocean table has no row with coordinates")
        if tables and total.most <= NODE_SIZE:
            break
        entries = stage(_packed(entries, sizes, total.scopes, total.rows, entry), "ocean-nodes")
        tables.append(entries.select(F.col("id").alias("node"), "entries"))
        table_bytes.append(total.rows * ENTRY_BYTES)
        entry = F.struct(F.col("id").alias("node"), "south", "north", "west", "east")
    roots = stage(
        entries.groupBy(F.col("scope").alias("q_scope"))
        .agg(F.collect_list(entry).alias("entries")), "ocean-roots")
    return OceanIndex(
        roots=roots, levels=tables[:0:-1], leaves=tables[0],
        root_bytes=total.rows * ENTRY_BYTES, level_bytes=table_bytes[:0:-1], leaf_bytes=table_bytes[0],
        years=roots.where(F.col("q_scope") != ALL_YEARS).select(
            F.col("q_scope").alias("q_year"), "q_scope"),
    )


def _nearer_side(at: Column, low: Column, high: Column) -> Column:
    """Distance to the interval, 0 inside it."""
    return F.greatest(low - at, at - high, F.lit(0.0))


def _least_possible(lat: Column, lon: Column, box: Column) -> Column:
    """Squared distance to the box: no coordinate in it is nearer."""
    dy = _nearer_side(lat, box["south"], box["north"])
    dx = _nearer_side(lon, box["west"], box["east"])
    return dy * dy + dx * dx


def _surely_reached(lat: Column, lon: Column, box: Column) -> Column:
    """Squared distance within which the box has a coordinate for sure.

    The boxes are tight, so each side touches one: at worst the far end of the nearest side.
    """
    y0, y1 = F.abs(lat - box["south"]), F.abs(lat - box["north"])
    x0, x1 = F.abs(lon - box["west"]), F.abs(lon - box["east"])
    y_near, y_far = F.least(y0, y1), F.greatest(y0, y1)
    x_near, x_far = F.least(x0, x1), F.greatest(x0, x1)
    return F.least(y_near * y_near + x_far * x_far, y_far * y_far + x_near * x_near)


def _walk_tasks(spark: SparkSession, rows: int) -> int:
    """Enough tasks to share out a few rows that each take long, and not too many for many rows."""
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               math.ceil(rows / MOST_QUERIES_PER_TASK))
    return min(max(1, math.ceil(rows / LEAST_QUERIES_PER_TASK)), most)


def match(queries: DataFrame, index: OceanIndex) -> DataFrame:
    """Nearest coordinate for each distinct (q_lat, q_lon, q_scope); adds the struct ``hit``.

    ``hit`` has the squared distance ``d2`` and the MATCHED columns. Equal distances go to
    the smaller latitude, then longitude. The rows are spread over the tasks by their key,
    so that bringing together what one key found needs no further shuffle.
    """
    lat, lon = F.col("q_lat"), F.col("q_lon")
    tasks = _walk_tasks(queries.sparkSession, queries.count())
    box, bound, of_query = F.col("box"), F.col("bound"), Window.partitionBy(*KEYS)

    frontier = queries.select(*KEYS, F.lit(float("inf")).alias("bound")).repartition(tasks, *KEYS)
    rows = sized_join(frontier, index.roots, ["q_scope"], index.root_bytes)
    for table, size in zip([*index.levels, index.leaves], [*index.level_bytes, index.leaf_bytes]):
        boxes = rows.select(*KEYS, "bound", F.explode("entries").alias("box")).select(
            *KEYS, "bound", F.col("box.node").alias("node"), _least_possible(lat, lon, box).alias("near"),
            _surely_reached(lat, lon, box).alias("reach"))
        # What the old bound leaves out cannot lower it either.
        tighter = boxes.where("near <= bound").withColumn("bound", F.least(bound, F.min("reach").over(of_query)))
        frontier = stage(tighter.where("near <= bound").select(*KEYS, "bound", "node"), "frontier")
        rows = sized_join(frontier.repartition(tasks, *KEYS), table, ["node"], size)

    candidates = (
        rows.select(*KEYS, "bound", F.explode("entries").alias("p"))
        .withColumn("d2", squared_distance(lat, lon, F.col("p.lat"), F.col("p.lon")))
        .where("d2 <= bound")
    )
    nearest = candidates.select(*KEYS, F.struct(
        "d2", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"), F.col("p.first").alias("first")).alias("best"))
    # The few at the bound come together by hash, without a sort.
    best = F.array_min(F.collect_list("best"))
    return (
        nearest.groupBy(*KEYS).agg(best.alias("best"))
        .select(*KEYS, F.struct(
            F.col("best.d2").alias("d2"),
            *[F.col(f"best.first.{c}").alias(c) for c in MATCHED]).alias("hit"))
    )


def attach_nearest(points: DataFrame, index: OceanIndex, own_year: Column | None = None,
                   lat: str = "decimalLatitude", lon: str = "decimalLongitude") -> DataFrame:
    """Add ``hit`` to every point: nearest in its own year if that year has ocean rows, else overall.

    Points that share coordinates and year are looked up once. A point without a year
    gets the overall nearest. Points without coordinates are dropped.
    """
    year = (F.lit(None) if own_year is None else own_year).cast("int")
    years = index.years
    if index.root_bytes <= broadcast_budget(points.sparkSession):
        years = F.broadcast(years)
    scoped = (
        points.na.drop(subset=[lat, lon])
        .withColumn("q_year", year)
        .join(years, "q_year", "left")
        .withColumn("q_scope", F.coalesce("q_scope", F.lit(ALL_YEARS)))
        .drop("q_year")
        # Shuffle and join keys treat -0.0 as 0.0 and so must the lookup.
        .withColumn("q_lat", F.col(lat) + F.lit(0.0))
        .withColumn("q_lon", F.col(lon) + F.lit(0.0))
    )
    distinct = stage(scoped.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")), "query-points")
    found = match(distinct, index)
    size = distinct.count() * RESULT_BYTES
    return sized_join(scoped, found, KEYS, size, counted=distinct).drop(*KEYS)
