import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shoalmark.functions.geo import REGION_WKT
from shoalmark.functions.wkt import edges, rings
from shoalmark.operators.cleaning import within_region
from shoalmark.operators.regions import cover, region_edges, region_join, unreadable_regions, within_wkt

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.5), (1.0, 1.0)]


@pytest.mark.parametrize("text, found", [
    ("POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))", [SQUARE]),
    (" polygon ( ( 0 0,4.0 0 ,4 4,  0\t4, 0 0 ) , (1 1,2 1,2 2.5,1 1) ) ", [SQUARE, HOLE]),
    ("MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0)), ((1 1, 2 1, 2 2.5, 1 1)))", [SQUARE, HOLE]),
    ("POLYGON Z ((1 1 9, 2 1 9, 2 2.5 -9, 1 1 9))", [HOLE]),
    ("POLYGON((-1.5e1 .5, 4. 0, 4 4))", [[(-15.0, 0.5), (4.0, 0.0), (4.0, 4.0)]]),
    ("POLYGON((0 0, 1 1))", None), ("POLYGON((0 0, 4 0, 4 4)", None), ("POINT(1 1)", None), ("", None), (None, None),
    ("POLYGON((a b, 4 0, 4 4))", None), ("POLYGON((0 0, 4 0, 4 4)) x", None), ("POLYGON EMPTY", None),
])
def test_rings(spark, text, found):
    got = spark.createDataFrame([(text,)], "t string").select(rings(F.col("t"))).first()[0]
    assert (got and [[tuple(p) for p in ring] for ring in got]) == found


def test_an_open_ring_is_closed_and_level_edges_are_left_out(spark):
    got = spark.range(1).select(edges(rings(F.lit("POLYGON((0 0, 4 0, 4 4, 0 4))")))).first()[0]
    assert [tuple(e) for e in got] == [(4.0, 0.0, 4.0, 0.0), (0.0, 4.0, 0.0, 0.0)]


def odd(lat, lon, text_rings):
    inside = False
    for ring in text_rings:
        for (x, y), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y > lat) != (y2 > lat) and lon < x + (lat - y) * ((x2 - x) / (y2 - y)):
                inside = not inside
    return inside


def random_regions(rng, n):
    out = []
    for i in range(n):
        x, y = rng.uniform(-20, 20), rng.uniform(-10, 10)
        ring = [(round(x + rng.uniform(-6, 6), rng.choice([0, 1, 5])), round(y + rng.uniform(-6, 6), rng.choice([0, 1, 5])))
                for _ in range(rng.choice([3, 4, 9, 25]))]
        hole = [(x, y), (x + 1.0, y), (x + 1.0, y + 0.5)]
        out.append((i, [ring, hole] if i % 3 == 0 else [ring]))
    return out


def wkt(found):
    return "POLYGON(" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + ")" for ring in found) + ")"


@pytest.mark.parametrize("cell", [0.3, 1.0, 7.0])
def test_join_equals_brute_force(spark, cell):
    rng = random.Random(6)
    regions = [*random_regions(rng, 25), (90, [[(0.0, 0.25), (3.0, 0.25), (3.0, 2.75), (0.0, 2.75)]])]
    points = [(i, rng.uniform(-18, 18), rng.uniform(-28, 28)) for i in range(1500)]
    points += [(2000 + i, float(rng.randint(-4, 4)), float(rng.randint(-4, 4))) for i in range(60)]
    points += [(3000, 0.25, 1.0), (3001, 0.26, 0.01), (3002, 2.74, 2.99), (3003, 2.75, 1.0)]
    points += [(4000, None, 1.0), (4001, 1.0, None), (4002, float("nan"), 1.0)]
    df = spark.createDataFrame(points, "id long, decimalLatitude double, decimalLongitude double").withColumn("box", F.lit("clash"))
    areas = spark.createDataFrame([(i, wkt(r)) for i, r in regions] + [(91, "POLYGON((1"), (92, None)], "region_id long, wkt string")
    found = rows(region_join(df, areas, cell=cell).select("id", "region_id"))
    assert found == sorted(((p, i) for p, lat, lon in points if lat is not None and lon is not None
                            for i, r in regions if odd(lat, lon, r)), key=repr)
    assert rows(unreadable_regions(areas, "wkt").select("region_id")) == [(91,), (92,)]


def test_join_beyond_the_broadcast_budget(spark, no_broadcast):
    """One cell holds most of the points, and is split."""
    points = spark.range(4000).select(F.col("id"), F.lit(1.2).alias("decimalLatitude"),
                                      F.when(F.col("id") % 10 == 0, 30.0).otherwise(1.3).alias("decimalLongitude"))
    areas = spark.createDataFrame([(1, wkt([SQUARE, HOLE])), (2, wkt([SQUARE]))], "region_id long, wkt string")
    assert rows(region_join(points, areas).groupBy("region_id").count()) == [(2, 3600)]


def test_cells_inside_have_no_edges(spark):
    areas = spark.createDataFrame([(1, wkt([SQUARE]))], "region_id long, wkt string")
    cells = cover(region_edges(areas, "region_id", "wkt"), 1.0).collect()
    assert {(c.i_lat, c.i_lon) for c in cells if c.whole} == {(i, j) for i in (1, 2) for j in (1, 2)}
    assert all(c.edges is None for c in cells if c.whole)
    plan = region_join(spark.createDataFrame([(1.0, 1.0)], "decimalLatitude double, decimalLongitude double"), areas)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_the_study_region_as_text(spark):
    rng = random.Random(2)
    points = spark.createDataFrame([(i, rng.uniform(0, 45), rng.uniform(60, 105)) for i in range(500)],
                                   "id long, decimalLatitude double, decimalLongitude double")
    assert rows(within_wkt(points, REGION_WKT)) == rows(within_region(points))
    with pytest.raises(ValueError, match="not a polygon"):
        within_wkt(points, "POINT(1 1)")
