import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from shoalmark.operators import nearest
from shoalmark.operators.fusion import fuse
from shoalmark.operators.nearest import attach_nearest, build_index, representatives
from shoalmark.schemas import OCEAN

OCC = "occ_id long, decimalLatitude double, decimalLongitude double, eventDate string"


def ocean_frame(spark, records):
    return spark.createDataFrame(records, OCEAN)


def at(year, month=1, day=1):
    return datetime(year, month, day)


def brute(points, ocean):
    """Nearest per point by trying all, in the documented order of ties."""
    def order(lat, lon, o):
        time, depth, la, lo, temp, sal = o
        dy, dx = lat - la, lon - lo
        return (dy * dy + dx * dx, la, lo, time is None, time or at(1), depth, temp, sal)

    found = {}
    for key, lat, lon, year in points:
        mine = [o for o in ocean if year is not None and o[0] and o[0].year == year] or ocean
        best = min(mine, key=lambda o: order(lat, lon, o))
        found[key] = (order(lat, lon, best)[0], best[4], best[0])
    return found


def check(spark, points, ocean):
    index = build_index(ocean_frame(spark, ocean))
    frame = spark.createDataFrame(
        points, "key long, decimalLatitude double, decimalLongitude double, y int")
    found = attach_nearest(frame, index, F.col("y"))
    got = {r.key: (r.hit.d2, r.hit.temperature_C, r.hit.ocean_time) for r in found.collect()}
    assert got == brute(points, ocean)


def random_case(seed, n_ocean, n_points, spread=30.0):
    rng = random.Random(seed)
    grid = lambda: rng.choice([-1, 1]) * rng.randrange(0, 40) * 0.25
    ocean = []
    for i in range(n_ocean):
        la, lo = (grid(), grid()) if i % 3 else (rng.uniform(-9, 9), rng.uniform(-9, 9))
        time = None if i % 17 == 0 else at(2000 + rng.randrange(3), rng.randrange(1, 13))
        ocean.append((time, 0.5, la, lo, float(i), 35.0))
    points = []
    for key in range(n_points):
        la, lo = (grid(), grid()) if key % 2 else (rng.uniform(-spread, spread),
                                                   rng.uniform(-spread, spread))
        points.append((key, la, lo, rng.choice([None, 1999, 2000, 2001, 2002])))
    return points, ocean


def test_equals_brute_force(spark):
    check(spark, *random_case(1, 700, 300))


def test_equals_brute_force_through_many_levels(spark, monkeypatch):
    monkeypatch.setattr(nearest, "NODE_SIZE", 3)
    check(spark, *random_case(2, 400, 200))


def test_equals_brute_force_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(nearest, "NODE_SIZE", 4)
    monkeypatch.setattr(nearest, "ROWS_PER_TASK", 60)
    check(spark, *random_case(3, 400, 200))


def test_equals_brute_force_beyond_the_broadcast_budget(spark, no_broadcast):
    check(spark, *random_case(4, 300, 150))


def test_hot_coordinates_and_dense_cluster(spark, no_broadcast, monkeypatch):
    """A third of the points at one place, a third of the ocean within a thousandth of a degree."""
    monkeypatch.setattr(nearest, "NODE_SIZE", 8)
    points, ocean = random_case(5, 200, 120)
    rng = random.Random(6)
    ocean += [(at(2001), 0.5, 1 + rng.random() / 1000, 2 + rng.random() / 1000, 1000.0 + i, 35.0)
              for i in range(100)]
    points += [(1000 + i, 1.0005, 2.0005, 2001) for i in range(60)]
    check(spark, points, ocean)


coordinate = st.one_of(st.integers(-8, 8).map(lambda i: i * 0.5),
                       st.floats(-50, 50, allow_nan=False, allow_subnormal=False))


@settings(max_examples=4, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(coordinate, coordinate, st.integers(2000, 2002)), min_size=1, max_size=60),
       st.lists(st.tuples(coordinate, coordinate, st.sampled_from([None, 1990, 2000, 2001])),
                min_size=1, max_size=40))
def test_any_points(spark, sea, land):
    ocean = [(at(y), 0.5, la, lo, float(i), 35.0) for i, (la, lo, y) in enumerate(sea)]
    check(spark, [(i, la, lo, y) for i, (la, lo, y) in enumerate(land)], ocean)


def test_first_time_represents_a_coordinate(spark):
    ocean = ocean_frame(spark, [
        (None, 0.1, 1.0, 1.0, 1.0, 35.0), (at(2000, 5), 0.5, 1.0, 1.0, 2.0, 35.0),
        (at(2000, 2), 0.5, 1.0, 1.0, 4.0, 35.0), (at(2000, 2), 0.5, 1.0, 1.0, 3.0, 35.0),
        (at(2000, 2), 0.5, None, 1.0, 9.0, 35.0),
    ])
    got = representatives(ocean).select("year", "first.temperature_C")
    assert rows(got) == [(2000, 3.0), (None, 1.0)]


def test_empty_ocean_is_an_error(spark):
    with pytest.raises(ValueError):
        build_index(ocean_frame(spark, []))


def fused(spark, occurrences, ocean):
    return {r.occ_id: r for r in fuse(
        spark.createDataFrame(occurrences, OCC), ocean_frame(spark, ocean)).collect()}


def test_fuse_year_fill_and_drop(spark):
    ocean = [
        (at(2000, 3), 0.5, 10.0, 70.0, 20.0, 35.0),
        (at(2001, 6), None, 12.0, 70.0, 25.0, 36.0),
        (None, 0.7, 30.0, 90.0, 10.0, 30.0),
    ]
    got = fused(spark, [
        (1, 10.1, 70.0, "2001-01-01"),   # its year is farther away than another
        (2, 10.1, 70.0, "1980-05-05"),   # no ocean row in its year: overall nearest
        (3, 10.1, 70.0, "unknown"),      # dated by the nearest row
        (4, 29.0, 90.0, None),           # nearest row has no time: dropped
        (5, 29.0, 90.0, "2000-07-07"),   # untimed rows never match a year
        (6, None, 70.0, "2000-01-01"),   # no coordinates: dropped
    ], ocean)
    assert sorted(got) == [1, 2, 3, 5]
    assert (got[1].temperature_C, got[1].depth, got[1].eventYear) == (25.0, None, 2001)
    assert (got[2].temperature_C, got[2].eventYear) == (20.0, 1980)
    assert (got[3].temperature_C, got[3].eventDate, got[3].eventYear) == (20.0, at(2000, 3), 2000)
    assert (got[5].temperature_C, got[5].eventYear) == (20.0, 2000)


def test_fuse_keeps_duplicates_and_names_in_use(spark):
    occurrences = spark.createDataFrame(
        [(1, 1.0, 1.0, "2000-01-01", 5, 6.0), (2, 1.0, 1.0, "2000-01-01", 5, 6.0)],
        OCC + ", scope int, lat double")
    ocean = ocean_frame(spark, [(at(2000), 0.5, 0.0, 0.0, 1.0, 1.0)])
    got = fuse(occurrences, ocean)
    assert got.count() == 2
    assert rows(got.select("scope", "lat")) == [(5, 6.0), (5, 6.0)]


@pytest.mark.parametrize("budget", ["0", str(1 << 26)])
def test_a_deep_tree_equals_brute_force(spark, monkeypatch, budget):
    monkeypatch.setattr(nearest, "NODE_SIZE", 4)
    spark.conf.set("spark.shoalmark.broadcastBytes", budget)
    try:
        points, ocean = random_case(11, 400, 60)
        assert len(build_index(ocean_frame(spark, ocean)).levels) >= 2
        check(spark, points, ocean)
    finally:
        spark.conf.unset("spark.shoalmark.broadcastBytes")
