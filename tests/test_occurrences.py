from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shoalmark.functions.geo import in_polygon
from shoalmark.functions.numbers import evenly_spaced
from shoalmark.functions.text import normalised_name, species_key
from shoalmark.functions.time import event_timestamp
from shoalmark.operators import cleaning, evaluation, grid, ocean, profile, species


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("name, expected", [
    ("\tThunnus Albacares \n", "thunnus albacares"), (" Abc ", "abc"),
    ("a  b", "a  b"), ("ÉTÉ", "été"), ("", ""),
])
def test_normalised_name(spark, name, expected):
    assert one(spark, normalised_name(F.lit(name))) == expected


@pytest.mark.parametrize("name, expected", [
    ("Thunnus albacares", "Thunnus_albacares"), ("A. b (Linné, 1758)", "A_b_Linné_1758"),
    ("x²_y-z/..", "x²_yz"),
])
def test_species_key(spark, name, expected):
    assert one(spark, species_key(F.lit(name))) == expected


@pytest.mark.parametrize("text, expected", [
    ("1999-07-03", datetime(1999, 7, 3)), ("1999-07-03T04:05:06Z", datetime(1999, 7, 3, 4, 5, 6)),
    ("1999-07-03 04:05:06+05:30", datetime(1999, 7, 2, 22, 35, 6)), ("1999", datetime(1999, 1, 1)),
    ("1999-07", datetime(1999, 7, 1)), ("1998-01-01/1998-01-31", None), ("", None),
    ("1/2/2020", None), ("junk", None), (None, None),
])
def test_event_timestamp(spark, text, expected):
    assert one(spark, event_timestamp(F.lit(text).cast("string"))) == expected


def frame(spark, names):
    return spark.createDataFrame(list(enumerate(names)), "occ_id long, species string")


def test_first_spelling_wins_and_others_do_not_count(spark):
    df = frame(spark, ["ABC", "abc", "ABC", "x", None, " abc"])
    assert rows(species.find_species(df, " aBc\t")) == [("abc", "ABC", 2)]
    assert rows(species.species_records(df, "abc").select("occ_id")) == [(0,), (2,)]
    assert species.species_records(df, "unknown").count() == 0


def test_gate(spark):
    df = frame(spark, ["a"] * 10 + ["b"] * 9)
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("A",)], "species string")
    assert rows(species.species_gate(df, names)) == [
        ("A", 0, "empty"), ("a", 10, "ok"), ("b", 9, "low"), ("c", 0, "empty")]


def test_ties_go_to_the_smaller_name(spark):
    df = frame(spark, ["b", "a", "c", "b", "a"])
    assert [tuple(r) for r in species.most_recorded(df, 2).collect()] == [("a", 2), ("b", 2)]
    assert rows(profile.modal_species(df)) == [("a",)]


def test_cleaning_counts_nan_as_missing_and_takes_what_exists(spark):
    raw = spark.createDataFrame(
        [(1, "x", 1.0, 2.0, "k"), (2, None, 1.0, 2.0, "k"), (3, "x", float("nan"), 2.0, "k")],
        "occ_id long, species string, decimalLatitude double, decimalLongitude double, other string")
    clean = cleaning.clean_occurrences(raw)
    assert clean.columns == ["occ_id", "species", "decimalLatitude", "decimalLongitude"]
    assert rows(clean.select("occ_id")) == [(1,)]


def test_polygon_equals_box_and_keeps_notch_out(spark):
    points = spark.range(400).select(
        (F.col("id") % 20 + 0.5).alias("lon"), (F.floor(F.col("id") / 20) + 0.5).alias("lat"))
    square = [(5.0, 5.0), (15.0, 5.0), (15.0, 15.0), (5.0, 15.0), (5.0, 5.0)]
    inside = points.where(in_polygon(F.col("lat"), F.col("lon"), square))
    assert inside.count() == 100
    notched = [(0.0, 0.0), (20.0, 0.0), (20.0, 20.0), (10.0, 10.0), (0.0, 20.0)]
    got = points.where(in_polygon(F.col("lat"), F.col("lon"), notched))
    assert got.where("lat > 12 and lon between 9 and 11").count() == 0
    assert got.where("lat < 9").count() == 180


def test_variables_are_taken_as_a_pair(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "temperature double, thetao double, so double")
    assert ocean.standard_variables(df).columns == ["temperature", "temperature_C", "salinity_PSU"]
    with pytest.raises(ValueError):
        ocean.standard_variables(df.select("temperature", "so"))


def test_surface_rows(spark):
    nan = float("nan")
    slices = spark.createDataFrame(
        [(7.0, 1, [1.0, 2.0], [5.0, 6.0, 7.0], [[1.0] * 3] * 2, [[1.0] * 3] * 2),
         (9.0, 0, [1.0, 2.0], [5.0, 6.0, 7.0], [[1.0, 2.0, nan], [4.0, 5.0, 6.0]],
          [[10.0, 20.0, 30.0], [40.0, None, 60.0]])],
        "depth double, depth_idx int, lat array<double>, lon array<double>, "
        "thetao array<array<double>>, so array<array<double>>")
    got = ocean.surface_rows(slices).drop("depth_idx")
    assert rows(got) == [
        (9.0, 1.0, 5.0, 1.0, 10.0), (9.0, 1.0, 6.0, 2.0, 20.0),
        (9.0, 2.0, 5.0, 4.0, 40.0), (9.0, 2.0, 7.0, 6.0, 60.0)]
    assert ocean.surface_layer(slices.drop("depth_idx")).count() == 2


def test_within_year_ends_with_the_last_second(spark):
    df = spark.createDataFrame(
        [("2020-12-31 23:59:59",), ("2020-12-31 23:59:59.5",), ("2020-01-01 00:00:00",),
         ("2019-12-31 23:59:59",)], "t string").select(F.col("t").cast("timestamp").alias("time"))
    assert ocean.within_year(df, 2020).count() == 2


def test_even_spacing(spark):
    got = spark.range(3).select(evenly_spaced(F.col("id"), 3, F.lit(2.0), F.lit(4.0)))
    assert rows(got) == [(2.0,), (3.0,), (4.0,)]
    assert one(spark, evenly_spaced(F.col("id"), 1, F.lit(2.0), F.lit(4.0))) == 2.0


def test_report_when_a_class_is_never_predicted(spark):
    pred = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    report = {r.name: r for r in evaluation.classification_report(pred).collect()}
    assert tuple(report["Presence"])[1:] == (0.0, 0.0, 0.0, 1)
    assert report["Absence"].precision == pytest.approx(2 / 3)
    assert report["accuracy"].f1 == pytest.approx(2 / 3)
    assert report["macro avg"].recall == 0.5
    assert rows(evaluation.confusion_matrix(pred)) == [(0, 0, 2), (0, 1, 0), (1, 0, 1), (1, 1, 0)]
    empty = evaluation.classification_report(pred.where("label > 5")).collect()
    assert all(r.support == 0 and r.f1 == 0.0 for r in empty)


def test_bands_end_with_one(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.999,), (1.0,)], "p double")
    assert [r[0] for r in df.select(grid.probability_band(F.col("p"))).collect()] == [1, 2, 20, 20]
