import pytest
from pyspark.sql import functions as F

from conftest import DATA, rows
from shoalmark.functions.numbers import seeded_hash
from shoalmark.operators import model, split
from shoalmark.operators.nearest import build_index
from shoalmark.operators.split import assign_split
from shoalmark.operators.training import pseudo_absences, shuffled, training_set, training_sets
from shoalmark.plans import pipelines
from shoalmark.plans.fixtures import view
from shoalmark.session import scratch_path
from shoalmark.sources.models import load_model, model_path


@pytest.fixture(scope="module")
def fused(spark):
    return view(spark, DATA, "fused")


def test_exact_absence_count_inside_the_box(fused):
    box = fused.agg(F.min("decimalLatitude"), F.max("decimalLatitude")).first()
    absent = pseudo_absences(fused, fused, ratio=3)
    assert absent.count() == 3 * fused.count()
    assert absent.where(~F.col("decimalLatitude").between(*box)).count() == 0


@pytest.mark.parametrize("make", [
    # Means are rounded: the last digit of a sum of doubles depends on its order.
    lambda df: training_set(df, "click", with_environment=True).withColumns(
        {c: F.round(c, 9) for c in ("temperature", "salinity")}),
    lambda df: training_sets(df),
    lambda df: assign_split(training_set(df, "view"), "presence", ["occ_id", "draw"]),
])
def test_seeded_rows_do_not_depend_on_partitions(fused, make):
    assert rows(make(fused.repartition(1))) == rows(make(fused.repartition(7)))


def test_another_seed_gives_other_points(fused):
    assert rows(training_set(fused, "click", seed=1)) != rows(training_set(fused, "click", seed=2))


def test_shuffled_order_is_repeatable_and_not_by_class(fused):
    df = training_set(fused, "click")
    first = [tuple(r) for r in shuffled(df).collect()]
    assert first == [tuple(r) for r in shuffled(df.repartition(5)).collect()]
    labels = [r[-1] for r in first]
    assert labels != sorted(labels) and labels != sorted(labels, reverse=True)


def test_training_sets_beyond_the_broadcast_budget(fused, no_broadcast):
    keys = ["species", "occ_id", "draw", "presence"]
    assert rows(training_sets(fused).where("species = 'click'").select(keys)) == rows(
        training_set(fused, "click").select(keys))


def split_counts(spark, labels, **options):
    df = spark.createDataFrame(list(enumerate(labels)), "id long, label int")
    split = assign_split(df, "label", ["id"], **options)
    assert split.count() == len(labels)
    return {(r.label, r.role): r["count"] for r in split.groupBy("label", "role").count().collect()}


@pytest.mark.parametrize("labels, tested", [
    ([0, 1], None), ([0, 0, 1], None), ([0, 0, 1, 1], {0: 1, 1: 1}),
    ([0] * 7 + [1] * 3, {0: 2, 1: 1}), ([0] * 5 + [1] * 5, {0: 2, 1: 1}),
    ([0] * 90 + [1] * 10, {0: 27, 1: 3}),
])
def test_split_has_exact_class_counts(spark, labels, tested):
    got = split_counts(spark, labels)
    if tested is None:
        assert {role for _, role in got} == {"both"}
    else:
        assert {k: got.get((k, "test"), 0) for k in (0, 1)} == tested


def test_split_beyond_the_broadcast_budget(spark, no_broadcast):
    got = split_counts(spark, [0] * 70 + [1] * 30)
    assert (got[0, "test"], got[1, "test"]) == (21, 9)


def test_split_tests_the_smallest_hashes_whatever_the_buckets(spark, monkeypatch):
    df = spark.range(30_000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    hashes = df.withColumn("h", seeded_hash(42, "split", F.col("id"))).collect()
    expected = set()
    for label, n_test in ((0, 6000), (1, 3000)):
        expected |= {r.id for r in sorted((r for r in hashes if r.label == label), key=lambda r: r.h)[:n_test]}
    assert 16 ** split.BUCKET_DIGITS <= 4096  # tasks count these before the shuffle, however many rows
    for digits in (split.BUCKET_DIGITS, 1, 5):
        monkeypatch.setattr(split, "BUCKET_DIGITS", digits)
        tested = assign_split(df, "label", ["id"]).where("role = 'test'").select("id").collect()
        assert len(tested) == 9000 and {r.id for r in tested} == expected


def separable(spark, n):
    """Presences in the north, absences in the south, some temperatures missing."""
    return spark.range(n).select(
        F.col("id").alias("occ_id"), F.lit(0).alias("draw"),
        (F.col("id") % 2).cast("int").alias("presence"),
        (F.col("id") % 97 / 10 + F.when(F.col("id") % 2 == 1, 20).otherwise(8)).cast("double")
        .alias("decimalLatitude"),
        (68 + F.col("id") % 29).cast("double").alias("decimalLongitude"),
        F.when(F.col("id") % 5 > 0, 20.0 + F.col("id") % 7).alias("temperature"),
        F.lit(35.0).alias("salinity"))


def test_forest_learns_survives_saving_and_is_repeatable(spark):
    rows_in = separable(spark, 400)
    fitted, tested = model.train_and_test(rows_in, trees=10)
    assert tested.count() == 120
    assert tested.where("label = prediction").count() / 120 > 0.9
    assert tested.where("p < 0 or p > 1 or p is null").count() == 0
    assert tested.where("temperature is null").count() > 0
    path = scratch_path(spark, "model")
    fitted.write().overwrite().save(path)
    again, tested_again = model.train_and_test(rows_in.repartition(5), trees=10)
    keep = ["occ_id", "prediction", "p"]
    assert rows(tested.select(keep)) == rows(tested_again.select(keep))
    assert rows(model.score(load_model(path), tested.drop("prediction", "p")).select(keep)) == rows(
        tested.select(keep))


def test_few_rows_use_coordinates_only(spark):
    fitted, tested = model.train_and_test(separable(spark, 3), trees=3)
    assert model.feature_columns(fitted) == ["decimalLatitude", "decimalLongitude"]
    assert tested.count() == 3


def test_pipelines_from_training_to_map(spark, fused):
    with pytest.raises(ValueError, match="most recorded"):
        pipelines.prepare_species(fused, "no such", scratch_path(spark, "out"))
    out = scratch_path(spark, "out")
    prepared = pipelines.prepare_species(fused, "CLICK", out)
    assert spark.read.option("header", True).csv(out).count() == prepared.count()
    occ = view(spark, DATA, "occ")
    sea = view(spark, DATA, "ocean").drop("ocean_id")
    fitted, _ = model.train_and_test(separable(spark, 100), trees=3)
    surface = model.prediction_surface(fitted, occ, build_index(sea, by_year=False), steps=12)
    assert surface.count() == 144
    assert surface.where("p between 0 and 1").count() == 144
    shown = pipelines.explore(view(spark, DATA, "taxa").withColumnRenamed("line_key", "occ_id"))
    assert shown["top_phyla"].count() == 5


def test_model_folder_by_species(spark):
    assert model_path(spark, "/base", "A. b") == "/base/A_b/random_forest_model"


def test_forest_settings_do_not_depend_on_the_number_of_rows(spark):
    def depth(n):
        rows = spark.range(n).selectExpr(
            "id as occ_id", "0 as draw", "cast(id % 7 as double) as decimalLatitude",
            "cast(id % 11 as double) as decimalLongitude", "cast(id % 2 as int) as presence")
        forest = model.fit_forest(rows, ["decimalLatitude", "decimalLongitude"], trees=1).stages[-1]
        return {p.name: v for p, v in forest.extractParamMap().items()}

    assert depth(19_999) == depth(20_001)


def test_no_and_negative_absences(spark):
    rows = spark.createDataFrame([(1, 1.0, 2.0)], "occ_id long, decimalLatitude double, decimalLongitude double")
    assert pseudo_absences(rows, rows, ratio=0).count() == 0
    assert pseudo_absences(rows, rows, ratio=3).count() == 3
    with pytest.raises(ValueError):
        pseudo_absences(rows, rows, ratio=-1)


def test_null_keys_are_told_apart(spark):
    rows = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert rows.select(seeded_hash(1, "t", F.col("x"), F.col("y"))).distinct().count() == 2
