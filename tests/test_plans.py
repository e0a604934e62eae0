"""What the planner makes of the operators."""

from pyspark.sql import functions as F

from conftest import DATA
from shoalmark.operators import cleaning, nearest, ocean, profile
from shoalmark.operators.fusion import fuse
from shoalmark.operators.joins import hot_keys
from shoalmark.operators.nearest import build_index
from shoalmark.operators.species import spellings
from shoalmark.operators.training import training_set, training_sets
from shoalmark.plans.fixtures import view
from shoalmark.session import stage


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_range_reaches_the_scan(spark):
    text = plan(ocean.within_year(view(spark, DATA, "ocean"), 1997))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThanOrEqual(o_orderdate" in text


def test_region_reaches_the_scan_of_a_stored_table(spark):
    stored = stage(view(spark, DATA, "occ"), "occ")
    text = plan(cleaning.within_region(stored))
    assert "GreaterThanOrEqual(decimalLatitude,8.0)" in text
    assert "LessThanOrEqual(decimalLongitude,97.0)" in text


def test_counts_read_one_column(spark):
    stored = stage(view(spark, DATA, "occ"), "occ")
    assert "ReadSchema: struct<eventDate:string>" in plan(profile.yearly_counts(stored))
    assert "ReadSchema: struct<species:string>" in plan(profile.counts(stored, "species"))


def test_top_k_is_not_a_full_sort(spark):
    text = plan(profile.modal_species(view(spark, DATA, "taxa")))
    assert "TakeOrderedAndProject" in text


def test_training_set_has_no_cross_join(spark):
    text = plan(training_set(view(spark, DATA, "fused"), "click", with_environment=True))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_the_walk_shuffles_once_when_the_tree_is_small(spark):
    occ = view(spark, DATA, "occ")
    index = build_index(view(spark, DATA, "ocean").drop("ocean_id"))
    fused = fuse(occ, index)
    text = plan(fused)
    assert text.count(" Exchange ") == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_sort_aggregate_over_raw_ocean_rows_or_candidates(spark):
    text = plan(nearest.representatives(view(spark, DATA, "ocean").drop("ocean_id")))
    below = text[text.rindex("SortAggregate"):]
    assert "BroadcastHashJoin" in below  # only the rows of the first time are ordered
    index = build_index(view(spark, DATA, "ocean").drop("ocean_id"))
    queries = spark.createDataFrame([(9.0, 70.0, nearest.ALL_YEARS)], "q_lat double, q_lon double, q_scope int")
    assert "SortAggregate" not in plan(nearest.match(queries, index))


def test_a_heavy_spelling_that_is_not_the_first_is_salted(spark, no_broadcast):
    rows = spark.range(4000).select(
        F.col("id").alias("occ_id"), F.when(F.col("id") == 0, "click").otherwise("CLICK").alias("species"),
        F.lit(1.0).alias("decimalLatitude"), F.lit(1.0).alias("decimalLongitude"))
    parts = hot_keys(spellings(rows).select("species", "n"), ["species"]).collect()
    assert {r.species for r in parts} == {"CLICK"} and parts[0]["__parts"] > 1
    sets = training_sets(rows)
    assert "__salt" in plan(sets) and sets.count() == 2


def test_beyond_the_budget_hot_keys_are_salted(spark, no_broadcast):
    occ = view(spark, DATA, "occ").withColumn("decimalLatitude", F.lit(10.0)).withColumn(
        "decimalLongitude", F.lit(70.0))
    index = build_index(view(spark, DATA, "ocean").drop("ocean_id"))
    fused = fuse(occ, index)
    assert "__salt" in plan(fused)
    assert fused.count() == occ.count()
