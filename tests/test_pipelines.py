"""From landed files to a map, with the files in between."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import DATA, rows
from shoalmark import session
from shoalmark.plans import pipelines
from shoalmark.plans.fixtures import view
from shoalmark.session import scratch_path
from shoalmark.sources.tables import with_year


def test_landed_files_to_map(spark):
    raw = view(spark, DATA, "occ_raw")
    pages, clean_path, sea_path = (scratch_path(spark, n) for n in ("pages", "clean", "sea"))
    raw.groupBy((F.floor(F.col("occ_id") / 10_000) * 10_000).alias("offset")).agg(
        F.collect_list(F.struct(*raw.columns)).alias("results")).write.json(pages)
    landed = pipelines.land_occurrences(spark, pages, clean_path)
    clean = landed["occurrences"]
    assert landed["gaps"].count() == 0 and landed["audit"].first().rows_after == clean.count()
    assert clean.count() == view(spark, DATA, "fused").count()
    assert clean.columns[:3] == ["occ_id", "species", "decimalLatitude"]

    csv = scratch_path(spark, "sea-csv")
    sea = view(spark, DATA, "ocean").drop("ocean_id")
    with_year(sea).write.option("header", True).partitionBy("year").csv(csv)
    pipelines.land_ocean_csv(spark, f"{csv}/year=*/*.csv", sea_path)
    stored = spark.read.parquet(sea_path)
    assert rows(stored.groupBy("year").count()) == rows(
        with_year(sea).groupBy("year").count())

    fused = pipelines.fuse_tables(clean, stored, scratch_path(spark, "fused"))
    assert fused.count() == clean.count()
    assert fused.where("temperature_C is null or eventYear is null").count() == 0

    result = pipelines.model_species(fused, "Purchase", scratch_path(spark, "models"))
    assert result["path"].endswith("/Purchase/random_forest_model")
    assert 0.0 <= result["accuracy"].first()[0] <= 1.0
    assert result["report"].count() == 5 and result["confusion"].count() == 4

    maps = pipelines.map_species(result["model"], fused, stored)
    assert maps["surface"].count() == 40_000
    assert maps["points"].select("species").distinct().count() == 1


def test_gates(spark):
    empty = scratch_path(spark, "pages")
    spark.createDataFrame([(0, [(None, None, None)])], "offset long, results array<struct<"
                          "species: string, decimalLatitude: double, decimalLongitude: double>>").write.json(empty)
    with pytest.raises(ValueError, match="no record"):
        pipelines.land_occurrences(spark, empty, scratch_path(spark, "clean"))
    fused = view(spark, DATA, "fused")
    with pytest.raises(ValueError, match="most recorded are"):
        pipelines.model_species(fused, "no such", scratch_path(spark, "models"))
    few = fused.where("species = 'click'").limit(3)
    with pytest.warns(UserWarning, match="only 3 records"):
        pipelines.prepare_species(few, "click", scratch_path(spark, "training"))


def test_all_species_and_a_limit(spark):
    fused = view(spark, DATA, "fused").withColumn("species", F.lower(F.trim("species")))
    path = scratch_path(spark, "all")
    gate = pipelines.prepare_all(fused, path, with_environment=False)
    assert {r.status for r in gate.collect()} == {"ok"}
    assert spark.read.parquet(path).count() == 2 * fused.count()
    pages = scratch_path(spark, "pages")
    raw = view(spark, DATA, "occ_raw")
    raw.groupBy((F.floor(F.col("occ_id") / 100) * 100).alias("offset")).agg(
        F.array_sort(F.collect_list(F.struct(*raw.columns))).alias("results")).write.json(pages)
    landed = pipelines.land_occurrences(spark, pages, scratch_path(spark, "clean"), limit=50)
    assert landed["audit"].first().rows_before == 50


def context(master):
    made = []
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda *a: None),
        sparkContext=SimpleNamespace(
            master=master, getCheckpointDir=lambda: made[-1] if made else None,
            setCheckpointDir=made.append))


def test_own_folder_in_a_local_session_only():
    local = context("local[2]")
    assert session.scratch_dir(local) == session.scratch_dir(local)
    with pytest.raises(RuntimeError):
        session.scratch_dir(context("spark://cluster:7077"))
