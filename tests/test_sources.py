import json
from pathlib import Path

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from conftest import rows
from shoalmark.schemas import OCCURRENCE, OCEAN, OCEAN_WITH_YEAR
from shoalmark.plans import pipelines
from shoalmark.session import release_staged, scratch_dir, scratch_path, stage
from shoalmark.sources.landing import first_records, landed_records, page_gaps, read_pages
from shoalmark.sources.models import save_model
from shoalmark.sources.tables import (
    landed_years, read_csv, read_ocean, write_by_species, write_csv, write_ocean, years_to_fetch)


def land(spark, tmp_path, pages):
    with open(tmp_path / "pages.json", "w") as out:
        for offset, ids in pages:
            out.write(json.dumps({"offset": offset, "results": [
                {"occ_id": i, "species": f"s{i}", "unknown": 1} for i in ids]}) + "\n")
    return read_pages(spark, str(tmp_path))


def names(df):
    return [(r.occ_id, r.species) for r in df.orderBy("occ_id").collect()]


def gaps(pages):
    return rows(page_gaps(pages, 2))


def test_all_landed_pages_are_kept_and_gaps_told(spark, tmp_path):
    pages = land(spark, tmp_path, [(0, [1, 2]), (2, [3]), (6, [7, 8]), (8, [])])
    assert names(landed_records(pages)) == [(0, "s1"), (1, "s2"), (2, "s3"), (6, "s7"), (7, "s8")]
    assert gaps(pages) == [(2, "short"), (4, "missing")]


def test_a_first_page_that_lacks_is_a_gap(spark, tmp_path):
    pages = land(spark, tmp_path, [(2, [3, 4])])
    assert names(landed_records(pages)) == [(2, "s3"), (3, "s4")]
    assert gaps(pages) == [(0, "missing")]


def test_no_gap(spark, tmp_path):
    assert gaps(land(spark, tmp_path, [(2, [3]), (0, [1, 2])])) == []
    assert gaps(land(spark, tmp_path, [])) == []


def test_ids_are_given_at_landing(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"offset": 0, "results": [{"species": "a"}, {"species": "b"}]}\n{"offset": 2, "results": [{"species": "c"}]}')
    assert names(landed_records(read_pages(spark, str(tmp_path)))) == [(0, "a"), (1, "b"), (2, "c")]


def test_a_page_without_an_offset_raises(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"results": [{"species": "a"}]}')
    with pytest.raises(Exception, match="no offset"):
        landed_records(read_pages(spark, str(tmp_path))).collect()


def test_first_records(spark, tmp_path):
    pages = land(spark, tmp_path, [(0, [1, 2]), (2, [3, 4]), (4, [5, 6])])
    assert names(first_records(landed_records(pages), 3)) == [(0, "s1"), (1, "s2"), (2, "s3")]
    assert landed_records(pages).count() == 6


def test_csv_keeps_quotes_line_breaks_and_blanks(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame(
        [(1, 'a "b", c', 1.5, None), (2, " x\ny ", None, 2.0)],
        "occ_id long, species string, decimalLatitude double, decimalLongitude double")
    write_csv(df, path)
    back = read_csv(spark, path, OCCURRENCE, multi_line=True).select(*df.columns)
    assert rows(back) == rows(df)


def test_csv_columns_by_name_with_bad_values_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "extra,decimalLongitude,species,decimalLatitude\nq,70.5,NA,NA\nq,nan,Abc,1\n")
    got = read_csv(spark, str(tmp_path / "a.csv"), OCCURRENCE)
    assert got.columns == OCCURRENCE.fieldNames()
    assert rows(got.select("species", "decimalLatitude", "decimalLongitude", "phylum")) == [
        ("Abc", 1.0, None, None), ("NA", None, 70.5, None)]


def test_csv_files_with_other_column_orders(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("species,decimalLatitude\nx,1\ny,2\n")
    (tmp_path / "b.csv").write_text("decimalLatitude,extra,species\n3,q,z\n")
    (tmp_path / "c.csv").write_text("species,decimalLatitude\nw,4\n")
    got = read_csv(spark, str(tmp_path / "*.csv"), OCCURRENCE)
    assert rows(got.select("species", "decimalLatitude", "genus")) == [
        ("w", 4.0, None), ("x", 1.0, None), ("y", 2.0, None), ("z", 3.0, None)]


def test_landed_years_come_from_folders(spark, tmp_path):
    path = scratch_path(spark, "ocean")
    assert landed_years(spark, path) == []
    write_ocean(ocean(spark, [2020, 2022]), path)
    assert landed_years(spark, path) == [2020, 2022]
    files = {}
    for year in (2020, 2021, 2022):
        files[year] = str(tmp_path / f"{year}.csv")
        Path(files[year]).write_text(f"latitude,time,longitude\n1,{year}-03-01 00:00:00,2\n")
    assert pipelines.land_ocean_years(spark, files, path) == [2021]
    assert rows(read_ocean(spark, path, OCEAN_WITH_YEAR).select("year", "latitude")) == [
        (2020, 1.0), (2021, 1.0), (2022, 1.0)]
    assert pipelines.land_ocean_years(spark, files, path) == []


def test_names_with_one_key_cannot_overwrite_each_other(spark):
    clash = spark.createDataFrame([(1, "A b"), (2, "A_b")], "occ_id long, species string")
    with pytest.raises(ValueError, match="A_b"):
        write_by_species(clash, scratch_path(spark, "species"))
    base, fitted = scratch_path(spark, "models"), Pipeline(stages=[]).fit(clash)
    save_model(fitted, spark, base, "A b")
    save_model(fitted, spark, base, "A b")
    with pytest.raises(ValueError, match="A b"):
        save_model(fitted, spark, base, "A_b")


def test_staged_tables_are_released_by_one_call(spark):
    staged = stage(spark.range(3), "three")
    folder = staged.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
    assert Path(folder).exists()
    assert release_staged(spark) >= 1
    assert not Path(folder).exists()


def ocean(spark, years):
    return spark.range(len(years)).select(
        F.element_at(F.array(*[F.lit(f"{y}-06-01").cast("timestamp") for y in years]),
                     F.col("id").cast("int") + 1).alias("time"),
        *[F.lit(1.0).alias(c) for c in OCEAN.fieldNames()[1:]])


def test_ocean_years_are_replaced_one_by_one(spark):
    path = scratch_path(spark, "ocean")
    write_ocean(ocean(spark, [2020, 2020, 2021]), path)
    write_ocean(ocean(spark, [2021, 2021, 2022]), path)
    stored = read_ocean(spark, path, OCEAN_WITH_YEAR)
    assert rows(stored.groupBy("year").count()) == [(2020, 2), (2021, 2), (2022, 1)]
    wanted = spark.createDataFrame([(y,) for y in (2019, 2020, 2022, 2023)], "year int")
    assert rows(years_to_fetch(wanted, stored)) == [(2019,), (2023,)]


def test_a_year_filter_prunes_folders(spark):
    path = scratch_path(spark, "ocean")
    write_ocean(ocean(spark, [2020, 2021]), path)
    plan = read_ocean(spark, path, OCEAN_WITH_YEAR).where("year = 2021")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text


def test_species_folders(spark):
    path = scratch_path(spark, "species")
    write_by_species(spark.createDataFrame(
        [(1, "Abc déf (x)"), (2, "A_b")], "occ_id long, species string"), path)
    assert rows(spark.read.parquet(path).select("occ_id", "species_key")) == [
        (1, "Abc_déf_x"), (2, "A_b")]


def test_staged_tables_lie_in_the_shared_folder(spark):
    staged = stage(spark.range(3), "three")
    assert staged.count() == 3
    folder = scratch_dir(spark).split(":")[-1]
    assert all(folder in f for f in staged.inputFiles())
