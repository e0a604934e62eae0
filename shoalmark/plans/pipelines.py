"""The operators put together: land, fuse, model, explore."""

from __future__ import annotations

import warnings

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalmark.operators.cleaning import clean_occurrences, cleaning_audit, within_region
from shoalmark.operators.evaluation import accuracy, classification_report, confusion_matrix
from shoalmark.operators.fusion import fuse
from shoalmark.operators.grid import density
from shoalmark.operators.model import feature_columns, prediction_surface, train_and_test
from shoalmark.operators.nearest import build_index
from shoalmark.operators.profile import (
    column_profile, head_rows, missing_dates, modal_species, summary_statistics, yearly_counts)
from shoalmark.operators.regions import within_wkt
from shoalmark.operators.species import few_or_none, most_recorded, species_gate, suggestions
from shoalmark.operators.training import ENVIRONMENT, shuffled, training_set, training_sets
from shoalmark.schemas import OCEAN
from shoalmark.session import configure, stage
from shoalmark.sources.landing import (
    PAGE_SIZE, first_records, land_pages, page_gaps, read_pages, stop_on_conflicts)
from shoalmark.sources.models import save_model
from shoalmark.sources.tables import (
    landed_years, read_csv, read_year_files, write_by_species, write_csv, write_landing, write_ocean,
    write_parquet)


def land_occurrences(spark: SparkSession, pages_path: str, out_path: str, limit: int | None = None,
                     region: str | None = None, page_size: int = PAGE_SIZE,
                     keep_conflicts: bool = False) -> dict[str, DataFrame]:
    """Landed pages to the clean occurrence table, inside the study region or one given as text.

    Keeps all records, or with ``limit`` those of the region that landed first. Stops if
    nothing is left after cleaning, and if pages disagree on a record, unless
    ``keep_conflicts``. Also gives what cleaning removed, which pages lack, and ``pages`` and
    ``conflicts``: the audit of ``land_pages`` and the versions of records it did not take.
    """
    configure(spark)
    pages = read_pages(spark, pages_path)
    landing = land_pages(pages, page_size)
    if not keep_conflicts:
        stop_on_conflicts(landing)
    inside = within_region(landing.records) if region is None else within_wkt(landing.records, region)
    if limit is not None:
        inside = first_records(inside, limit)
    inside = stage(inside, "landed")
    write_parquet(clean_occurrences(inside), out_path)
    clean = spark.read.parquet(out_path)
    if clean.isEmpty():
        raise ValueError("no record is left after cleaning")
    return {"occurrences": clean, "audit": cleaning_audit(inside), "gaps": page_gaps(pages, page_size),
            "pages": landing.audit, "conflicts": landing.conflicts}


def land_ocean_csv(spark: SparkSession, pattern: str, out_path: str) -> None:
    """Flat ocean files, one per year, to the table partitioned by year."""
    configure(spark)
    write_ocean(read_csv(spark, pattern, OCEAN), out_path)


def land_ocean_years(spark: SparkSession, files: dict[int, str], out_path: str) -> list[int]:
    """Land the files of the years that the table does not have yet; returns those years.

    All missing years are read by one job. Every row is kept, also one of another year than its
    file's or without a time (the nearest join takes both): read the table with ``read_ocean``.
    ``read_landings`` tells how many there are.
    """
    configure(spark)
    there = set(landed_years(spark, out_path))
    missing = {year: files[year] for year in sorted(set(files) - there)}
    if missing:
        write_landing(stage(read_year_files(spark, missing, OCEAN), "ocean-years"), out_path, list(missing))
    return list(missing)


def fuse_tables(occurrences: DataFrame, ocean: DataFrame, out_path: str) -> DataFrame:
    configure(occurrences.sparkSession)
    write_parquet(fuse(occurrences, ocean), out_path)
    return occurrences.sparkSession.read.parquet(out_path)


def species_training(fused: DataFrame, name: str, with_environment: bool) -> DataFrame:
    """The staged training rows of one species.

    An unknown name raises and says which species have the most records; one with few
    records warns.
    """
    rows = stage(training_set(fused, name, with_environment), "training")
    presences = rows.where("presence = 1").count()
    status = few_or_none(presences)
    if status == "empty":
        offer = ", ".join(r.species for r in suggestions(fused).collect())
        raise ValueError(f"no species {name!r}; the most recorded are: {offer}")
    if status == "low":
        warnings.warn(f"{name!r} has only {presences} records", stacklevel=2)
    return rows


def prepare_species(fused: DataFrame, name: str, out_path: str,
                    with_environment: bool = True) -> DataFrame:
    """Write the shuffled training file of one species."""
    rows = species_training(fused, name, with_environment)
    write_csv(shuffled(rows).drop("occ_id", "draw", "species"), out_path)
    return rows


def prepare_all(fused: DataFrame, out_path: str, with_environment: bool = True) -> DataFrame:
    """Write the training rows of every species, a folder each, and return each one's gate.

    Stops if two species share a folder's name.
    """
    rows = stage(training_sets(fused, with_environment), "training")
    write_by_species(rows, out_path)
    return species_gate(rows.where("presence = 1"), rows)


def model_species(fused: DataFrame, name: str, model_base: str,
                  with_environment: bool = True) -> dict[str, DataFrame | PipelineModel | str]:
    """Train, evaluate and save the model of one species."""
    spark = configure(fused.sparkSession)
    model, tested = train_and_test(species_training(fused, name, with_environment), with_environment)
    tested = stage(tested, "tested")
    return {
        "model": model,
        "path": save_model(model, spark, model_base, name),
        "accuracy": accuracy(tested),
        "report": classification_report(tested),
        "confusion": confusion_matrix(tested),
    }


def map_species(model: PipelineModel, occurrences: DataFrame, ocean: DataFrame,
                name: str | None = None) -> dict[str, DataFrame]:
    """Surface of presence probability, and the recorded points of a species to lay over it.

    Without a name the points are those of the species with the most records.
    """
    index = None
    if set(ENVIRONMENT) & set(feature_columns(model)):
        index = build_index(ocean, by_year=False)
    return {
        "surface": prediction_surface(model, occurrences, index),
        "points": overlay(occurrences, name).select("species", "decimalLatitude", "decimalLongitude"),
    }


def overlay(occurrences: DataFrame, name: str | None = None) -> DataFrame:
    """Records of a species to lay over its map: without a name, of the most recorded one."""
    target = modal_species(occurrences).scalar() if name is None else F.lit(name)
    return occurrences.where(F.col("species") == target)


def explore(occurrences: DataFrame) -> dict[str, DataFrame]:
    """The tables behind a first look at the records."""
    configure(occurrences.sparkSession)
    tables = {
        "head": head_rows(occurrences),
        "profile": column_profile(occurrences),
        "summary": summary_statistics(occurrences),
        "top_species": most_recorded(occurrences, 20),
        "yearly": yearly_counts(occurrences),
        "missing_dates": missing_dates(occurrences),
    }
    if {"decimalLatitude", "decimalLongitude"} <= set(occurrences.columns):
        tables["density"] = density(occurrences)
    if "phylum" in occurrences.columns:
        tables["top_phyla"] = most_recorded(occurrences, 10, "phylum")
    return tables
