"""The registered queries: each operator run over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalmark.functions.geo import REGION_WKT, in_polygon
from shoalmark.functions.text import normalised_name, species_key
from shoalmark.functions.time import event_timestamp, event_year
from shoalmark.operators import cleaning, evaluation, forest, grid, model, ocean, profile, regions, species
from shoalmark.operators.fusion import fuse
from shoalmark.operators.nearest import MATCHED, attach_nearest, build_index
from shoalmark.operators.split import assign_split
from shoalmark.operators.training import (
    pseudo_absences, shuffled, training_set, training_sets)
from shoalmark.plans import all_species, pipelines
from shoalmark.plans.fixtures import view
from shoalmark.schemas import OCCURRENCE, OCEAN, OCEAN_WITH_YEAR
from shoalmark.session import configure, scratch_path, stage
from shoalmark.sources import landing, tables
from shoalmark.sources.models import load_model, save_model

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

POINT = ("decimalLatitude", "decimalLongitude")
# A five-cornered area (lon, lat) inside the region, with one corner pointing inwards.
AREA = ((70.0, 9.0), (90.0, 12.0), (95.0, 33.0), (82.0, 20.0), (71.0, 30.0))


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    run.__wrapped__ = function
    QUERIES[function.__name__.removesuffix("_query")] = run
    return run


def ocean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "ocean").drop("ocean_id")


# --- sources and sinks ---------------------------------------------------------------


def landed(spark: SparkSession, sf_dir: str, page_size: int) -> DataFrame:
    """The ``occ`` view written as pages and landed again."""
    occ = view(spark, sf_dir, "occ")
    offset = F.floor(F.col("occ_id") / page_size) * page_size
    pages = occ.groupBy(offset.alias("offset")).agg(
        F.array_sort(F.collect_list(F.struct(*occ.columns))).alias("results"))
    path = scratch_path(spark, "pages")
    pages.write.json(path)
    return landing.landed_records(landing.read_pages(spark, path)).select(*occ.columns)


@query
def landing_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, 1000)


@query
def landing_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.first_records(landed(spark, sf_dir, 100), 750)


@query
def landing_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = landed(spark, sf_dir, 1000)
    return landing.first_records(records, records.count() // 2)


def downloaded_again(spark: SparkSession, sf_dir: str) -> landing.Landing:
    """The ``occ`` view landed from pages of 100 as several broken downloads leave them: pages
    that lack, that landed twice, that begin half-way into others, that are too long, and that
    have other names in them."""
    occ = view(spark, sf_dir, "occ")
    place, page = F.col("occ_id"), F.floor(F.col("occ_id") / 100) * 100
    half = F.floor((place - 50) / 100) * 100
    other_name = F.when(place % 2 == 0, F.upper("species")).otherwise(F.col("species"))
    long = F.floor((place - 200) / 1300) * 1300 + 200
    kinds = [
        ("first", occ.withColumn("offset", page).where("offset % 1100 <> 500")),
        ("again", occ.withColumn("offset", page).where("offset % 300 = 0 and offset % 1100 <> 500")),
        ("half", occ.where("occ_id >= 50").withColumn("offset", half + 50).where("(offset - 50) % 400 = 0")),
        ("other", occ.withColumn("offset", page + 20).where("offset % 700 = 20 and occ_id between offset and offset + 59")
         .withColumn("species", other_name)),
        ("long", occ.where("occ_id >= 200").withColumn("offset", long).where("occ_id < offset + 120")),
    ]
    path = scratch_path(spark, "pages")
    for kind, rows in kinds:
        rows.groupBy("offset").agg(F.array_sort(F.collect_list(F.struct(*occ.columns))).alias("results")).write.json(
            f"{path}/kind={kind}")
    return landing.land_pages(landing.read_pages(spark, path).drop("kind"), page_size=100)


@query
def landing_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downloaded_again(spark, sf_dir).records.select(*view(spark, sf_dir, "occ").columns)


@query
def landing_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downloaded_again(spark, sf_dir).conflicts.select(*view(spark, sf_dir, "occ").columns)


@query
def landing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downloaded_again(spark, sf_dir).audit


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    occ = view(spark, sf_dir, "occ_raw")
    path = scratch_path(spark, "csv")
    tables.write_csv(occ, path)
    return tables.read_csv(spark, path, OCCURRENCE).select(*occ.columns)


@query
def ocean_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ocean-csv")
    tables.with_year(ocean_rows(spark, sf_dir)).hint("rebalance", "year").write.option(
        "header", True).partitionBy("year").csv(path)
    stacked = tables.read_csv(spark, f"{path}/year=*/*.csv", OCEAN)
    return stacked.groupBy(F.year("time").alias("year")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("temperature_C").alias("min_temperature"),
        F.max("salinity_PSU").alias("max_salinity"))


def landed_year_files(spark: SparkSession, sf_dir: str) -> str:
    """The ``ocean`` view landed from a CSV folder for each year, in two goes and once more.

    A year's files also hold rows of the year before, and rows without a time that can be read.
    """
    rows = tables.with_year(view(spark, sf_dir, "ocean")).withColumn(
        "file_year", F.col("year") + (F.col("ocean_id") % 41 == 0).cast("int"))
    rows = rows.withColumn("time", F.when(F.col("ocean_id") % 53 == 0, "no time").otherwise(F.col("time").cast("string")))
    files, path = scratch_path(spark, "ocean-csv"), scratch_path(spark, "ocean")
    rows.drop("year", "ocean_id").hint("rebalance", "file_year").write.option("header", True).partitionBy("file_year").csv(files)
    years = [r.file_year for r in rows.select("file_year").distinct().orderBy("file_year").collect()]
    given = {year: f"{files}/file_year={year}" for year in years}
    for part in (dict(list(given.items())[::2]), given, given):
        pipelines.land_ocean_years(spark, part, path)
    return path


@query
def ocean_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_ocean(spark, landed_year_files(spark, sf_dir), OCEAN_WITH_YEAR)


@query
def ocean_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_landings(spark, landed_year_files(spark, sf_dir))


@query
def ocean_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ocean")
    tables.write_ocean(ocean_rows(spark, sf_dir), path)
    return tables.read_ocean(spark, path, OCEAN_WITH_YEAR)


@query
def missing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = view(spark, sf_dir, "occ").select(event_year(F.col("eventDate")).alias("year"))
    return tables.years_to_fetch(
        wanted.where("year is not null"), tables.with_year(ocean_rows(spark, sf_dir)))


@query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.with_year(view(spark, sf_dir, "ocean"))
    return tables.stack_tables(
        rows.where("year < 1998").select("ocean_id", "year", "temperature_C"),
        rows.where("year >= 1998").select("salinity_PSU", "temperature_C", "year", "ocean_id"))


@query
def species_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "by-species")
    tables.write_by_species(view(spark, sf_dir, "fused"), path)
    return spark.read.parquet(path).groupBy("species_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("occ_id").alias("first_id"),
        F.max("occ_id").alias("last_id"))


@query
def summary_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "summary")
    tables.write_csv(profile.summary_statistics(view(spark, sf_dir, "taxa")), path)
    return spark.read.schema("metric string, value bigint").option("header", True).csv(path)


# --- projections and names -----------------------------------------------------------


@query
def select_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = view(spark, sf_dir, "taxa").withColumnsRenamed(
        {"taxon_class": "class", "taxon_order": "order"})
    return cleaning.select_existing(renamed, keep=("line_key",)).withColumnsRenamed(
        {"class": "taxon_class", "order": "taxon_order"})


@query
def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "occ_raw").select(
        "occ_id", normalised_name(F.col("species")).alias("name"))


@query
def species_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("species", F.lit(" ("), "family", F.lit(", "), "genus", F.lit(".)"))
    return view(spark, sf_dir, "taxa").where("species is not null").select(
        name.alias("name")).distinct().select("name", species_key(F.col("name")).alias("species_key"))


@query
def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return species.key_collisions(view(spark, sf_dir, "taxa").withColumn(
        "species", F.concat("family", F.when(F.col("line_key") % 2 == 0, ".").otherwise("-"))))


@query
def parse_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "occ").select(
        "occ_id", event_timestamp(F.col("eventDate")).alias("event_time"))


@query
def event_year_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "occ").select(
        "occ_id", event_year(F.col("eventDate")).alias("year")).where("year is not null")


# --- gridded ocean -------------------------------------------------------------------


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``grid_slices`` view with nested arrays, axes and a second variable."""
    steps = F.sequence(F.lit(0), F.lit(7))

    def axis(start: float) -> Column:
        return F.transform(steps, lambda i: F.lit(start) + i * F.lit(0.25))

    def nested(values: Column) -> Column:
        return F.transform(steps, lambda i: F.slice(values, i * 8 + 1, 8))

    flat = view(spark, sf_dir, "grid_slices").withColumnRenamed("thetao", "flat")
    return flat.select(
        F.col("time").cast("timestamp").alias("time"), "depth_idx", axis(8.0).alias("lat"), axis(68.0).alias("lon"),
        nested(F.col("flat")).alias("thetao"), nested(F.reverse("flat")).alias("so"))


@query
def grid_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocean.flatten_grid(slices(spark, sf_dir))


@query
def surface_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocean.surface_rows(slices(spark, sf_dir))


@query
def ocean_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocean.standard_variables(view(spark, sf_dir, "ocean").select(
        "ocean_id", F.col("temperature_C").alias("thetao"), F.col("salinity_PSU").alias("so")))


@query
def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocean.within_year(view(spark, sf_dir, "ocean"), 1997)


# --- filters -------------------------------------------------------------------------


@query
def clean_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_occurrences(view(spark, sf_dir, "occ_raw"))


@query
def cleaning_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_audit(view(spark, sf_dir, "occ_raw"))


@query
def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = view(spark, sf_dir, "occ").select(
        "occ_id", (F.col("decimalLatitude") - 3.0).alias("decimalLatitude"),
        (F.col("decimalLongitude") + 2.0).alias("decimalLongitude"))
    return cleaning.within_region(shifted)


@query
def polygon_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "occ").where(
        in_polygon(F.col("decimalLatitude"), F.col("decimalLongitude"), AREA)
    ).select("occ_id", *POINT)


@query
def region_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.region_join(view(spark, sf_dir, "occ"), view(spark, sf_dir, "areas")).select("occ_id", "region_id")


@query
def unreadable_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.unreadable_regions(view(spark, sf_dir, "areas"), "wkt")


@query
def wkt_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = view(spark, sf_dir, "occ").select(
        "occ_id", (F.col("decimalLatitude") - 3.0).alias("decimalLatitude"),
        (F.col("decimalLongitude") + 2.0).alias("decimalLongitude"))
    return regions.within_wkt(shifted, REGION_WKT)


@query
def species_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return species.canonical_spellings(view(spark, sf_dir, "occ_raw"))


@query
def species_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return species.species_records(view(spark, sf_dir, "occ_raw"), " Click")


@query
def species_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    occ = view(spark, sf_dir, "occ_raw").where("species is not null").select("species")
    others = view(spark, sf_dir, "taxa").select(F.col("phylum").alias("species"))
    return species.known_names(view(spark, sf_dir, "occ_raw"), occ.union(others))


@query
def species_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = view(spark, sf_dir, "taxa").select(
        F.concat_ws(" ", "species", "genus", "family", "phylum").alias("species"))
    names = records.union(records.select(F.upper("species")))
    return species.species_gate(records, names)


@query
def species_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return species.suggestions(view(spark, sf_dir, "taxa"))


@query
def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_dates(view(spark, sf_dir, "occ"))


# --- joins ---------------------------------------------------------------------------


@query
def nearest_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(ocean_rows(spark, sf_dir), by_year=False)
    return attach_nearest(view(spark, sf_dir, "occ"), index).select(
        "occ_id", F.sqrt("hit.d2").alias("distance"), *[f"hit.{c}" for c in MATCHED])


@query
def nearest_same_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(ocean_rows(spark, sf_dir))
    dated = view(spark, sf_dir, "occ").withColumn("year", event_year(F.col("eventDate")))
    found = attach_nearest(dated.where("year is not null"), index, F.col("year"))
    return found.select("occ_id", "year", F.sqrt("hit.d2").alias("distance"),
                        *[f"hit.{c}" for c in MATCHED])


@query
def fuse_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse(view(spark, sf_dir, "occ"), ocean_rows(spark, sf_dir))


@query
def prediction_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.lattice(view(spark, sf_dir, "occ"))


# --- counts and profiles -------------------------------------------------------------


@query
def species_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.counts(view(spark, sf_dir, "taxa"), "species")


@query
def phylum_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.counts(view(spark, sf_dir, "taxa"), "phylum")


@query
def yearly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.yearly_counts(cleaning.clean_occurrences(view(spark, sf_dir, "occ_raw")))


@query
def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.bounding_box(view(spark, sf_dir, "occ_raw"))


@query
def mean_environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.mean_environment(view(spark, sf_dir, "fused")).select(
        F.round("temperature", 9).alias("temperature"), F.round("salinity", 9).alias("salinity"))


@query
def modal_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.modal_species(view(spark, sf_dir, "taxa"))


@query
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_profile(view(spark, sf_dir, "occ_raw"))


@query
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.head_rows(view(spark, sf_dir, "occ"))


@query
def top_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    return species.most_recorded(view(spark, sf_dir, "taxa"), 20)


@query
def top_phyla(spark: SparkSession, sf_dir: str) -> DataFrame:
    return species.most_recorded(view(spark, sf_dir, "taxa"), 10, "phylum")


@query
def cleaning_audit_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_audit(view(spark, sf_dir, "occ_nan"))


@query
def bounding_box_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.bounding_box(view(spark, sf_dir, "occ_nan"))


@query
def mean_environment_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = profile.mean_environment(view(spark, sf_dir, "occ_nan"))
    return means.select(*(F.round(c, 9).alias(c) for c in means.columns))


@query
def occurrence_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.density(view(spark, sf_dir, "occ_raw"))


# --- training sets -------------------------------------------------------------------


@query
def pseudo_absence(spark: SparkSession, sf_dir: str) -> DataFrame:
    fused = view(spark, sf_dir, "fused")
    return pseudo_absences(fused, fused, ratio=2).select("occ_id", "draw", *POINT)


@query
def training_set_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_set(view(spark, sf_dir, "fused"), "View")


@query
def training_set_env(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_set(view(spark, sf_dir, "fused"), "view ", with_environment=True)
    return rows.withColumns({c: F.round(c, 9) for c in ("temperature", "salinity")})


@query
def training_sets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_sets(view(spark, sf_dir, "fused"))


@query
def shuffled_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffled(training_set(view(spark, sf_dir, "fused"), "click"))


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return assign_split(labels, "quality", ["doc_id"])


@query
def small_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type", (F.col("value") > 10).cast("int").alias("presence"))
    return assign_split(events, "presence", ["event_id"], by=["user_id", "event_type"])


# --- models and measures -------------------------------------------------------------


def trained(spark: SparkSession, sf_dir: str):
    rows = training_set(view(spark, sf_dir, "fused"), "click", with_environment=True)
    return model.train_and_test(rows)


@query
def rf_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.classification_report(trained(spark, sf_dir)[1])


@query
def rf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trained(spark, sf_dir)[1].select("occ_id", "draw", "label", "prediction", "p")


@query
def rf_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, tested = trained(spark, sf_dir)
    path = save_model(fitted, spark, scratch_path(spark, "models"), "click")
    before = stage(tested, "tested")
    again = model.score(load_model(path), before.drop("prediction", "p"))
    return again.select("occ_id", "draw", F.col("p").alias("p_reloaded")).join(
        before, ["occ_id", "draw"]).select("occ_id", "draw", "p", "p_reloaded")


@query
def rf_test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, prediction = F.col("p"), F.col("prediction")
    return trained(spark, sf_dir)[1].select(
        "occ_id", "draw", "label", p.between(0, 1).alias("p_in_range"),
        ((p == 0.5) | (prediction == (p > 0.5).cast("int"))).alias("prediction_follows"))


@query
def rf_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.classification_report(trained(spark, sf_dir)[1]).select("name", "support")


@query
def rf_reload_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rf_reload.__wrapped__(spark, sf_dir)
    return rows.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(~F.col("p").eqNullSafe(F.col("p_reloaded"))).alias("n_different"))


def node_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with p from the model and p walked through its table of nodes."""
    fitted, tested = trained(spark, sf_dir)
    path = save_model(fitted, spark, scratch_path(spark, "models"), "click")
    rows = stage(tested.withColumnRenamed("prediction", "model_prediction").withColumnRenamed("p", "model_p"), "tested")
    nodes = forest.saved_nodes(spark, path).withColumn("species", rows.agg(F.min("species")).scalar())
    return forest.score_by_nodes(rows, nodes, model.feature_columns(fitted))


@query
def rf_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    close = F.abs(F.col("p") - F.col("model_p")) <= 1e-12
    return node_scores(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~close).alias("n_different_p"),
        F.count_if(F.col("prediction") != F.col("model_prediction")).alias("n_different_class"))


def modelled_species(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Models of all species of the ``fused`` view, in names without case and blanks."""
    fused = view(spark, sf_dir, "fused").withColumn("species", normalised_name(F.col("species")))
    return all_species.model_all(fused, base)


@query
def model_all_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = modelled_species(spark, sf_dir, scratch_path(spark, "models"))
    # Absences all have the mean conditions, so that a forest that learns tells nearly all apart.
    return report.select("species", "n_train", "n_test", (F.col("accuracy") >= 0.95).alias("learnt"))


@query
def surface_all_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "models")
    modelled_species(spark, sf_dir, base)
    maps = all_species.map_all(spark, base, view(spark, sf_dir, "occ"), ocean_rows(spark, sf_dir))
    return maps.select("species", "cell_id", "temperature", "salinity", F.col("p").between(0, 1).alias("p_in_range"))


@query
def surface_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, _ = trained(spark, sf_dir)
    index = build_index(ocean_rows(spark, sf_dir), by_year=False)
    points = model.surface_points(view(spark, sf_dir, "occ"), index)
    return model.score(fitted, points).select(
        "cell_id", "temperature", "salinity", F.col("p").between(0, 1).alias("p_in_range"))


@query
def overlay_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    occ = view(spark, sf_dir, "occ_raw")
    return pipelines.overlay(occ).select("occ_id", "species", *POINT)


@query
def prediction_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, _ = trained(spark, sf_dir)
    index = build_index(ocean_rows(spark, sf_dir), by_year=False)
    return model.prediction_surface(fitted, view(spark, sf_dir, "occ"), index)


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(view(spark, sf_dir, "pred"))


@query
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = evaluation.classification_report(view(spark, sf_dir, "pred"))
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.accuracy(view(spark, sf_dir, "pred")).select(
        F.round("accuracy", 9).alias("accuracy"))


@query
def probability_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "pred").groupBy(
        grid.probability_band(F.col("p")).alias("band")).agg(F.count(F.lit(1)).alias("n"))
