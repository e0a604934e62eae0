"""Counts, extremes and profiles of the occurrence table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalmark.functions.numbers import nan_to_null
from shoalmark.functions.time import event_timestamp, event_year

FIRST_YEAR_SHOWN = 1950  # fixed value: the chart starts after this year


def counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, missing values left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def yearly_counts(df: DataFrame, after: int = FIRST_YEAR_SHOWN) -> DataFrame:
    """Records per year of ``eventDate``, in order of the year."""
    return (
        counts(df.select(event_year(F.col("eventDate")).alias("year")), "year")
        .where(F.col("year") > after).orderBy("year")
    )


def bounding_box(df: DataFrame) -> DataFrame:
    """One row: the extremes of the coordinates over all species, missing values left out."""
    lat, lon = (nan_to_null(F.col(c)) for c in ("decimalLatitude", "decimalLongitude"))
    return df.agg(F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"),
                  F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"))


def mean_environment(df: DataFrame) -> DataFrame:
    """One row: mean temperature and salinity, missing values left out."""
    return df.agg(F.avg(nan_to_null(F.col("temperature_C"))).alias("temperature"),
                  F.avg(nan_to_null(F.col("salinity_PSU"))).alias("salinity"))


def modal_species(df: DataFrame) -> DataFrame:
    """One row: the species with the most records, the smallest name among ties."""
    return (
        counts(df, "species").orderBy(F.desc("n"), "species").limit(1).select("species")
    )


def missing_dates(df: DataFrame) -> DataFrame:
    """One row: records whose date is missing or not readable."""
    return df.agg(F.count_if(event_timestamp(F.col("eventDate")).isNull()).alias("n_missing"))


def column_profile(df: DataFrame) -> DataFrame:
    """For each column its type, its values that are not missing, and the rows; one pass."""
    filled = df.agg(F.count(F.lit(1)).alias("rows"),
                    F.struct(*[F.count(f"`{c}`").alias(c) for c in df.columns]).alias("filled"))
    lines = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.col("filled")[f.name].alias("non_null"), F.col("rows"))
        for i, f in enumerate(df.schema.fields)
    ]
    return filled.select(F.inline(F.array(*lines)))


def summary_statistics(df: DataFrame) -> DataFrame:
    """Metric and value: records, and distinct species."""
    return df.agg(
        F.count(F.lit(1)).alias("num_records"), F.count_distinct("species").alias("num_species"),
    ).unpivot([], ["num_records", "num_species"], "metric", "value")


def head_rows(df: DataFrame, k: int = 5) -> DataFrame:
    """First rows in order of the row id."""
    return df.orderBy("occ_id").limit(k)
