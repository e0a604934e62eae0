"""From raw occurrence records to the clean table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalmark.functions.geo import REGION_LATITUDE, REGION_LONGITUDE, in_box
from shoalmark.schemas import OCCURRENCE_COLUMNS

REQUIRED = ("species", "decimalLatitude", "decimalLongitude")


def select_existing(df: DataFrame, wanted: Sequence[str] = OCCURRENCE_COLUMNS,
                    keep: Sequence[str] = ("occ_id",)) -> DataFrame:
    """The wanted columns that exist, in the wanted order, after the row id if there is one."""
    return df.select([f"`{c}`" for c in [*keep, *wanted] if c in df.columns])


def complete(df: DataFrame, required: Sequence[str] = REQUIRED) -> Column:
    """True where every required column has a value; NaN is none, as in cleaning."""
    condition = F.lit(True)
    for name in required:
        condition = condition & F.col(name).isNotNull()
        if df.schema[name].dataType.typeName() in ("double", "float"):
            condition = condition & ~F.isnan(name)
    return condition


def clean_occurrences(raw: DataFrame) -> DataFrame:
    """Useful columns of the rows that have a species name and coordinates."""
    return select_existing(raw).na.drop(how="any", subset=list(REQUIRED))


def cleaning_audit(raw: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows before and after cleaning and rows removed, in one pass."""
    before, after = F.count(F.lit(1)), F.count_if(complete(raw, required))
    return raw.agg(before.alias("rows_before"), after.alias("rows_after"),
                   (before - after).alias("rows_removed"))


def within_region(df: DataFrame, lat: str = "decimalLatitude", lon: str = "decimalLongitude",
                  lat_range: Sequence[float] = REGION_LATITUDE,
                  lon_range: Sequence[float] = REGION_LONGITUDE) -> DataFrame:
    return df.where(in_box(F.col(lat), F.col(lon), lat_range, lon_range))
