"""Gridded ocean variables as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalmark.functions.numbers import nan_to_null

# Names a (temperature, salinity) pair may have; a pair is taken whole.
VARIABLE_PAIRS = (("thetao", "so"), ("temperature", "salinity"))
STANDARD_NAMES = ("temperature_C", "salinity_PSU")


def standard_variables(df: DataFrame) -> DataFrame:
    """Rename the first pair of variables found to the standard names."""
    for pair in VARIABLE_PAIRS:
        if set(pair) <= set(df.columns):
            return df.withColumnsRenamed(dict(zip(pair, STANDARD_NAMES)))
    raise ValueError(f"none of the variable pairs {VARIABLE_PAIRS} among {df.columns}")


def surface_layer(slices: DataFrame) -> DataFrame:
    """First depth of each time, by place and not by value; all rows if there is no depth."""
    return slices.where("depth_idx = 0") if "depth_idx" in slices.columns else slices


def flatten_grid(slices: DataFrame) -> DataFrame:
    """One row per time, latitude and longitude from slices of nested arrays.

    A slice has ``lat`` and ``lon`` arrays and two variables as arrays of latitude rows.
    The other columns are repeated. Arrays are zipped and unnested, never indexed.
    """
    slices = standard_variables(slices)
    scalars = [c for c in slices.columns if c not in ("lat", "lon", *STANDARD_NAMES)]
    temperature, salinity = STANDARD_NAMES
    rows = slices.select(*scalars, "lon", F.inline(F.arrays_zip("lat", temperature, salinity)))
    return (
        rows.select(*scalars, F.col("lat").alias("latitude"),
                    F.inline(F.arrays_zip("lon", temperature, salinity)))
        .select(*scalars, "latitude", F.col("lon").alias("longitude"),
                *[nan_to_null(F.col(v).cast("double")).alias(v) for v in STANDARD_NAMES])
    )


def surface_rows(slices: DataFrame) -> DataFrame:
    """Surface layer flattened, cells without a value (land) left out."""
    return flatten_grid(surface_layer(slices)).na.drop(how="any", subset=list(STANDARD_NAMES))


def within_year(ocean: DataFrame, year: int) -> DataFrame:
    """Rows from the first to the last second of a calendar year.

    The limits take the column's own type, so that the filter reaches the scan.
    """
    kind = ocean.schema["time"].dataType
    first, last = f"{year}-01-01 00:00:00", f"{year}-12-31 23:59:59"
    return ocean.where(F.col("time").between(F.lit(first).cast(kind), F.lit(last).cast(kind)))
