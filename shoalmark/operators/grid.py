"""Regular lattices, density rasters, probability bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalmark.functions.numbers import evenly_spaced
from shoalmark.operators.profile import bounding_box

GRID_STEPS = 200  # fixed value: lattice points along each axis
BANDS = 20  # fixed value


def lattice(df: DataFrame, steps: int = GRID_STEPS) -> DataFrame:
    """``steps`` by ``steps`` points over the bounding box of ``df``, latitude by latitude."""
    box = bounding_box(df).select(F.struct("*")).scalar()
    return (
        df.sparkSession.range(steps * steps)
        .select(
            F.col("id").alias("cell_id"),
            F.floor(F.col("id") / steps).cast("int").alias("i_lat"),
            (F.col("id") % steps).cast("int").alias("i_lon"),
            box.alias("box"),
        )
        .select(
            "cell_id", "i_lat", "i_lon",
            evenly_spaced(F.col("i_lat"), steps, F.col("box.min_lat"), F.col("box.max_lat"))
            .alias("decimalLatitude"),
            evenly_spaced(F.col("i_lon"), steps, F.col("box.min_lon"), F.col("box.max_lon"))
            .alias("decimalLongitude"),
        )
    )


def density(df: DataFrame, cell: float = 0.5) -> DataFrame:
    """Occurrences per cell of ``cell`` degrees."""
    return df.where("decimalLatitude is not null and decimalLongitude is not null").groupBy(
        F.floor(F.col("decimalLatitude") / cell).alias("i_lat"),
        F.floor(F.col("decimalLongitude") / cell).alias("i_lon"),
    ).agg(F.count(F.lit(1)).alias("n"))


def probability_band(p: Column, bands: int = BANDS) -> Column:
    """Number of the band of equal width from 1; the upper end belongs to the last."""
    return F.least(F.width_bucket(p, F.lit(0.0), F.lit(1.0), F.lit(bands)), F.lit(bands))
