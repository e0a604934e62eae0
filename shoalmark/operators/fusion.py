"""Occurrences with the ocean conditions of their nearest grid cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalmark.functions.time import event_timestamp
from shoalmark.operators.nearest import MATCHED, OceanIndex, attach_nearest, build_index


def fuse(occurrences: DataFrame, ocean: DataFrame | OceanIndex) -> DataFrame:
    """Join each occurrence to the nearest ocean coordinate of its year.

    * The year is that of ``eventDate``; a missing date is filled from the time of the
      overall nearest ocean row, which then is also the nearest of that year.
    * A year without ocean rows falls back to the overall nearest row.
    * A row that still has no date is dropped, as grouping by year would drop it.

    Every row therefore needs one lookup only: in its year, or over all years.
    """
    index = ocean if isinstance(ocean, OceanIndex) else build_index(ocean)
    dated = occurrences.withColumn("eventDate", event_timestamp(F.col("eventDate")))
    matched = attach_nearest(dated, index, F.year("eventDate"))
    return (
        matched.select(
            *[c for c in dated.columns if c != "eventDate"],
            F.coalesce("eventDate", "hit.ocean_time").alias("eventDate"),
            *[F.col(f"hit.{c}").alias(c) for c in MATCHED],
        )
        .withColumn("eventYear", F.year("eventDate"))
        .where(F.col("eventYear").isNotNull())
    )
