"""Training sets of presences and random pseudo-absences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalmark.functions.numbers import DEFAULT_SEED, between, seeded_hash, seeded_uniform
from shoalmark.operators.joins import sized_join
from shoalmark.operators.profile import bounding_box, mean_environment
from shoalmark.operators.species import canonical_spellings, species_records, spellings
from shoalmark.session import stage

ABSENCE_RATIO = 1  # fixed value
COORDINATES = ("decimalLatitude", "decimalLongitude")
ENVIRONMENT = ("temperature", "salinity")
SPELLING_BYTES = 256  # one species name with its keys in a broadcast relation


def pseudo_absences(presences: DataFrame, everything: DataFrame, ratio: int = ABSENCE_RATIO,
                    seed: int = DEFAULT_SEED) -> DataFrame:
    """``ratio`` uniform random points per presence (none for 0), in the box around ``everything``.

    Each point is drawn from the seed, the presence's id and its own number: the count is
    exact and the points do not depend on partitioning.
    """
    if ratio < 0:
        raise ValueError("the number of absences per presence cannot be negative")
    box = bounding_box(everything).select(F.struct("*")).scalar()

    def draw(tag: str, low: str, high: str):
        return between(seeded_uniform(seed, tag, F.col("occ_id"), F.col("draw")),
                       F.col(f"box.{low}"), F.col(f"box.{high}"))

    return (
        presences.where(F.lit(ratio > 0))
        .withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(max(ratio, 1)))))
        .withColumn("box", box)
        .withColumn("decimalLatitude", draw("lat", "min_lat", "max_lat"))
        .withColumn("decimalLongitude", draw("lon", "min_lon", "max_lon"))
        .drop("box")
    )


def _stacked(presences: DataFrame, everything: DataFrame, with_environment: bool,
             ratio: int, seed: int) -> DataFrame:
    keys = ["species", "occ_id"]
    absences = pseudo_absences(presences.select(*keys), everything, ratio, seed)
    present = presences.withColumn("draw", F.lit(0))
    columns = [*keys, "draw", *COORDINATES]
    if with_environment:
        # Absences all get the mean conditions of the whole table. A model can tell them
        # by that value alone; kept because that is how the training set is defined.
        present = present.withColumnsRenamed(
            {"temperature_C": "temperature", "salinity_PSU": "salinity"})
        means = mean_environment(everything).select(F.struct("*")).scalar()
        absences = absences.withColumn("mean", means).withColumns(
            {v: F.col(f"mean.{v}") for v in ENVIRONMENT})
        columns += ENVIRONMENT
    return (
        present.withColumn("presence", F.lit(1)).select(*columns, "presence")
        .unionByName(absences.withColumn("presence", F.lit(0)).select(*columns, "presence"))
    )


def training_set(df: DataFrame, name: str, with_environment: bool = False,
                 ratio: int = ABSENCE_RATIO, seed: int = DEFAULT_SEED) -> DataFrame:
    """Training rows of one species; empty if the name is unknown.

    Rows have the key (``occ_id``, ``draw``); the box and the means are those of ``df``.
    """
    return _stacked(species_records(df, name), df, with_environment, ratio, seed)


def training_sets(df: DataFrame, with_environment: bool = False,
                  ratio: int = ABSENCE_RATIO, seed: int = DEFAULT_SEED) -> DataFrame:
    """Training rows of every species at once, told apart by ``species``."""
    canonical = stage(canonical_spellings(df).select("species"), "spellings")
    # All spellings are counted, as one that is not the first can be the heavy one.
    presences = sized_join(df, canonical, ["species"], canonical.count() * SPELLING_BYTES,
                           counted=spellings(df).select("species", "n"))
    return _stacked(presences, df, with_environment, ratio, seed)


def shuffled(training: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """Repeatable random order, for files; fitting a model needs none."""
    return training.orderBy(
        seeded_hash(seed, "order", F.col("occ_id"), F.col("draw")), "occ_id", "draw")
