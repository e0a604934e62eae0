"""Species names: spellings, look-up, counts to go by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalmark.functions.text import normalised_name, species_key

FEW_RECORDS = 10  # fixed value: fewer presences than this give a warning
SUGGESTIONS = 5  # fixed value


def spellings(df: DataFrame) -> DataFrame:
    """One row per stored spelling: its records, its first row, its normalised name.

    Names are normalised after counting, once per spelling instead of once per row.
    """
    return (
        df.where("species is not null")
        .groupBy("species").agg(F.count(F.lit(1)).alias("n"), F.min("occ_id").alias("first_id"))
        .withColumn("name", normalised_name(F.col("species")))
    )


def canonical_spellings(df: DataFrame) -> DataFrame:
    """For each normalised name the spelling stored first, and the records with just that one.

    Rows with another spelling of the name do not count.
    """
    first = F.min_by(F.struct("species", "n"), "first_id")
    return spellings(df).groupBy("name").agg(first.alias("first")).select("name", "first.*")


def find_species(df: DataFrame, name: str) -> DataFrame:
    """At most one row: the stored spelling that ``name`` stands for."""
    return canonical_spellings(df).where(F.col("name") == normalised_name(F.lit(name)))


def species_records(df: DataFrame, name: str) -> DataFrame:
    """Rows with exactly the stored spelling that ``name`` stands for; none if unknown."""
    return df.where(F.col("species") == find_species(df, name).select("species").scalar())


def known_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Each of ``names`` (column ``species``) and whether the table has it in any spelling."""
    stored = spellings(df).select("name").distinct().withColumn("known", F.lit(True))
    return (
        names.select("species").distinct()
        .withColumn("name", normalised_name(F.col("species")))
        .join(stored, "name", "left")
        .select("species", "name", F.coalesce("known", F.lit(False)).alias("known"))
    )


def most_recorded(df: DataFrame, k: int, column: str = "species") -> DataFrame:
    """The ``k`` values with the most records, ties in order of the value."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column).limit(k)
    )


def suggestions(df: DataFrame) -> DataFrame:
    """What to offer when a name is unknown."""
    return most_recorded(df, SUGGESTIONS).select("species")


def record_status(n: Column) -> Column:
    """``empty`` stops, ``low`` warns, ``ok`` goes on."""
    return F.when(n == 0, "empty").when(n < FEW_RECORDS, "low").otherwise("ok")


def few_or_none(n: int) -> str:
    """The status of a count that the driver already has."""
    return "empty" if n == 0 else "low" if n < FEW_RECORDS else "ok"


def species_gate(df: DataFrame, names: DataFrame) -> DataFrame:
    """Records and status of each of ``names`` (column ``species``), exact spelling."""
    counted = (
        df.where("species is not null").groupBy("species").agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    return (
        names.select("species").distinct().join(counted, "species", "left")
        .select("species", n.alias("n"), record_status(n).alias("status"))
    )


def key_collisions(df: DataFrame) -> DataFrame:
    """Path keys that stand for more than one species name."""
    return (
        df.where("species is not null").select("species").distinct()
        .groupBy(species_key(F.col("species")).alias("species_key"))
        .agg(F.count(F.lit(1)).alias("n_names")).where("n_names > 1")
    )
