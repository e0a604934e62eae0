"""Explicit schemas: nothing is inferred on read."""

from pyspark.sql import types as T

# The columns a clean occurrence table has.
OCCURRENCE_COLUMNS = (
    "species", "decimalLatitude", "decimalLongitude", "eventDate", "scientificName", "phylum",
    "class", "order", "family", "genus",
)

_DOUBLES = {"decimalLatitude", "decimalLongitude"}

OCCURRENCE = T.StructType(
    [T.StructField("occ_id", T.LongType())]
    + [T.StructField(name, T.DoubleType() if name in _DOUBLES else T.StringType())
       for name in OCCURRENCE_COLUMNS]
)

PAGE = T.StructType([
    T.StructField("offset", T.LongType()),
    T.StructField("results", T.ArrayType(OCCURRENCE)),
])

OCEAN = T.StructType([
    T.StructField("time", T.TimestampType()),
    T.StructField("depth", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("temperature_C", T.DoubleType()),
    T.StructField("salinity_PSU", T.DoubleType()),
])

OCEAN_WITH_YEAR = T.StructType(OCEAN.fields + [T.StructField("year", T.IntegerType())])
