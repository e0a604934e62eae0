"""Tables in files: CSV for exchange, Parquet between steps."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoalmark.functions.numbers import nan_to_null
from shoalmark.functions.text import species_key
from shoalmark.operators.species import key_collisions


MOST_HEADER_BYTES = 1 << 20  # a header line is read up to here
HEADER_BUFFER, HEADER_READERS = 1 << 14, 16
_NO_HOST = "^([A-Za-z0-9+.-]+):///"
# Folders of a table of years that a plain read of its rows leaves out.
UNPLACED, LANDINGS = "_unplaced", "_landings"
LANDING = "file_year int, n_rows long, n_other_year long, n_no_time long"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             multi_line: bool = False, file_column: str | None = None) -> DataFrame:
    """Columns of ``schema`` from CSV with a header row; ``path`` may be a glob or a list.

    Columns are found by their header and cast; missing ones, unreadable values and NaN
    become NULL. Files may have different headers: those with the same one are read
    together, and the rows are stacked by column name. ``file_column`` names a column to add
    that holds each row's file.

    A file whose fields hold line breaks needs ``multi_line``, which reads each file in one
    task; otherwise large files are split.
    """
    parts = []
    for files in files_by_header(spark, path):
        raw = (
            spark.read.option("header", True).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').option("enforceSchema", False)
            .csv(files)
        )
        source = [] if file_column is None else [F.col("_metadata.file_path").alias(file_column)]
        parts.append(raw.select([_column(raw, f) for f in schema.fields] + source))
    if parts:
        return stack_tables(*parts)
    return spark.createDataFrame([], schema if file_column is None else T.StructType(
        [*schema.fields, T.StructField(file_column, T.StringType())]))


def _column(raw: DataFrame, field: T.StructField) -> Column:
    if field.name not in raw.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    value = F.col(f"`{field.name}`").try_cast(field.dataType)
    if isinstance(field.dataType, T.DoubleType):
        value = nan_to_null(value)
    return value.alias(field.name)


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file, None if it has none; reads a buffer or as many as the line takes.

    Through Hadoop's file system, so any store that Spark reads will do, and compressed files.
    """
    path, files = _hadoop_path(spark, file)
    hadoop = spark._jvm.org.apache.hadoop
    codec = hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    stream = files.open(path)
    lines = hadoop.util.LineReader(stream if codec is None else codec.createInputStream(stream), HEADER_BUFFER)
    try:
        text = hadoop.io.Text()
        return text.toString() if lines.readLine(text, MOST_HEADER_BYTES, MOST_HEADER_BYTES) else None
    finally:
        lines.close()


def files_by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The files, those with the same first line together; files without a line are left out.

    No file is read through. The driver asks for the first lines, several at a time, and holds a
    header and the names of its files, as in a listing.
    """
    files = [file for one in ([path] if isinstance(path, str) else path) for file in list_files(spark, one)]
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADER_READERS) as readers:
        for file, header in zip(files, readers.map(lambda file: first_line(spark, file), files)):
            if header is not None:
                groups.setdefault(header, []).append(file)
    return [groups[header] for header in sorted(groups)]


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` by CSV part files, each with a header row."""
    (
        df.write.mode("overwrite").option("header", True)
        .option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def with_year(ocean: DataFrame) -> DataFrame:
    return ocean.withColumn("year", F.year("time"))


def write_ocean(ocean: DataFrame, path: str) -> None:
    """Replace the years present in ``ocean`` below ``path``; other years stay.

    Rows are rebalanced by year first: few files to a small year, and a large year is
    shared between tasks instead of going to one.
    """
    (
        with_year(ocean).hint("rebalance", "year")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year").parquet(path)
    )


def read_ocean(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Ocean rows below ``path``, with those that landed from the file of another year or
    without a time; a filter on ``year`` prunes folders."""
    placed = spark.read.schema(schema).parquet(path)
    if not _exists(spark, f"{path}/{UNPLACED}"):
        return placed
    own = T.StructType([f for f in schema.fields if f.name != "year"])
    unplaced = with_year(spark.read.schema(own).parquet(f"{path}/{UNPLACED}"))
    return placed.unionByName(unplaced.select(placed.columns))


def _hadoop_path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    folder, files = _hadoop_path(spark, path)
    return files.exists(folder)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files that a read of ``path`` (a file, a folder with what is in it, or a glob)
    takes; hidden files and folders are none."""
    pattern, files = _hadoop_path(spark, path)
    found = []
    for status in files.globStatus(pattern) or []:
        root = status.getPath().toUri().getPath()
        inside = files.listFiles(status.getPath(), True)
        while inside.hasNext():
            one = inside.next().getPath().toUri()
            below = one.getPath().removeprefix(root).split("/")
            if not any(name.startswith(".") or name.startswith("_") and "=" not in name for name in below):
                found.append(re.sub(_NO_HOST, r"\1:/", unquote(one.toString())))
    return sorted(found)


def file_name(file: Column) -> Column:
    """A row's file as ``list_files`` names it, ``scheme:/`` where there is no host."""
    return F.regexp_replace(F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B"))), _NO_HOST, "$1:/")


def read_year_files(spark: SparkSession, files: dict[int, str], schema: T.StructType) -> DataFrame:
    """Rows of CSV files that belong to one year each, as ``file_year``, in one scan for each
    header. The names of the files are held by the driver, as in a listing."""
    listed = {year: list_files(spark, path) for year, path in files.items()}
    absent = [files[year] for year, found in listed.items() if not found]
    if absent:
        raise FileNotFoundError(f"no files at {', '.join(absent)}")
    named = [(file, year) for year, found in listed.items() for file in found]
    if len({file for file, _ in named}) < len(named):
        raise ValueError("a file is given for more than one year")
    years = spark.createDataFrame(named, "file string, file_year int")
    rows = read_csv(spark, [file for file, _ in named], schema, file_column="file")
    return rows.withColumn("file", file_name(F.col("file"))).join(years, "file").drop("file")


def write_landing(rows: DataFrame, path: str, file_years: list[int]) -> None:
    """Add the rows (with ``file_year``) of these years' files to the table of years at ``path``.

    Rows of the file's own year replace that year's folder. Rows of another year or without a
    time would fall into folders that other files own; they go to folders of their own, one for
    each file's year, below UNPLACED. LANDINGS gets a row for each file's year. All three are
    replaced by year, so a landing that broke off can be run again.
    """
    own = F.coalesce(F.year("time") == F.col("file_year"), F.lit(False))
    _write_parts(rows.where(~own), f"{path}/{UNPLACED}", "file_year")
    write_ocean(rows.where(own).drop("file_year"), path)
    spark = rows.sparkSession
    counts = rows.groupBy("file_year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.year("time") != F.col("file_year")).alias("n_other_year"),
        F.count_if(F.col("time").isNull()).alias("n_no_time"))
    every = spark.createDataFrame([(year,) for year in file_years], "file_year int")
    _write_parts(every.join(counts, "file_year", "left").na.fill(0).coalesce(1), f"{path}/{LANDINGS}", "file_year")


def _write_parts(df: DataFrame, path: str, by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_landings(spark: SparkSession, path: str) -> DataFrame:
    """What landed at ``path``: rows of each file's year, those of other years and without a time."""
    if not _exists(spark, f"{path}/{LANDINGS}"):
        return spark.createDataFrame([], LANDING)
    return spark.read.schema(LANDING).parquet(f"{path}/{LANDINGS}")


def years_to_fetch(requested: DataFrame, existing: DataFrame) -> DataFrame:
    """Requested years of which no ocean row is there yet."""
    return requested.select("year").distinct().join(
        existing.select("year").distinct(), "year", "left_anti")


def landed_years(spark: SparkSession, path: str) -> list[int]:
    """Years whose files have landed at ``path``, from the names of folders; no row is read. A
    year counts if it has a folder, or if its file landed without a row of that year."""
    names = []
    for pattern, mark in ((f"{path}/year=*", "year="), (f"{path}/{LANDINGS}/file_year=*", "file_year=")):
        found, files = _hadoop_path(spark, pattern)
        names += [status.getPath().getName().removeprefix(mark) for status in files.globStatus(found) or []]
    return sorted({int(name) for name in names if name.isdigit()})


def stack_tables(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, columns matched by name, missing ones NULL."""
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table, allowMissingColumns=True)
    return stacked


def write_by_species(df: DataFrame, path: str, names: DataFrame | None = None) -> None:
    """One folder per species key, replaced where it exists; common species get several files.

    Raises if two species share a key, as one would replace or mix with the other. ``names`` has
    the species of ``df`` (column ``species``) where reading them there costs less.
    """
    clashes = key_collisions(df if names is None else names).limit(5).collect()
    if clashes:
        raise ValueError(f"species with the same key: {', '.join(c.species_key for c in clashes)}")
    (
        df.withColumn("species_key", species_key(F.col("species")))
        .hint("rebalance", "species_key")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("species_key").parquet(path)
    )
