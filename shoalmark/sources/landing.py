"""Occurrence records from landed pages of JSON."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoalmark.operators.intervals import sweep
from shoalmark.operators.joins import left_sized_join
from shoalmark.schemas import PAGE
from shoalmark.session import stage

# Records to a page, and the number of records one study asked for.
PAGE_SIZE = 10_000
RECORD_LIMIT = 30_000
MARK_BYTES = 64  # of a marked page in a broadcast relation, without its file's name
CUT_BUCKETS = 1 << 16


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages as landed: one JSON object to a line, with its offset and its array of records.

    Keys outside the schema are not read, keys a record lacks become NULL.
    """
    return spark.read.schema(PAGE).json(path)


@dataclass
class Landing:
    """The records of landed pages, one for each place.

    ``conflicts`` has the other versions of places that pages disagree on, with the place as
    ``occ_id``; ``audit`` has a row (offset, end, problem, n) for every page or range that is not
    as it should be.
    """

    records: DataFrame
    conflicts: DataFrame
    audit: DataFrame


def land_pages(pages: DataFrame, page_size: int = PAGE_SIZE) -> Landing:
    """All records of all landed pages, each with its place in the whole as ``occ_id``.

    The place is the page's offset plus the place in the page, the same on every run; an id the
    record itself has is not used. Pages may have landed twice and may overlap: ``occ_id`` is
    unique all the same. Equal pages collapse. A sweep over the ranges of the others finds those
    that overlap; only their records are compared, place by place. Places that agree collapse.
    Where they disagree, the record of the page that begins first (of these the longest, of these
    the one with the smallest digest) stays, and the others are the conflicts.

    The audit's problems: ``repeated`` (n more copies of a page), ``overlap`` (a range that
    several different pages have a part of, n of them), ``oversize`` (a page with n records, above
    ``page_size``), ``short`` (a page of n records before the last), and ``missing`` (a range of n
    records that no page has). A page without an offset raises, as its records have no place.
    """
    missing = F.raise_error(F.lit("a landed page has no offset")).cast("bigint")
    stored = stage(pages.select(
        F.coalesce("offset", missing).alias("offset"), "results",
        F.coalesce(F.size("results"), F.lit(0)).cast("bigint").alias("n"),
        F.sha2(F.to_json(F.struct("results"), {"ignoreNullFields": "true"}), 256).alias("digest")), "pages")
    page = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    known = stored.select("offset", "n", "digest", page.alias("page"))
    distinct = stage(known.groupBy("offset", "n", "digest").agg(
        F.min("page").alias("first"), F.count(F.lit(1)).alias("copies")), "distinct-pages")
    ranges = distinct.withColumn("end", F.col("offset") + F.col("n"))
    swept = sweep(ranges.where("n > 0"), "offset", "end", ["digest"])
    sizes = swept.groupBy("cluster").agg(F.count(F.lit(1)).alias("pages"), F.max("end").alias("cluster_end"))
    shared = stage(sizes.where("pages > 1"), "page-clusters")

    # Only pages that are not plain are joined: further copies, which are left out, and pages that
    # share a range with others.
    further = known.join(distinct.where("copies > 1"), ["offset", "n", "digest"]).where("page <> first")
    plural = swept.join(shared, "cluster").select(F.col("first").alias("page"), F.lit("shared").alias("kind"))
    marks = stage(further.select("page", F.lit("further").alias("kind")).unionByName(plural), "page-marks")
    size = marks.agg(F.sum(F.octet_length("page.file") + MARK_BYTES)).first()[0] or 0
    chosen = left_sized_join(stored.withColumn("page", page), marks, ["page"], size).where(
        "kind is null or kind = 'shared'").withColumn("shared", F.col("kind").isNotNull())
    own = [f.name for f in pages.schema["results"].dataType.elementType if f.name != "occ_id"]
    placed = chosen.select("offset", "n", "digest", "shared", F.posexplode("results").alias("place", "record")).select(
        (F.col("offset") + F.col("place")).alias("occ_id"), "offset", "n", "digest", "shared",
        *[F.col(f"record.`{name}`").alias(name) for name in own])
    alone = placed.where(~F.col("shared")).select("occ_id", *own)
    if shared.isEmpty():
        records, conflicts = alone, alone.limit(0)
    else:
        versions = _versions(placed.where("shared").drop("shared"), own)
        records = alone.unionByName(versions.where("version = 1").drop("version"))
        conflicts = versions.where("version > 1").drop("version")
    return Landing(records, conflicts, _audit(ranges, swept, shared, page_size))


def _versions(placed: DataFrame, own: list[str]) -> DataFrame:
    """The different records at each place, numbered from 1 in the order of their pages.

    Equal records are grouped before their place is, so copies are combined where they are read.
    """
    by_page = F.struct("offset", (-F.col("n")).alias("shorter"), "digest")
    different = placed.groupBy("occ_id", *own).agg(F.min(by_page).alias("first"))
    versions = stage(different.withColumn(
        "version", F.row_number().over(Window.partitionBy("occ_id").orderBy("first"))), "page-versions")
    return versions.select("occ_id", *own, "version")


def _audit(ranges: DataFrame, swept: DataFrame, shared: DataFrame, page_size: int) -> DataFrame:
    def problem(df: DataFrame, name: str, offset: str = "offset", end: str = "end", n: str = "n") -> DataFrame:
        return df.select(F.expr(offset).alias("offset"), F.expr(end).alias("end"), F.lit(name).alias("problem"),
                         F.expr(n).cast("bigint").alias("n"))

    last = ranges.agg(F.max("offset"))
    holes = swept.withColumn("from", F.coalesce("reach", F.lit(0))).where("offset > from")
    return (problem(ranges.where("copies > 1"), "repeated", n="copies - 1")
            .unionByName(problem(shared, "overlap", "cluster", "cluster_end", "pages"))
            .unionByName(problem(ranges.where(F.col("n") > page_size), "oversize"))
            .unionByName(problem(ranges.where((F.col("n") < page_size) & (F.col("offset") < last.scalar())), "short"))
            .unionByName(problem(holes, "missing", "from", "offset", "offset - from")))


def stop_on_conflicts(landing: Landing) -> None:
    """Raise if pages disagree on a place."""
    found = landing.conflicts.select("occ_id").limit(3).collect()
    if found:
        places = ", ".join(str(r.occ_id) for r in found)
        raise ValueError(f"pages overlap and disagree, first at places {places}: see land_pages")


def landed_records(pages: DataFrame) -> DataFrame:
    """The records of ``land_pages``; raises if pages disagree on a place."""
    landing = land_pages(pages)
    stop_on_conflicts(landing)
    return landing.records


def page_gaps(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Where landing broke off: ``offset`` of each page that is not there, and of each page
    before the last that is short. Empty if the pages follow each other from 0."""
    sizes = pages.select("offset", F.coalesce(F.size("results"), F.lit(0)).alias("n"))
    last = sizes.agg(F.max("offset"))
    expected = sizes.select((F.col("offset") + page_size).alias("offset")).where(
        F.col("offset") <= last.scalar()).unionByName(
        sizes.agg(F.lit(0).cast("bigint").alias("offset"), F.count(F.lit(1)).alias("n")).where("n > 0").select("offset"))
    absent = expected.distinct().join(sizes, "offset", "left_anti").select("offset", F.lit("missing").alias("problem"))
    short = sizes.where((F.col("n") < page_size) & (F.col("offset") < last.scalar()))
    return absent.unionByName(short.select("offset", F.lit("short").alias("problem")))


def first_records(records: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` records landed first, by ``occ_id``, which must be unique.

    Finds the last id that belongs to them and filters by it. The id's range is cut into
    CUT_BUCKETS parts, which are counted; the part in which the count reaches the limit is cut
    again, until it is one id wide. So no task holds the records, however many are asked for.
    """
    ids = stage(records.select("occ_id"), "ids")
    low, high = ids.agg(F.min("occ_id"), F.max("occ_id")).first()
    wanted = limit
    while low is not None and low < high and wanted > 0:
        width = (high - low) // CUT_BUCKETS + 1
        part = F.expr(f"(occ_id - ({low})) div {width}")
        counts = ids.where(F.col("occ_id").between(low, high)).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("part")))
        reached = upto.where(F.col("upto") >= wanted).orderBy("part").first()
        if reached is None:  # fewer records than asked for
            return records
        wanted -= reached.upto - reached.n
        low += reached.part * width
        high = min(high, low + width - 1)
    return records.where(F.col("occ_id") <= high) if wanted > 0 and low is not None else records.limit(0)
