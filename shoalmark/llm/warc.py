"""WARC archives with a two-level capture index.

Records are gzip members of their own in files that Spark's text sink writes, so any file
system that Spark writes to will do. The index keeps captures sorted by reversed-host key
in compressed blocks. A sparse directory has the first key of each block; look-ups search
it and then the block by bisection. Reading loads each archive that has a wanted record
whole, and decompresses nothing but the byte range of each record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shoalmark.llm.common import in_arrow
from shoalmark.operators.joins import sized_join
from shoalmark.session import broadcast_budget, scratch_path, stage

# Formats of the WARC 1.1 standard.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# An empty gzip member. As the line separator of the text sink it ends every record and
# keeps the file a chain of gzip members; see ``write_archives``.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

RECORD = ("page_id long, url string, record_type string, payload_bytes long, "
          "payload_digest string, refers_to long, payload binary")
READ_ROWS = 1000  # records that leave a reading task together
CAPTURE = "url_key string, record_id string, path string, start long, length long"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), *BASE32)


def record_id(page_id: int | None) -> str:
    """Names the captures of a page; rows that repeat a page_id share a name."""
    return f"urn:page:{page_id}"


def url_key(url: str | None) -> str:
    """Reversed host, port, path and query, so that captures of a site sort together."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:  # not a URL by its syntax: sorted as it is
        return url
    tail = parts.path + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}{f':{port}' if port else ''}){tail}"


def header_text(value: str) -> str:
    """A header value on one line, reversibly."""
    return json.dumps(value)[1:-1]


def to_record(row: dict) -> bytes:
    """One WARC record, with the payload or, for a revisit, a reference in its place."""
    response = row["record_type"] == "response"
    body = row["payload"] if response else b""
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<{record_id(row['page_id'])}>",
        "WARC-Payload-Digest": f"sha1:{row['payload_digest']}",
        "Content-Type": "text/html; charset=utf-8",
        "X-Payload-Length": str(row["payload_bytes"]),
    }
    if row["url"] is not None:
        headers["WARC-Target-URI"] = header_text(row["url"])
    if not response:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = f"<{record_id(row['refers_to'])}>"
    headers["Content-Length"] = str(len(body))
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode()
    return VERSION + head + b"\r\n" + body + b"\r\n\r\n"


def from_record(data: bytes) -> dict:
    """Headers and body of one record; raises unless it is whole and its digest holds."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] + b"\r\n" != VERSION:
        raise ValueError("not a WARC record")
    headers = dict(line.decode().split(": ", 1) for line in lines[1:])
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("record cut short")
    body, digest = rest[:length], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    response = headers["WARC-Type"] == "response"
    if response and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
        raise ValueError("payload does not have its digest")
    uri = headers.get("WARC-Target-URI")
    return {
        "page_id": page_id(headers["WARC-Record-ID"]),
        "url": None if uri is None else json.loads(f'"{uri}"'),
        "record_type": headers["WARC-Type"], "payload_digest": digest,
        "payload_bytes": len(body) if response else int(headers["X-Payload-Length"]),
        "refers_to": None if response else page_id(headers["WARC-Refers-To"]),
        "payload": body if response else None,
    }


def page_id(name: str) -> int | None:
    number = name.strip("<>").removeprefix("urn:page:")
    return None if number == "None" else int(number)


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """What each page's record holds. Of equal payloads of ``least_bytes`` or more the smallest
    page_id is the response and the others revisit it; smaller payloads are all responses."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("payload"))
    digested = rows.select(
        "page_id", "url", F.octet_length("payload").cast("long").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"), "payload")
    repeated = (digested.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
                .agg(F.min("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
                .where((F.col("n") > 1) & F.col("response_id").isNotNull()))
    # Only payloads that occur twice need their response; the others join nothing.
    repeated = stage(repeated, "repeated-payloads")
    size = repeated.count() * 64
    if size <= broadcast_budget(pages.sparkSession):
        joined = digested.join(F.broadcast(repeated.drop("n")), "payload_digest", "left")
    else:
        inner = sized_join(digested, repeated.drop("n"), ["payload_digest"], size,
                           counted=repeated.select("payload_digest", "n"))
        alone = digested.join(repeated, "payload_digest", "left_anti")
        joined = inner.unionByName(alone.withColumn("response_id", F.lit(None).cast("long")))
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return joined.select(
        "page_id", "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "payload_bytes", "payload_digest", F.when(revisit, F.col("response_id")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def write_archives(rows: DataFrame, path: str, records_per_file: int = 4000) -> None:
    """Write the records of ``records`` as gzip archives below ``path``.

    Readers hold one archive at a time, so ``records_per_file`` must keep it well below the
    2 GB that Spark can hold in a cell.

    The text sink writes bytes as they are; its line separator, an empty gzip member, is
    passed as Latin-1 so that it too is written byte for byte.
    """

    def compressed(batch: pa.RecordBatch) -> dict:
        return {"member": [gzip.compress(to_record(row), 6, mtime=0) for row in _rows(batch)]}

    (in_arrow(rows, compressed, "member binary").select(F.col("member").cast("string"))
     .write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", records_per_file).text(path))


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one after the other, so that a batch's payloads are not all copied at once."""
    names = batch.schema.names
    for k in range(batch.num_rows):
        yield {name: batch[name][k].as_py() for name in names}


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def members(data: memoryview, chunk: int = 16_384) -> Iterator[tuple[int, int, bytes]]:
    """(start, length, content) of each gzip member that has content.

    Fed in chunks, as what follows a member is copied out of the decompressor.
    """
    at = 0
    while at < len(data):
        inflate, fed, content = zlib.decompressobj(wbits=31), at, []
        while not inflate.eof:
            if fed >= len(data):
                raise ValueError("archive cut short")
            content.append(inflate.decompress(data[fed:fed + chunk]))
            fed = min(fed + chunk, len(data))
        used = fed - len(inflate.unused_data) - at
        if any(content):
            yield at, used, b"".join(content)
        at += used


def captures(spark: SparkSession, archives: str) -> DataFrame:
    """Scan archives once: key, record id and byte range of every record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch["path"].to_pylist(), batch["content"]):
                out: dict[str, list] = {name.split()[0]: [] for name in CAPTURE.split(", ")}
                for start, length, content in members(memoryview(data.as_buffer())):
                    row = from_record(content)
                    for name, value in zip(out, (url_key(row["url"]), record_id(row["page_id"]),
                                                 path, start, length)):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out)

    return archive_files(spark, archives).mapInArrow(run, CAPTURE)


def build_index(found: DataFrame, path: str, block_rows: int = 3000) -> DataFrame:
    """Sort captures by (url_key, record_id) into compressed blocks of ``block_rows`` lines.

    Written to ``path`` as rows (part, first_key, last_key, lines), one per block; the key
    columns alone are the sparse directory. Parts are ranges of the sorted captures. The
    sort takes record and place along, so one busy key is spread over blocks and parts.
    """
    order = [c.split()[0] for c in CAPTURE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []
        for batch in batches:
            pending += zip(*(batch[name].to_pylist() for name in order))
            while len(pending) >= block_rows:
                yield block(pending[:block_rows])
                pending = pending[block_rows:]
        if pending:
            yield block(pending)

    def block(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "first_key": [sort_key(*rows[0][:2])], "last_key": [sort_key(*rows[-1][:2])],
            "lines": [zlib.compress("\n".join(map(json.dumps, rows)).encode())]})

    (found.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(run, "first_key string, last_key string, lines binary")
     .withColumn("part", F.spark_partition_id()).write.parquet(path))
    return found.sparkSession.read.parquet(path)


def sort_key(key: str, record: str) -> str:
    """Sorts as (key, record) do: NUL is below every character that either has."""
    return f"{key}\0{record}"


def covering(firsts: list[str], lasts: list[str], key: str) -> range:
    """The consecutive ranges first..last that hold ``key``; found by bisection."""
    return range(bisect_left(lasts, key), bisect_right(firsts, key))


def lookup(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Byte ranges of the captures of each distinct (url_key, record_id) in ``wanted``.

    The top of the directory has one row per index part (as many as the index was written
    in tasks) and goes along with the code. Bisecting it names the part of a key; in that
    part the key meets the block directory, which is bisected for the block, and the block's
    lines, which are bisected for the captures. Parts that no key needs are not read further.
    """
    tops = sorted((r.first, r.last, r.part) for r in index.groupBy("part").agg(
        F.min("first_key").alias("first"), F.max("last_key").alias("last")).collect())
    firsts, lasts, parts = ([t[i] for t in tops] for i in range(3))

    def to_part(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"asked": [], "asked_part": []}
        for key in map(sort_key, batch["url_key"].to_pylist(), batch["record_id"].to_pylist()):
            for at in covering(firsts, lasts, key):
                out["asked"].append(key), out["asked_part"].append(parts[at])
        return out

    def find(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by([("first_key", "ascending"), ("last_key", "ascending")])
        first, last = blocks["first_key"].to_pylist(), blocks["last_key"].to_pylist()
        by_block: dict[int, list[str]] = {}
        for key in asked["asked"].to_pylist():
            for at in covering(first, last, key):
                by_block.setdefault(at, []).append(key)
        out: list[list] = []
        for at, keys in by_block.items():
            lines = [json.loads(x) for x in zlib.decompress(blocks["lines"][at].as_buffer()).split(b"\n")]
            names = [sort_key(*line[:2]) for line in lines]
            for key in keys:
                out += lines[bisect_left(names, key):bisect_right(names, key)]
        columns = list(zip(*out)) or [[]] * len(names_of)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names_of)

    names_of = [c.split()[0] for c in CAPTURE.split(", ")]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    routed = in_arrow(wanted.select("url_key", "record_id").distinct(), to_part,
                      "asked string, asked_part int")
    needed = index.join(F.broadcast(routed.select(F.col("asked_part").alias("part")).distinct()),
                        "part", "left_semi")
    return routed.groupBy("asked_part").cogroup(needed.groupBy("part")).applyInArrow(find, CAPTURE)


def read_ranges(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """RECORD rows of the byte ranges ``lookup`` gives, from the archives below ``path``.

    Files meet their ranges by an equi-join, which broadcasts the ranges if they are small;
    each range is cut out of its file, and nothing else is decompressed.
    """
    ranges = stage(ranges.groupBy("path").agg(
        F.collect_list(F.struct(F.col("start").cast("int").alias("start"),
                                F.col("length").cast("int").alias("length"))).alias("ranges"),
        F.count(F.lit(1)).alias("n")), "ranges")
    size = ranges.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n * 8 + ranges.count() * 256
    files = sized_join(archive_files(spark, path), ranges.drop("n"), ["path"], size,
                       counted=ranges.select("path", F.lit(1).alias("n")))
    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, places in zip(batch["content"], batch["ranges"]):
                data = memoryview(data.as_buffer())
                places = [(p["start"], p["start"] + p["length"]) for p in places.as_py()]
                for k in range(0, len(places), READ_ROWS):
                    rows = [from_record(gzip.decompress(data[a:b])) for a, b in places[k:k + READ_ROWS]]
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("content", "ranges").mapInArrow(run, RECORD)


def page_names(pages: DataFrame) -> DataFrame:
    """(url_key, record_id) of each page, for ``lookup``."""

    def rows(batch: pa.RecordBatch) -> dict:
        return {"url_key": list(map(url_key, batch["url"].to_pylist())),
                "record_id": list(map(record_id, batch["page_id"].to_pylist()))}

    return in_arrow(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")), rows,
                    "url_key string, record_id string")


def round_trip(pages: DataFrame, least_bytes: int = 0, block_rows: int = 3000) -> DataFrame:
    """Write all pages as WARC, index the archives, and read each page's captures back.

    Returns RECORD rows, one per input row. A null html is an empty payload. Null urls sort
    first, null page_ids are captures without an id and never the response of another. Of
    rows that repeat the smallest page_id of a payload each is a response. An empty table
    gives no rows. Only page_id, url and html are read. A very long payload is one record, which
    its task holds whole; an archive with it must stay below 2 GB (see ``write_archives``).
    """
    spark = pages.sparkSession
    archives, index_path = scratch_path(spark, "warc"), scratch_path(spark, "captures")
    write_archives(records(pages, least_bytes), archives)
    index = build_index(stage(captures(spark, archives), "found"), index_path, block_rows)
    return read_ranges(spark, archives, lookup(index, page_names(pages)))
