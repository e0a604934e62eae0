"""Helpers shared by the operators: tables, tokens, hashes and Arrow tasks."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalmark.session import broadcast_budget

# The white space that separates words in the query contracts.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z in lower case, split on space, tab, \\n, \\v, \\f and \\r."""
    return text.encode().lower().split() if text else []


def hash_words(tokens: Iterable[bytes]) -> Iterator[int]:
    return map(xxhash.xxh3_64_intdigest, tokens)


def remainder(doc_id: int | None, modulus: int) -> int | None:
    """crc32 of the id as text, modulo; null for a null id."""
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def remainder_column(doc_id: str, modulus: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(modulus))


def text_key(doc_id: Column, text: Column) -> Column:
    """Names a document by its id and its text; only rows repeated in both share it."""
    return F.xxhash64(doc_id.cast("string"), F.sha2(text, 256))


def other_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns but those of these names; Spark tells names apart without case."""
    taken = {name.lower() for name in names}
    return [c for c in df.columns if c.lower() not in taken]


def unused_names(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column has."""
    taken = {c.lower() for c in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        free.append(name)
    return free


def in_arrow(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``rows`` (batch to columns by name) to each Arrow batch of ``df``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = rows(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def left_join_sized(left: DataFrame, right: DataFrame, on: list[str], right_bytes: int) -> DataFrame:
    """Left join that broadcasts ``right`` if it is measured to fit, else shuffles both sides.

    ``right`` has each key once, so in the shuffle join only ``left`` can be skewed, and
    adaptive execution splits its large partitions.
    """
    if right_bytes <= broadcast_budget(left.sparkSession):
        right = F.broadcast(right)
    return left.join(right, on, "left")
