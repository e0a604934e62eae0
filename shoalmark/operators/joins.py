"""Equi-join against a table whose size is known: broadcast when small, else salted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalmark.session import broadcast_budget, stage

# A key holding more than one part in HOT_SHARE of the left rows counts as hot, so
# there are fewer than HOT_SHARE hot keys however large the data is.
HOT_SHARE = 2000


def hot_keys(counted: DataFrame, on: Sequence[str], weight: str = "n") -> DataFrame:
    """Keys heavy enough to be split, with the number of parts for each; under HOT_SHARE rows."""
    total = counted.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("total"))
    return stage(
        counted.where(F.col(weight) * HOT_SHARE > total.scalar())
        .select(*on, F.ceil(F.col(weight) * HOT_SHARE / total.scalar()).cast("int").alias("__parts")),
        "hot-keys",
    )


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                hot: DataFrame) -> DataFrame:
    """Inner shuffle join that spreads each hot key of ``left`` over its own number of parts.

    Rows of a hot key get a part by the hash of the whole row; ``right`` rows of that
    key are repeated once per part. No row is dropped and none is matched twice.
    """
    on = list(on)
    hot = F.broadcast(hot)
    salted_left = left.join(hot, on, "left").withColumn(
        "__salt", F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("__parts")), F.lit(0))
    ).drop("__parts")
    salted_right = right.join(hot, on, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("__parts", F.lit(1)) - 1))
    ).drop("__parts")
    return salted_left.join(salted_right, [*on, "__salt"]).drop("__salt")


def sized_join(left: DataFrame, right: DataFrame, on: Sequence[str], right_bytes: int,
               counted: DataFrame | None = None) -> DataFrame:
    """Inner join on ``on``: no shuffle of ``left`` if ``right`` is measured to fit a broadcast.

    ``counted`` gives rows of ``left`` per key (columns ``on`` and ``n``) where the caller
    has them already. Otherwise ``left`` is staged and counted here, so that what leads to
    it runs once, and only when salting is needed.
    """
    if right_bytes <= broadcast_budget(left.sparkSession):
        return left.join(F.broadcast(right), list(on))
    if counted is None:
        left = stage(left, "join-input")
        counted = left.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    return salted_join(left, right, on, hot_keys(counted, on))


def left_sized_join(left: DataFrame, right: DataFrame, on: Sequence[str], right_bytes: int) -> DataFrame:
    """Left join on keys that ``right`` has once each: ``left`` is not shuffled if ``right`` is
    measured to fit a broadcast."""
    if right_bytes <= broadcast_budget(left.sparkSession):
        right = F.broadcast(right)
    return left.join(right, list(on), "left")
