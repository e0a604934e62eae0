"""Stratified train and test rows with exact class counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoalmark.functions.numbers import DEFAULT_SEED, seeded_hash
from shoalmark.operators.joins import sized_join
from shoalmark.session import stage

TEST_SHARE = 0.3  # fixed value
LEAST_ROWS = 4  # fixed value: with fewer rows, all are used for training and testing
STRATUM_BYTES = 256
# 4096 buckets of a stratum's hashes: few enough that tasks count most of their rows before the
# shuffle, and the one bucket that is ranked has 1/4096 of the stratum.
BUCKET_DIGITS = 3


def _test_counts(df: DataFrame, by: list[str], label: str, share: float) -> DataFrame:
    """Rows, and rows to test, of each stratum: largest remainders, ties to the smaller label."""
    group = Window.partitionBy(*by, F.lit(0))
    n_test = F.ceil(F.lit(share) * F.col("total"))
    return (
        df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("total", F.sum("n").over(group))
        .withColumn("n_test", n_test)
        .withColumn("whole", F.expr("n_test * n div total"))
        .withColumn("rest", F.expr("n_test * n % total"))
        .withColumn("left_over", F.col("n_test") - F.sum("whole").over(group))
        .withColumn("turn", F.row_number().over(group.orderBy(F.desc("rest"), label)))
        .withColumn("take", F.col("whole") + (F.col("turn") <= F.col("left_over")).cast("int"))
        .select(*by, label, "n", "total", "take")
    )


def assign_split(df: DataFrame, label: str, key: Sequence[str], by: Sequence[str] = (),
                 share: float = TEST_SHARE, seed: int = DEFAULT_SEED) -> DataFrame:
    """Add ``role``: ``train``, ``test``, or ``both`` where a group has too few rows to split.

    Within each stratum (group and label) the rows with the smallest seeded hashes are
    tested. The hash up to which they go is found from counts per hash bucket, and only
    the one bucket it falls into is ranked, so no stratum is ever sorted as a whole.
    """
    by, key = list(by), list(key)
    strata = [*by, label]
    hashed = df.withColumn("hash", seeded_hash(seed, "split", *[F.col(k) for k in key]))
    bucket = F.substring("hash", 1, BUCKET_DIGITS)
    targets = stage(_test_counts(df, by, label, share), "split-targets")
    target_bytes = targets.count() * STRATUM_BYTES
    buckets = hashed.groupBy(*strata, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("here"))
    upto = F.sum("here").over(Window.partitionBy(*strata).orderBy("bucket"))
    edges = (
        sized_join(buckets, targets, strata, target_bytes)
        .withColumn("upto", upto)
        .where("total >= %d and take > upto - here and take <= upto" % LEAST_ROWS)
        .select(*strata, "bucket", (F.col("take") - F.col("upto") + F.col("here")).alias("rank"))
    )
    in_order = Window.partitionBy(*strata).orderBy("hash", *key)
    at_edge = sized_join(hashed.withColumn("bucket", bucket).select(*strata, *key, "hash", "bucket"),
                         edges, [*strata, "bucket"], target_bytes)
    cutoffs = (
        at_edge.withColumn("place", F.row_number().over(in_order)).where("place = rank")
        .select(*strata, F.struct("hash", *key).alias("last"))
    )
    limits = targets.join(cutoffs, strata, "left").select(*strata, "total", "last")
    role = (
        F.when(F.col("total") < LEAST_ROWS, "both")
        .when(F.struct("hash", *key) <= F.col("last"), "test").otherwise("train")
    )
    return (
        sized_join(hashed, limits, strata, target_bytes, counted=targets)
        .withColumn("role", role).select(*df.columns, "role")
    )
