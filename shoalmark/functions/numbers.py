"""Numeric helpers: missing values, repeatable draws, even spacing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42  # fixed value


def nan_to_null(value: Column) -> Column:
    """NaN counts as missing, so that averages and extremes skip it."""
    return F.when(~F.isnan(value), value)


def seeded_hash(seed: int, tag: str, *keys: Column) -> Column:
    """Hex digest of the seed, a tag and the row's keys, the same on every partitioning.

    A NULL key counts as a value of its own, so ("a", NULL) and (NULL, "a") differ.
    """
    parts = [F.lit(f"{seed}:{tag}")] + [F.coalesce(k.cast("string"), F.lit("\0")) for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def seeded_uniform(seed: int, tag: str, *keys: Column) -> Column:
    """Draw in [0, 1): the first 32 bits of the seeded hash."""
    head = F.substring(seeded_hash(seed, tag, *keys), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(4294967296.0)


def between(unit: Column, low: Column, high: Column) -> Column:
    """Move a draw from [0, 1) to [low, high)."""
    return low + unit * (high - low)


def evenly_spaced(step: Column, steps: int, low: Column, high: Column) -> Column:
    """Point ``step`` of ``steps`` from low to high, both ends included."""
    if steps == 1:
        return low
    return low + step * (high - low) / F.lit(steps - 1)
