"""Keeping equi-joins even when one key holds much of a table.

A key with many rows is cut into numbered slices; the other side gets one copy
of its rows per slice. Results don't depend on which keys are cut or how often,
so only the largest keys need to be listed, which bounds the list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 10_000
ROWS_PER_SLICE = 1_000_000

SLICE = "_slice"


def hot_keys(df: DataFrame, on: Sequence[str], rows_per_slice: int) -> DataFrame | None:
    """The keys with more than `rows_per_slice` rows and their number of `slices`.

    Runs one counting job at once, so that plans stay plain in the usual case
    that there are none (None).
    """
    counts = df.groupBy(*on).agg(F.count("*").alias("weight"))
    return heaviest_keys(counts, on, rows_per_slice)


def heaviest_keys(weights: DataFrame, on: Sequence[str], per_slice: int, most: Column | None = None) -> DataFrame | None:
    """The keys of `weights` (one row each, with `weight`) heavier than `per_slice`, and their number of `slices`, `most` at most.

    At most the `MAX_HOT_KEYS` heaviest are listed, which bounds what the driver holds and
    broadcasts; any key left out has under 1/MAX_HOT_KEYS of the whole weight. None if there are none.
    """
    slices = F.ceil(F.col("weight") / per_slice).cast("long")
    counted = weights.withColumn("slices", slices if most is None else F.least(slices, most)).where("slices > 1")
    listed = counted.orderBy(F.col("weight").desc(), *on).limit(MAX_HOT_KEYS).select(*on, "slices")
    rows = listed.collect()
    return weights.sparkSession.createDataFrame(rows, listed.schema) if rows else None


def spread(df: DataFrame, hot: DataFrame | None, on: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Give every row of the large side one slice of its key, chosen by `by`."""
    if hot is None:
        return df.withColumn(SLICE, _zero())
    joined = df.join(F.broadcast(hot), list(on), "left")
    return joined.withColumn(SLICE, F.pmod(F.xxhash64(*by), _slices())).drop("slices")


def copy_to_slices(df: DataFrame, hot: DataFrame | None, on: Sequence[str]) -> DataFrame:
    """Repeat every row of the other side for each slice of its key."""
    if hot is None:
        return df.withColumn(SLICE, _zero())
    joined = df.join(F.broadcast(hot), list(on), "left")
    every = F.sequence(_zero(), _slices() - 1)
    return joined.withColumn(SLICE, F.explode(every)).drop("slices")


def spread_join(
    large: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    by: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    counted: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Inner (or left) join whose `large` side may hold most of its rows under one key.

    `by` are columns of `large` that tell its rows apart within a key. Keys are
    counted in `counted`, if given: a stored table with the keys of `large`.
    """
    hot = hot_keys(large if counted is None else counted, on, rows_per_slice)
    if hot is None:
        return large.join(other, list(on), how)
    left, right = spread(large, hot, on, by), copy_to_slices(other, hot, on)
    return left.join(right, [*on, SLICE], how).drop(SLICE)


def _zero() -> Column:
    return F.lit(0).cast("long")


def _slices() -> Column:
    return F.coalesce("slices", F.lit(1).cast("long"))
