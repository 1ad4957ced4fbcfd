"""First row per group, key checks and the duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thalweg.functions import KEY_COLUMNS, hashed_key


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every group in `order`.

    Filtering a row number lets the planner cut every group to one row *before*
    the shuffle, so a key that holds most of the table sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(w)).where("_position = 1").drop("_position")


def with_observation_key(observations: DataFrame) -> DataFrame:
    rest = [F.col(c) for c in observations.columns]
    return observations.select(hashed_key(*KEY_COLUMNS).alias("observation_key"), *rest)


def dedupe_by_key(
    df: DataFrame,
    key: str = "observation_key",
    first_by: Sequence[str] = ("fish_observation_point_id",),
) -> DataFrame:
    """One row per key: lowest `first_by`, then the remaining columns decide.

    Ordering by every column makes the survivor independent of how the input
    is laid out, and gives all readers of the result the same shuffle, which
    Spark then runs once.
    """
    rest = [c for c in df.columns if c != key and c not in first_by]
    order = [F.col(c).asc_nulls_last() for c in (*first_by, *rest)]
    return first_per_group(df, [key], order)


def duplicate_report(df: DataFrame, cols: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Groups of rows that agree on `cols` (NULLs agree), with their size `n`."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def repeated_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise if any combination of `cols` is NULL or occurs twice, as a key must."""
    nulls = F.lit(False)
    for c in cols:
        nulls = nulls | F.col(c).isNull()
    keys = df.groupBy(*cols).agg(F.count("*").alias("n"))
    bad = keys.where((F.col("n") > 1) | nulls).limit(1).collect()
    if bad:
        raise ValueError(f"not a unique key: {bad[0].asDict()}")


def key_collisions(observations: DataFrame) -> DataFrame:
    """How many distinct key-column tuples and distinct keys a source holds.

    The difference is what null skipping and the short hash merge.
    """
    tuples = with_observation_key(observations).select("observation_key", *KEY_COLUMNS).distinct()
    keys = tuples.groupBy("observation_key").agg(F.count("*").alias("n"))
    return keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_tuples"),
        F.count("*").alias("n_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_merged"),
    )
