"""The event table on disk, with posting tables that answer which events hold an id.

Events are laid out in buckets by event id. Beside them, for each of the id arrays,
stands a table of (id, event id) in buckets by id. A lookup by ids reads the buckets of those
postings, and then only the buckets of the events they name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.operators.events import explode_events

EVENT_ID = "fish_obsrvtn_event_id"
INDEXED = ("obs_ids", "species_ids")
BUCKETS = 64
#: Up to so many events are looked up by their ids; more of them are found by a join.
FEW_EVENTS = 10_000


def write_events(events: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write an event table (rows as of `rollup_events`) and its postings to a new folder.

    Buckets are cut by size as they are written, so that one that holds very much is several files.
    """
    events.sparkSession.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{path}/layout")
    _write(events, EVENT_ID, f"{path}/events", buckets)
    for column in INDEXED:
        listed = events.select(F.explode(F.array_distinct(column)).alias("id"), EVENT_ID).where("id is not null")
        _write(listed.distinct(), "id", f"{path}/{column}", buckets)


def _write(df: DataFrame, key: str, path: str, buckets: int) -> None:
    placed = df.withColumn("bucket", _bucket(F.col(key), buckets)).hint("rebalance", "bucket")
    placed.sortWithinPartitions("bucket", key).write.mode("errorifexists").partitionBy("bucket").parquet(path)


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(buckets)).cast("int")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/events").drop("bucket")


def stored_events_with(spark: SparkSession, path: str, column: str, ids: Sequence[int]) -> DataFrame:
    """All rows of the stored events whose array `column` (one of `INDEXED`) holds any of the ids."""
    if column not in INDEXED:
        raise ValueError(f"{column} has no postings")
    buckets = spark.read.parquet(f"{path}/layout").first().buckets
    postings = _of(spark.read.parquet(f"{path}/{column}"), "id", ids, buckets)
    events = spark.read.parquet(f"{path}/events")
    found = postings.select(EVENT_ID).distinct()
    few = [r[0] for r in found.limit(FEW_EVENTS + 1).collect()]
    if len(few) <= FEW_EVENTS:
        return _of(events, EVENT_ID, few, buckets).drop("bucket")
    return events.join(found, EVENT_ID, "left_semi").drop("bucket")


def _of(df: DataFrame, key: str, ids: Sequence[int], buckets: int) -> DataFrame:
    """The rows with these keys, from their buckets only."""
    keys = sorted({int(i) for i in ids})
    if not keys:
        return df.where(F.lit(False))
    spark = df.sparkSession
    own = spark.createDataFrame([(k,) for k in keys], "k long").select(_bucket(F.col("k"), buckets).alias("b")).distinct()
    return df.where(F.col("bucket").isin([r.b for r in own.collect()]) & F.col(key).isin(keys))


def create_event_view(
    spark: SparkSession, path: str, streams: DataFrame, observations: DataFrame, species: DataFrame, name: str = "observation_events"
) -> DataFrame:
    """Make the stored events, as single observations, a temporary view for SQL; returns the view's rows."""
    rows = explode_events(read_events(spark, path), streams, observations, species)
    rows.createOrReplaceTempView(name)
    return spark.table(name)
