"""Writers of the output table, its export and the duplicate report."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from thalweg.functions.wkb import with_wkb
from thalweg.operators.grouping import assert_unique, duplicate_report
from thalweg.schemas import OUTPUT, OUTPUT_COLUMNS, length_limits

#: Digits of an entry's number.
_DIGITS = 12
SORTED_BY = ("blue_line_key", "downstream_route_measure", "observation_key")


def write_duplicates(df: DataFrame, path: str) -> None:
    """The duplicate report of a source as CSV with a header."""
    duplicate_report(df).write.mode("overwrite").option("header", True).csv(path)


class PublishConflict(RuntimeError):
    """Another run was published while this one was written."""


def write_observations(df: DataFrame, path: str) -> str:
    """Replace the output table at `path`; readers see the old or the new one.

    The rows go to a run folder of their own. Only once they pass the checks is
    the run entered as the table's next numbered entry; a failed run leaves the published
    table as it was. The number is that after the one published when the write began, and its
    entry is a file that can be made only once: of two writers that began at the same state, one wins and the
    other gets a `PublishConflict`.
    """
    spark = df.sparkSession
    number = _last(spark, path)[1] + 1
    run = f"run-{uuid.uuid4().hex}"
    clustered = df.select(*OUTPUT_COLUMNS).repartitionByRange(*SORTED_BY).sortWithinPartitions(*SORTED_BY)
    limits, seen = length_limits(OUTPUT), Observation()
    clustered.observe(seen, *longest_texts(limits)).write.mode("errorifexists").parquet(f"{path}/runs/{run}")
    raise_if_longer(seen.get, limits)
    written = spark.read.schema(OUTPUT).parquet(f"{path}/runs/{run}")
    assert_unique(written, ["observation_key"])
    _enter(spark, path, number, run)
    return run


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The last published output table."""
    run, number = _last(spark, path)
    if not number:
        raise ValueError(f"nothing is published at {path}")
    return spark.read.schema(OUTPUT).parquet(f"{path}/runs/{run}")


def _enter(spark: SparkSession, path: str, number: int, run: str) -> None:
    """Make entry `number`, which names `run`, unless it is there.

    The entry is written aside and then renamed to its place, which fails where there is one. So an entry is
    whole from the start and made by one writer only, on file systems whose renames are atomic.
    """
    fs, folder = _entries(spark, path)
    fs.mkdirs(folder)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    entry, aside = hadoop.Path(folder, f"{number:0{_DIGITS}d}-entry"), hadoop.Path(folder, f".{run}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(run, "ascii"))
    finally:
        out.close()
    try:
        made = _link(aside, entry) if fs.getScheme() == "file" else fs.rename(aside, entry)
    finally:
        fs.delete(aside, False)
    if not made:
        raise PublishConflict(f"entry {number} of {path} was made by another run")


def _link(aside, entry) -> bool:
    """As a rename that doesn't replace, which a local file system hasn't."""
    try:
        os.link(aside.toUri().getPath(), entry.toUri().getPath())
    except FileExistsError:
        return False
    return True


def _last(spark: SparkSession, path: str) -> tuple[str, int]:
    """The run with the largest number, which no clock decides; (empty, 0) before the first."""
    fs, folder = _entries(spark, path)
    if not fs.exists(folder):
        return "", 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = [int(n[:_DIGITS]) for n in names if n.endswith("-entry")]
    if not numbers:
        return "", 0
    last = max(numbers)
    entry = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{last:0{_DIGITS}d}-entry")
    return _run_of(fs, entry), last


def _entries(spark: SparkSession, path: str):
    """The file system, and the folder of entries."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/published")
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _run_of(fs, entry) -> str:
    opened = fs.open(entry)
    try:
        return bytes(opened.readNBytes(100)).decode("ascii")
    finally:
        opened.close()


def export_observations(df: DataFrame, path: str, columns: Sequence[str] = OUTPUT_COLUMNS, binary: bool = False) -> None:
    """The output columns, path codes as text, snapped position only, as Parquet.

    With `binary` the position is well-known binary with Z, which other tools read, instead of a struct.
    """
    chosen = df.select(*columns)
    (with_wkb(chosen) if binary else chosen).write.mode("overwrite").parquet(path)


def export_events(events: DataFrame, path: str) -> None:
    """Event rows as Parquet, with the position in well-known binary with Z and M, the measure on the route."""
    with_wkb(events, measure="downstream_route_measure").write.mode("overwrite").parquet(path)


def check_lengths(df: DataFrame, limits: dict[str, int] | None = None) -> None:
    """Raise if a text column exceeds its declared length; runs over `df` once."""
    limits = length_limits(OUTPUT) if limits is None else limits
    raise_if_longer(df.agg(*longest_texts(limits)).collect()[0].asDict(), limits)


def longest_texts(limits: dict[str, int]) -> list[Column]:
    """The length of each column's longest text, as aggregates: for a table, or observed while it is written."""
    return [F.max(F.length(c)).alias(c) for c in limits]


def raise_if_longer(longest: dict[str, int | None], limits: dict[str, int]) -> None:
    over = {c: longest[c] for c, n in limits.items() if longest.get(c) is not None and longest[c] > n}
    if over:
        raise ValueError(f"text longer than declared: {over}")
