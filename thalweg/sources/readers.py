"""Readers of the source and lookup tables, with fixed schemas.

Parquet readers select the schema's columns, so that unused ones stay unread,
and cast them, so that whole-number decimals arrive as integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thalweg import schemas
from thalweg.functions.wkb import wkb_points
from thalweg.sources.writers import longest_texts, raise_if_longer
from thalweg.staging import stage


def read_observations(spark: SparkSession, path: str, geometry: str = "geom") -> DataFrame:
    """Source observations, with `x` and `y`, or `points` for multi-part positions.

    The source is read once, here, into a stored table that all later steps use. Texts longer than
    their declared length stop the read: all rows are checked, matched or not.

    The file holds `x` and `y`, a `points` array, or well-known binary in
    `geometry`. A whole new file replaces the old one: nothing is kept between
    reads.
    """
    df = spark.read.parquet(path)
    fields = schemas.OBSERVATION_FIELDS
    if {"x", "y"} <= set(df.columns):
        return _checked(_typed(df, schemas.OBSERVATIONS.fields), fields)
    if "points" in df.columns:
        return _checked(_typed(df, schemas.MULTIPART_OBSERVATIONS.fields), fields)
    return _checked(df.select(*_casts(df, fields), wkb_points(geometry).alias("points")), fields)


def _checked(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """`df` as a stored table, with its texts measured while it is written: the source is read once."""
    limits, seen = schemas.length_limits(T.StructType(fields)), Observation()
    stored = stage(df.observe(seen, *longest_texts(limits)), "read-observations")
    raise_if_longer(seen.get, limits)
    return stored


def read_streams(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark.read.parquet(path), schemas.STREAMS.fields)


def read_waterbody_xref(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark.read.parquet(path), schemas.WATERBODY_XREF.fields)


def read_waterbodies(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark.read.parquet(path), schemas.WATERBODIES.fields)


def read_stream_xref(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark.read.parquet(path), schemas.STREAM_XREF.fields)


def read_waterbody_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, compressed or not."""
    return _csv(spark, path, schemas.WATERBODY_DICTIONARY)


def read_species(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, compressed or not."""
    return _csv(spark, path, schemas.SPECIES)


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An empty field is NULL, a quoted empty field an empty text; bad rows stop the job."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .csv(path)
    )


def _typed(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    return df.select(*_casts(df, fields))


def _casts(df: DataFrame, fields: list[T.StructField]):
    """Columns in schema form. A number that isn't whole stops the job."""
    out = []
    for f in fields:
        c = F.col(f.name)
        actual = df.schema[f.name].dataType
        if isinstance(f.dataType, T.IntegralType) and isinstance(actual, T.FractionalType):
            # NaN and infinite values fail this too; a whole number too large fails the cast
            whole = c.isNull() | (c == F.floor(c))
            c = F.when(whole, c.cast(f.dataType)).otherwise(
                F.raise_error(F.concat(F.lit(f"{f.name} isn't whole: "), c.cast("string")))
            )
        out.append(c.cast(f.dataType).alias(f.name, metadata=f.metadata))
    return out
