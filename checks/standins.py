"""Domain tables derived from the test data's `orders` and `events`.

Each function returns the Spark form of a table that `checks.oracle` builds
again in DuckDB SQL. Only integer arithmetic and exact doubles are used, so
both engines hold identical rows.
"""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thalweg.plans import Sources

SEGMENTS_PER_ROUTE = 10


def _vertex(e: int) -> str:
    j = f"(2 * i + {e})"
    return f"""named_struct(
        'x', cast((l % 20) * 1400 + (l * 37) % 300 + 60 * {j} as double),
        'y', cast((l div 20) * 500 + (l * 53) % 200 + (l * 31 + 17 * {j} * {j}) % 97 as double),
        'z', cast(500 + l % 100 as double) + {j} * 0.5D,
        'm', cast(65 * {j} as double) + 0.25D)"""


def streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.selectExpr("o_orderkey", "o_orderkey div 10 as l", "o_orderkey % 10 as i").selectExpr(
        "o_orderkey as linear_feature_id",
        "354087611 + l as blue_line_key",
        "case when l % 50 = 7 then 6010 when l % 4 < 2 then 1200 else 1000 end as edge_type",
        """case when l % 47 = 9 then null when l % 43 = 5 then concat('999.', l)
            else concat('100.', 1000000 + l) end as wscode_ltree""",
        "if(l % 41 = 3, null, concat('100.', 1000000 + l, '.', i)) as localcode_ltree",
        "if(l % 4 < 2, 1000 + l div 4, null) as waterbody_key",
        "concat('GRP', l % 7) as watershed_group_code",
        "cast(130 * i as double) + 0.25D as downstream_route_measure",
        "cast(130 * (i + 1) as double) + 0.25D as upstream_route_measure",
        "concat('River ', l % 20) as gnis_name",
        "cast(o_orderkey % 400 as double) / 10000D as gradient",
        "cast(1 + o_orderkey % 7 as int) as stream_order",
        f"array({_vertex(0)}, {_vertex(1)}, {_vertex(2)}) as vertices",
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Needs the route count up front: one row-count action on `orders`."""
    routes = spark.read.parquet(f"{sf_dir}/orders.parquet").count() // SEGMENTS_PER_ROUTE
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr(
        "event_id as e", "ts", "user_id as u", "event_type", f"(event_id * 7) % {routes} as l"
    ).selectExpr(
        "e as fish_observation_point_id",
        "if(e % 13 = 0, null, l div 4 + e % 2) as wbody_id",
        "upper(substring(event_type, 1, 2)) as species_code",
        "u % 9 as agency_id",
        "if(e % 10 = 0, 'Summary', 'Observation') as point_type_code",
        "cast(ts as date) as observation_date",
        "concat('Agency ', u % 9) as agency_name",
        "concat('src', e % 3) as source",
        "concat('report ', u) as source_ref",
        "cast(9 + u % 3 as int) as utm_zone",
        "cast(400000 + (u % 20) * 1400 as int) as utm_easting",
        "cast(5000000 + (u % 5) * 500 as int) as utm_northing",
        "if(e % 4 = 1, null, 'A') as activity_code",
        "if(e % 4 = 1, null, 'Activity') as activity",
        "if(e % 4 = 0, null, 'A') as life_stage_code",
        "if(e % 4 = 0, null, 'Adult') as life_stage",
        "event_type as species_name",
        "concat(lpad(l div 4 + 1, 5, '0'), 'ABCD') as waterbody_identifier",
        "case e % 6 when 0 then 'Lake' when 1 then 'Wetland' when 5 then null else 'Stream' end as waterbody_type",
        "concat('River ', l % 20) as gazetted_name",
        "concat('100-', 1000000 + l) as new_watershed_code",
        "concat('100-', 1000000 + l) as trimmed_watershed_code",
        "concat('report/', u) as acat_report_url",
        "concat('F', e % 5) as feature_code",
        """cast((l % 20) * 1400 + (e * 131) % 1500 - if(e % 17 = 0, (e * 11) % 9000, 0) as double) as x""",
        "cast((l div 20) * 500 + (e * e * 29) % 700 - 100 as double) as y",
    )


def branch_code(route: Column) -> Column:
    """The code of a route in a branching network: the digits of its number in base four; route r runs into r div 4."""
    digits = F.conv(route.cast("string"), 10, 4)
    return F.concat(F.lit("1"), F.regexp_replace(digits, "(.)", ".$1"))


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    routes = orders.selectExpr("o_orderkey div 10 as route").distinct()
    return routes.withColumn("code", branch_code(F.col("route")))


def waterbodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    routes = orders.selectExpr("o_orderkey div 10 as l").where("l % 4 < 2")
    return routes.selectExpr("1000 + l div 4 as waterbody_key").distinct()


def waterbody_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return waterbodies(spark, sf_dir).selectExpr(
        "waterbody_key - 1000 as id",
        "concat(lpad(waterbody_key - 999, 5, '0'), 'ABCD') as waterbody_identifier",
    )


def waterbody_xref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return waterbodies(spark, sf_dir).selectExpr(
        "waterbody_key - 999 as waterbody_key_50k",
        "'ABCD' as watershed_group_code_50k",
        "waterbody_key as waterbody_key_20k",
    )


def stream_xref(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.where("(o_orderkey % 10) % 3 = 0").selectExpr(
        "concat('100', 1000000 + o_orderkey div 10) as watershed_code_50k",
        "o_orderkey as linear_feature_id_20k",
    )


def species(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_type").distinct().selectExpr(
        "cast(length(event_type) * 100 + ascii(event_type) as int) as species_id",
        "upper(substring(event_type, 1, 2)) as code",
        "event_type as name",
    )


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        observations=observations(spark, sf_dir),
        streams=streams(spark, sf_dir),
        waterbody_dictionary=waterbody_dictionary(spark, sf_dir),
        waterbody_xref=waterbody_xref(spark, sf_dir),
        waterbodies=waterbodies(spark, sf_dir),
        stream_xref=stream_xref(spark, sf_dir),
        species=species(spark, sf_dir),
    )


@F.arrow_udf(T.BinaryType())
def binary_position(x: pa.Array, y: pa.Array, parts: pa.Array) -> pa.Array:
    """Well-known binary: a point, or with two parts a multi-point whose second part lies one to the east."""
    out = []
    for a, b, n in zip(x.to_pylist(), y.to_pylist(), parts.to_pylist()):
        points = [struct.pack("<BIdd", 1, 1, a + i, b) for i in range(n)]
        out.append(points[0] if n == 1 else struct.pack("<BII", 1, 4, n) + b"".join(points))
    return pa.array(out, pa.binary())


def binary_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations as a source may hold them: binary positions, decimal ids, every fifth in two parts."""
    parts = F.when(F.col("fish_observation_point_id") % 5 == 0, 2).otherwise(1)
    rows = observations(spark, sf_dir).withColumn("geom", binary_position("x", "y", parts)).drop("x", "y")
    decimals = {c: F.col(c).cast("decimal(20,2)") for c in ("fish_observation_point_id", "wbody_id", "utm_zone")}
    return rows.withColumns(decimals)


def padded(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All columns of a schema, those that `df` lacks NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
