import math
import struct

import pytest
from pyspark.sql import functions as F

from thalweg import functions as fn
from thalweg.functions.wkb import wkb_points
from thalweg.operators import events
from thalweg.operators.grouping import (
    assert_unique,
    dedupe_by_key,
    duplicate_report,
    first_per_group,
    with_observation_key,
)

KEY_SCHEMA = (
    "source string, species_code string, observation_date date, utm_zone int, utm_easting int,"
    " utm_northing int, life_stage_code string, activity_code string"
)


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("r")).collect()[0].r


def test_key_of_known_text(spark):
    cols = [F.lit("a"), F.lit(None).cast("string"), F.lit("2020-01-02").cast("date"), F.lit(10), F.lit("x")]
    nulls = F.lit(None).cast("string")
    assert one(spark, fn.hashed_key(*cols[:4], nulls, cols[4])) == "52a68e3b40"


def test_key_skips_nulls_but_not_empty_text(spark):
    null = F.lit(None).cast("string")
    assert one(spark, fn.hashed_key(F.lit("s"), null, F.lit("A"))) == one(
        spark, fn.hashed_key(F.lit("s"), F.lit("A"), null)
    )
    assert one(spark, fn.hashed_key(F.lit(""), null, F.lit(""))) != one(spark, fn.hashed_key(null, null, null))


def test_event_id(spark):
    assert one(spark, fn.event_id("k", "m"), k=354155148, m=34180.0) == 675380034180
    assert one(spark, fn.event_id("k", "m"), k=354155148, m=34180.5) == 675380034180


@pytest.mark.parametrize("code, below", [("999", True), ("999.1", True), ("9991", False), (None, None)])
def test_descendant(spark, code, below):
    assert one(spark, fn.is_descendant_or_self(F.lit(code).cast("string"), "999")) is below


def test_path_order(spark):
    df = spark.createDataFrame([(c,) for c in ("9", "100.2", "100", "100.190442")], "c string")
    got = [r.c for r in df.orderBy(fn.path_order("c")).collect()]
    assert got == ["100", "100.190442", "100.2", "9"]


def test_text_rules(spark):
    assert one(spark, fn.strip_leading_zeros("t"), t="00012ABCD") == "12ABCD"
    assert one(spark, fn.strip_dashes("t"), t="100-1-2") == "10012"
    assert one(spark, fn.joined_code(F.lit(12), F.lit("ABCD"))) == "12ABCD"
    assert one(spark, fn.joined_code(F.lit(12), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "low, high, m, expected",
    [
        (10.2, 10.8, 10.5, 11.0),
        (0.25, 130.25, 130.9, 130.0),
        (130.25, 260.25, 130.4, 131.0),
        (None, 10.0, 12.0, 10.0),
        (3.0, None, 1.0, 3.0),
    ],
)
def test_clamp(spark, low, high, m, expected):
    lo, hi = (F.lit(v).cast("double") for v in (low, high))
    assert one(spark, fn.clamp_measure(F.lit(m), lo, hi)) == expected


def on_edge(spark, x, y, x1, y1, x2, y2, m1=0.0, m2=20.0):
    edge = {k: F.lit(float(v)) for k, v in dict(x1=x1, y1=y1, x2=x2, y2=y2, m1=m1, m2=m2).items()}
    px, py = F.lit(float(x)), F.lit(float(y))
    row = spark.range(1).select(
        F.sqrt(fn.squared_distance_to_edge(px, py, edge)).alias("d"),
        fn.measure_on_edge(px, py, edge).alias("m"),
    )
    return tuple(row.collect()[0])


def test_distance_and_measure(spark):
    assert on_edge(spark, 4, 3, 0, 0, 10, 0) == (3.0, 8.0)
    assert on_edge(spark, 13, 4, 0, 0, 10, 0) == (5.0, 20.0)
    assert on_edge(spark, 4, 5, 1, 1, 1, 1, m1=7.0, m2=9.0) == (5.0, 7.0)


def test_shared_vertex_distance_is_identical(spark):
    vertex = (0.1 + 0.2, 1e6 / 3)
    before = on_edge(spark, 5.7, 333340.1, -9.3, 333330.7, *vertex)
    after = on_edge(spark, 5.7, 333340.1, *vertex, 11.9, 333300.3)
    assert before[0] == after[0] == math.sqrt((5.7 - vertex[0]) ** 2 + (333340.1 - vertex[1]) ** 2)


def test_edges_of_short_lines(spark):
    vertex = "array<struct<x:double,y:double,z:double,m:double>>"
    p = (0.0, 0.0, 0.0, 0.0)
    df = spark.createDataFrame([(1, [p, p, p]), (2, [p]), (3, []), (4, None)], f"id int, vertices {vertex}")
    counts = {r.id: r.n for r in fn.explode_edges(df, "id").groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 2}


def test_positions_at_measure(spark):
    vertex = "array<struct<x:double,y:double,z:double,m:double>>"
    bent = [(0.0, 0.0, 5.0, 0.0), (10.0, 0.0, 7.0, 10.0), (10.0, 10.0, 9.0, 20.0)]
    df = spark.createDataFrame([(bent,)], f"vertices {vertex}")

    def at(m):
        return [tuple(p) for p in df.select(fn.positions_at_measure("vertices", F.lit(m))).collect()[0][0]]

    assert at(5.0) == [(5.0, 0.0, 6.0)]
    assert at(10.0) == [(10.0, 0.0, 7.0)]
    assert at(20.0) == [(10.0, 10.0, 9.0)]
    assert at(21.0) == at(-1.0) == []


def wkb_point(x, y, order="<", kind=1, extra=(), srid=None):
    flag = kind | (0x20000000 if srid is not None else 0)
    out = bytes([1 if order == "<" else 0]) + struct.pack(order + "I", flag)
    if srid is not None:
        out += struct.pack(order + "I", srid)
    return out + struct.pack(order + f"{2 + len(extra)}d", x, y, *extra)


def test_wkb_points(spark):
    two = b"\x01" + struct.pack("<II", 4, 2) + wkb_point(1.5, -2.5) + wkb_point(1e-310, 1234567.890123)
    none = b"\x01" + struct.pack("<II", 4, 0)
    cases = [
        (wkb_point(0.1, -123456.789), [(0.1, -123456.789)]),
        (wkb_point(1e300, 3.0, order=">"), [(1e300, 3.0)]),
        (wkb_point(7.0, 8.0, kind=1001, extra=(9.0,)), [(7.0, 8.0)]),
        (wkb_point(7.0, 8.0, kind=0x80000001, extra=(9.0,), srid=3005), [(7.0, 8.0)]),
        (two, [(1.5, -2.5), (1e-310, 1234567.890123)]),
        (none, []),
        (wkb_point(float("nan"), float("nan")), []),
        (None, None),
    ]
    df = spark.createDataFrame([(i, bytearray(w) if w else None) for i, (w, _) in enumerate(cases)], "i int, g binary")
    got = {r.i: r.p for r in df.select("i", wkb_points("g").alias("p")).collect()}
    for i, (_, expected) in enumerate(cases):
        assert (None if got[i] is None else [tuple(p) for p in got[i]]) == expected, i


def test_other_geometry_stops(spark):
    df = spark.createDataFrame([(bytearray(b"\x01" + struct.pack("<II", 2, 0)),)], "g binary")
    with pytest.raises(Exception, match="neither a point"):
        df.select(wkb_points("g")).collect()


def test_duplicates_group_nulls(spark):
    import datetime

    row = ("s", None, datetime.date(2020, 1, 2), 10, None, 5, None, "A")
    other = ("s", None, datetime.date(2020, 1, 2), 10, None, 5, "A", None)
    report = duplicate_report(spark.createDataFrame([row, row, other], KEY_SCHEMA)).collect()
    assert [r.n for r in report] == [2] and report[0].activity_code == "A"


def test_dedupe_keeps_lowest_id_with_nulls_last(spark):
    schema = f"fish_observation_point_id long, {KEY_SCHEMA}, x double"
    same = ("s", "A", None, 1, 2, 3)
    rows = [(None, *same, "A", None, 0.0), (7, *same, None, "A", 1.0), (7, *same, "A", None, 0.5)]
    for order in (rows, rows[::-1]):
        kept = dedupe_by_key(with_observation_key(spark.createDataFrame(order, schema))).collect()
        assert [(r.fish_observation_point_id, r.x) for r in kept] == [(7, 0.5)]


def test_first_per_group_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    first = first_per_group(df, ["k"], [F.col("id").desc()])
    assert {r.k: r.id for r in first.collect()} == {0: 999, 1: 997, 2: 998}
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert_unique(df, ["k", "v"])
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])
    with pytest.raises(ValueError):
        assert_unique(df.unionByName(spark.createDataFrame([(None, "c")], df.schema)), ["k", "v"])


def test_unnest_pads(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], ["a", "b"])], "i int, n array<int>, t array<string>")
    rows = events.unnest(df, {"n": "n1", "t": "t1"}).collect()
    assert [(r.n1, r.t1) for r in rows] == [(1, "a"), (2, "b"), (3, None)]


def test_unnest_null_arrays(spark):
    df = spark.createDataFrame([(1, None, ["x", "y"]), (2, [7], None), (3, None, None), (4, [], [])], "i int, n array<int>, t array<string>")
    rows = events.unnest(df, {"n": "n1", "t": "t1"}).orderBy("i", "t1").collect()
    assert [tuple(r) for r in rows] == [(1, None, "x"), (1, None, "y"), (2, 7, None)]
