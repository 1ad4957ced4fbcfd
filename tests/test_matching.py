import pytest
from pyspark.sql import functions as F

from tests.tables import line, observation, sources, streams
from thalweg.operators import matching as mt
from thalweg.operators.skew import spread_join
from thalweg.plans import build
from thalweg.plans.snapping import candidates, eligible_streams, keyed_observations
from thalweg.schemas import OUTPUT_COLUMNS


def candidate(at, d, m, line_id=1, waterbody=None, listed=False, ref="W1"):
    return (ref, float(at), 0.0, line_id, line_id, 1, waterbody, float(m), float(d), listed)


CANDIDATE = (
    "match_ref string, x double, y double, linear_feature_id long, anchor_id long, blue_line_key long,"
    " waterbody_key long, measure double, distance double, listed boolean"
)


def winners(spark, *rows):
    df = spark.createDataFrame(list(rows), CANDIDATE)
    got = mt.match_tiers(df, by=["x", "y", "match_ref"]).collect()
    return {r.x: (r.match_type[0], r.linear_feature_id, r.distance, r.measure) for r in got}


def test_every_rule_of_thumb(spark):
    s = "S100"
    got = winners(
        spark,
        # lookup tie: lowest measure, any line in a waterbody at that distance
        candidate(1, 40, 50, 1, 100, True),
        candidate(1, 40, 20, 2, 101),
        candidate(1, 40, 10, 3, None),
        candidate(1, 5, 1, 4, 102),
        # no lookup: closest, even outside a waterbody
        candidate(2, 900, 5, 5),
        candidate(2, 800, 7, 6),
        # lookup at 90 m before another stream at 10 m
        candidate(3, 90, 5, 7, listed=True, ref=s),
        candidate(3, 10, 5, 8, ref=s),
        # near stream before a lookup at 200 m
        candidate(4, 200, 5, 9, listed=True, ref=s),
        candidate(4, 50, 5, 10, ref="S100"),
        # limits
        candidate(5, 100, 5, 11, ref=s),
        candidate(6, 100.0001, 5, 12, ref=s),
        candidate(7, 100.0001, 5, 13, listed=True, ref=s),
        candidate(8, 500, 5, 14, listed=True, ref=s),
        candidate(9, 499.9, 5, 15, listed=True, ref=s),
        # a winner need not be listed itself; equal measures go to the lowest id
        candidate(10, 60, 9, 16, listed=True, ref=s),
        candidate(10, 60, 9, 15, ref=s),
        candidate(11, 30, 5, 17, ref="U"),
    )
    assert got == {
        1.0: ("D", 2, 40.0, 20.0),
        2.0: ("E", 6, 800.0, 7.0),
        3.0: ("A", 7, 90.0, 5.0),
        4.0: ("B", 10, 50.0, 5.0),
        5.0: ("B", 11, 100.0, 5.0),
        7.0: ("C", 13, 100.0001, 5.0),
        9.0: ("C", 15, 499.9, 5.0),
        10.0: ("A", 15, 60.0, 9.0),
        11.0: ("B", 17, 30.0, 5.0),
    }


@pytest.mark.parametrize(
    "kind, number, code, expected",
    [
        ("Lake", 5, "100-1", "W5"),
        ("Wetland", None, "100-1", None),
        ("Stream", None, "100-1", "S1001"),
        ("Stream", 5, None, "U"),
        (None, 5, "100-1", None),
    ],
)
def test_profile(spark, kind, number, code, expected):
    row = [(kind, number, code)]
    df = spark.createDataFrame(row, "waterbody_type string, wbody_id long, new_watershed_code string")
    assert df.select(mt.match_profile().alias("p")).collect()[0].p == expected


def test_waterbody_targets(spark):
    s = sources(
        spark,
        [observation()],
        [line(1, (0, 0, 0), (10, 0, 10))],
        dictionary=[(7, "00012ABCD"), (8, "00013ABCD"), (9, None)],
        wb_xref=[(12, "ABCD", 500), (12, "ABCD", 501), (12, "ABCD", 999), (13, None, 500)],
        waterbodies=[500, 501],
    )
    got = mt.waterbody_targets(s.waterbody_dictionary, s.waterbody_xref, s.waterbodies).collect()
    assert {tuple(r) for r in got} == {(7, 500), (7, 501)}


def test_eligible_streams(spark):
    keep = dict(wscode_ltree="9991")
    rows = [
        line(1, (0, 0, 0), (1, 0, 1), **keep),
        line(2, (0, 0, 0), (1, 0, 1), wscode_ltree="999.5"),
        line(3, (0, 0, 0), (1, 0, 1), wscode_ltree="999"),
        line(4, (0, 0, 0), (1, 0, 1), wscode_ltree=None),
        line(5, (0, 0, 0), (1, 0, 1), localcode_ltree=None),
        line(6, (0, 0, 0), (1, 0, 1), edge_type=6010),
        line(7, (0, 0, 0), (1, 0, 1), edge_type=None),
    ]
    s = sources(spark, [observation()], rows)
    assert [r.linear_feature_id for r in eligible_streams(s.streams).collect()] == [1]


@pytest.mark.parametrize("most, sliced", [(32, False), (2, False), (2, True)])
def test_flags_beside_the_search(spark, monkeypatch, most, sliced):
    """One lake holds most lines and many observations name it; some lines are named by many codes."""
    monkeypatch.setattr(mt, "MAX_REFS", most)
    if sliced:
        kept = mt.spread_join
        monkeypatch.setattr(mt, "spread_join", lambda *a, **b: kept(*a, **{**b, "rows_per_slice": 3}))
    lines = [line(i, (i * 20, 0, 0), (i * 20 + 15, 5, 15), route=i, waterbody_key=[500, 500, 500, 501, None][i % 5]) for i in range(40)]
    refs = [("W1", 500), ("W2", 500), ("W3", 500), ("W1", 501), ("W9", 777), ("S7", 3), ("S8", 3), ("S9", 3), ("S7", 500), ("S7", 11)]
    targets = spark.createDataFrame(refs, "match_ref string, target long")
    points = [(float(i * 40), 10.0, r) for i in range(20) for r in ("W1", "W2", "W9", "S7", "S9", "U")]
    spots = spark.createDataFrame(points, "x double, y double, match_ref string")
    got = candidates(spots, streams(spark, *lines), by=mt.PROFILE, k=8, radius=90.0, targets=targets).collect()
    assert len(got) > 300 and {r.listed for r in got} == {True, False}
    for r in got:
        target = r.waterbody_key if r.match_ref[0] == "W" else r.linear_feature_id
        assert r.listed == ((r.match_ref, target) in refs), r
    plain = candidates(spots, streams(spark, *lines), by=mt.PROFILE, k=8, radius=90.0)
    assert sorted((tuple(r[c] for c in plain.columns) for r in got), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_candidates_stay_in_their_cells(spark):
    lines = [line(i, (i * 20, 0, 0), (i * 20 + 15, 5, 15), route=i, waterbody_key=500) for i in range(9)]
    targets = spark.createDataFrame([("W1", 500)], "match_ref string, target long")
    spots = spark.createDataFrame([(5.0, 5.0, "W1")], "x double, y double, match_ref string")
    found = candidates(spots, streams(spark, *lines), by=mt.PROFILE, keep_cell=True, targets=targets)
    judged = mt.match_tiers(found, by=["cell", *mt.PROFILE])
    plan = judged._jdf.queryExecution().executedPlan().toString()
    # points and edges go to their cells; nothing after that is dealt out again
    assert plan.count("hashpartitioning(cell") == 2 and "hashpartitioning(match_ref" not in plan


def test_whole_job(spark):
    lines = [
        line(1, (0, 0, 0), (100, 0, 100), route=10, waterbody_key=500),
        line(2, (100, 0, 100), (200, 0, 200), route=10, wscode_ltree="100.2"),
        line(3, (0, 400, 0), (200, 400, 200), route=11),
        line(4, (0, 90000, 0.5), (0, 90000.4, 0.9), route=12),
    ]
    observed = [
        observation(fish_observation_point_id=1, x=100.0, y=30.0),
        observation(fish_observation_point_id=2, x=150.7, y=20.0, source="s1"),
        observation(fish_observation_point_id=3, x=50.0, y=350.0, waterbody_type="Lake", wbody_id=7),
        observation(fish_observation_point_id=4, x=50.0, y=350.0, waterbody_type="Lake"),
        observation(fish_observation_point_id=5, x=50.0, y=5.0, waterbody_type=None),
        observation(fish_observation_point_id=6, x=150.7, y=150.0, new_watershed_code="100-2"),
        observation(fish_observation_point_id=7, x=150.7, y=150.0, new_watershed_code="100-3"),
        observation(fish_observation_point_id=8, x=150.7, y=150.0, new_watershed_code=None),
        observation(fish_observation_point_id=9, x=0.0, y=90000.0),
        observation(fish_observation_point_id=10, x=50.0, y=350.0, waterbody_type="Lake", wbody_id=99),
        observation(fish_observation_point_id=11, x=None, y=None),
    ]
    s = sources(
        spark,
        observed,
        lines,
        dictionary=[(7, "00012ABCD")],
        wb_xref=[(12, "ABCD", 500)],
        waterbodies=[500],
        stream_xref=[("1002", 2), ("1002", 2), ("1003", 77)],
    )
    out = build(s)
    assert out.columns == OUTPUT_COLUMNS and len(OUTPUT_COLUMNS) == 34
    got = {r.fish_observation_point_id: r for r in out.collect()}
    assert sorted(got) == [1, 3, 6, 9, 10]
    tie = got[1]  # lines 1 and 2 share the closest vertex
    assert (tie.match_type, tie.linear_feature_id, tie.wscode) == (mt.TIER_B, 1, "100")
    assert (tie.downstream_route_measure, tuple(tie.geom)) == (100.0, (100.0, 0.0, 1000.0))
    lake = got[3]
    assert (lake.match_type, lake.distance_to_stream) == (mt.TIER_D, 350.0)
    assert (lake.downstream_route_measure, tuple(lake.geom)) == (50.0, (50.0, 0.0, 500.0))
    assert (got[6].match_type, got[6].downstream_route_measure) == (mt.TIER_C, 150.0)
    over = got[9]  # no whole metre on the line: the measure leaves it, the row stays
    assert (over.downstream_route_measure, over.geom) == (1.0, None)
    assert (got[10].match_type, got[10].blue_line_key, got[10].distance_to_stream) == (mt.TIER_E, 11, 50.0)


def test_point_type_is_optional(spark):
    rows = [
        observation(fish_observation_point_id=1, point_type_code="Summary"),
        observation(fish_observation_point_id=2, point_type_code="Observation"),
    ]
    df = sources(spark, rows, [line(1, (0, 0, 0), (1, 0, 1))]).observations
    assert keyed_observations(df).count() == 2
    assert [r.fish_observation_point_id for r in keyed_observations(df, "Observation").collect()] == [2]


def test_spread_join_keeps_every_row(spark):
    big = spark.range(300).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 5).alias("k"), "id")
    other = spark.createDataFrame([(i, f"v{i}{j}") for i in range(5) for j in range(2)], "k long, v string")
    plain = sorted(tuple(r) for r in big.join(other, "k").select("k", "id", "v").collect())
    cut = spread_join(big, other, ["k"], ["id"], rows_per_slice=30).select("k", "id", "v").collect()
    assert sorted(tuple(r) for r in cut) == plain and len(plain) == 600


def test_unmatched_and_summary(spark):
    obs = spark.createDataFrame([("a",), ("b",)], "observation_key string")
    hit = spark.createDataFrame([("a",)], "observation_key string")
    assert [r.observation_key for r in mt.unmatched(obs, hit).collect()] == ["b"]
    rows = [("A", 1, 5.0), ("A", 1, 5.0), ("A", 1, 6.0), ("B", 1, 5.0)]
    df = spark.createDataFrame(rows, "match_type string, blue_line_key long, downstream_route_measure double")
    got = {r.match_type: (r.n_distinct_events, r.n_observations) for r in mt.match_summary(df).collect()}
    assert got == {"A": (2, 3), "B": (1, 1)}
