from pyspark.sql import functions as F

from tests.tables import line, streams
from thalweg.operators import events
from thalweg.operators.routes import elevation_at, locate_along
from thalweg.plans import lookups


def test_locate_along(spark):
    lines = streams(
        spark,
        line(1, (0, 0, 0), (50, 0, 50), (100, 0, 100), route=5),
        line(2, (100, 0, 100), (100, 100, 200.5), route=5),
        line(3, (500, 0, 300), (600, 0, 400), route=5),
        line(4, (0, 0, 0), (0, 900, 900), route=6),
        line(5, (7, 7, 0), (8, 7, 10), route=None),
    )
    cases = [
        (5, 50.0, (50.0, 0.0)),
        (5, 75.0, (75.0, 0.0)),
        (5, 100.0, (100.0, 0.0)),
        (5, 200.5, (100.0, 100.0)),
        (5, 250.0, None),
        (5, 400.0, (600.0, 0.0)),
        (5, 401.0, None),
        (6, 899.0, (0.0, 899.0)),
        (9, 1.0, None),
        (None, 1.0, None),
        (5, None, None),
    ]
    at = spark.createDataFrame(
        [(i, k, m) for i, (k, m, _) in enumerate(cases)],
        "e int, blue_line_key long, downstream_route_measure double",
    )
    got = {r.e: r.geom for r in locate_along(at, lines, by=["e"]).collect()}
    assert len(got) == len(cases)
    for i, (_, _, expected) in enumerate(cases):
        assert (got[i] and (got[i].x, got[i].y)) == expected, cases[i]


def test_elevation_leaves_out_what_is_off_the_line(spark):
    lines = streams(spark, line(1, (0, 0, 0.5), (10, 0, 1.25)))
    at = lines.select("vertices", F.explode(F.array(F.lit(1.0), F.lit(1.25), F.lit(2.0))).alias("m"))
    got = [(r.m, r.elevation) for r in elevation_at(at, measure="m").collect()]
    assert sorted(got) == [(1.0, 10.0), (1.25, 13.0)]


OBSERVED = (
    "observation_key string, fish_observation_point_id long, species_code string, match_type string,"
    " distance_to_stream double, linear_feature_id long, wscode string, localcode string,"
    " watershed_group_code string, blue_line_key long, downstream_route_measure double,"
    " geom struct<x:double,y:double,z:double>"
)


def observed(spark, n):
    rows = [
        (f"k{i}", i, "ST" if i % 2 else "??", "A", float(i), 1, "1", "1.1", "G", 354155148, 34180.0, (1.0, 2.0, 3.0))
        for i in range(n)
    ]
    rows.append(("z", n, "CO", "B", 0.5, 2, "1", "1.2", "G", 354155148, 99.0, None))
    return spark.createDataFrame(rows, OBSERVED)


def species(spark):
    return spark.createDataFrame([(11, "ST"), (12, "CO")], "species_id int, code string")


def test_rollup(spark):
    rolled = events.rollup_events(observed(spark, 4), species(spark))
    rows = {r.fish_obsrvtn_event_id: r for r in rolled.collect()}
    big = rows[675380034180]
    assert big.obs_ids == [0, 1, 2, 3] and big.species_codes == ["??", "ST", "??", "ST"]
    assert big.species_ids == [None, 11, None, 11] and big.distances_to_stream == [0.0, 1.0, 2.0, 3.0]
    assert len(rows) == 2 and {r.part_no for r in rows.values()} == {0}
    assert events.events_with_species(rolled, [11]).count() == 1
    assert events.events_with_observation(rolled, 4).count() == 1


def test_large_events_are_cut_and_explode_whole(spark):
    obs = observed(spark, 60)
    rolled = events.rollup_events(obs, species(spark), max_items=10)
    big = rolled.where("downstream_route_measure = 34180").collect()
    assert len(big) > 1 and len({r.part_no for r in big}) == len(big)
    assert {r.geom for r in big} == {(1.0, 2.0, 3.0)}
    assert sorted(i for r in big for i in r.obs_ids) == list(range(60))
    lines = streams(spark, line(1, (0, 0, 0), (1, 0, 1)), line(2, (0, 0, 0), (1, 0, 1)))
    source = obs.select(
        "fish_observation_point_id",
        "species_code",
        *[
            F.lit(None).cast("string").alias(c)
            for c in (
                "agency_id observation_date agency_name source source_ref activity_code activity"
                " life_stage_code life_stage acat_report_url"
            ).split()
        ],
    )
    single = events.explode_events(rolled, lines, source, species(spark))
    assert len(single.columns) == 24
    got = {r.fish_observation_point_id: (r.species_id, r.distance_to_stream) for r in single.collect()}
    assert got == {**{i: (11, float(i)) for i in range(1, 60, 2)}, 60: (12, 0.5)}


def test_unmatched_rollup(spark):
    left = spark.createDataFrame(
        [("a", 5, "ST", 1.0, 1.0), ("b", 3, "CO", 1.0, 1.0), ("c", 9, "??", 2.0, 2.0)],
        "observation_key string, fish_observation_point_id long, species_code string, x double, y double",
    )
    lines = streams(spark, line(1, (8, 1, 0), (8, 2, 1)), line(2, (9, 1, 0), (9, 2, 1)))
    left = left.withColumn("x", F.when(F.col("x") == 2.0, 9000.0).otherwise(F.col("x")))
    got = events.rollup_unmatched(left, lines, species(spark)).orderBy("x").collect()
    assert [(r.fish_obsrvtn_pnt_distinct_id, r.obs_ids, r.species_ids, r.distance_to_stream) for r in got] == [
        (3, [3, 5], [12, 11], 7.0),
        (9, [9], [None], None),
    ]


def test_parts_follow_the_ids(spark, monkeypatch):
    monkeypatch.setattr(events, "BUCKET", 7)
    rolled = events.rollup_events(observed(spark, 40), species(spark), max_items=10)
    big = rolled.where("downstream_route_measure = 34180").orderBy("part_no").collect()
    assert [r.part_no for r in big] == [0, 1, 2, 3]
    assert [r.obs_ids for r in big] == [list(range(s, s + 10)) for s in range(0, 40, 10)]
    # one observation at one part brings the whole event
    assert events.events_with_observation(rolled, 33).count() == 4
    assert events.events_with_species(rolled, [11]).count() == 4
    left = spark.createDataFrame(
        [(f"k{i}", i, "ST", 1.0, 1.0) for i in range(25)],
        "observation_key string, fish_observation_point_id long, species_code string, x double, y double",
    )
    spots = events.rollup_unmatched(left, streams(spark, line(1, (8, 1, 0), (8, 2, 1))), species(spark), max_items=10)
    got = spots.orderBy("part_no").collect()
    assert [(r.fish_obsrvtn_pnt_distinct_id, r.part_no, len(r.obs_ids)) for r in got] == [(0, 0, 10), (0, 1, 10), (0, 2, 5)]


def test_lookups_sort_by_path(spark):
    rows = [("b", "9", "9", 1.0), ("a", "100.2", "1", 5.0), ("c", "100.2", "1", 2.0), ("d", None, "1", 2.0)]
    obs = spark.createDataFrame(rows, "observation_key string, wscode string, localcode string, downstream_route_measure double")
    obs = obs.select("*", F.lit("ST").alias("species_code"), F.lit("G").alias("watershed_group_code"))
    obs = obs.withColumns({"linear_feature_id": F.lit(1).cast("long"), "blue_line_key": F.lit(1)})
    lines = streams(spark, line(1, (0, 0, 0), (1, 0, 10), gradient=0.5, stream_order=3, gnis_name="R"))
    got = lookups.gradient_at_species(obs, lines, "ST", "G").collect()
    assert [r.observation_key for r in got] == ["c", "a", "b", "d"] and got[0].gnis_name == "R"
    up = lookups.elevation_at_species(obs, lines, "ST", "G").collect()
    assert [(r.observation_key, r.elevation) for r in up] == [("c", 20.0), ("a", 50.0), ("b", 10.0), ("d", 20.0)]
    assert [r.species_code for r in lookups.species_on_route(obs, 1, 2.5).collect()] == ["ST"]


def test_a_bin_with_most_events_is_split(spark):
    lines = streams(spark, line(1, (0, 0, 0), (1000, 0, 1000)), line(2, (1000, 0, 1000), (1000, 500, 1500)))
    rows = [(i, 1, 150.0 + i / 100) for i in range(300)] + [(900, 1, 1000.0), (901, 1, 1500.0), (902, 1, 1500.5), (903, 2, 3.0), (904, 1, None), (905, None, 1.0)]
    events = spark.createDataFrame(rows, "event int, blue_line_key long, downstream_route_measure double")
    plain = {r.event: r.geom for r in locate_along(events, lines, by=["event"]).collect()}
    split = {r.event: r.geom for r in locate_along(events, lines, by=["event"], rows_per_slice=20).collect()}
    assert split == plain and len(plain) == len(rows)
    assert all(abs(plain[i].x - (150.0 + i / 100)) < 1e-9 for i in range(300))
    assert (plain[900].x, plain[900].y, plain[901].y) == (1000.0, 0.0, 500.0) and plain[902] is plain[903] is plain[904] is plain[905] is None


def test_one_head_per_event(spark):
    schema = (
        "fish_obsrvtn_event_id long, part_no long, linear_feature_id long, blue_line_key long, downstream_route_measure double,"
        " match_types array<string>, obs_ids array<long>, species_codes array<string>, species_ids array<int>, distances_to_stream array<double>"
    )

    def row(event, part, ids):
        return (event, part, 5, event, 1.0, ["A"] * len(ids), ids, ["X"] * len(ids), [1] * len(ids), [0.5] * len(ids))

    parts = spark.createDataFrame([row(1, 0, [1, 2]), row(1, 1, [3]), row(2, 0, [4])], schema)
    maximal = spark.createDataFrame([(1, 1.0, [7, 9])], "blue_line_key long, downstream_route_measure double, maximal_species array<int>")
    got = {r.fish_obsrvtn_event_id: (r.linear_feature_id, r.n_parts, r.n_observations, r.maximal_species) for r in events.event_heads(parts, maximal).collect()}
    assert got == {1: (5, 2, 3, [7, 9]), 2: (5, 1, 1, [])}
    assert "maximal_species" not in events.event_heads(parts).columns
