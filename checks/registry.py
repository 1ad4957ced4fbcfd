"""The registered queries: every operator over the whole stand-in tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import standins
from thalweg.functions import (
    clamp_measure,
    event_id,
    explode_edges,
    is_descendant_or_self,
    measure_on_edge,
    path_order,
    squared_distance_to_edge,
)
from thalweg.functions.wkb import wkb_points
from thalweg.operators import events, matching, paths
from thalweg.operators.grouping import duplicate_report, key_collisions, repeated_keys, with_observation_key
from thalweg.operators.nearest import nearest_lines
from thalweg.operators.paths import farthest_upstream, join_below
from thalweg.operators.routes import anchor_codes, elevation_at, locate_along
from thalweg.operators.skew import spread_join
from thalweg import schemas
from thalweg import sources as io
from thalweg.plans import Sources, build, lookups, snapping
from thalweg.staging import stage, staged_path

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _round(name: str) -> Column:
    return F.round(name, 6).alias(name)


def _mm(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) * 1000).cast("long")


def _text(array: Column | str) -> Column:
    a = F.col(array) if isinstance(array, str) else array
    return F.array_join(F.transform(a, lambda v: v.cast("string")), ",")


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(snapping.keyed_observations(standins.observations(spark, sf_dir)), "keyed")


def _date_text(df: DataFrame) -> DataFrame:
    return df.withColumn("observation_date", F.col("observation_date").cast("string"))


# --- keys and duplicates ---------------------------------------------------


@_query
def obs_key(spark, sf_dir):
    keyed = with_observation_key(standins.observations(spark, sf_dir))
    return keyed.select("fish_observation_point_id", "observation_key")


@_query
def obs_dedup(spark, sf_dir):
    return snapping.keyed_observations(standins.observations(spark, sf_dir)).select(
        "observation_key", "fish_observation_point_id", "species_code", "waterbody_type", "x", "y"
    )


@_query
def obs_dedup_observation_type(spark, sf_dir):
    source = standins.observations(spark, sf_dir)
    kept = snapping.keyed_observations(source, point_type="Observation")
    return kept.select("observation_key", "fish_observation_point_id")


@_query
def obs_duplicates(spark, sf_dir):
    return _date_text(duplicate_report(standins.observations(spark, sf_dir)))


@_query
def key_collisions_report(spark, sf_dir):
    return key_collisions(standins.observations(spark, sf_dir))


@_query
def unique_key_check(spark, sf_dir):
    keyed = with_observation_key(standins.observations(spark, sf_dir))
    return repeated_keys(keyed, ["observation_key"])


@_query
def multipart_points(spark, sf_dir):
    e = F.col("event_id")
    parts = F.transform(
        F.filter(F.array(*[F.lit(p) for p in range(3)]), lambda p: p < e % 4),
        lambda p: F.struct(
            (e % 1000 + p).cast("double").alias("x"), (F.col("user_id") * p).cast("double").alias("y")
        ),
    )
    source = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", parts.alias("points"))
    return snapping.explode_points(source)


# --- sources and sinks: stand-ins written in source form and read back ------


def _written(df: DataFrame, name: str, form: str = "parquet") -> str:
    path = staged_path(df.sparkSession, name)
    (df.write.parquet if form == "parquet" else df.write.option("header", True).option("escape", '"').csv)(path)
    return path


@_query
def read_observations_binary(spark, sf_dir):
    read = io.read_observations(spark, _written(standins.binary_observations(spark, sf_dir), "observations"))
    columns = ("fish_observation_point_id", "wbody_id", "species_code", "observation_date", "utm_zone", "x", "y")
    return _date_text(snapping.explode_points(read).select(*columns))


@_query
def read_streams(spark, sf_dir):
    read = io.read_streams(spark, _written(standins.streams(spark, sf_dir), "streams"))
    flat_columns = [c for c in read.columns if c != "vertices"]
    return read.select(*flat_columns, F.size("vertices").alias("n_vertices"), F.col("vertices")[1]["z"].alias("second_z"))


@_query
def read_waterbody_dictionary(spark, sf_dir):
    name = F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, 'Big "B" Lake, North\nArm')
    rows = standins.padded(standins.waterbody_dictionary(spark, sf_dir).withColumn("gazetted_name", name), schemas.WATERBODY_DICTIONARY)
    read = io.read_waterbody_dictionary(spark, _written(rows, "dictionary", "csv"))
    return read.select("id", "waterbody_identifier", "gazetted_name", F.col("gazetted_name").isNull().alias("no_name"))


@_query
def read_species(spark, sf_dir):
    rows = standins.padded(standins.species(spark, sf_dir), schemas.SPECIES)
    return io.read_species(spark, _written(rows, "species", "csv")).select("species_id", "code", "name")


@_query
def read_waterbody_xref(spark, sf_dir):
    return io.read_waterbody_xref(spark, _written(standins.waterbody_xref(spark, sf_dir), "waterbody-xref"))


@_query
def read_waterbodies(spark, sf_dir):
    return io.read_waterbodies(spark, _written(standins.waterbodies(spark, sf_dir), "waterbodies"))


@_query
def read_stream_xref(spark, sf_dir):
    return io.read_stream_xref(spark, _written(standins.stream_xref(spark, sf_dir), "stream-xref"))


@_query
def duplicates_csv(spark, sf_dir):
    path = staged_path(spark, "duplicates")
    io.write_duplicates(standins.observations(spark, sf_dir), path)
    schema = duplicate_report(standins.observations(spark, sf_dir)).schema
    return _date_text(spark.read.schema(schema).option("header", True).csv(path))


@_query
def published_observations(spark, sf_dir):
    path = staged_path(spark, "published")
    io.write_observations(build(standins.sources(spark, sf_dir)), path)
    return flat(io.read_published(spark, path))


@_query
def exported_observations(spark, sf_dir):
    path = staged_path(spark, "export")
    io.export_observations(build(standins.sources(spark, sf_dir)), path)
    return flat(spark.read.parquet(path))


@_query
def exported_positions(spark, sf_dir):
    """Positions as well-known binary, read back by the reader of sources."""
    path = staged_path(spark, "export")
    io.export_observations(build(standins.sources(spark, sf_dir)), path, binary=True)
    point = F.element_at(wkb_points("geom"), 1)
    back = spark.read.parquet(path).select("observation_key", point.alias("p"))
    return back.select("observation_key", F.round("p.x", 6).alias("geom_x"), F.round("p.y", 6).alias("geom_y"))


# --- streams, codes, geometry ----------------------------------------------


@_query
def streams_eligible(spark, sf_dir):
    return snapping.eligible_streams(standins.streams(spark, sf_dir)).select(
        "linear_feature_id", "blue_line_key", "edge_type", "wscode_ltree", "localcode_ltree"
    )


@_query
def path_descendants(spark, sf_dir):
    return standins.streams(spark, sf_dir).select(
        "linear_feature_id",
        is_descendant_or_self("wscode_ltree", "999").alias("below_999"),
        # every local code lies below its route's code
        is_descendant_or_self(
            "localcode_ltree", F.concat(F.lit("100."), (F.col("blue_line_key") - 354087611 + 1000000).cast("string"))
        ).alias("below_own"),
        is_descendant_or_self("localcode_ltree", "100.1000002").alias("below_route"),
    )


@_query
def path_containment(spark, sf_dir):
    """How many routes of a branching network lie below each route, and the sum of their numbers."""
    routes = standins.branches(spark, sf_dir)
    lower = routes.select(F.col("route").alias("lower_route"), F.col("code").alias("lower_code"))
    met = join_below(routes, lower, upper_code="code", lower_code="lower_code", by=["lower_route"], or_self=False)
    return met.groupBy("route").agg(F.count("*").alias("n_below"), F.sum("lower_route").alias("sum_below"))


@_query
def path_order_extremes(spark, sf_dir):
    code = F.concat(F.col("stream_order").cast("string"), F.lit("."), F.col("localcode_ltree"))
    coded = standins.streams(spark, sf_dir).where("localcode_ltree is not null")
    ordered = coded.select("watershed_group_code", path_order(code).alias("p"))
    return ordered.groupBy("watershed_group_code").agg(
        F.array_join(F.min("p"), ".").alias("first_path"), F.array_join(F.max("p"), ".").alias("last_path")
    )


@_query
def path_order_rank(spark, sf_dir):
    code = F.concat(F.col("stream_order").cast("string"), F.lit("."), F.col("localcode_ltree"))
    coded = standins.streams(spark, sf_dir).where("localcode_ltree is not null")
    place = Window.partitionBy("blue_line_key").orderBy(path_order(code), "linear_feature_id")
    return coded.select("linear_feature_id", F.row_number().over(place).cast("long").alias("place"))


@_query
def point_edge_distance(spark, sf_dir):
    lines = standins.streams(spark, sf_dir)
    n = lines.count()
    points = standins.observations(spark, sf_dir).select(
        "fish_observation_point_id",
        (F.col("fish_observation_point_id") * 7 % n).alias("linear_feature_id"),
        "x",
        "y",
    )
    met = points.join(explode_edges(lines, "linear_feature_id"), "linear_feature_id")
    edge = {c: F.col(c) for c in ("x1", "y1", "x2", "y2", "m1", "m2")}
    x, y = F.col("x"), F.col("y")
    return met.select(
        "fish_observation_point_id",
        F.col("edge_no").cast("long").alias("edge_no"),
        F.round(F.sqrt(squared_distance_to_edge(x, y, edge)), 6).alias("distance"),
        F.round(measure_on_edge(x, y, edge), 6).alias("measure"),
    )


# --- nearest lines -----------------------------------------------------------


def _found(spark, sf_dir, k):
    """Search per distinct position, as the job does, then per observation."""
    keyed = _keyed(spark, sf_dir).select("observation_key", "x", "y")
    lines = snapping.eligible_streams(standins.streams(spark, sf_dir))
    spots = stage(keyed.select("x", "y").distinct(), "spots")
    found = nearest_lines(spots, lines, by=["x", "y"], k=k)
    return spread_join(keyed, found, ["x", "y"], by=["observation_key"])


@_query
def knn_nearest(spark, sf_dir):
    return _found(spark, sf_dir, 10).select(
        "observation_key", "linear_feature_id", _round("distance"), _round("measure")
    )


@_query
def knn_candidates(spark, sf_dir):
    return (
        _found(spark, sf_dir, 100)
        .groupBy("observation_key")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("linear_feature_id").alias("sum_ids"),
            F.sum(_mm("distance")).alias("sum_distance_mm"),
            F.sum(_mm("measure")).alias("sum_measure_mm"),
            F.round(F.max("distance"), 6).alias("farthest"),
        )
    )


@_query
def knn_within_radius(spark, sf_dir):
    """No limit on the number of lines: the radius alone decides."""
    return (
        _found(spark, sf_dir, None)
        .groupBy("observation_key")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("linear_feature_id").alias("sum_ids"),
            F.round(F.max("distance"), 6).alias("farthest"),
        )
    )


@_query
def closest_per_route(spark, sf_dir):
    streams = standins.streams(spark, sf_dir)
    found = snapping.observation_candidates(_keyed(spark, sf_dir), streams)
    return found.join(anchor_codes(streams), "anchor_id").select(
        "observation_key",
        "linear_feature_id",
        "wscode",
        "localcode",
        "waterbody_key",
        "blue_line_key",
        _round("measure"),
        _round("distance"),
    )


# --- matching ------------------------------------------------------------------


def _matches(spark, sf_dir) -> tuple[Sources, DataFrame, DataFrame]:
    sources, keyed = standins.sources(spark, sf_dir), _keyed(spark, sf_dir)
    return sources, keyed, snapping.matches(keyed, sources)


def _rounded_matches(spark, sf_dir) -> DataFrame:
    _, _, matched = _matches(spark, sf_dir)
    return matched.withColumns(
        {c: F.round(c, 6) for c in ("downstream_route_measure", "distance_to_stream")}
    )


@_query
def waterbody_targets(spark, sf_dir):
    s = standins.sources(spark, sf_dir)
    return matching.waterbody_targets(s.waterbody_dictionary, s.waterbody_xref, s.waterbodies)


@_query
def waterbody_pairs(spark, sf_dir):
    return matching.waterbody_pairs(_keyed(spark, sf_dir), waterbody_targets(spark, sf_dir))


@_query
def stream_xref_candidates(spark, sf_dir):
    sources = standins.sources(spark, sf_dir)
    keyed = snapping.with_profile(_keyed(spark, sf_dir))
    flowing = keyed.where(~F.col("waterbody_type").isin(*matching.STILL_WATER))
    profiles = stage(flowing.select(*matching.PROFILE).distinct(), "profiles")
    found = snapping.candidates(profiles, sources.streams, by=matching.PROFILE, targets=snapping.all_targets(sources))
    slim = flowing.select("observation_key", *matching.PROFILE)
    flagged = spread_join(slim, found.where("listed"), matching.PROFILE, by=["observation_key"])
    return flagged.select("observation_key", "linear_feature_id", _round("distance"))


@_query
def match_tiers(spark, sf_dir):
    return _rounded_matches(spark, sf_dir)


def _tier_query(name: str, tag: str) -> None:
    def tier(spark, sf_dir):
        return _rounded_matches(spark, sf_dir).where(F.col("match_type") == tag)

    _QUERIES[name] = tier


for _name, _tag in (
    ("tier_a", matching.TIER_A),
    ("tier_b", matching.TIER_B),
    ("tier_c", matching.TIER_C),
    ("tier_d", matching.TIER_D),
    ("tier_e", matching.TIER_E),
):
    _tier_query(_name, _tag)


@_query
def match_summary(spark, sf_dir):
    return matching.match_summary(build(standins.sources(spark, sf_dir)))


@_query
def unmatched_obs(spark, sf_dir):
    _, keyed, matched = _matches(spark, sf_dir)
    return matching.unmatched(keyed, matched).select(
        "observation_key", "fish_observation_point_id", "waterbody_type"
    )


def _unmatched_spots(spark, sf_dir, **limit) -> DataFrame:
    sources, keyed, matched = _matches(spark, sf_dir)
    left = stage(matching.unmatched(keyed, matched), "unmatched")
    lines = snapping.eligible_streams(sources.streams)
    return events.rollup_unmatched(left, lines, sources.species, **limit)


def _rolled_text(rolled):
    return rolled.select(
        "fish_obsrvtn_pnt_distinct_id",
        "part_no",
        _text("obs_ids").alias("obs_ids"),
        _text("species_ids").alias("species_ids"),
        _round("distance_to_stream"),
        "x",
        "y",
    )


@_query
def unmatched_rollup(spark, sf_dir):
    return _rolled_text(_unmatched_spots(spark, sf_dir))


@_query
def unmatched_rollup_in_parts(spark, sf_dir):
    return _rolled_text(_unmatched_spots(spark, sf_dir, max_items=2))


# --- the output table ------------------------------------------------------------


@_query
def measure_clamp(spark, sf_dir):
    sources, _, matched = _matches(spark, sf_dir)
    own = sources.streams.select(
        "linear_feature_id",
        F.col("downstream_route_measure").alias("low"),
        F.col("upstream_route_measure").alias("high"),
    )
    raw = F.col("downstream_route_measure")
    return matched.join(own, "linear_feature_id").select(
        "observation_key",
        F.round(raw, 6).alias("measure"),
        clamp_measure(raw, "low", "high").alias("downstream_route_measure"),
    )


@_query
def observations(spark, sf_dir):
    return flat(build(standins.sources(spark, sf_dir)))


def flat(snapped: DataFrame) -> DataFrame:
    """Output rows with the position in columns, doubles rounded and dates as text."""
    rest = [c for c in snapped.columns if c not in ("geom", "distance_to_stream")]
    return _date_text(
        snapped.select(
            *rest,
            _round("distance_to_stream"),
            *[F.round(f"geom.{c}", 6).alias(f"geom_{c}") for c in "xyz"],
        )
    )


def _scattered_events(spark, sf_dir) -> DataFrame:
    routes = standins.streams(spark, sf_dir).count() // standins.SEGMENTS_PER_ROUTE
    e = F.col("event_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        e,
        (F.lit(354087611) + (e * 7) % routes).alias("blue_line_key"),
        (((e * 37) % 1400).cast("double") + (e % 4) * 0.25).alias("downstream_route_measure"),
    )


@_query
def locate_along_route(spark, sf_dir):
    located = locate_along(_scattered_events(spark, sf_dir), standins.streams(spark, sf_dir), by=["event_id"])
    return located.select("event_id", *[F.round(f"geom.{c}", 6).alias(f"geom_{c}") for c in "xyz"])


@_query
def elevation_on_line(spark, sf_dir):
    at = (F.col("downstream_route_measure") + F.col("linear_feature_id") % 140).alias("measure")
    lines = standins.streams(spark, sf_dir).select("linear_feature_id", "vertices", at)
    return elevation_at(lines, measure="measure").select("linear_feature_id", "measure", "elevation")


# --- use of the output -------------------------------------------------------------


def _output(spark, sf_dir) -> tuple[Sources, DataFrame]:
    sources = standins.sources(spark, sf_dir)
    return sources, build(sources)


@_query
def species_on_route(spark, sf_dir):
    _, snapped = _output(spark, sf_dir)
    return lookups.species_on_route(snapped, 354087619, 900.0)


@_query
def observations_with_stream(spark, sf_dir):
    sources, snapped = _output(spark, sf_dir)
    attributes = ("gnis_name", "gradient", "stream_order")
    found = lookups.observations_with_stream(snapped, sources.streams, "CL", "GRP1", *attributes)
    return found.select("observation_key", *attributes)


@_query
def gradient_at_species(spark, sf_dir):
    sources, snapped = _output(spark, sf_dir)
    return lookups.gradient_at_species(snapped, sources.streams, "VI", "GRP3")


@_query
def elevation_at_species(spark, sf_dir):
    sources, snapped = _output(spark, sf_dir)
    return lookups.elevation_at_species(snapped, sources.streams, "CL", "GRP2")


def _branching(snapped: DataFrame) -> DataFrame:
    """The observations with codes of a branching network, which the stand-in streams lack."""
    route = F.col("blue_line_key") - 354087611
    local = F.concat_ws(".", standins.branch_code(route), (F.col("linear_feature_id") % 10 / 3).cast("int").cast("string"))
    return snapped.withColumn("wscode", standins.branch_code(route)).withColumn("localcode", local)


@_query
def species_farthest_upstream(spark, sf_dir):
    sources, snapped = _output(spark, sf_dir)
    return farthest_upstream(_branching(snapped))


@_query
def maximal_species(spark, sf_dir):
    sources, snapped = _output(spark, sf_dir)
    found = paths.maximal_species(_branching(snapped), sources.species)
    return found.select("blue_line_key", "downstream_route_measure", _text("maximal_species").alias("maximal_species"))


# --- the event model -----------------------------------------------------------------


@_query
def event_ids(spark, sf_dir):
    placed = _scattered_events(spark, sf_dir)
    return placed.select(
        "event_id", event_id("blue_line_key", "downstream_route_measure").alias("fish_obsrvtn_event_id")
    )


def _events(spark, sf_dir, **limit) -> tuple[Sources, DataFrame]:
    sources, snapped = _output(spark, sf_dir)
    return sources, events.rollup_events(stage(snapped, "observations"), sources.species, **limit)


@_query
def event_rollup(spark, sf_dir):
    return _event_text(_events(spark, sf_dir)[1])


@_query
def event_rollup_in_parts(spark, sf_dir):
    return _event_text(_events(spark, sf_dir, max_items=2)[1])


def _event_text(rolled: DataFrame) -> DataFrame:
    arrays = ("obs_ids", "match_types", "species_codes", "species_ids")
    return rolled.select(
        "fish_obsrvtn_event_id",
        "part_no",
        "linear_feature_id",
        "wscode_ltree",
        "localcode_ltree",
        "blue_line_key",
        "watershed_group_code",
        "downstream_route_measure",
        F.round("geom.z", 6).alias("geom_z"),
        *[_text(a).alias(a) for a in arrays],
        _text(F.transform("distances_to_stream", _mm)).alias("distances_mm"),
    )


@_query
def event_explode(spark, sf_dir):
    sources, rolled = _events(spark, sf_dir)
    single = events.explode_events(rolled, sources.streams, sources.observations, sources.species)
    rest = [c for c in single.columns if c not in ("geom", "distance_to_stream")]
    return _date_text(
        single.select(*rest, _round("distance_to_stream"), F.round("geom.z", 6).alias("geom_z"))
    )


@_query
def unnest_arrays(spark, sf_dir):
    e = F.col("event_id")

    def first(n: Column, limit: int) -> Column:
        every = F.array(*[F.lit(i).cast("long") for i in range(limit)])
        return F.filter(every, lambda i: i < n)

    arrays = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.when(e % 7 != 0, first(e % 4, 4)).alias("ns"),
        F.when(e % 5 != 0, F.transform(first(e % 3, 3), lambda i: F.concat(F.lit("v"), i.cast("string")))).alias("labels"),
    )
    return events.unnest(arrays, {"ns": "n", "labels": "label"})


@_query
def events_with_species(spark, sf_dir):
    _, rolled = _events(spark, sf_dir)
    found = events.events_with_species(rolled, [499, 518])
    return found.select("fish_obsrvtn_event_id", "part_no", _text("obs_ids").alias("obs_ids"))


@_query
def events_with_species_in_parts(spark, sf_dir):
    """Whole events come back, also where just one of their parts holds the species."""
    _, rolled = _events(spark, sf_dir, max_items=2)
    found = events.events_with_species(rolled, [499, 518])
    return found.select("fish_obsrvtn_event_id", "part_no", _text("obs_ids").alias("obs_ids"))


def _stored(spark, sf_dir, **limit) -> str:
    path = staged_path(spark, "events")
    io.write_events(_events(spark, sf_dir, **limit)[1], path)
    return path


@_query
def stored_events_with_species(spark, sf_dir):
    """By the posting tables, over events in parts."""
    found = io.stored_events_with(spark, _stored(spark, sf_dir, max_items=2), "species_ids", [499, 518])
    return found.select("fish_obsrvtn_event_id", "part_no", _text("obs_ids").alias("obs_ids"))


@_query
def stored_events_with_observation(spark, sf_dir):
    found = io.stored_events_with(spark, _stored(spark, sf_dir), "obs_ids", [391])
    return found.select("fish_obsrvtn_event_id", "part_no", _text("species_codes").alias("species_codes"))


@_query
def event_heads(spark, sf_dir):
    """One row per event with the species it is the most upstream place of, whatever the size of its parts."""
    sources, snapped = _output(spark, sf_dir)
    stored = stage(snapped, "observations")
    parts = events.rollup_events(stored, sources.species, max_items=2)
    heads = events.event_heads(parts, paths.maximal_species(_branching(stored), sources.species))
    return heads.select(
        "fish_obsrvtn_event_id", "linear_feature_id", "blue_line_key", "downstream_route_measure", "n_parts", "n_observations",
        _text("maximal_species").alias("maximal_species"),
    )


@_query
def events_with_observation(spark, sf_dir):
    _, rolled = _events(spark, sf_dir)
    found = events.events_with_observation(rolled, 391)
    return found.select("fish_obsrvtn_event_id", "part_no", _text("species_codes").alias("species_codes"))
