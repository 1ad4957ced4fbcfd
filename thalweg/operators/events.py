"""The event model: one row per (route, measure) with arrays of observations.

An event's arrays can't grow without limit. Every event is cut into parts of
`max_items` observations in the order of their ids, rows that differ in `part_no`;
(event id, part_no) is the table's key. Explosion and membership put parts together
again, so answers don't depend on where they are cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.functions import event_id
from thalweg.operators.nearest import nearest_lines

MAX_ITEMS = 100_000
#: Ids that are numbered in one go; bounds the rows of one key in a window.
BUCKET = 65_536

_ARRAYS = ("match_types", "obs_ids", "species_codes", "species_ids", "distances_to_stream")
EVENT = ("blue_line_key", "downstream_route_measure")


def rollup_events(observations: DataFrame, species: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """Snapped observations gathered per event, each array ordered by observation id.

    Observations with an unknown species code stay, with a NULL species id.
    """
    ids = species.select(F.col("code").alias("species_code"), "species_id")
    named = observations.join(ids, "species_code", "left")
    item = F.struct(
        F.col("fish_observation_point_id").alias("obs_id"),
        "match_type",
        "species_code",
        "species_id",
        F.col("distance_to_stream").alias("distance"),
    )
    gathered = (
        _in_parts(named, EVENT, "fish_observation_point_id", max_items)
        .groupBy(*EVENT, "part_no")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
    )
    place = F.struct("linear_feature_id", "wscode", "localcode", "watershed_group_code", "geom")
    first = F.min_by(place, F.struct("linear_feature_id", "observation_key"))
    places = observations.groupBy(*EVENT).agg(first.alias("place"))
    return _event_columns(gathered.join(places, list(EVENT)))


def event_heads(parts: DataFrame, maximal: DataFrame | None = None) -> DataFrame:
    """One row per event, whatever its size: the event's own columns, and how many parts and observations it has.

    `parts` are rows of `rollup_events`, whose arrays are the chunks of the event; the event id is a
    unique key here and leads to them. `maximal` (route, measure, `maximal_species`) adds the species
    whose most upstream place the event is, an empty array where there are none.
    """
    own = [c for c in parts.columns if c not in ("part_no", *_ARRAYS)]
    whole = parts.groupBy("fish_obsrvtn_event_id").agg(
        *[F.min_by(c, "part_no").alias(c) for c in own if c != "fish_obsrvtn_event_id"],
        F.count("*").alias("n_parts"),
        F.sum(F.size("obs_ids")).alias("n_observations"),
    )
    if maximal is None:
        return whole
    none = F.array().cast("array<int>")
    return whole.join(maximal, list(EVENT), "left").withColumn("maximal_species", F.coalesce("maximal_species", none))


def _event_columns(events: DataFrame) -> DataFrame:
    def column(field: str):
        return F.transform("items", lambda i: i[field])

    return events.select(
        event_id(*EVENT).alias("fish_obsrvtn_event_id"),
        "part_no",
        "place.linear_feature_id",
        F.col("place.wscode").alias("wscode_ltree"),
        F.col("place.localcode").alias("localcode_ltree"),
        "blue_line_key",
        "place.watershed_group_code",
        "downstream_route_measure",
        column("match_type").alias("match_types"),
        column("obs_id").alias("obs_ids"),
        column("species_code").alias("species_codes"),
        column("species_id").alias("species_ids"),
        column("distance").alias("distances_to_stream"),
        "place.geom",
    )


def _in_parts(df: DataFrame, on: Sequence[str], by: str, max_items: int) -> DataFrame:
    """Add `part_no`, the position within the group in the order of the ids `by` by `max_items`, and `first_id`.

    Rows are counted per bucket of ids and numbered within it, so that even the
    largest group is never numbered by one task.
    """
    bucketed = df.withColumn("_bucket", F.floor(F.col(by) / BUCKET))
    counts = bucketed.groupBy(*on, "_bucket").agg(F.count("*").alias("n"), F.min(by).alias("least"))
    earlier = Window.partitionBy(*on).orderBy("_bucket")
    before = counts.select(
        *on,
        "_bucket",
        F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.min("least").over(earlier.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("first_id"),
    )
    within = Window.partitionBy(*on, "_bucket").orderBy(by)
    numbered = bucketed.withColumn("_no", F.row_number().over(within) - 1)
    part = F.floor((F.col("before") + F.col("_no")) / max_items).cast("long")
    return numbered.join(before, [*on, "_bucket"]).withColumn("part_no", part).drop("_bucket", "_no", "before")


def rollup_unmatched(
    unmatched: DataFrame, lines: DataFrame, species: DataFrame, max_items: int = MAX_ITEMS
) -> DataFrame:
    """Distinct positions of unmatched observations, gathered like events.

    A position is named by its lowest observation id. Its distance is that to the
    closest of `lines` (as for `nearest_lines`), looked for once per position, and
    NULL where none is in reach.
    """
    ids = species.select(F.col("code").alias("species_code"), "species_id")
    item = F.struct(F.col("fish_observation_point_id").alias("obs_id"), "species_id")
    parted = _in_parts(unmatched.join(ids, "species_code", "left"), ("x", "y"), "fish_observation_point_id", max_items)
    spots = parted.groupBy("x", "y", "part_no").agg(
        F.sort_array(F.collect_list(item)).alias("items"), F.min("first_id").alias("fish_obsrvtn_pnt_distinct_id")
    )
    places = unmatched.select("x", "y").distinct()
    reach = nearest_lines(places, lines, by=["x", "y"], k=1)
    return spots.join(reach.select("x", "y", F.col("distance").alias("distance_to_stream")), ["x", "y"], "left").select(
        "fish_obsrvtn_pnt_distinct_id",
        "part_no",
        F.transform("items", lambda i: i["obs_id"]).alias("obs_ids"),
        F.transform("items", lambda i: i["species_id"]).alias("species_ids"),
        "distance_to_stream",
        "x",
        "y",
    )


def unnest(df: DataFrame, arrays: dict[str, str]) -> DataFrame:
    """Explode several arrays side by side; shorter ones are padded with NULL.

    `arrays` maps array columns to the names of their elements. A NULL array counts
    as an empty one.
    """
    rest = [c for c in df.columns if c not in arrays]
    zipped = F.arrays_zip(*[F.coalesce(a, F.array().cast(df.schema[a].dataType)).alias(a) for a in arrays])
    rows = df.select(*rest, F.explode(zipped).alias("_item"))
    return rows.select(*rest, *[F.col("_item")[a].alias(n) for a, n in arrays.items()])


def explode_events(
    events: DataFrame, streams: DataFrame, observations: DataFrame, species: DataFrame
) -> DataFrame:
    """The event table as single observations, with stream, source and species columns.

    Observations with an unknown species code are left out.
    """
    rows = unnest(
        events.select(
            "fish_obsrvtn_event_id",
            "linear_feature_id",
            "blue_line_key",
            "downstream_route_measure",
            "geom",
            "obs_ids",
            "distances_to_stream",
            "match_types",
        ),
        {
            "obs_ids": "fish_observation_point_id",
            "distances_to_stream": "distance_to_stream",
            "match_types": "match_type",
        },
    )
    on_stream = streams.select(
        "linear_feature_id", "wscode_ltree", "localcode_ltree", "waterbody_key", "watershed_group_code"
    )
    source = observations.select(
        "fish_observation_point_id",
        "species_code",
        "agency_id",
        "observation_date",
        "agency_name",
        "source",
        "source_ref",
        "activity_code",
        "activity",
        "life_stage_code",
        "life_stage",
        "acat_report_url",
    )
    codes = species.select(F.col("code").alias("species_code"), "species_id")
    return (
        rows.join(on_stream, "linear_feature_id")
        .join(source, "fish_observation_point_id")
        .join(codes, "species_code")
        .select(
            "fish_observation_point_id",
            "fish_obsrvtn_event_id",
            "linear_feature_id",
            "wscode_ltree",
            "localcode_ltree",
            "blue_line_key",
            "waterbody_key",
            "downstream_route_measure",
            "distance_to_stream",
            "match_type",
            "watershed_group_code",
            "species_id",
            "species_code",
            "agency_id",
            "observation_date",
            "agency_name",
            "source",
            "source_ref",
            "activity_code",
            "activity",
            "life_stage_code",
            "life_stage",
            "acat_report_url",
            "geom",
        )
    )


def events_with_species(events: DataFrame, species_ids: Sequence[int]) -> DataFrame:
    """All parts of the events at which any of the species was seen."""
    wanted = F.array(*[F.lit(int(i)) for i in species_ids])
    return _whole(events, events.where(F.arrays_overlap("species_ids", wanted)))


def events_with_observation(events: DataFrame, observation_id: int) -> DataFrame:
    """All parts of the event that holds the observation."""
    return _whole(events, events.where(F.array_contains("obs_ids", F.lit(observation_id).cast("long"))))


def _whole(events: DataFrame, found: DataFrame) -> DataFrame:
    return events.join(found.select("fish_obsrvtn_event_id").distinct(), "fish_obsrvtn_event_id", "left_semi")
