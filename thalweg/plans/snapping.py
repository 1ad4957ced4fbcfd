"""The snapping job: observations and streams in, snapped observations out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thalweg.functions import clamp_measure, is_descendant_or_self
from thalweg.operators.grouping import dedupe_by_key, with_observation_key
from thalweg.operators.matching import (
    LINE_FLAGS,
    PROFILE,
    WATER_FLAGS,
    flag_listed,
    line_refs,
    listed_targets,
    match_profile,
    match_tiers,
    search_flags,
    target_refs,
    waterbody_targets,
)
from thalweg.operators.nearest import CELL, DEFAULT_K, DEFAULT_RADIUS, nearest_lines
from thalweg.operators.routes import anchor_codes, closest_per_route, locate_along
from thalweg.operators.skew import spread_join
from thalweg.staging import stage
from thalweg.schemas import OBSERVATION_COLUMNS, OUTPUT_COLUMNS

# The code of unconnected streams and the edge type left out.
UNCONNECTED_CODE = "999"
EXCLUDED_EDGE_TYPE = 6010


@dataclass(frozen=True)
class Sources:
    observations: DataFrame
    streams: DataFrame
    waterbody_dictionary: DataFrame
    waterbody_xref: DataFrame
    waterbodies: DataFrame
    stream_xref: DataFrame
    species: DataFrame | None = None


def is_eligible() -> Column:
    """Streams that take part in the search; a NULL in any test leaves one out."""
    return (
        F.col("localcode_ltree").isNotNull()
        & ~is_descendant_or_self("wscode_ltree", UNCONNECTED_CODE)
        & (F.col("edge_type") != EXCLUDED_EDGE_TYPE)
    )


def eligible_streams(streams: DataFrame) -> DataFrame:
    return streams.where(is_eligible())


def explode_points(observations: DataFrame, points: str = "points") -> DataFrame:
    """One row per part of a multi-part position; none for a NULL or empty one."""
    parts = observations.withColumn("_part", F.explode(points)).drop(points)
    return parts.select("*", "_part.x", "_part.y").drop("_part")


def keyed_observations(observations: DataFrame, point_type: str | None = None) -> DataFrame:
    """Observations with a position, one per key.

    `point_type` keeps one `point_type_code` only; by default all count.
    """
    if "points" in observations.columns:
        observations = explode_points(observations)
    placed = observations.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    if point_type is not None:
        placed = placed.where(F.col("point_type_code") == point_type)
    return dedupe_by_key(with_observation_key(placed.select(*OBSERVATION_COLUMNS, "x", "y")))


def candidates(
    points: DataFrame,
    streams: DataFrame,
    *,
    by: tuple[str, ...],
    k: int | None = DEFAULT_K,
    radius: float = DEFAULT_RADIUS,
    keep_cell: bool = False,
    cell_size: float | None = None,
    targets: DataFrame | None = None,
) -> DataFrame:
    """Nearest streams of every point, reduced to the closest ones per route.

    With `targets` (and `match_ref` in `by`) each has `listed`: whether the lookups name it.
    """
    lines, refs = eligible_streams(streams), None if targets is None else target_refs(targets)
    extra = {} if refs is None else {"flags": search_flags(), "needs": line_refs(lines, refs)}
    found = nearest_lines(
        points,
        lines,
        by=by,
        k=k,
        radius=radius,
        carry=("blue_line_key", "waterbody_key"),
        keep_cell=True,
        cell_size=cell_size,
        **extra,
    )
    own, anchored = ((), ()) if refs is None else (LINE_FLAGS, WATER_FLAGS)
    reduced = closest_per_route(found, by=[CELL, *by], own=own, anchored=["waterbody_key", *anchored])
    if refs is not None:
        crowded = not refs.where("crowded").isEmpty()
        reduced = flag_listed(reduced, targets if crowded else None, [CELL, *by])
    return reduced if keep_cell else reduced.drop(CELL)


def observation_candidates(keyed: DataFrame, streams: DataFrame) -> DataFrame:
    """The candidates of every observation, searched once per distinct position."""
    at = ("x", "y")
    spots = stage(keyed.select(*at).distinct(), "spots")
    found = candidates(spots, streams, by=at)
    slim = keyed.select("observation_key", *at)
    return spread_join(slim, found, at, by=["observation_key"]).drop(*at)


def winners(keyed: DataFrame, sources: Sources, cell_size: float | None = None) -> DataFrame:
    """The matched line per distinct (x, y, profile), stored: it is the costly step."""
    profiles = stage(with_profile(keyed).where("match_ref is not null").select(*PROFILE).distinct(), "profiles")
    flagged = candidates(profiles, sources.streams, by=PROFILE, keep_cell=True, cell_size=cell_size, targets=all_targets(sources))
    return stage(match_tiers(flagged, by=[CELL, *PROFILE]).drop(CELL), "winners")


def all_targets(sources: Sources) -> DataFrame:
    """What the waterbody and stream lookups connect, as one stored table."""
    pairs = waterbody_targets(sources.waterbody_dictionary, sources.waterbody_xref, sources.waterbodies)
    return stage(listed_targets(pairs, sources.stream_xref), "targets")


def with_profile(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("match_ref", match_profile())


def matches(keyed: DataFrame, sources: Sources, cell_size: float | None = None) -> DataFrame:
    """One row per matched observation: line, codes, unrounded measure, tag."""
    won = with_codes(winners(keyed, sources, cell_size), sources.streams)
    slim = with_profile(keyed).where("match_ref is not null").select("observation_key", *PROFILE)
    joined = spread_join(slim, won, PROFILE, by=["observation_key"])
    return joined.select(
        "observation_key",
        "linear_feature_id",
        "wscode",
        "localcode",
        "waterbody_key",
        "blue_line_key",
        F.col("measure").alias("downstream_route_measure"),
        F.col("distance").alias("distance_to_stream"),
        "match_type",
    )


def with_codes(won: DataFrame, streams: DataFrame) -> DataFrame:
    """Winners with the path codes of their anchor line."""
    return spread_join(won, anchor_codes(streams), ["anchor_id"], by=PROFILE).drop("anchor_id")


def snapped(won: DataFrame, streams: DataFrame) -> DataFrame:
    """Winners with whole-metre measures, codes, group and position."""
    own = streams.select(
        "linear_feature_id",
        "watershed_group_code",
        F.col("downstream_route_measure").alias("_from"),
        F.col("upstream_route_measure").alias("_to"),
    )
    rounded = (
        spread_join(with_codes(won, streams), own, ["linear_feature_id"], by=PROFILE, counted=won)
        .withColumn("downstream_route_measure", clamp_measure("measure", "_from", "_to"))
        .drop("measure", "_from", "_to")
    )
    return locate_along(rounded, streams, by=PROFILE)


def snap(keyed: DataFrame, won: DataFrame, streams: DataFrame) -> DataFrame:
    """The output table from keyed observations and their winners."""
    placed = snapped(won, streams).withColumnRenamed("distance", "distance_to_stream")
    return spread_join(with_profile(keyed), placed, PROFILE, by=["observation_key"]).select(*OUTPUT_COLUMNS)


def build(sources: Sources, point_type: str | None = None, cell_size: float | None = None) -> DataFrame:
    """The whole job: three staged tables, then one lazy plan for the rest."""
    keyed = stage(keyed_observations(sources.observations, point_type), "keyed")
    return snap(keyed, winners(keyed, sources, cell_size), sources.streams)
