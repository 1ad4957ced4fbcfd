"""Joins over path codes, and what lies upstream of what.

A path code names its ancestors, so containment needs no comparison of pairs: every
code is exploded into its prefixes, and these meet the ancestors' codes in an equi-join.
The work is rows times path depth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thalweg.functions import path_label_after, path_prefixes
from thalweg.operators.skew import ROWS_PER_SLICE, spread_join
from thalweg.staging import stage

EVENT = ("blue_line_key", "downstream_route_measure")
_PLACE = (*EVENT, "wscode", "localcode")


def join_below(
    upper: DataFrame,
    lower: DataFrame,
    *,
    upper_code: str,
    lower_code: str,
    by: Sequence[str],
    or_self: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Every row of `lower` with every row of `upper` whose code is an ancestor of its own (or the same).

    `by` tells the rows of `lower` apart. Column names mustn't clash. Rows with a NULL code meet
    nothing. A code near the root, which most of `lower` lies below, is spread over
    several tasks; prefixes that no row of `upper` has are left out before the join.
    """
    above = F.explode(path_prefixes(lower_code))
    known = upper.select(F.col(upper_code).alias("_above")).where("_above is not null").distinct()
    listed = lower.withColumn("_above", above)
    if not or_self:
        listed = listed.where(F.col("_above") != F.col(lower_code))
    listed = listed.join(known, "_above", "left_semi")
    return spread_join(listed, upper.withColumn("_above", F.col(upper_code)), ["_above"], by, rows_per_slice).drop("_above")


def farthest_upstream(observations: DataFrame, species: str = "species_code") -> DataFrame:
    """Places (`EVENT`, wscode, localcode, `species`) with no observation of the species further upstream.

    This rule is the library's own. One place is upstream of another

    * on the same route, if its measure is larger;
    * on the same stream (equal wscode), if its position, the first label of its localcode after
      the wscode, is larger (none counts as the mouth, the lowest);
    * on a stream that runs into the other's (its wscode goes on), if the label with
      which it goes on, the position of the confluence, is larger.

    Labels compare as text, as codes of fixed width do. Two places on one position of a stream are
    not upstream of each other, unless their route says so. A place without a wscode is compared
    along its route only; one without a localcode counts as the mouth. Rows without a
    species, route or measure have no place.

    Each species' largest positions are kept per route, stream and confluence, and places are
    compared with those: no pairs of observations, and every aggregate combines before its shuffle.
    """
    placed = observations.select(F.col(species).alias("_species"), *_PLACE)
    for c in ("_species", *EVENT):
        placed = placed.where(F.col(c).isNotNull())
    at = F.coalesce(path_label_after("localcode", F.col("wscode")), F.lit(""))
    places = stage(placed.distinct().withColumn("_at", at), "species-places")
    by_route = places.groupBy("_species", "blue_line_key").agg(F.max("downstream_route_measure").alias("_highest"))
    on_stream = places.select("_species", F.col("wscode").alias("_stream"), "_at")
    along = on_stream.union(_confluences(on_stream.select("_species", "_stream").distinct()))
    by_stream = along.where("_stream is not null").groupBy("_species", "_stream").agg(F.max("_at").alias("_uppermost"))
    keys = ["_species", *EVENT]
    met = spread_join(places, by_route, ["_species", "blue_line_key"], keys)
    on_route = met.where(F.col("downstream_route_measure") == F.col("_highest")).withColumnRenamed("wscode", "_stream")
    coded = spread_join(on_route.where("_stream is not null"), by_stream, ["_species", "_stream"], keys)
    highest = coded.where(F.col("_at") == F.col("_uppermost")).drop("_uppermost")
    kept = highest.unionByName(on_route.where("_stream is null"), allowMissingColumns=True)
    return kept.select(*EVENT, F.col("_stream").alias("wscode"), "localcode", F.col("_species").alias(species))


def _confluences(streams: DataFrame) -> DataFrame:
    """Every stream above a stream with an observation, and where on it that one's water arrives."""
    above = streams.withColumn("_above", F.explode(path_prefixes("_stream"))).where(F.col("_above") != F.col("_stream"))
    return above.select("_species", F.col("_above").alias("_on"), path_label_after("_stream", F.col("_above")).alias("_at")).withColumnRenamed(
        "_on", "_stream"
    )


def maximal_species(observations: DataFrame, species: DataFrame) -> DataFrame:
    """Per event the sorted ids of the species that it is the most upstream place of.

    As `farthest_upstream`; species without an id and events without such a species are left out.
    """
    ids = species.select(F.col("code").alias("species_code"), "species_id").where("species_id is not null")
    found = farthest_upstream(observations).join(ids, "species_code")
    return found.groupBy(*EVENT).agg(F.sort_array(F.collect_set("species_id")).alias("maximal_species"))
