"""Tiered matching: one line per observation through ordered rules.

The rules look only at where an observation lies, what kind of water it is in
and which waterbody or watershed code it names. `match_profile` turns that into
one text, and matching runs once per distinct (x, y, profile), however many
observations share it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thalweg.functions import joined_code, strip_dashes, strip_leading_zeros
from thalweg.operators.grouping import first_per_group
from thalweg.operators.skew import spread_join
from thalweg.staging import stage

# Waterbody types, distance limits in metres and result tags.
STILL_WATER = ("Lake", "Wetland")
NEAR_LIMIT = 100.0
FAR_LIMIT = 500.0
TIER_A = "A. matched - stream; within 100m; lookup"
TIER_B = "B. matched - stream; within 100m; closest stream"
TIER_C = "C. matched - stream; 100-500m; lookup"
TIER_D = "D. matched - waterbody; construction line within 1500m; lookup"
TIER_E = "E. matched - waterbody; construction line within 1500m; closest"

# in the order in which they are tried
TIER_RULES = (TIER_D, TIER_E, TIER_A, TIER_B, TIER_C)

PROFILE = ("x", "y", "match_ref")

#: How many refs a line carries through the search at most.
MAX_REFS = 32

_STILL, _FLOWING, _FLOWING_UNCODED = "W", "S", "U"


def match_profile(
    waterbody_type: str = "waterbody_type",
    waterbody_id: str = "wbody_id",
    watershed_code: str = "new_watershed_code",
) -> Column:
    """What the rules need to know of an observation, apart from its place.

    NULL where no rule can apply: an unknown waterbody type, or still water
    without a waterbody id.
    """
    kind = F.col(waterbody_type)
    code = F.concat(F.lit(_FLOWING), strip_dashes(watershed_code))
    return F.when(
        kind.isin(*STILL_WATER), F.concat(F.lit(_STILL), F.col(waterbody_id).cast("long").cast("string"))
    ).when(~kind.isin(*STILL_WATER), F.coalesce(code, F.lit(_FLOWING_UNCODED)))


def waterbody_targets(dictionary: DataFrame, xref: DataFrame, waterbodies: DataFrame) -> DataFrame:
    """Distinct (`wbody_id`, `waterbody_key`) pairs the waterbody lookups connect."""
    named = dictionary.select(
        F.col("id").cast("long").alias("wbody_id"),
        strip_leading_zeros("waterbody_identifier").alias("code"),
    )
    coded = xref.select(
        joined_code("waterbody_key_50k", "watershed_group_code_50k").alias("code"),
        F.col("waterbody_key_20k").cast("long").alias("waterbody_key"),
    )
    known = waterbodies.select(F.col("waterbody_key").cast("long").alias("waterbody_key"))
    linked = coded.join(known, "waterbody_key", "left_semi")
    return named.join(linked, "code").select("wbody_id", "waterbody_key").distinct()


def waterbody_pairs(observations: DataFrame, targets: DataFrame) -> DataFrame:
    """The waterbody keys each still-water observation may be matched to."""
    still = observations.where(F.col("waterbody_type").isin(*STILL_WATER)).select(
        "observation_key", F.col("wbody_id").cast("long").alias("wbody_id")
    )
    return still.join(targets, "wbody_id").select("observation_key", "waterbody_key").distinct()


def listed_targets(waterbody_pairs: DataFrame, stream_xref: DataFrame) -> DataFrame:
    """Both lookups as distinct (`match_ref`, `target`): a waterbody key for
    still water, a line id for flowing water."""
    still = waterbody_pairs.select(
        F.concat(F.lit(_STILL), F.col("wbody_id").cast("string")).alias("match_ref"),
        F.col("waterbody_key").alias("target"),
    )
    flowing = stream_xref.select(
        F.concat(F.lit(_FLOWING), F.col("watershed_code_50k")).alias("match_ref"),
        F.col("linear_feature_id_20k").cast("long").alias("target"),
    ).where("match_ref is not null and target is not null")
    return still.unionByName(flowing.distinct())


#: Columns of candidates after the search.
LINE_FLAGS, WATER_FLAGS = ("line_listed", "line_crowded"), ("water_listed", "water_crowded")


def target_refs(targets: DataFrame) -> DataFrame:
    """Per line (`kind` flowing) and waterbody (still) the `match_ref`s that the lookups connect with it, stored.

    `refs` are arrays of `MAX_REFS` at most. A target with more than that has none and is
    marked crowded; its candidates are left to `join_listed`.
    """
    kinds = targets.withColumn("kind", F.substring("match_ref", 1, 1))
    counts = kinds.groupBy("kind", "target").agg(F.count("*").alias("n"))
    few = kinds.join(counts.where(F.col("n") <= MAX_REFS), ["kind", "target"], "left_semi")
    refs = few.groupBy("kind", "target").agg(F.collect_set("match_ref").alias("refs"), F.lit(False).alias("crowded"))
    many = counts.where(F.col("n") > MAX_REFS).select("kind", "target", F.lit(None).cast("array<string>").alias("refs"), F.lit(True).alias("crowded"))
    return stage(refs.unionByName(many), "target-refs")


def line_refs(lines: DataFrame, refs: DataFrame) -> DataFrame:
    """The refs of each line's own and of its waterbody's, with whether it is crowded; only of lines that have some."""

    def of(kind: str, name: str, key: str) -> DataFrame:
        return refs.where(F.col("kind") == kind).select(
            F.col("target").alias(key), F.col("refs").alias(f"{name}_refs"), F.col("crowded").alias(f"{name}_crowded")
        )

    # one waterbody may hold most lines
    slim = lines.where(F.col("waterbody_key").isNotNull()).select("linear_feature_id", F.col("waterbody_key").cast("long").alias("waterbody_key"))
    by_water = spread_join(slim, of(_STILL, "water", "waterbody_key"), ["waterbody_key"], by=["linear_feature_id"]).drop("waterbody_key")
    return of(_FLOWING, "line", "linear_feature_id").join(by_water, "linear_feature_id", "full")


def search_flags() -> dict[str, Column]:
    """For `nearest_lines`: whether the lookups connect a point's `match_ref` with a line and with its waterbody."""

    def listed(name: str) -> Column:
        return F.coalesce(F.array_contains(f"{name}_refs", F.col("match_ref")), F.lit(False))

    def crowded(name: str) -> Column:
        return F.coalesce(f"{name}_crowded", F.lit(False))

    return {f"{name}_{what}": f(name) for name in ("line", "water") for what, f in (("listed", listed), ("crowded", crowded))}


def flag_listed(candidates: DataFrame, targets: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """Add `listed`: the lookups connect this candidate with the observation.

    The search has settled that beside each candidate (`search_flags`), so candidates stay where
    they are. Only those of crowded lines and waterbodies meet the table of `targets` (None if there are
    no such), spread where one of them holds very many.
    """
    still = F.col("match_ref").startswith(_STILL)
    listed = candidates.withColumn("listed", F.when(still, F.col("water_listed")).otherwise(F.col("line_listed")))
    if targets is None:
        return listed.drop(*LINE_FLAGS, *WATER_FLAGS)
    crowded = F.when(still, F.col("water_crowded")).otherwise(F.col("line_crowded"))
    plain = listed.where(~crowded).drop(*LINE_FLAGS, *WATER_FLAGS)
    rest = stage(listed.where(crowded).drop("listed", *LINE_FLAGS, *WATER_FLAGS), "crowded")
    return plain.unionByName(join_listed(rest, targets, by))


def join_listed(candidates: DataFrame, targets: DataFrame, by: Sequence[str]) -> DataFrame:
    """`listed` by a join on (`match_ref`, target), for candidates that `by` and the line tell apart."""
    still = F.col("match_ref").startswith(_STILL)
    target = F.when(still, F.col("waterbody_key")).otherwise(F.col("linear_feature_id"))
    flags = targets.withColumn("listed", F.lit(True))
    joined = spread_join(candidates.withColumn("target", target), flags, ["match_ref", "target"], [*by, "linear_feature_id"], how="left")
    return joined.withColumn("listed", F.coalesce("listed", F.lit(False))).drop("target")


def match_tiers(candidates: DataFrame, *, by: Sequence[str]) -> DataFrame:
    """At most one candidate per `by` group, with its `match_type`.

    Each rule has a distance: the smallest among the candidates it accepts.
    The first rule that has one decides, and the winner is the candidate at
    that distance with the lowest measure, then line id. The winner only has to
    lie at the distance; it need not satisfy the rule that set it, except that
    the waterbody lookup takes lines in a waterbody only.

    All rules are judged in one pass over the candidates, at most `k` per group.
    """
    d, listed = F.col("distance"), F.col("listed")
    still = F.col("match_ref").startswith(_STILL)
    near = d <= NEAR_LIMIT
    far = (d > NEAR_LIMIT) & (d < FAR_LIMIT)
    # a candidate counts for the first rule that takes it; where no candidate
    # counts for an earlier rule, that is every candidate a rule takes
    rule = (
        F.when(still & listed, TIER_RULES.index(TIER_D))
        .when(still, TIER_RULES.index(TIER_E))
        .when(near & listed, TIER_RULES.index(TIER_A))
        .when(near, TIER_RULES.index(TIER_B))
        .when(far & listed, TIER_RULES.index(TIER_C))
    )
    first = F.min(F.when(rule.isNotNull(), F.struct(rule.alias("rule"), d.alias("at"))))
    decided = candidates.withColumn("_first", first.over(Window.partitionBy(*by)))
    tag = F.element_at(F.array(*[F.lit(t) for t in TIER_RULES]), F.col("_first.rule") + 1)
    at_limit = decided.where(d == F.col("_first.at")).withColumn("match_type", tag)
    eligible = at_limit.where((F.col("match_type") != TIER_D) | F.col("waterbody_key").isNotNull())
    order = [F.col("measure").asc_nulls_last(), F.col("linear_feature_id").asc()]
    return first_per_group(eligible, by, order).drop("listed", "_first")


def unmatched(observations: DataFrame, matches: DataFrame) -> DataFrame:
    return observations.join(matches.select("observation_key"), "observation_key", "left_anti")


def match_summary(observations: DataFrame) -> DataFrame:
    """Distinct (route, measure) events and observations per match type."""
    events = observations.groupBy("match_type", "blue_line_key", "downstream_route_measure").agg(
        F.count("*").alias("n")
    )
    return events.groupBy("match_type").agg(
        F.count("*").alias("n_distinct_events"), F.sum("n").alias("n_observations")
    )
