"""From lines to routes: closest position per route, and points at a measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.functions import explode_edges, positions_at_measure
from thalweg.functions.geometry import between_ends
from thalweg.operators.grouping import first_per_group
from thalweg.operators.skew import ROWS_PER_SLICE, SLICE, copy_to_slices, hot_keys, spread

MEASURE_BIN = 100.0
_BIN = ["_route", "_bin"]


def closest_per_route(
    candidates: DataFrame,
    *,
    by: Sequence[str],
    route: str = "blue_line_key",
    line_id: str = "linear_feature_id",
    anchored: Sequence[str] = (),
    own: Sequence[str] = (),
) -> DataFrame:
    """Per point and route, all candidate lines at the smallest distance.

    Consecutive lines of a route share a vertex, so ties are common. Every tied
    line keeps its own id and its `own` columns, but the measure and the `anchored` columns come from
    one of them, the anchor: the tied line with the lowest id, reported as
    `anchor_id`. Lines without a route drop out.
    """
    group = Window.partitionBy(*by, route)
    # a rank filter is cut short while streaming, so later steps see ties only
    tied = (
        candidates.where(F.col(route).isNotNull())
        .withColumn("_rank", F.rank().over(group.orderBy("distance")))
        .where("_rank = 1")
    )
    anchor = group.orderBy(line_id)
    from_anchor = [F.first(c).over(anchor).alias(c) for c in ("measure", *anchored)]
    return tied.select(
        *by, line_id, route, *own, "distance", F.first(line_id).over(anchor).alias("anchor_id"), *from_anchor
    )


def anchor_codes(lines: DataFrame) -> DataFrame:
    """Path codes by `anchor_id`."""
    return lines.select(
        F.col("linear_feature_id").alias("anchor_id"),
        F.col("wscode_ltree").alias("wscode"),
        F.col("localcode_ltree").alias("localcode"),
    )


def locate_along(
    events: DataFrame,
    lines: DataFrame,
    *,
    by: Sequence[str],
    route: str = "blue_line_key",
    measure: str = "downstream_route_measure",
    bin_size: float = MEASURE_BIN,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add `geom`, the x, y, z position of each event on its route.

    `by` identifies an event. An edge covers `[m1, m2)`; where nothing
    continues from its end, the end belongs to it too. An event off its route
    keeps its row with a NULL `geom`. Where lines of a route overlap, the
    lowest line id and edge wins.

    Events meet only the edges in their own measure bin, not all of the route. A bin with
    more than `rows_per_slice` events is cut into slices by `by`, its edges go to each.
    """

    def to_bin(m):
        return F.floor(m / F.lit(bin_size)).cast("long")

    edges = explode_edges(lines.where(F.col(route).isNotNull()), route, "linear_feature_id")
    low, high = F.least("m1", "m2"), F.greatest("m1", "m2")
    binned = edges.select(
        F.col(route).alias("_route"),
        F.explode(F.sequence(to_bin(low), to_bin(high))).alias("_bin"),
        low.alias("_low"),
        high.alias("_high"),
        F.struct("linear_feature_id", "edge_no").alias("_edge"),
        *[f"{c}{n}" for c in "xyzm" for n in (1, 2)],
    )
    m = F.col(measure)
    placed = events.withColumns({"_route": F.col(route), "_bin": to_bin(m)})
    hot = hot_keys(placed.where("_bin is not null"), _BIN, rows_per_slice)
    left, right = spread(placed, hot, _BIN, by).alias("e"), copy_to_slices(binned, hot, _BIN).alias("l")
    same = F.lit(True)
    for c in (*_BIN, SLICE):
        same = same & (F.col(f"e.{c}") == F.col(f"l.{c}"))
    met = left.join(right, same & (F.col("_low") <= m) & (m <= F.col("_high")), "left")
    at_end = (m == F.col("_high")) & (F.col("_low") < F.col("_high"))
    one = first_per_group(
        met.withColumn("_at_end", at_end),
        by,
        [F.col("_at_end").asc_nulls_last(), F.col("_edge").asc_nulls_last()],
    )
    t = F.coalesce((m - F.col("m1")) / F.nullif(F.col("m2") - F.col("m1"), F.lit(0.0)), F.lit(0.0))
    position = F.struct(*[between_ends(t, F.col(f"{c}1"), F.col(f"{c}2")).alias(c) for c in "xyz"])
    return one.select(*events.columns, F.when(F.col("_edge").isNotNull(), position).alias("geom"))


def elevation_at(
    located: DataFrame, *, vertices: str = "vertices", measure: str = "downstream_route_measure"
) -> DataFrame:
    """One row per position of `measure` on the row's own line, with its rounded Z.

    A measure that isn't on the line gives no row.
    """
    spots = located.withColumn("_spot", F.explode(positions_at_measure(vertices, measure)))
    return spots.withColumn("elevation", F.round("_spot.z")).drop("_spot")
