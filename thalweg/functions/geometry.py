"""Planar geometry as column arithmetic.

A line is an `array<struct<x,y,z,m: double>>`; points are plain `x`, `y`
columns in a metric projection. Everything here is built from JVM expressions
so that it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edges_of(vertices: str | Column) -> Column:
    """The consecutive vertex pairs of a line as `array<struct<0,1>>`.

    Lines with fewer than two vertices give an empty array, NULL gives NULL.
    """
    v = F.col(vertices) if isinstance(vertices, str) else vertices
    n = F.greatest(F.size(v) - 1, F.lit(0))
    return F.arrays_zip(F.slice(v, F.lit(1), n), F.slice(v, F.lit(2), n))


def explode_edges(lines: DataFrame, *keep: str, vertices: str = "vertices") -> DataFrame:
    """One row per edge: the `keep` columns, `edge_no` and both end points."""
    pairs = lines.select(*keep, F.posexplode(edges_of(vertices)).alias("edge_no", "edge"))
    a, b = F.col("edge")["0"], F.col("edge")["1"]
    ends = [a[f].alias(f"{f}1") for f in "xyzm"] + [b[f].alias(f"{f}2") for f in "xyzm"]
    return pairs.select(*keep, "edge_no", *ends)


def squared_distance_to_edge(px: Column, py: Column, edge: dict[str, Column]) -> Column:
    """Squared planar distance from a point to the edge x1, y1, x2, y2.

    Beyond an end the end itself counts, and its coordinates are used as they
    are. That keeps the distance to a vertex bit-identical for the edges that
    share it, which tie detection relies on. A zero-length edge is its start.
    """
    e = _Edge(px, py, edge)
    ax, ay, bx, by = px - e.x1, py - e.y1, px - e.x2, py - e.y2
    across = ax * e.dy - ay * e.dx
    return (
        F.when(e.before_start, ax * ax + ay * ay)
        .when(e.past_end, bx * bx + by * by)
        .otherwise(across * across / e.length2)
    )


def measure_on_edge(px: Column, py: Column, edge: dict[str, Column]) -> Column:
    """M of the edge at its closest position to the point."""
    e = _Edge(px, py, edge)
    m1, m2 = edge["m1"], edge["m2"]
    inside = m1 + e.along / e.length2 * (m2 - m1)
    return F.when(e.before_start, m1).when(e.past_end, m2).otherwise(inside)


class _Edge:
    """Shared terms: where the foot of the point falls on the edge's line."""

    def __init__(self, px: Column, py: Column, edge: dict[str, Column]):
        self.x1, self.y1, self.x2, self.y2 = (edge[c] for c in ("x1", "y1", "x2", "y2"))
        self.dx, self.dy = self.x2 - self.x1, self.y2 - self.y1
        self.length2 = self.dx * self.dx + self.dy * self.dy
        self.along = (px - self.x1) * self.dx + (py - self.y1) * self.dy
        self.before_start = self.along <= 0.0
        self.past_end = self.along >= self.length2


def between_ends(t: Column, start: Column, end: Column) -> Column:
    """Linear interpolation that returns the end value exactly at 1."""
    return F.when(t >= 1.0, end).otherwise(start + t * (end - start))


def positions_at_measure(vertices: str | Column, measure: str | Column) -> Column:
    """Every point of one line whose M equals `measure`: `array<struct<x,y,z>>`.

    Edges are half-open `[m1, m2)` except the last, which is closed, so a
    measure on an inner vertex is reported once. A measure off the line gives
    an empty array.
    """
    v = F.col(vertices) if isinstance(vertices, str) else vertices
    m = F.col(measure) if isinstance(measure, str) else measure
    last = F.size(v) - 2

    def hits(edge: Column, position: Column) -> Column:
        a, b = edge["0"]["m"], edge["1"]["m"]
        return ((a <= m) & (m < b)) | ((position == last) & (a <= m) & (m == b))

    def locate(edge: Column) -> Column:
        a, b = edge["0"], edge["1"]
        t = F.coalesce((m - a["m"]) / F.nullif(b["m"] - a["m"], F.lit(0.0)), F.lit(0.0))
        return F.struct(*[between_ends(t, a[f], b[f]).alias(f) for f in "xyz"])

    return F.transform(F.filter(edges_of(v), hits), locate)


def force_3d(point: str | Column) -> Column:
    """Drop M from a point struct; NULL stays NULL."""
    p = F.col(point) if isinstance(point, str) else point
    return F.when(p.isNotNull(), F.struct(*[p[f].alias(f) for f in "xyz"]))
