"""Small literal tables for the hand cases."""

from __future__ import annotations

from thalweg import schemas
from thalweg.plans import Sources


def observation(**values):
    row = dict.fromkeys(f.name for f in schemas.OBSERVATIONS.fields)
    row.update(fish_observation_point_id=1, species_code="ST", waterbody_type="Stream", x=0.0, y=0.0)
    row.update(values)
    row.setdefault("source", f"s{row['fish_observation_point_id']}")
    if row["source"] is None:
        row["source"] = f"s{row['fish_observation_point_id']}"
    return row


def observations(spark, *rows):
    return spark.createDataFrame(
        [tuple(r[f.name] for f in schemas.OBSERVATIONS.fields) for r in rows], schemas.OBSERVATIONS
    )


def line(line_id, *points, route=1, **values):
    """A line through (x, y, m) points; z is 10 times m."""
    row = dict.fromkeys(f.name for f in schemas.STREAMS.fields)
    row.update(
        linear_feature_id=line_id,
        blue_line_key=route,
        edge_type=1000,
        wscode_ltree="100",
        localcode_ltree=f"100.{line_id}",
        watershed_group_code="GRP1",
        downstream_route_measure=float(points[0][2]),
        upstream_route_measure=float(points[-1][2]),
        vertices=[(float(x), float(y), 10.0 * m, float(m)) for x, y, m in points],
    )
    row.update(values)
    return row


def streams(spark, *rows):
    return spark.createDataFrame(
        [tuple(r[f.name] for f in schemas.STREAMS.fields) for r in rows], schemas.STREAMS
    )


def sources(spark, observed, lines, dictionary=(), wb_xref=(), waterbodies=(), stream_xref=()):
    pad = [(i, None, None, None, None, ident, None, None, None) for i, ident in dictionary]
    return Sources(
        observations=observations(spark, *observed),
        streams=streams(spark, *lines),
        waterbody_dictionary=spark.createDataFrame(pad, schemas.WATERBODY_DICTIONARY),
        waterbody_xref=spark.createDataFrame(list(wb_xref), schemas.WATERBODY_XREF),
        waterbodies=spark.createDataFrame([(w,) for w in waterbodies], schemas.WATERBODIES),
        stream_xref=spark.createDataFrame(list(stream_xref), schemas.STREAM_XREF),
    )
