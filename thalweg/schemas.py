"""Column lists and schemas of the tables that the job reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, type_: T.DataType, comment: str, max_length: int | None = None) -> T.StructField:
    meta: dict[str, object] = {"comment": comment}
    if max_length is not None:
        meta["max_length"] = max_length
    return T.StructField(name, type_, True, meta)


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

OBSERVATION_FIELDS = [
    _field("fish_observation_point_id", _L, "id in the source, may change between downloads"),
    _field("wbody_id", _L, "id in the waterbody dictionary"),
    _field("species_code", _S, "species", 6),
    _field("agency_id", _L, "observing agency"),
    _field("point_type_code", _S, "single observation or summary", 20),
    _field("observation_date", T.DateType(), "day of the observation"),
    _field("agency_name", _S, "name of the observing agency", 60),
    _field("source", _S, "data set the row comes from", 1000),
    _field("source_ref", _S, "bibliographic reference of the source", 4000),
    _field("utm_zone", _I, "UTM zone of the reported position"),
    _field("utm_easting", _I, "UTM easting of the reported position"),
    _field("utm_northing", _I, "UTM northing of the reported position"),
    _field("activity_code", _S, "activity, short form", 100),
    _field("activity", _S, "activity", 300),
    _field("life_stage_code", _S, "life stage, short form", 100),
    _field("life_stage", _S, "life stage", 300),
    _field("species_name", _S, "common name of the species", 60),
    _field("waterbody_identifier", _S, "sequence number and group of the waterbody", 9),
    _field("waterbody_type", _S, "kind of water, such as Stream or Lake", 20),
    _field("gazetted_name", _S, "name of the waterbody", 30),
    _field("new_watershed_code", _S, "watershed code with dashes", 56),
    _field("trimmed_watershed_code", _S, "watershed code without trailing zeros", 56),
    _field("acat_report_url", _S, "link to a report", 254),
    _field("feature_code", _S, "feature class", 10),
]

POINT = T.StructType([T.StructField(c, _D) for c in "xy"])
POINT_Z = T.StructType([T.StructField(c, _D) for c in "xyz"])
VERTEX = T.StructType([T.StructField(c, _D) for c in "xyzm"])

OBSERVATIONS = T.StructType([*OBSERVATION_FIELDS, _field("x", _D, "easting"), _field("y", _D, "northing")])
MULTIPART_OBSERVATIONS = T.StructType(
    [*OBSERVATION_FIELDS, _field("points", T.ArrayType(POINT), "positions")]
)

STREAMS = T.StructType(
    [
        _field("linear_feature_id", _L, "line"),
        _field("blue_line_key", _L, "route the line belongs to"),
        _field("edge_type", _I, "kind of line"),
        _field("wscode_ltree", _S, "path code of the stream"),
        _field("localcode_ltree", _S, "path code of the position on the stream"),
        _field("waterbody_key", _L, "waterbody the line runs through"),
        _field("watershed_group_code", _S, "watershed group", 4),
        _field("downstream_route_measure", _D, "measure at the lower end"),
        _field("upstream_route_measure", _D, "measure at the upper end"),
        _field("gnis_name", _S, "name of the stream"),
        _field("gradient", _D, "slope"),
        _field("stream_order", _I, "order"),
        _field("vertices", T.ArrayType(VERTEX), "measured line"),
    ]
)

WATERBODY_DICTIONARY = T.StructType(
    [
        _field("id", _I, "waterbody id used by observations"),
        _field("type", _S, "kind of waterbody"),
        _field("extinct_indicator", _S, "no longer in use"),
        _field("watershed_id", _I, "watershed"),
        _field("sequence_number", _S, "number within the group"),
        _field("waterbody_identifier", _S, "zero-padded number and group"),
        _field("gazetted_name", _S, "name"),
        _field("waterbody_mouth_identifier", _S, "waterbody at the mouth"),
        _field("formatted_name", _S, "name for display"),
    ]
)

SPECIES = T.StructType(
    [
        _field("species_id", _I, "species"),
        _field("code", _S, "species code used by observations"),
        _field("name", _S, "common name"),
        _field("cdcgr_code", _S, "global rank"),
        _field("cdclr_code", _S, "local rank"),
        _field("scientific_name", _S, "scientific name"),
        _field("spctype_code", _S, "type"),
        _field("spcgrp_code", _S, "group"),
    ]
)

WATERBODY_XREF = T.StructType(
    [
        _field("waterbody_key_50k", _I, "waterbody number, coarse scale"),
        _field("watershed_group_code_50k", _S, "group, coarse scale"),
        _field("waterbody_key_20k", _I, "waterbody, fine scale"),
    ]
)

WATERBODIES = T.StructType([_field("waterbody_key", _I, "waterbody")])

STREAM_XREF = T.StructType(
    [
        _field("watershed_code_50k", _S, "watershed code without dashes, coarse scale"),
        _field("linear_feature_id_20k", _L, "line, fine scale"),
    ]
)

OUTPUT_FIELDS = [
    _field("observation_key", _S, "stable hash of the identifying columns"),
    *OBSERVATION_FIELDS,
    _field("linear_feature_id", _L, "matched line"),
    _field("wscode", _S, "path code of the stream"),
    _field("localcode", _S, "path code of the position on the stream"),
    _field("blue_line_key", _L, "matched route"),
    _field("watershed_group_code", _S, "watershed group", 4),
    _field("downstream_route_measure", _D, "whole-metre measure on the route"),
    _field("match_type", _S, "rule that made the match"),
    _field("distance_to_stream", _D, "metres from the observation to the line"),
    _field("geom", POINT_Z, "position on the route"),
]
OUTPUT = T.StructType(OUTPUT_FIELDS)

OBSERVATION_COLUMNS = [f.name for f in OBSERVATION_FIELDS]
OUTPUT_COLUMNS = [f.name for f in OUTPUT_FIELDS]


def length_limits(schema: T.StructType) -> dict[str, int]:
    """Columns with a maximum text length."""
    return {f.name: f.metadata["max_length"] for f in schema.fields if "max_length" in f.metadata}
