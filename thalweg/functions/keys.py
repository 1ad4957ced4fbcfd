"""Stable hashed keys and integer event ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns behind the key, in hashing order, and the id layout.
KEY_COLUMNS = (
    "source",
    "species_code",
    "observation_date",
    "utm_zone",
    "utm_easting",
    "utm_northing",
    "life_stage_code",
    "activity_code",
)
KEY_SEPARATOR = "|"
KEY_LENGTH = 10
EVENT_ROUTE_OFFSET = 354087611
EVENT_ROUTE_STRIDE = 10000000


def hashed_key(*cols: str | Column, length: int = KEY_LENGTH) -> Column:
    """First `length` hex digits of the SHA-1 over the non-null columns' text.

    NULLs are skipped (not written as an empty piece), so rows that differ
    only in *which* of two neighbouring columns is NULL share a key. Don't pass
    doubles: their text form is engine specific.
    """
    text = F.concat_ws(KEY_SEPARATOR, *[_col(c).cast("string") for c in cols])
    return F.substring(F.sha1(text), 1, length)


def event_id(route_key: str | Column, measure: str | Column) -> Column:
    """Integer id of a (route, measure) event; the measure rounds half to even."""
    route = _col(route_key).cast("long") + F.lit(1) - F.lit(EVENT_ROUTE_OFFSET)
    return route * F.lit(EVENT_ROUTE_STRIDE) + F.rint(_col(measure)).cast("long")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
