"""Arithmetic on route measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_measure(measure: str | Column, downstream: str | Column, upstream: str | Column) -> Column:
    """Whole-metre measure held to a segment's range.

    The measure is limited from above, floored, limited from below and ceiled,
    in that order. Limits that are NULL don't apply. On a segment without a
    whole metre inside it the result can exceed `upstream`.
    """
    m, lo, hi = (F.col(c) if isinstance(c, str) else c for c in (measure, downstream, upstream))
    limited = F.floor(F.least(hi, m)).cast("double")
    return F.ceil(F.greatest(lo, limited)).cast("double")
