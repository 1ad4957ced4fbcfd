"""Hierarchical path codes (`a.b.c`) and the text rules of the code lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_descendant_or_self(code: str | Column, ancestor: str | Column) -> Column:
    """True when `code` is `ancestor` (a text, or a column) or lies below it; NULL if either is NULL.

    Labels are whole: `9991` isn't below `999`.
    """
    c, above = _col(code), F.lit(ancestor) if isinstance(ancestor, str) else ancestor
    return (c == above) | c.startswith(F.concat(above, F.lit(".")))


def path_prefixes(code: str | Column) -> Column:
    """The codes above `code`, from the first label on, and `code` itself; NULL for NULL."""
    labels = path_order(code)
    each = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, F.lit(1), n), "."))
    return F.when(labels.isNotNull(), each)


def path_label_after(code: str | Column, ancestor: Column) -> Column:
    """The label of `code` that follows `ancestor`; NULL where `code` doesn't lie below it."""
    c = _col(code)
    rest = F.substr(c, F.length(ancestor) + 2)
    return F.when(c.startswith(F.concat(ancestor, F.lit("."))), F.substring_index(rest, ".", 1))


def path_order(code: str | Column) -> Column:
    """Sort key that compares path codes label by label."""
    return F.split(_col(code), r"\.")


def strip_leading_zeros(text: str | Column) -> Column:
    return F.ltrim(_col(text), F.lit("0"))


def strip_dashes(text: str | Column) -> Column:
    return F.replace(_col(text), F.lit("-"), F.lit(""))


def joined_code(number: str | Column, suffix: str | Column) -> Column:
    """`number` as text followed by `suffix`; NULL if either is NULL."""
    return F.concat(_col(number).cast("string"), _col(suffix))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
