"""Scalar expressions shared by the operators.  Each takes and returns columns and stays inside whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """A double in which NaN is null: missing values have one form after ingest."""
    return F.nanvl(col(c).try_cast("double"), F.lit(None).cast("double"))


def finite(c: str | Column) -> Column:
    """Neither null, NaN nor infinite."""
    c = col(c)
    return F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False))


def finite_value(c: str | Column) -> Column:
    return F.when(finite(c), col(c))


def micros(start: str | Column, end: str | Column) -> Column:
    """Whole microseconds between two timestamps; works without a time zone."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end))


def seconds(start: str | Column, end: str | Column) -> Column:
    return micros(start, end) / F.lit(1e6)


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """top / bottom where bottom is positive, else null."""
    return F.when(col(bottom) > 0, col(top) / col(bottom))


def leaf(path: str | Column, sep: str = "/") -> Column:
    return F.substring_index(col(path), sep, -1)


def parts(path: str | Column, sep: str = "/") -> Column:
    """The path's parts that are not empty."""
    return F.filter(F.split(col(path), sep), lambda x: x != "")


def slug(c: str | Column) -> Column:
    return F.replace(F.lower(F.trim(col(c))), F.lit(" "), F.lit("_"))


def matches(c: str | Column, pattern: str | None) -> Column:
    """Case-insensitive regular-expression containment; null never matches, an empty pattern always does."""
    return F.coalesce(col(c), F.lit("")).rlike("(?i)" + pattern) & col(c).isNotNull() if pattern else F.lit(True)


def contains_folded(c: str | Column, text: str) -> Column:
    """Case-insensitive literal containment."""
    return F.coalesce(F.contains(F.lower(col(c)), F.lit(text.lower())), F.lit(False))


def uuid_text(c: str | Column) -> Column:
    """A UUID as lower-case text: a binary column of 16 bytes as digits with dashes, text as it is, whatever its length."""
    c = col(c)
    dashed = F.regexp_replace(F.lower(F.hex(c.cast("binary"))), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    raw = (F.typeof(c) == "binary") & (F.octet_length(c.cast("binary")) == 16)
    return F.when(raw, dashed).otherwise(F.lower(c.cast("string")))


def pad_edge(values: str | Column, length: int) -> Column:
    """The array cut or extended by its last value to the length; empty stays empty."""
    v = col(values)
    return F.when(F.size(v) == 0, v).otherwise(F.slice(F.concat(v, F.array_repeat(F.element_at(v, -1), F.greatest(F.lit(length) - F.size(v), F.lit(0)))), 1, length))


def mask(n: str | Column, length: int) -> Column:
    """min(n, length) ones, then zeros."""
    return F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: (i <= col(n)).cast("tinyint"))


def file_name(number_: str | Column, stem: str = "batch", digits: int = 6) -> Column:
    return F.format_string(f"{stem}_%0{digits}d", col(number_))
