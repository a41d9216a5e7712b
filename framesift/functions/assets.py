"""Scalar expressions on assets: ids, labels, probes and caption text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framesift.functions.columns import as_column

# The characters Python's str.strip removes.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def file_name(path) -> Column:
    return F.substring_index(as_column(path), "/", -1)


def asset_id(path) -> Column:
    """File name without what follows its last dot. Not unique: folders are lost."""
    name = file_name(path)
    suffix = F.substring_index(name, ".", -1)
    stem = F.left(name, F.length(name) - F.length(suffix) - 1)
    return F.when(F.contains(name, F.lit(".")), stem).otherwise(name)


def class_label(path) -> Column:
    """Name of the folder that holds the asset; null for a bare file name."""
    path = as_column(path)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(F.contains(path, F.lit("/")), folder)


def has_suffix(path, suffix: str) -> Column:
    """Case-insensitive suffix test."""
    return F.endswith(F.lower(as_column(path)), F.lit(suffix.lower()))


def strip_text(text) -> Column:
    """Remove Unicode whitespace from both ends, as Python's ``str.strip``."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def unit_count(declared, counted) -> Column:
    """The declared number of units if positive, else the counted one."""
    declared = as_column(declared)
    return F.when(declared > 0, declared).otherwise(as_column(counted)).cast("bigint")


def duration_seconds(ticks, numerator, denominator) -> Column:
    """Ticks times the time base; 0.0 when the ticks are unknown."""
    seconds = as_column(ticks) * as_column(numerator) / as_column(denominator)
    return F.coalesce(seconds.cast("double"), F.lit(0.0))


def safe_rate(rows, elapsed) -> Column:
    """Rows per second when both are positive, else null."""
    rows, elapsed = as_column(rows), as_column(elapsed)
    return F.when((rows > 0) & (elapsed > 0), rows.cast("double") / elapsed)


def format_cell(value, digits: int | None = None) -> Column:
    """Table cell: the value, with ``digits`` decimals if asked; a dash for null."""
    value = as_column(value)
    text = F.format_string(f"%.{digits}f", value) if digits is not None else value.cast("string")
    return F.when(value.isNotNull(), text).otherwise(F.lit("—"))
