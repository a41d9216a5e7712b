"""Argument handling shared by the column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    """A name becomes the column, a Column stays, any other value is a literal."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)
