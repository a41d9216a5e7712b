"""Rows of sampled units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unit_rows(assets: DataFrame, units: str = "frames", name: str = "unit") -> DataFrame:
    """One row per sampled unit, with its 0-based ``slot``; none for an asset without
    units.

    The outer form keeps Spark from inferring a filter on the array's size, which it
    would push to the scan and there sample every asset a second time.
    """
    kept = [c for c in assets.columns if c != units]
    rows = assets.select(*kept, F.posexplode_outer(units).alias("slot", name))
    return rows.where(F.col("slot").isNotNull())
