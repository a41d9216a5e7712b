"""Exact positions in a total order, without one task seeing the whole order."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framesift.workspace import stage

# Rows of one range partition.
ROWS_PER_TASK = 1_000_000

# Rows up to which a first-n sends that many candidates of every task to one task.
TOP_N_ROWS = 1_000


def join_groups(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on ``keys`` in which null keys match; gives ``left``'s columns, then
    the others of ``right``."""
    others = [c for c in right.columns if c not in keys]
    named = right.select(*[F.col(c).alias(f"_of_{c}") for c in keys], *others)
    match = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys])
    return left.join(named, match, how).drop(*[f"_of_{c}" for c in keys])


def sorted_segments(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), size: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Range-sort ``df`` by ``by`` and ``order`` into staged rows and segments.

    The rows carry ``_row``, ascending in the sort order. A segment is the part
    of one ``by`` group that lies in one range partition: ``_first`` is its
    smallest ``_row``, ``_rows`` its size and ``_before`` the number of rows of
    the group in earlier segments. A group of any size is spread over as many
    range partitions as it needs; per group only its segments meet in one task.
    The number of partitions follows from ``size``, the rows of ``df``, which are
    counted when it is not given.

    The order must be unique within a group. Range bounds are sampled anew each
    time a plan runs, so the sorted rows are written once and both results read
    that table.
    """
    keys = [F.col(c) for c in (*by, *order)]
    tasks = max(1, math.ceil((df.count() if size is None else size) / ROWS_PER_TASK))
    ranged = df.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    rows = stage(ranged.withColumn("_row", F.monotonically_increasing_id()), "sorted")
    sizes = rows.groupBy(*by, F.shiftright("_row", 33).alias("_part")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first")
    )
    earlier = (
        Window.partitionBy(*by)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.sum("_rows").over(earlier) - F.col("_rows")
    return rows, sizes.withColumn("_before", before)


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` up to and including each row in ``order``, which
    must be unique. No task sees more than one range partition."""
    rows, _ = sorted_segments(df, order)
    rows = rows.withColumn("_part", F.shiftright("_row", 33))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = sums.select("_part", (F.sum("_sum").over(upto) - F.col("_sum")).alias("_before"))
    within = (
        Window.partitionBy("_part")
        .orderBy("_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = (F.sum(value).over(within) + F.col("_before")).alias(name)
    return rows.join(before, "_part").select(*df.columns, total)


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``, which must be unique; 0 gives no rows.

    Up to ``TOP_N_ROWS`` this is Spark's top-n. Beyond that the candidates of all
    tasks are too many for one, so rows are kept by their position in a range sort.
    """
    if n < 0:
        raise ValueError(f"n must be >= 0, got {n}")
    if n <= TOP_N_ROWS:
        return df.orderBy(*order).limit(n)
    rows, segments = sorted_segments(df, order)
    taken = F.least(F.col("_rows"), F.lit(n) - F.col("_before"))
    end = segments.where(F.col("_before") < n).agg(F.max(F.col("_first") + taken)).first()[0]
    # Ascending in the sort order, ``_row`` cuts the table at one value, which Parquet
    # statistics turn into files that are not opened. No rows at all have no end.
    return rows.where(F.col("_row") < (end or 0)).select(*df.columns)
