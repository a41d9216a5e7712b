"""Even sampling when the units of an asset are rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framesift.functions.sampling import position, slots_at
from framesift.operators.ordering import join_groups, sorted_segments
from framesift.workspace import stage

# Rows one task may sort as a single group.
HOT_ROWS = 1_000_000


def sample_groups(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    num_samples: int,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per group the rows at ``num_samples`` even positions of ``order``.

    Adds ``slot`` (0-based) and ``num_units`` (size of the group). Short groups
    repeat rows, so every group gives exactly ``num_samples`` rows. Ties of ``order``
    are broken by the other columns, as far as they can be ordered, from left to right.

    Groups of up to ``hot_rows`` rows are ranked by a window, one shuffle on the
    group. Larger ones are never gathered: their rows are range-sorted over many
    tasks, written once and picked by position. Group sizes are counted first,
    which reads the group column alone.
    """
    rest_of = [f.name for f in df.schema if f.name not in (group, *order) and _orderable(f.dataType)]
    order = [*order, *rest_of]
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("num_units"))
    hot = stage(sizes.where(F.col("num_units") > hot_rows), "hot-groups")
    if hot.isEmpty():
        return _sample_by_window(df, group, order, num_samples)
    rest = join_groups(df, hot, [group], "left_anti")
    cold = _sample_by_window(rest, group, order, num_samples)
    hot_rows_only = join_groups(df, hot.select(group), [group], "left_semi")
    large = _sample_by_range(hot_rows_only, hot, group, order, num_samples)
    return cold.unionByName(large)


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def _sample_by_window(df, group, order, num_samples):
    per_group = Window.partitionBy(group)
    ranked = df.withColumns(
        {
            "_rank": F.row_number().over(per_group.orderBy(*order)) - 1,
            "num_units": F.count(F.lit(1)).over(per_group),
        }
    )
    slots = slots_at(F.col("_rank"), F.col("num_units"), num_samples)
    return ranked.select(*df.columns, "num_units", F.explode(slots).alias("slot"))


def _sample_by_range(df, hot, group, order, num_samples):
    size = hot.agg(F.sum("num_units")).first()[0]
    rows, segments = sorted_segments(df, order, [group], size)
    sized = join_groups(segments, hot, [group])
    slots = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), position("num_units", i, num_samples).alias("at"))
            for i in range(num_samples)
        ]
    )
    offset = F.col("target.at") - F.col("_before")
    targets = (
        sized.withColumn("target", F.explode(slots))
        .where((offset >= 0) & (offset < F.col("_rows")))
        .select((F.col("_first") + offset).alias("_row"), "num_units", "target.slot")
    )
    # Staged, the targets are a small table of known size: Spark broadcasts them instead of
    # shuffling the rows of the hot groups once more.
    return rows.join(stage(targets, "targets"), "_row").drop("_row")
