"""Even sampling of positions and items, as Column builders.

Arrays are built by ``transform`` over the slots. Spelling the slots out would keep
16 of them inside whole-stage code and halve the time of the bare positions, but
with 32 the generated method passes the size the JVM still compiles and the query
runs a hundred times slower.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framesift.functions.columns import as_column


def _check_samples(num_samples: int) -> None:
    if num_samples <= 0:
        raise ValueError(f"num_samples must be > 0, got {num_samples}")


def position(total, slot, num_samples: int) -> Column:
    """Position of one slot: ``slot * total / num_samples`` rounded half to even,
    at most ``total - 1``. No check of ``total``; exact below 2**53."""
    size = as_column(total).cast("double")
    exact = size * as_column(slot).cast("double") / F.lit(float(num_samples))
    return F.least(F.rint(exact), size - 1.0).cast("bigint")


def _positions(total: Column, num_samples: int) -> Column:
    slots = F.array(*[F.lit(float(i)) for i in range(num_samples)])
    return F.transform(slots, lambda slot: position(total, slot, num_samples))


def even_positions(total, num_samples: int) -> Column:
    """Array of ``num_samples`` ascending positions in ``[0, total)``.

    Positions repeat when ``total < num_samples``. A total that is not positive
    fails the query; a null total gives null.
    """
    _check_samples(num_samples)
    total = as_column(total)
    message = F.concat(F.lit("total must be > 0, got "), total.cast("string"))
    return F.when(total > 0, _positions(total, num_samples)).when(
        total.isNotNull(), F.raise_error(message)
    )


def pad_array(items, length: int) -> Column:
    """Repeat the last item until the array has ``length`` items; longer arrays
    stay whole. An empty array fails the query."""
    items = as_column(items)
    size = F.size(items)
    padded = F.concat(items, F.array_repeat(F.element_at(items, -1), F.lit(length) - size))
    return (
        F.when(size >= length, items)
        .when(size > 0, padded)
        .when(items.isNotNull(), F.raise_error(F.lit("cannot pad an empty array")))
    )


def pick_even(items, num_samples: int, declared=None) -> Column:
    """Items at the even positions of ``declared`` units.

    ``items`` may hold fewer units than ``declared`` (a truncated asset):
    positions past the end are skipped and the last item kept fills up. Null
    when there is nothing to pick.
    """
    _check_samples(num_samples)
    items = as_column(items)
    size = F.size(items)
    if declared is None:
        declared = size
        kept = _positions(size, num_samples)
    else:
        declared = as_column(declared)
        kept = F.filter(_positions(declared, num_samples), lambda at: at < size)
        kept = pad_array(kept, num_samples)
    picked = F.transform(kept, lambda at: F.get(items, at.cast("int")))
    return F.when((size > 0) & (declared > 0), picked)


def slots_at(rank, total, num_samples: int) -> Column:
    """Array of the slots whose position is ``rank``: empty for most rows, more
    than one where a short group repeats a row.

    From ``num_samples`` rows on, positions lie at least one apart and only the slot
    nearest to the rank can have it; shorter groups try all slots.
    """
    _check_samples(num_samples)
    rank, total = as_column(rank), as_column(total)
    nearest = F.rint(rank.cast("double") * float(num_samples) / total.cast("double")).cast("int")
    hit = (nearest < num_samples) & (position(total, nearest, num_samples) == rank)
    every = F.array(*[F.lit(i) for i in range(num_samples)])
    return (
        F.when(total < num_samples, F.filter(every, lambda i: position(total, i, num_samples) == rank))
        .when(hit, F.array(nearest))
        .otherwise(F.array().cast("array<int>"))
    )


def position_gaps(positions) -> Column:
    """Array of the differences between neighbouring positions."""
    positions = as_column(positions)
    pairs = F.size(positions) - 1
    return F.zip_with(
        F.slice(positions, F.lit(2), pairs), F.slice(positions, F.lit(1), pairs), lambda b, a: b - a
    )
