"""Even positions, padding and picking against plain Python statements of the rules."""

import pytest
from pyspark.sql import functions as F

from framesift.functions import sampling as S


def positions(total, samples):
    return [min(round(i * total / samples), total - 1) for i in range(samples)]


def picked(items, declared, samples):
    kept = [items[p] for p in positions(declared, samples) if p < len(items)]
    return kept + kept[-1:] * (samples - len(kept)) if kept else None


def one(spark, column, **values):
    row = spark.range(1)
    for name, value in values.items():
        row = row.withColumn(name, value)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("samples", [1, 2, 3, 7, 8, 16, 32])
def test_positions_grid(spark, samples):
    totals = spark.range(1, 700).union(spark.sql("SELECT explode(array(1600L, 1800L, 9999L, 123457L))"))
    rows = totals.select("id", S.even_positions("id", samples).alias("p")).collect()
    assert all(row.p == positions(row.id, samples) for row in rows)


@pytest.mark.parametrize("total", [16, 100, 1000])
def test_positions_cover_the_range(spark, total):
    found = one(spark, S.even_positions(F.lit(total), 16))
    assert len(found) == 16 and found[0] == 0 and max(found) <= total - 1
    assert found == sorted(found)


def test_short_total_repeats_positions(spark):
    found = one(spark, S.even_positions(F.lit(5), 16))
    assert len(found) == 16 and max(found) == 4
    assert len(set(one(spark, S.even_positions(F.lit(16), 16)))) == 16


def test_large_total(spark):
    total = 3 * 10**12 + 7
    assert one(spark, S.even_positions(F.lit(total), 16)) == positions(total, 16)


@pytest.mark.parametrize("total", [0, -3])
def test_total_must_be_positive(spark, total):
    with pytest.raises(Exception, match="total must be > 0"):
        one(spark, S.even_positions(F.lit(total), 16))


def test_samples_must_be_positive():
    with pytest.raises(ValueError):
        S.even_positions(F.lit(100), 0)


def test_null_total_gives_null(spark):
    assert one(spark, S.even_positions(F.lit(None).cast("bigint"), 4)) is None


def test_gaps_are_even(spark):
    gaps = one(spark, S.position_gaps("p"), p=S.even_positions(F.lit(1600), 16))
    assert len(gaps) == 15 and all(99 <= gap <= 101 for gap in gaps)


@pytest.mark.parametrize(
    "items, length, expected",
    [([1, 2, 3], 5, [1, 2, 3, 3, 3]), ([1, 2, 3], 3, [1, 2, 3]), ([1, 2, 3], 2, [1, 2, 3]),
     ([7], 3, [7, 7, 7])],
)
def test_pad(spark, items, length, expected):
    assert one(spark, S.pad_array(F.array(*map(F.lit, items)), length)) == expected


def test_pad_of_nothing_fails(spark):
    with pytest.raises(Exception, match="empty array"):
        one(spark, S.pad_array(F.array().cast("array<int>"), 3))


def test_pick_follows_declared_count(spark):
    rows = spark.range(1, 60).select(F.col("id").alias("declared")).withColumn(
        "held", F.explode(F.sequence(F.lit(0), F.col("declared") + 2))
    )
    items = F.when(F.col("held") == 0, F.array().cast("array<bigint>")).otherwise(
        F.sequence(F.lit(100), F.col("held") + 99)
    )
    found = rows.withColumn("items", items).select(
        "declared", "held", S.pick_even("items", 16, "declared").alias("x")
    )
    for row in found.collect():
        assert row.x == picked(list(range(100, 100 + row.held)), row.declared, 16)


def test_pick_keeps_null_items(spark):
    found = one(spark, S.pick_even("a", 4), a=F.array(F.lit(None).cast("int"), F.lit(2)))
    assert found == [None, None, 2, 2]


@pytest.mark.parametrize("samples", [1, 3, 16])
def test_slots_name_every_slot_once(spark, samples):
    ranks = spark.range(1, 80).select(
        F.col("id").alias("n"), F.explode(F.sequence(F.lit(0), F.col("id") - 1)).alias("r")
    )
    hits = ranks.select("n", "r", F.explode(S.slots_at("r", "n", samples)).alias("slot")).collect()
    for total in range(1, 80):
        found = sorted((hit.slot, hit.r) for hit in hits if hit.n == total)
        assert found == list(enumerate(positions(total, samples)))
