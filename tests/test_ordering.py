"""Group sampling and first-n: the paths for hot groups give what the plain ones give."""

import pytest
from pyspark.sql import functions as F

from framesift.operators import ordering
from framesift.operators.groups import sample_groups


@pytest.fixture(autouse=True)
def small_tasks(monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_TASK", 300)


@pytest.fixture()
def skewed(spark):
    """One group, and the null group, hold a third of all rows each."""
    rows = spark.range(3000, numPartitions=6)
    group = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 2, F.col("id") % 40 + 1)
    return rows.select(
        group.alias("g"), F.xxhash64("id").alias("o"), F.col("id").alias("t"), "id"
    )


def brute_force(rows, samples):
    groups = {}
    for row in rows:
        groups.setdefault(row.g, []).append(row)
    for group, members in groups.items():
        members.sort(key=lambda r: (r.o, r.t))
        n = len(members)
        for slot in range(samples):
            at = min(round(slot * n / samples), n - 1)
            yield (group, members[at].id, slot, n)


@pytest.mark.parametrize("hot_rows", [0, 30, 500, 10_000])
def test_hot_groups_are_sampled_exactly(spark, skewed, hot_rows):
    found = sample_groups(skewed, "g", ["o", "t"], 16, hot_rows=hot_rows)
    assert found.columns == ["g", "o", "t", "id", "num_units", "slot"]
    got = sorted(map(repr, ((r.g, r.id, r.slot, r.num_units) for r in found.collect())))
    assert got == sorted(map(repr, brute_force(skewed.collect(), 16)))


def test_ties_still_fill_every_slot(spark):
    rows = spark.range(200).select(F.lit(1).alias("g"), (F.col("id") % 2).alias("o"), "id")
    found = sample_groups(rows, "g", ["o"], 16, hot_rows=10)
    assert sorted(r.slot for r in found.collect()) == list(range(16))


def test_ties_give_the_same_rows_by_both_methods(spark):
    rows = spark.range(64, numPartitions=5).selectExpr(
        "IF(id % 4 = 0, NULL, 1) AS g", "id DIV 4 AS o", "IF(id % 3 = 0, NULL, id) AS a", "id", "map(id, 1) AS m"
    )
    plain, ranged = (
        sorted(map(repr, sample_groups(rows, "g", ["o"], 16, hot_rows=hot).drop("m").collect())) for hot in (1000, 10)
    )
    assert ranged == plain and len(plain) == 32
    assert len({r.id for r in sample_groups(rows, "g", ["o"], 16, hot_rows=10).collect()}) == 32


def test_hot_rows_never_meet_in_one_window(spark, skewed):
    plan = sample_groups(skewed, "g", ["o", "t"], 4, hot_rows=0)._jdf.queryExecution().toString()
    assert "row_number" in plan  # the branch of the other groups
    rows, segments = ordering.sorted_segments(skewed.select("g", "o", "t"), ["o", "t"], ["g"])
    sizes = [r._rows for r in segments.where("g = 0").collect()]
    assert len(sizes) > 1 and sum(sizes) == 1000


@pytest.mark.parametrize("n", [0, 1, 777, 5000])
def test_first_n_by_range(spark, skewed, n, monkeypatch):
    top = [r.t for r in ordering.first_n(skewed, ["o", "t"], n).collect()]
    monkeypatch.setattr(ordering, "TOP_N_ROWS", -1)
    ranged = ordering.first_n(skewed, ["o", "t"], n)
    assert ranged.columns == skewed.columns
    assert sorted(top) == sorted(r.t for r in ranged.collect())


def test_first_n_of_nothing_by_range(spark, monkeypatch):
    monkeypatch.setattr(ordering, "TOP_N_ROWS", -1)
    assert ordering.first_n(spark.range(0), ["id"], 5).count() == 0


def test_first_n_refuses_negative(spark):
    with pytest.raises(ValueError):
        ordering.first_n(spark.range(3), ["id"], -1)


def test_running_total(spark):
    rows = spark.range(500, numPartitions=5).select("id", (F.col("id") % 7).alias("v"))
    found = {r.id: r.s for r in ordering.running_total(rows, ["id"], "v", "s").collect()}
    assert found == {i: sum(j % 7 for j in range(i + 1)) for i in range(500)}
