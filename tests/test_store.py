"""Laid-out stores: one look-up for all shards, content that isn't shuffled."""

import os
import re

import pytest
from pyspark.sql import functions as F

from framesift.config import RunConfig
from framesift.plans import captioning
from framesift.sources import manifest as M
from framesift.sources import store as S
from framesift.sources.results import read_captions
from framesift.workspace import stage

CONFIG = RunConfig(on_fetch_error="quarantine")


@pytest.fixture()
def pages(spark):
    rows = [(f"/p/{i}.txt", " ".join(f"w{j}" for j in range(i + 1))) for i in range(40)] + [(None, "no key")]
    return spark.createDataFrame(rows, "url string, html string")


@pytest.fixture()
def listed(spark):
    uris = [f"/p/{i}.txt" for i in range(0, 40, 2)] + ["/p/4.txt"] * 70 + ["/p/6.txt"] * 3 + ["/lost.txt", "/lost.txt", None]
    return spark.createDataFrame([(u,) for u in uris], "video_uri string")


def counted(listed, parts):
    return stage(M.count_copies(listed).withColumn("part", S.part_of(M.URI, parts)), "counted")


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("hot_copies", [2, 32, 100])
def test_look_up_equals_the_join(spark, folder, pages, listed, hot_copies):
    from framesift.sources.fetch import fetch_from_store

    store = S.write_store(pages, "url", "html", folder + "/store", 3, 2)
    found = S.fetch_from_parts(counted(listed, 3), store, range(3), "quarantine", hot_copies)
    assert rows_of(found) == rows_of(fetch_from_store(listed, pages, "url", "html", "quarantine"))
    with pytest.raises(Exception, match="not in the store"):
        S.fetch_from_parts(counted(listed, 3), store, range(3)).collect()


def test_content_is_not_shuffled_and_parts_are_read_once(spark, folder, pages, listed):
    store = S.write_store(pages, "url", "html", folder + "/store", 5, 2)
    wanted, files = counted(listed, 5), []
    for shard in range(2):
        mine = wanted.where(F.col("part") % 2 == shard)
        found = S.fetch_from_parts(mine, store, range(shard, 5, 2), "quarantine", hot=False)
        plan = plan_of(found)
        # the one shuffle is that of the URIs
        assert len(re.findall("Exchange", plan)) == 1 and "Sort" not in plan and plan.count("FileScan") == 2
        assert "Bucketed: true" in plan and re.search(r"PartitionFilters: \[[^\]]*part#", plan)
        files += [f for f in found.inputFiles() if "/content/" in f]
    every = S.table(spark, store).inputFiles()
    assert sorted(files) == sorted(every)


def test_another_session_opens_the_store(spark, folder, pages):
    store = S.write_store(pages, "url", "html", folder + "/store", 3, 2)
    spark.sql(f"DROP TABLE {store.name}")
    again = S.open_store(spark, folder + "/store")
    assert again == store and S.table(spark, again).count() == 40
    assert S.write_store(pages.limit(0), "url", "html", folder + "/store", 9, 9) == store  # kept
    S.drop_store(spark, store)
    assert not os.path.exists(folder + "/store")


def test_only_wanted_rows_are_laid_out(spark, folder, pages, listed, monkeypatch):
    for most, name in ((100_000, "/a"), (0, "/b")):
        monkeypatch.setattr(S, "BROADCAST_URIS", most)
        store = S.write_store(pages, "url", "html", folder + name, 2, 2, listed)
        assert S.table(spark, store).count() == 20


@pytest.mark.parametrize("placement", ["fused", "staged"])
def test_runs_from_every_kind_of_store_agree(spark, folder, pages, listed, placement):
    config = RunConfig(on_fetch_error="quarantine", placement=placement)
    laid_out = S.write_store(pages, "url", "html", folder + "/store", 4, 2)
    tables = {
        "one": ((pages, "url", "html"), 1), "many": ((pages, "url", "html"), 3),
        "laid": (laid_out, 1), "parts": (laid_out, 3),
    }
    results = {}
    for name, (store, shards) in tables.items():
        stats = captioning.run(spark, listed, f"{folder}/{name}", config, store=store, shards=shards)
        assert (stats["rows"], stats["rejected"]) == (93, 3)
        assert not os.path.exists(stats["ledger"] + "/content") and not os.path.exists(stats["ledger"] + "/samples")
        bad = spark.read.parquet(f"{folder}/{name}_rejected")
        results[name] = rows_of(read_captions(spark, f"{folder}/{name}")), rows_of(bad)
    assert results["one"] == results["many"] == results["laid"] == results["parts"]
    assert S.table(spark, laid_out).count() == 40


def test_a_run_scans_a_table_once_for_all_shards(spark, folder, pages, listed):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    watched = pages.mapInArrow(count, pages.schema)
    captioning.run(spark, listed, folder + "/out", CONFIG, store=(watched, "url", "html"), shards=6)
    assert reads.value == 41


def test_empty_manifest(spark, folder, pages, listed):
    stats = captioning.run(spark, listed.limit(0), folder + "/out", CONFIG, store=(pages, "url", "html"), shards=3)
    assert (stats["rows"], read_captions(spark, folder + "/out").count()) == (0, 0)
