"""Plans of the operators: what is read, what is shuffled, what is evaluated twice."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from framesift.operators import ordering
from framesift.operators.groups import sample_groups
from framesift.sources.fetch import fetch_from_store

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def exchanges(plan):
    return len(re.findall(r"Exchange (?:hash|range|RoundRobin|Single)", plan))


def read_columns(plan):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan)]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("caption_documents", {"doc_id", "text", "n_chars"}),
        ("caption_request", {"doc_id", "text", "n_chars"}),
        ("even_positions", {"doc_id", "n_chars"}),
        ("sample_word_rows", {"doc_id", "text"}),
        ("pick_even_items", {"vec_id", "embedding"}),
        ("asset_id", {"page_id", "url"}),
        ("manifest_from_listing", {"url"}),
        ("drop_failed", {"event_id", "event_type", "props"}),
        ("decode_text_assets", {"doc_id", "text", "lang", "source"}),
    ],
)
def test_narrow_stages(spark, name, columns):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert exchanges(plan) == 0
    assert read_columns(plan) == [columns]


@pytest.mark.parametrize(
    "name, shuffles",
    [("sample_turns", 1), ("sample_events", 1), ("frame_count_fallback", 1),
     ("backend_agreement", 2), ("sweep_best", 1), ("caption_variety", 2)],
)
def test_shuffles(spark, name, shuffles):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert exchanges(plan) == shuffles
    assert "Join" not in plan


@pytest.mark.parametrize("name", ["backend_agreement", "caption_variety", "frame_count_fallback"])
def test_aggregates_hash(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_words_are_sampled_once(spark):
    plan = plan_of(entry.sample_word_rows(spark, SF_DIR))
    assert len(re.findall(r"split\(", plan)) == 1


def test_counting_reads_the_group_column_alone(spark):
    events = entry.table(spark, SF_DIR, "events")
    plan = plan_of(events.groupBy("user_id").agg(F.count(F.lit(1))))
    assert read_columns(plan) == [{"user_id"}]


def test_store_content_is_shuffled_once(spark):
    pages = entry.table(spark, SF_DIR, "pages")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fetched = fetch_from_store(entry.page_manifest(spark, SF_DIR), pages, "url", "html")
        plan = plan_of(fetched)
        fetched.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The manifest for the semi join, the content, the manifest for the left join.
    assert plan.count("SortMergeJoin") == 2 and exchanges(plan) == 3


def test_hot_rows_are_looked_up_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_TASK", 100)
    events = entry.table(spark, SF_DIR, "events").select("user_id", "ts", "event_id", "value")
    plan = plan_of(sample_groups(events, "user_id", ["ts", "event_id"], 4, hot_rows=0))
    # The one shuffle is that of the other groups; hot rows are picked by position.
    assert exchanges(plan) == 1 and "SortMergeJoin" not in plan


def test_first_rows_by_range_are_not_shuffled_again(spark, monkeypatch):
    monkeypatch.setattr(ordering, "TOP_N_ROWS", 0)
    pages = entry.table(spark, SF_DIR, "pages").select("url")
    plan = plan_of(ordering.first_n(pages, ["url"], 20))
    assert exchanges(plan) == 0 and "Join" not in plan and "LessThan(_row" in plan
