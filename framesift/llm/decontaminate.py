"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised
benchmark items, every text scanned once, hits mapped back to the original text.

Texts are normalised to lower-case ``ALNUM`` words between single spaces. A window is
``width`` consecutive words of an item; an item with fewer, but not none, is one window.
A word of a document that lies inside an occurrence of a window is hit.

Null and empty texts have no words and no hits. Null items and items without words have
no windows; the windows of an item without an id count as hits but name no item. Repeated
rows are reported once each, in the same way. Other columns, whatever their names, are
handed through untouched; a column called like ``out`` is replaced.

The benchmark is cut into blocks of at most ``block`` different windows. A block is the
only thing that is broadcast, so an automaton has at most ``block * width`` words whatever
the size of the benchmark. A benchmark of several blocks scans the texts once for each,
with what was found so far staged in between.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.llm.text import ALNUM, TO_ALNUM, built, free_name, give_back
from framesift.workspace import ship_package, stage

WIDTH = 10
BLOCK = 20_000
HITS = (
    "struct<n_words: bigint, n_hit: bigint, runs: array<struct<first: bigint, last: bigint>>,"
    " spans: array<struct<start: bigint, end: bigint>>, items: array<string>>"
)

_PATTERN = re.compile(ALNUM)


def normalised(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_ALNUM).split()


def windows(text: str | None, width: int) -> list[str]:
    words = normalised(text)
    return [
        b" ".join(words[i : i + width]).decode("utf-8", "surrogatepass")
        for i in range(max(len(words) - width + 1, min(len(words), 1)))
    ]


def blocks(benchmark: DataFrame, width: int, block: int, item: str, text: str) -> Iterator[dict]:
    """The benchmark as maps from a window to its items, one bounded map at a time."""
    found: dict[str, set] = {}
    for name, content in benchmark.select(F.col(item).cast("string"), text).toLocalIterator():
        for window in windows(content, width):
            if window not in found and len(found) >= block:
                yield found
                found = {}
            found.setdefault(window, set()).update([] if name is None else [name])
    if found:
        yield found


def automaton_of(found: dict):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for window, items in found.items():
        automaton.add_word(f" {window} ", (window.count(" ") + 1, items))
    automaton.make_automaton()
    return automaton


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for first, last in sorted(runs):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    return [tuple(run) for run in merged]


def scan_text(automaton, text, runs=(), items=()) -> dict:
    """Hits in one text, beside those of earlier blocks."""
    words = normalised(text)
    runs, items = list(runs), set(items)
    line = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
    ends = None
    for at, (length, names) in automaton.iter(line):
        if ends is None:  # position of the space after every word
            ends = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4") == 32)[1:]
        last = int(np.searchsorted(ends, at))
        runs.append((last - length + 1, last))
        items |= names
    runs = _merge(runs)
    spans = []
    if runs:
        places = [found.span() for found in _PATTERN.finditer(text.translate(_LOWER))]
        spans = [{"start": places[a][0], "end": places[b][1]} for a, b in runs]
    return {
        "n_words": len(words),
        "n_hit": sum(b - a + 1 for a, b in runs),
        "runs": [{"first": a, "last": b} for a, b in runs],
        "spans": spans,
        "items": sorted(items),
    }


_LOWER = {upper: upper + 32 for upper in range(65, 91)}


def _scanner(spark, found: dict):
    key, shared = uuid.uuid4().hex, spark.sparkContext.broadcast(found)

    @F.pandas_udf(HITS)
    def scan(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, runs, items in batches:
            automaton = built("automaton", key, lambda: automaton_of(shared.value))
            rows = [
                scan_text(
                    automaton,
                    content,
                    () if before is None else [(run["first"], run["last"]) for run in before],
                    () if names is None else names,
                )
                for content, before, names in zip(text, runs, items)
            ]
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "runs", "spans", "items"])
            text = runs = items = rows = None
            give_back()

    return scan


def with_hits(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    out: str = "hits",
    width: int = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """``df`` with a struct ``out``: ``n_words``, ``n_hit``, ``runs`` of hit words (first
    and last word), ``spans`` (the same as code points of the original text, end
    exclusive) and the ``items`` found, as sorted strings."""
    spark = df.sparkSession
    ship_package(spark)
    none: tuple[Column, Column] = (
        F.lit(None).cast("array<struct<first: bigint, last: bigint>>"),
        F.lit(None).cast("array<string>"),
    )
    scanned = False
    for found in blocks(benchmark, width, block, item, item_text):
        if scanned:
            df = stage(df, "decontaminated")
        before = (F.col(out)["runs"], F.col(out)["items"]) if scanned else none
        df = df.withColumn(out, _scanner(spark, found)(F.col(text), *before))
        scanned = True
    if not scanned:
        df = df.withColumn(out, _scanner(spark, {"\0": set()})(F.col(text), *none))
    return df


def clean(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` without any hit word, all columns as they are."""
    hits = free_name(df, "_benchmark_hits")
    columns = [F.col(f"`{c}`") for c in df.columns]
    return with_hits(df, benchmark, out=hits, **options).where(F.col(hits)["n_hit"] == 0).select(*columns)


def op3_benchmark_decontamination(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = F.col("hits")
    return with_hits(documents, benchmark).select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        (hits["n_hit"] > 0).alias("contaminated"),
    )


OP3_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '{ALNUM}') AS w FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '{ALNUM}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), {WIDTH}) AS width,
         array_to_string(w[i:i + {WIDTH - 1}], ' ') AS window_text
  FROM b, unnest(range(1, greatest(len(w) - {WIDTH - 2}, 2))) AS t(i) WHERE len(w) > 0),
dw AS (
  SELECT row, i, width, array_to_string(w[i:i + width - 1], ' ') AS window_text
  FROM d, (SELECT DISTINCT width FROM bw), unnest(range(1, len(w) - width + 2)) AS t(i)),
hit AS (
  SELECT row, i, dw.width, item_id FROM dw JOIN bw
  ON dw.window_text = bw.window_text AND dw.width = bw.width),
words AS (
  SELECT row, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + width)) AS t(p) GROUP BY row),
items AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL)
  GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row) LEFT JOIN items USING (row)
"""
