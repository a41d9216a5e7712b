"""Manifests: build from a listing, read, limit, shard, resume, write."""

from __future__ import annotations

import itertools
import os
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.functions.assets import has_suffix
from framesift.operators.ordering import first_n
from framesift.sources.storage import list_folder
from framesift.workspace import ship_package, stage

URI = "video_uri"
_LIST_ROWS = 5_000
_LISTING = pa.schema([("path", pa.string()), ("length", pa.int64()), ("is_folder", pa.bool_())])
_LISTING_DDL = "path string, length bigint, is_folder boolean"

# Rows of one file of a shard.
SHARD_FILE_ROWS = 100_000

# Copies that are made from one fetched row in place. Their content is not shuffled;
# of a URI with more of them, one row per so many copies is.
HOT_COPIES = 32

# Standard CSV quoting, and no trimming of URIs.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def list_assets(
    spark: SparkSession, root: str, suffix: str = ".mp4", limit: int | None = None
) -> DataFrame:
    """Files below ``root`` whose name ends in ``suffix`` (any case), with length.

    One job per level of the folder tree lists all its folders in parallel, so
    neither the driver nor the task of a big subtree ever holds the listing. A
    positive ``limit`` keeps the first paths in sorted order, for which only the folders
    are listed that may hold one of them; None or 0 keeps all.
    """
    ship_package(spark)
    root = root if "://" in root or root.startswith("file:") else os.path.abspath(root)
    if limit:
        return _first_assets(spark, root, suffix, limit)
    tasks = spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(root,)], "path string")
    levels = []
    while True:
        level = stage(folders.mapInArrow(_children, _LISTING_DDL), "listing")
        levels.append(level.where("not is_folder").select("path", "length"))
        folders = level.where("is_folder").select("path")
        if folders.isEmpty():
            break
        folders = folders.repartition(tasks)
    return reduce(DataFrame.unionByName, levels).where(has_suffix("path", suffix))


def _first_assets(spark: SparkSession, root: str, suffix: str, limit: int) -> DataFrame:
    """The first ``limit`` paths, by opening folders in the order of their paths.

    All paths below a folder begin with its own and a slash, and so come after that. A
    round lists the first open folders, one for each task, and what turns out to lie beyond
    the last path wanted is never opened. The paths found and the open folders are written
    tables; the driver sees only the folders of a round.
    """
    tasks = spark.sparkContext.defaultParallelism
    place = F.concat("path", F.lit("/"))
    found = spark.createDataFrame([], "path string, length bigint")
    still_open = spark.createDataFrame([(root,)], "path string")
    while True:
        chosen = [row.path for row in still_open.orderBy(place).limit(tasks).collect()]
        if not chosen:
            break
        listed = spark.createDataFrame([(path,) for path in chosen], "path string").repartition(len(chosen))
        level = stage(listed.mapInArrow(_children, _LISTING_DDL), "listing")
        files = level.where("not is_folder").select("path", "length").where(has_suffix("path", suffix))
        found = stage(first_n(found.unionByName(files), ["path"], limit), "first-assets")
        rest = still_open.where(place > F.lit(chosen[-1] + "/"))
        still_open = rest.unionByName(level.where("is_folder").select("path"))
        last = found.agg(F.count(F.lit(1)).alias("rows"), F.max("path").alias("path")).first()
        if last.rows >= limit:
            still_open = still_open.where(place < F.lit(last.path))
        still_open = stage(still_open, "open-folders")
    return found


def _children(batches):
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            entries = list_folder(folder)
            while chunk := list(itertools.islice(entries, _LIST_ROWS)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*chunk), _LISTING.types)],
                    schema=_LISTING,
                )


def manifest_of(paths: DataFrame, column: str = "path") -> DataFrame:
    return paths.select(F.col(column).alias(URI))


def select_assets(
    candidates: DataFrame, column: str, suffix: str, limit: int | None = None
) -> DataFrame:
    """Manifest of the URIs in ``column`` that end in ``suffix`` (any case); a
    positive ``limit`` keeps the first in sorted order."""
    manifest = manifest_of(candidates, column).where(has_suffix(URI, suffix))
    return limit_manifest(manifest, limit) if limit else manifest


def write_manifest(manifest: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, in URI order over the sorted file names. Copies of a URI may
    fill several files."""
    _numbered(manifest).orderBy(URI, "_copy").select(URI).write.mode(mode).csv(path, **CSV_OPTIONS)


def read_manifest(
    spark: SparkSession, path: str, limit: int | None = None, kind: str = "csv"
) -> DataFrame:
    """The ``video_uri`` column of CSV or Parquet files; other columns are not kept.

    ``limit`` keeps the first rows in file order. 0 keeps none.
    """
    if kind == "csv":
        table = spark.read.csv(path, **CSV_OPTIONS)
        block, line = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    elif kind == "parquet":
        table = spark.read.parquet(path)
        block, line = F.lit(0), F.col("_metadata.row_index")
    else:
        raise ValueError(f"kind must be 'csv' or 'parquet', got {kind!r}")
    if limit is None:
        return table.select(URI)
    place = [F.col("_metadata.file_path").alias("_file"), block.alias("_block"), line.alias("_line")]
    return first_n(table.select(URI, *place), ["_file", "_block", "_line"], limit).select(URI)


def limit_manifest(manifest: DataFrame, limit: int) -> DataFrame:
    """First URIs in sorted order, for manifests without a file order."""
    return first_n(_numbered(manifest), [URI, "_copy"], limit).select(URI)


def _numbered(manifest: DataFrame) -> DataFrame:
    """Copies of a URI told apart, so that a sort can put them into different tasks."""
    return manifest.select(URI, F.monotonically_increasing_id().alias("_copy"))


def spread(manifest: DataFrame, partitions: int) -> DataFrame:
    """Even tasks for the expensive stages, whatever the file count of the manifest.

    Round robin rather than by URI: copies of one URI must not share a task.
    """
    return manifest.repartition(partitions)


def write_shards(
    manifest: DataFrame, path: str, shards: int, mode: str = "errorifexists"
) -> None:
    """Split a manifest into ``shards`` even parts, ``path/shard=<i>``.

    A shard is whatever was written for it, so runs over single shards never
    disagree on their rows, and copies of one URI spread over all shards. A shard has
    a file, and a task that writes it, for every ``SHARD_FILE_ROWS`` rows. Counts the
    manifest first.
    """
    files = max(1, -(-manifest.count() // (shards * SHARD_FILE_ROWS)))
    even = manifest.select(URI).repartition(shards * files).withColumn(
        "shard", F.spark_partition_id() % shards
    )
    even.write.mode(mode).partitionBy("shard").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    schema = f"{URI} string, shard int"
    return spark.read.schema(schema).parquet(path).where(F.col("shard") == shard).select(URI)


def write_counted_shards(manifest: DataFrame, path: str, part: Column, shards: int) -> None:
    """Every URI once, with its number of copies, in the shard of its ``part`` modulo
    ``shards``. Files as in ``write_shards``."""
    counted = count_copies(manifest).withColumn("shard", part % shards)
    files = max(1, -(-manifest.count() // (shards * SHARD_FILE_ROWS)))
    spread_out = counted.repartition(shards * files, "shard", F.pmod(F.hash(URI), F.lit(files)))
    spread_out.write.mode("overwrite").partitionBy("shard").parquet(path)


def read_counted_shard(spark: SparkSession, path: str, shard: int | None = None) -> DataFrame:
    """``video_uri`` and ``copies`` of one shard; of all of them, with ``shard``, for None."""
    rows = spark.read.schema(f"{URI} string, copies bigint, shard int").parquet(path)
    return rows if shard is None else rows.where(F.col("shard") == shard).drop("shard")


def count_copies(manifest: DataFrame) -> DataFrame:
    """Every URI once, with its number of copies. Copies merge before the shuffle, so
    joins on the result know no hot URI."""
    return manifest.groupBy(URI).agg(F.count(F.lit(1)).alias("copies"))


def split_copies(counted: DataFrame, most: int = HOT_COPIES) -> DataFrame:
    """Rows with more than ``most`` copies as several rows, spread over all tasks."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(most).cast("bigint"))
    split = counted.withColumn("_start", F.explode_outer(starts))
    part = F.least(F.lit(most).cast("bigint"), F.col("copies") - F.col("_start"))
    spark = counted.sparkSession
    tasks = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    return split.withColumn("copies", part).drop("_start").repartition(tasks)


def repeat_copies(counted: DataFrame) -> DataFrame:
    """One row per copy again. Rows should hold no more than a task's worth."""
    copies = F.explode_outer(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return counted.select("*", copies.alias("_copy")).drop("copies", "_copy")


def remaining(manifest: DataFrame, done: DataFrame, path: str = "path") -> DataFrame:
    """Manifest rows, copies included, whose URI is not listed in ``done``."""
    finished = done.select(F.col(path).alias(URI)).distinct()
    left = count_copies(manifest).join(finished, URI, "left_anti")
    return repeat_copies(split_copies(left))
