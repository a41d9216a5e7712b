"""Captioning of manifests as they arrive."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framesift.config import RunConfig
from framesift.plans.captioning import (
    caption_manifest,
    check_config,
    read_ledger,
    task_count,
    write_ledger,
)
from framesift.sources.manifest import CSV_OPTIONS, URI, spread
from framesift.sources.results import CAPTION_COLUMNS
from framesift.sources.storage import open_uri
from framesift.sources.store import Store
from framesift.workspace import exists, read_text, stage, write_text


def caption_arrivals(
    spark: SparkSession,
    manifests: str,
    output: str,
    checkpoint: str,
    config: RunConfig = RunConfig(),
    store: Store | tuple[DataFrame, str, str] | None = None,
    opener: Callable = open_uri,
    files_per_batch: int = 1_000,
    kind: str = "csv",
    columns: str | None = None,
    repeats: str = "keep",
) -> StreamingQuery:
    """Start captioning every manifest file that has arrived in ``manifests``.

    Manifests are CSV files with a header, or Parquet files, that have ``video_uri`` among
    their columns. CSV files have one header, that of the first file present or the one
    that ``columns`` names as DDL; a file with another one stops the query. The query ends
    when all present files are done; started again with the same ``checkpoint`` it
    takes only new ones. Each micro-batch writes its own folder of ``output`` and
    writes it whole, so a batch repeated after a crash adds no rows. The folder is named
    after the checkpoint too, by an id kept in it: a new checkpoint counts its batches
    from 0 again and adds to what is in ``output``.

    ``repeats="skip"`` captions a URI once however often it arrives, in one batch or in
    many: the URIs seen are keyed state of the query, kept in its checkpoint, so one that
    was rejected isn't tried again either. A checkpoint is bound to the setting it began with.
    """
    check_config(config)
    if repeats not in ("keep", "skip"):
        raise ValueError(f"repeats must be 'keep' or 'skip', got {repeats!r}")
    mine = f"{output}/stream={_stream_id(spark, checkpoint)}"

    def caption(batch: DataFrame, number: int) -> None:
        batch = stage(batch, "arrived") if repeats == "skip" else batch
        if store is None:
            batch = spread(batch, config.partitions or task_count(spark, batch.count()))
        captioned = caption_manifest(batch, config, store, opener)
        write_ledger(captioned, f"{mine}/batch={number}")

    arrivals = _arriving(spark, manifests, kind, columns, files_per_batch)
    if repeats == "skip":
        arrivals = arrivals.dropDuplicates([URI])
    return (
        arrivals.writeStream.foreachBatch(caption)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _arriving(spark: SparkSession, manifests: str, kind: str, columns: str | None, files: int) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", files)
    if kind == "parquet":  # columns are found by name
        return reader.schema(f"{URI} string").parquet(manifests)
    if kind != "csv":
        raise ValueError(f"kind must be 'csv' or 'parquet', got {kind!r}")
    columns = columns or _header(spark, manifests)
    return reader.schema(columns).options(**CSV_OPTIONS, enforceSchema=False).csv(manifests).select(URI)


def _header(spark: SparkSession, manifests: str) -> str:
    """The columns of the first manifest, all of them text; one column where none is there yet."""
    if not exists(spark, manifests):
        return f"{URI} string"
    lines = spark.read.text(manifests).select(F.col("_metadata.file_path").alias("file")).limit(1).collect()
    if not lines:
        return f"{URI} string"
    names = spark.read.csv(lines[0].file, **CSV_OPTIONS).columns
    return ", ".join(f"`{name}` string" for name in names)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    path = f"{checkpoint.rstrip('/')}/captions_id"
    if not exists(spark, path):
        write_text(spark, path, uuid.uuid4().hex)
    return read_text(spark, path)


def arrived_rejected(spark: SparkSession, output: str) -> DataFrame:
    """The dead letters of all micro-batches so far."""
    rows = read_ledger(spark, output).where(F.col("error_type").isNotNull())
    return rows.select("path", "video_id", "error_type")


def arrived_captions(spark: SparkSession, output: str) -> DataFrame:
    """The captions of all micro-batches so far."""
    rows = read_ledger(spark, output).where(F.col("error_type").isNull())
    return rows.select(*CAPTION_COLUMNS)
