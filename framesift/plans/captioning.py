"""A whole run: manifest to captions, with previews, dead letters and statistics."""

from __future__ import annotations

import base64
import json
import math
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from framesift.config import RunConfig
from framesift.operators.caption import caption_assets, get_backend
from framesift.operators.decode import decode_assets, unpack_samples
from framesift.operators.models import get_model
from framesift.operators.placement import caption_profile, decode_profile
from framesift.operators.quality import caption_sketch, caption_variety, sketched_variety
from framesift.operators.readers import get_reader
from framesift.sinks.captions import write_captions, write_preview
from framesift.sources.fetch import check_error_mode, fetch_from_store
from framesift.sources.manifest import (
    HOT_COPIES,
    URI,
    count_copies,
    limit_manifest,
    read_counted_shard,
    read_manifest,
    read_shard,
    spread,
    write_counted_shards,
    write_shards,
)
from framesift.sources.storage import open_uri
from framesift.sources.store import Store, drop_store, fetch_from_parts, part_of, write_store
from framesift.workspace import create_text, delete, exists, read_text, stage, write_text

# Assets of one task: little enough to redo when an executor is lost.
ASSETS_PER_TASK = 1_000
MAX_TASKS = 100_000

LEDGER_SCHEMA = (
    "path string, video_id string, caption string, num_frames bigint, duration_sec double, "
    "error_type string"
)


class HeldBack(Exception):
    """A run whose captions were found degenerate; its ledger stands, its output doesn't."""


def check_config(config: RunConfig) -> None:
    """Raise on unknown names before any job runs."""
    get_backend(config.backend)
    get_reader(config.reader)
    get_model(config.model)
    check_error_mode(config.on_fetch_error)
    if config.placement not in ("fused", "staged"):
        raise ValueError(f"placement must be 'fused' or 'staged', got {config.placement!r}")
    if config.on_error not in ("drop", "fail"):
        raise ValueError(f"on_error must be 'drop' or 'fail', got {config.on_error!r}")


def caption_manifest(
    manifest: DataFrame,
    config: RunConfig,
    store: Store | tuple[DataFrame, str, str] | None = None,
    opener: Callable = open_uri,
) -> DataFrame:
    """Captions of the URIs in ``manifest``, not yet computed: one row per URI with
    ``path``, the result columns and ``error_type``.

    ``store`` names a laid-out store or a content table with its key and content columns;
    without it tasks open the URIs. A content table decides the tasks itself, by the size
    of what it holds, unless ``partitions`` is set. The fused batch backend fetches,
    decodes and captions in one pass. The request backend hands requests on, and so
    decodes first; ``staged`` does that for both, and writes the samples.
    """
    check_config(config)
    assets = fetched_assets(manifest, config, store)
    if config.placement == "fused":
        return caption_fetched(assets, config, opener)
    return caption_decoded(stage(decode_fetched(assets, config, opener, packed=True), "samples"), config)


def fetched_assets(
    manifest: DataFrame, config: RunConfig, store: Store | tuple[DataFrame, str, str] | None
) -> DataFrame:
    """``path`` of every URI and, from a store, ``bytes``."""
    if store is None:
        return manifest.select(F.col(URI).alias("path"))
    if isinstance(store, Store):
        counted = stage(count_copies(manifest).withColumn("part", part_of(URI, store.parts)), "wanted")
        used = counted.groupBy("part").agg(F.max("copies").alias("copies")).collect()  # a row a part
        hot = any(row.copies > HOT_COPIES for row in used)
        assets = fetch_from_parts(counted, store, [row.part for row in used], config.on_fetch_error, hot=hot)
    else:
        assets = fetch_from_store(manifest, *store, on_error=config.on_fetch_error)
    return assets.repartition(config.partitions) if config.partitions else assets


def caption_fetched(assets: DataFrame, config: RunConfig, opener: Callable) -> DataFrame:
    """Captions without samples being written in between."""
    if config.backend != "batch":
        return caption_decoded(decode_fetched(assets, config, opener), config)
    return caption_assets(
        assets,
        reader=config.reader,
        model=config.model,
        num_samples=config.num_units,
        batch_size=config.batch_size,
        threads=config.decode_threads,
        opener=opener,
        on_fetch_error=config.on_fetch_error,
        on_error=config.on_error,
        profile=caption_profile(config),
    )


def decode_fetched(
    assets: DataFrame, config: RunConfig, opener: Callable, packed: bool = False
) -> DataFrame:
    return decode_assets(
        assets,
        config.reader,
        config.num_units,
        config.on_error,
        decode_profile(config),
        opener,
        config.on_fetch_error,
        packed,
    )


def caption_decoded(decoded: DataFrame, config: RunConfig) -> DataFrame:
    if "block" in decoded.columns and config.backend != "batch":
        decoded = unpack_samples(decoded, config.reader)
    return get_backend(config.backend)(
        decoded, model=config.model, batch_size=config.batch_size, profile=caption_profile(config)
    ).select("path", "video_id", "caption", "num_frames", "duration_sec", "error_type")


def task_count(spark: SparkSession, rows: int) -> int:
    """Enough tasks for the session's cores and for small retries."""
    wanted = math.ceil(rows / ASSETS_PER_TASK)
    return min(max(wanted, spark.sparkContext.defaultParallelism), MAX_TASKS)


def run(
    spark: SparkSession,
    manifest: str | DataFrame,
    output: str,
    config: RunConfig = RunConfig(),
    limit: int | None = None,
    store: Store | tuple[DataFrame, str, str] | None = None,
    opener: Callable = open_uri,
    shards: int = 1,
    run_id: str | None = None,
) -> dict:
    """Caption a manifest into ``output`` and return the run's statistics.

    The model runs once per asset: each shard's rows, good and bad, are written to
    ``<output>_ledger/<run_id>`` and everything else is read from there: the
    captions, the dead letters in ``<output>_rejected`` and the preview. What a shard
    wrote is counted while it is written.

    A content table is looked up once for all shards: its wanted rows are laid out by
    shard beside the ledger, and dropped when the run is done. A ``Store`` is read in
    place, every shard its own parts, and its content isn't shuffled at all.

    With staged placement the samples of the next shard are made while one shard is
    captioned, by two jobs at a time in scheduler pools of their own. Samples stand
    beside the ledger, packed, until their shard is captioned.

    A run that crashed and is started again under its ``run_id`` keeps the shards
    it has finished and the samples it has written. It must ask for the same: another
    manifest, limit, reader, model name, backend or output under the id raises, and so does
    the id of a finished run.
    What stands at ``output`` is replaced only if this run had begun to write it. Only
    an ``append`` that broke off within the last, small write can repeat rows.

    With ``min_variety`` a run whose captions are too much alike raises ``HeldBack`` before
    anything is published. Its ledger stays, and so does the reason, in ``_HELD``; started
    again with a lower threshold it is published without asking the model again.
    """
    check_config(config)
    output = output.rstrip("/")
    ledger = f"{output}_ledger/{run_id or uuid.uuid4().hex}"
    listed = _limited(spark, manifest, limit)
    mode = config.write_mode
    if mode == "errorifexists":
        if exists(spark, f"{ledger}/_WRITING"):
            mode = "overwrite"
        else:
            for target in (output, f"{output}_rejected"):
                if exists(spark, target):
                    raise FileExistsError(f"{target} exists")
    if run_id is not None:
        _claim(spark, ledger, _record(listed, config, limit, output))
    started = time.time()
    numbers, assets = _shards(spark, listed, ledger, config, store, shards)
    todo = [n for n in numbers if not exists(spark, f"{ledger}/captions/shard={n}/_SUCCESS")]

    def write_captioned(shard: int, captioned: DataFrame) -> None:
        stats = write_ledger(captioned, f"{ledger}/captions/shard={shard}")
        write_text(spark, f"{ledger}/stats/shard-{shard}.json", json.dumps({"shard": shard} | stats))

    if config.placement == "staged":
        samples = f"{ledger}/samples"

        def decode(shard: int) -> None:
            if not exists(spark, f"{samples}/shard={shard}/_SUCCESS"):
                decoded = decode_fetched(assets(shard), config, opener, packed=True)
                decoded.write.mode("overwrite").parquet(f"{samples}/shard={shard}")

        def caption(shard: int) -> None:
            written = spark.read.parquet(f"{samples}/shard={shard}")
            write_captioned(shard, caption_decoded(written, config))
            delete(spark, f"{samples}/shard={shard}")

        _one_ahead(spark, todo, decode, caption)
        delete(spark, samples)
    else:
        for shard in todo:
            write_captioned(shard, caption_fetched(assets(shard), config, opener))

    stats = _shard_stats(spark, ledger, numbers)
    rows = read_ledger(spark, f"{ledger}/captions")
    _hold_back(spark, ledger, rows, stats, config.min_variety)
    write_text(spark, f"{ledger}/_WRITING", "")
    write_captions(rows.where(F.col("error_type").isNull()), output, mode)
    bad = rows.where(F.col("error_type").isNotNull()).select("path", "video_id", "error_type")
    bad.write.mode(mode).parquet(f"{output}_rejected")
    elapsed = time.time() - started
    write_preview(spark, output)
    write_text(spark, f"{ledger}/_DONE", "")
    if exists(spark, f"{ledger}/content/_STORE"):
        drop_store(spark, Store(f"{ledger}/content", shards, _buckets(spark, shards)))
    return {
        "backend": config.backend,
        "elapsed_sec": elapsed,
        "output": output,
        "batch_size": config.batch_size,
        "gpu_concurrency": config.gpu_concurrency,
        "limit": limit,
        "ledger": ledger,
        "rows": sum(one["captioned"] for one in stats),
        "rejected": sum(one["rejected"] for one in stats),
    }


def _shards(
    spark: SparkSession,
    listed: DataFrame,
    ledger: str,
    config: RunConfig,
    store: Store | tuple[DataFrame, str, str] | None,
    shards: int,
) -> tuple[list[int], Callable[[int], DataFrame]]:
    """The numbers of the shards, and how to get the assets of one."""
    path = f"{ledger}/manifest"
    dealt = exists(spark, f"{path}/_SUCCESS")
    if store is None or shards == 1 and not isinstance(store, Store):
        if not dealt:
            write_shards(listed, path, shards, "overwrite")

        def opened(shard: int) -> DataFrame:
            part = read_shard(spark, path, shard)
            if store is None:
                part = spread(part, config.partitions or task_count(spark, part.count()))
            return fetched_assets(part, config, store)

        return _shard_numbers(spark, path), opened

    parts = store.parts if isinstance(store, Store) else shards
    if not dealt:
        write_counted_shards(listed, path, part_of(URI, parts), shards)
    if not isinstance(store, Store):
        content, key, value = store
        wanted = read_counted_shard(spark, path)
        store = write_store(content, key, value, f"{ledger}/content", parts, _buckets(spark, parts), wanted)
    copies = read_counted_shard(spark, path).groupBy("shard").agg(F.max("copies").alias("copies"))
    most = {row.shard: row.copies for row in copies.collect()}  # one row a shard

    def looked_up(shard: int) -> DataFrame:
        found = fetch_from_parts(
            read_counted_shard(spark, path, shard),
            store,
            range(shard, parts, shards),
            config.on_fetch_error,
            hot=most[shard] > HOT_COPIES,
        )
        return found.repartition(config.partitions) if config.partitions else found

    return sorted(most), looked_up


def _buckets(spark: SparkSession, parts: int) -> int:
    """Buckets of a part, so that all of them are as many as the session's shuffle tasks."""
    return max(1, math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / parts))


def _one_ahead(spark: SparkSession, todo: list[int], prepare: Callable, finish: Callable) -> None:
    """``finish`` every shard, with ``prepare`` at work on the next one meanwhile.

    The two jobs have pools of their own, which count where the session schedules fairly.
    If one of them fails the other one ends first: what it made is kept for the next start.
    """
    context = spark.sparkContext

    def prepared(shard: int) -> None:
        context.setLocalProperty("spark.scheduler.pool", "framesift-decode")
        prepare(shard)

    before = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", "framesift-caption")
    try:
        with ThreadPoolExecutor(max_workers=1) as pool:
            ahead = None
            for shard, following in zip(todo, [*todo[1:], None]):
                (ahead or pool.submit(prepared, shard)).result()
                ahead = None if following is None else pool.submit(prepared, following)
                finish(shard)
    finally:
        context.setLocalProperty("spark.scheduler.pool", before)


def _record(manifest: DataFrame, config: RunConfig, limit: int | None, output: str) -> str:
    """What a run was asked for. The manifest counts by its URIs, in any order."""
    rows, urls = manifest.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64(URI).cast("decimal(38,0)"))
    ).first()
    reader = get_reader(config.reader)
    asked = {
        "rows": rows,
        "uris": str(urls),
        "limit": limit,
        "reader": f"{type(reader).__module__}.{type(reader).__qualname__}",
        "model": get_model(config.model).name,
        "backend": config.backend,
        "units": config.num_units,
        "output": output,
    }
    return json.dumps(asked, sort_keys=True)


def _claim(spark: SparkSession, ledger: str, record: str) -> None:
    """Begin or go on with a run; raise if its id stands for another or a finished one."""
    if exists(spark, f"{ledger}/_DONE"):
        raise ValueError(f"{ledger} is the ledger of a finished run")
    if create_text(spark, f"{ledger}/_RECORD", record):
        return
    known = read_text(spark, f"{ledger}/_RECORD")
    if known != record:
        raise ValueError(f"{ledger} is the ledger of another run: {known}, not {record}")


def _limited(spark, manifest, limit):
    if isinstance(manifest, str):
        return read_manifest(spark, manifest, limit)
    return manifest if limit is None else limit_manifest(manifest, limit)


def _shard_numbers(spark, path):
    shards = spark.read.schema(f"{URI} string, shard int").parquet(path).select("shard").distinct()
    return sorted(row.shard for row in shards.collect())


def write_ledger(captioned: DataFrame, path: str) -> dict:
    """One part of a ledger, and what was counted while it was written. Written whole again
    after a crash, hence overwrite."""
    seen, started = Observation(), time.time()
    captioned.observe(seen, *_statistics()).write.mode("overwrite").parquet(path)
    return _portable(seen.get) | {"elapsed_sec": time.time() - started}


def _portable(counted: dict) -> dict:
    """The statistics with the sketch as text."""
    return counted | {"sketch": base64.b64encode(bytes(counted["sketch"])).decode()}


def _hold_back(spark: SparkSession, ledger: str, rows: DataFrame, stats: list[dict], least: float) -> None:
    """Raise if the captions are degenerate. The shards' sketches decide; only near the
    threshold are the captions counted exactly."""
    if not least or not stats:
        return
    parts = [(one["captioned"], base64.b64decode(one["sketch"])) for one in stats]  # one row a shard
    told = sketched_variety(spark.createDataFrame(parts, "captions bigint, sketch binary"), (), least).first()
    degenerate, about = told.degenerate, f"about {told.distinct_estimate}"
    if degenerate is None:
        exact = caption_variety(rows.where(F.col("error_type").isNull()), (), least).first()
        degenerate, about = exact.degenerate, str(exact.distinct_captions)
    if degenerate:
        reason = f"{about} distinct captions among {told.captions}, fewer than a share of {least}"
        write_text(spark, f"{ledger}/_HELD", reason)
        raise HeldBack(reason)
    delete(spark, f"{ledger}/_HELD")


def _statistics() -> list:
    good = F.col("error_type").isNull()
    none = F.lit(0).cast("bigint")
    return [
        caption_sketch(F.when(good, F.col("caption"))).alias("sketch"),
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(good, 1)).alias("captioned"),
        F.count("error_type").alias("rejected"),
        F.coalesce(F.sum(F.when(good, F.col("num_frames"))), none).alias("units"),
        F.coalesce(F.sum(F.when(good, F.col("duration_sec"))), F.lit(0.0)).alias("asset_sec"),
        F.coalesce(F.sum(F.length("caption").cast("bigint")), none).alias("caption_chars"),
    ]


def _shard_stats(spark: SparkSession, ledger: str, shards: list[int]) -> list[dict]:
    """The statistics of finished shards. Only where a crash came between a shard and its
    statistics are its rows read again."""
    found = []
    for shard in shards:
        path = f"{ledger}/stats/shard-{shard}.json"
        if not exists(spark, path):
            again = read_ledger(spark, f"{ledger}/captions/shard={shard}").agg(*_statistics()).first()
            write_text(spark, path, json.dumps({"shard": shard} | _portable(again.asDict()) | {"elapsed_sec": None}))
        found.append(json.loads(read_text(spark, path)))
    return found


STATS_SCHEMA = (
    "shard int, rows bigint, captioned bigint, rejected bigint, units bigint, asset_sec double, "
    "caption_chars bigint, elapsed_sec double"
)


def read_statistics(spark: SparkSession, ledger: str) -> DataFrame:
    """The statistics of a run by shard, as they were counted when the shards were written."""
    if not exists(spark, f"{ledger}/stats"):
        return spark.createDataFrame([], STATS_SCHEMA)
    return spark.read.schema(STATS_SCHEMA).json(f"{ledger}/stats")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All finished parts of a ledger. An empty run has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
