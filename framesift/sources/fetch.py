"""Getting the bytes of the listed assets."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.sources.manifest import HOT_COPIES, URI, count_copies, repeat_copies, split_copies
from framesift.sources.storage import open_uri
from framesift.workspace import ship_package, stage

# Bytes after which a task hands a batch of fetched assets on.
BATCH_BYTES = 64 << 20

# Most bytes of one asset that a binary column and its Arrow batch can hold.
MAX_BYTES = 2_000_000_000

_FETCHED = pa.schema([("path", pa.string()), ("bytes", pa.binary()), ("error_type", pa.string())])


def check_error_mode(mode: str) -> None:
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', got {mode!r}")


def column_sized(data: bytes) -> bytes:
    if len(data) > MAX_BYTES:
        raise OverflowError(f"{len(data)} bytes do not fit a column")
    return data


def fetch_uris(
    manifest: DataFrame, opener: Callable = open_uri, on_error: str = "fail"
) -> DataFrame:
    """``path`` and ``bytes`` of every URI listed, copies included.

    ``fail`` stops the job at an asset that cannot be read; ``quarantine`` keeps
    its row with null bytes and adds ``error_type``. An asset too large for a column
    counts as unreadable here; ``caption_assets`` can read it by path.
    """
    check_error_mode(on_error)
    ship_package(manifest.sparkSession)
    failing = on_error == "fail"

    def fetch(batches):
        rows, size = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                try:
                    with opener(uri) as stream:
                        data, error = column_sized(stream.read()), None
                except MemoryError:
                    raise  # says nothing about the asset
                except Exception as problem:
                    if failing:
                        raise RuntimeError(f"cannot fetch {uri!r}") from problem
                    data, error = None, "fetch_failed:" + type(problem).__name__
                rows.append({"path": uri, "bytes": data, "error_type": error})
                size += len(data or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_FETCHED)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_FETCHED)

    fetched = manifest.select(URI).mapInArrow(fetch, "path string, bytes binary, error_type string")
    return fetched.select("path", "bytes") if failing else fetched


def fetch_from_store(
    manifest: DataFrame,
    store: DataFrame,
    key: str,
    content: str,
    on_error: str = "fail",
    hot_copies: int = HOT_COPIES,
) -> DataFrame:
    """``path`` and ``bytes`` of every URI listed, from a table with unique ``key``.

    Copies are counted first, so every URI is looked up once and no key of the join
    is hot. The store is cut down to the listed keys before its content moves; Spark
    broadcasts them where the counted table is small enough. Copies are made from
    the found row; a URI with more than ``hot_copies`` is split over many tasks.
    """
    check_error_mode(on_error)
    wanted = stage(count_copies(manifest), "wanted").withColumnRenamed(URI, "path")
    stored = store.select(F.col(key).alias("path"), F.col(content).cast("binary").alias("bytes"))

    def looked_up(listed: DataFrame) -> DataFrame:
        held = stored.join(listed.select("path"), "path", "left_semi")
        return listed.join(held.withColumn("_held", F.lit(True)), "path", "left")

    found = repeat_copies(looked_up(wanted.where(F.col("copies") <= hot_copies)))
    hot = stage(wanted.where(F.col("copies") > hot_copies), "hot-wanted")
    if not hot.isEmpty():
        found = found.unionByName(repeat_copies(split_copies(looked_up(hot), hot_copies)))
    return checked_content(found, on_error)


def checked_content(found: DataFrame, on_error: str) -> DataFrame:
    """``path`` and ``bytes`` of looked-up rows; ``_held`` is null for what is not in the store."""
    missing = F.col("_held").isNull()
    if on_error == "quarantine":
        return found.select("path", "bytes", F.when(missing, "not_found").alias("error_type"))
    message = F.concat(F.lit("not in the store: "), F.coalesce("path", F.lit("null")))
    checked = F.when(missing, F.raise_error(message)).otherwise(F.col("bytes"))
    return found.select("path", checked.alias("bytes"))
