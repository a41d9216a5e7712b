"""Decoding fetched assets into evenly sampled units."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.config import NUM_UNITS
from framesift.functions.assets import asset_id
from framesift.operators.blocks import pack_units, unpacked
from framesift.operators.readers import attempt_sample, error_type, get_reader
from framesift.sources.fetch import BATCH_BYTES
from framesift.sources.storage import open_uri
from framesift.workspace import ship_package

_ARROW_UNITS = {"string": pa.string(), "binary": pa.binary()}


def decode_assets(
    fetched: DataFrame,
    reader="text",
    num_samples: int = NUM_UNITS,
    on_error: str = "drop",
    profile=None,
    opener: Callable = open_uri,
    on_fetch_error: str = "fail",
    packed: bool = False,
) -> DataFrame:
    """Sampled units of every asset: ``path, video_id, frames, num_frames,
    duration_sec, error_type``.

    Without a column ``bytes`` the task opens the path itself, so that an asset of any
    size is read, of which a ranged reader reads no more than it needs, and
    ``on_fetch_error`` says what becomes of one that can't be opened or read.
    Unreadable assets keep their row, with an error type and null units, or stop the
    job if ``on_error`` is ``fail``. A row with an ``error_type`` from the fetch passes
    through unread. ``packed`` gives, for samples that are written, ``block`` instead of
    ``frames``: the units as one compact value, which ``caption_batches`` takes too. Frames are large; where
    nothing else needs them, ``caption_assets`` decodes without handing them on.
    """
    reader = get_reader(reader)
    ship_package(fetched.sparkSession)
    unit = reader.unit_type
    schema = pa.schema(
        [
            ("path", pa.string()),
            ("block", pa.binary()) if packed else ("frames", pa.list_(_ARROW_UNITS[unit])),
            ("num_frames", pa.int64()),
            ("duration_sec", pa.float64()),
            ("error_type", pa.string()),
        ]
    )

    given = "bytes" in fetched.columns
    opening = None if given else opener

    def decode(batches):
        rows, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = dict.fromkeys(schema.names)
                row["path"] = path = batch.column(0)[i].as_py()
                row["error_type"] = batch.column(1)[i].as_py()
                if row["error_type"] is None:
                    data = batch.column(2)[i].as_py() if given else None
                    sampled = attempt_sample(reader, path, data, opening, num_samples, on_fetch_error, on_error)
                    if packed and "frames" in sampled:
                        sampled = _packed_sample(sampled, path, on_error)
                    row |= sampled
                    size += len(row["block"] or b"") if packed else sum(map(len, row["frames"] or ()))
                rows.append(row)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    if "error_type" not in fetched.columns:
        fetched = fetched.withColumn("error_type", F.lit(None).cast("string"))
    return (
        fetched.select("path", "error_type", *(["bytes"] if given else []))
        .mapInArrow(
            decode,
            f"path string, {'block binary' if packed else f'frames array<{unit}>'}, "
            "num_frames bigint, duration_sec double, error_type string",
            profile=profile,
        )
        .select("path", asset_id("path").alias("video_id"), "block" if packed else "frames", "num_frames",
                "duration_sec", "error_type")
    )


def _packed_sample(sampled: dict, path: str, on_error: str) -> dict:
    try:
        return {k: v for k, v in sampled.items() if k != "frames"} | {"block": pack_units(sampled["frames"])}
    except OverflowError as problem:
        if on_error == "fail":
            raise RuntimeError(f"cannot decode {path!r}") from problem
        return {"error_type": error_type(problem)}


def unpack_samples(decoded: DataFrame, reader="text") -> DataFrame:
    """``frames`` instead of the ``block`` of packed samples."""
    ship_package(decoded.sparkSession)
    unit = get_reader(reader).unit_type
    kept = [field for field in decoded.schema.fields if field.name != "block"]

    def unpack(batches):
        for batch in batches:
            for at in range(batch.num_rows):  # one asset at a time, as its units are large
                row = pa.Table.from_batches([batch.slice(at, 1)])
                frames = unpacked(row.column("block"), _ARROW_UNITS[unit])
                yield from row.drop_columns("block").append_column("frames", frames).to_batches()

    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kept)
    return decoded.mapInArrow(unpack, f"{columns}, frames array<{unit}>")


def readable(decoded: DataFrame) -> DataFrame:
    """Only the assets that could be decoded."""
    return decoded.where(F.col("error_type").isNull()).drop("error_type")


def rejected(decoded: DataFrame) -> DataFrame:
    """Dead letters: which assets were left out, and why. Decoding is repeated for every
    frame that is built on it; to keep both kinds, write the decoded table first."""
    return decoded.where(F.col("error_type").isNotNull()).select("path", "video_id", "error_type")
