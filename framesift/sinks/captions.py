"""Writing results and their previews."""

from __future__ import annotations

import csv
import io
import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.config import PREVIEW_ROWS
from framesift.sources.results import CAPTION_COLUMNS, read_captions
from framesift.workspace import write_text

log = logging.getLogger(__name__)

# Fixed value: column order of the CSV preview.
PREVIEW_COLUMNS = ["video_id", "num_frames", "duration_sec", "caption"]


def write_captions(captions: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with the four result columns. ``append`` adds files to a folder that
    already holds results, and their rows with them."""
    captions.select(*CAPTION_COLUMNS).write.mode(mode).parquet(path)


def preview_rows(spark: SparkSession, path: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a written result, in order of its files.

    Opens the files from the front and doubles their number until they hold enough,
    so the cost does not grow with the result.
    """
    files = sorted(read_captions(spark, path).inputFiles())
    taken = 1
    while True:
        head = spark.read.schema(read_captions(spark, path).schema).parquet(*files[:taken])
        if taken >= len(files) or head.limit(rows).count() >= rows:
            break
        taken *= 2
    ordered = head.orderBy(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return ordered.limit(rows)


def write_preview(spark: SparkSession, path: str, rows: int = PREVIEW_ROWS) -> bool:
    """``preview.csv`` and ``preview.json`` in ``<path>_preview``, beside the result
    so that its folder stays pure Parquet. A failure is logged, never raised."""
    folder = path.rstrip("/") + "_preview"
    try:
        head = [row.asDict() for row in preview_rows(spark, path, rows).collect()]
        table = io.StringIO(newline="")
        writer = csv.DictWriter(table, PREVIEW_COLUMNS)
        writer.writeheader()
        writer.writerows({c: row[c] for c in PREVIEW_COLUMNS} for row in head)
        write_text(spark, f"{folder}/preview.csv", table.getvalue())
        write_text(spark, f"{folder}/preview.json", json.dumps(head, indent=2))
    except Exception:
        log.warning("no preview for %s", path, exc_info=True)
        return False
    return True
