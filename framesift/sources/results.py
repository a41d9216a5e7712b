"""Reading written results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CAPTION_COLUMNS = ["video_id", "caption", "num_frames", "duration_sec"]
CAPTION_SCHEMA = "video_id string, caption string, num_frames bigint, duration_sec double"


def read_captions(spark: SparkSession, path: str, schema: str = CAPTION_SCHEMA) -> DataFrame:
    """All ``*.parquet`` files of a result folder as one table; others are ignored."""
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows of a written result, -1 when it cannot be read."""
    try:
        return read_captions(spark, path).count()
    except Exception:
        return -1
