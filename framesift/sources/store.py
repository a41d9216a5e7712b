"""A content store laid out by key, so that looking assets up never moves their content.

The layout is one Parquet table, partitioned by a hash of the key into ``parts`` and bucketed
by the key, sorted, into ``buckets`` in each part. A look-up shuffles the listed URIs alone
and streams the content past them. Whoever needs the URIs of some parts reads only the files
of these: a run in shards reads every part once, however many shards it has.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.sources.fetch import check_error_mode, checked_content
from framesift.sources.manifest import HOT_COPIES, URI, repeat_copies, split_copies
from framesift.workspace import delete, exists, read_text, write_text

#: Counted URIs up to this many are broadcast to cut a store down before it moves.
BROADCAST_URIS = 100_000


@dataclass(frozen=True)
class Store:
    """A laid-out store. Small and picklable; ``table`` finds its files."""

    path: str
    parts: int
    buckets: int

    @property
    def name(self) -> str:
        """Name in the session's catalog, where alone Spark keeps how files are bucketed."""
        return "framesift_store_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]


def part_of(uri: Column | str, parts: int) -> Column:
    return F.pmod(F.xxhash64(uri), F.lit(parts)).cast("int")


def write_store(
    content: DataFrame, key: str, value: str, path: str, parts: int, buckets: int, wanted: DataFrame | None = None
) -> Store:
    """Lay out the rows of ``content`` by their unique ``key``, in one shuffle.

    With ``wanted``, a table with ``video_uri``, only the rows it lists are kept; up to
    ``BROADCAST_URIS`` of them cut the content down before it moves. Rows without a key
    can't be looked up and are left out. A layout that broke off is written anew, a finished
    one is kept.
    """
    spark = content.sparkSession
    store = Store(path.rstrip("/"), parts, buckets)
    if exists(spark, f"{store.path}/_STORE"):
        return open_store(spark, path)
    rows = content.select(F.col(key).alias("path"), F.col(value).cast("binary").alias("bytes")).where("path is not null")
    if wanted is not None:
        listed = wanted.select(F.col(URI).alias("path")).distinct()
        if listed.limit(BROADCAST_URIS + 1).count() <= BROADCAST_URIS:
            listed = F.broadcast(listed)
        rows = rows.join(listed, "path", "left_semi")
    rows = rows.withColumn("part", part_of("path", parts))
    bucket = F.pmod(F.hash("path"), F.lit(buckets))
    spark.sql(f"DROP TABLE IF EXISTS {store.name}")
    (
        rows.repartition(parts * buckets, "part", bucket)
        .write.mode("overwrite")
        .option("path", f"{store.path}/content")
        .partitionBy("part")
        .bucketBy(buckets, "path")
        .sortBy("path")
        .saveAsTable(store.name)
    )
    write_text(spark, f"{store.path}/_STORE", json.dumps({"parts": parts, "buckets": buckets}))
    return store


def open_store(spark: SparkSession, path: str) -> Store:
    """A store that was written before, by this session or another one."""
    return Store(path.rstrip("/"), **json.loads(read_text(spark, f"{path.rstrip('/')}/_STORE")))


def table(spark: SparkSession, store: Store) -> DataFrame:
    """``path``, ``bytes`` and ``part`` of the whole store."""
    if not spark.catalog.tableExists(store.name):
        spark.sql(
            f"CREATE TABLE {store.name} (path STRING, bytes BINARY, part INT) USING parquet "
            f"PARTITIONED BY (part) CLUSTERED BY (path) SORTED BY (path) INTO {store.buckets} BUCKETS "
            f"LOCATION '{store.path}/content'"
        )
        spark.sql(f"MSCK REPAIR TABLE {store.name}")
    return spark.table(store.name)


def drop_store(spark: SparkSession, store: Store) -> None:
    """Delete the layout. The content it was made from is elsewhere."""
    spark.sql(f"DROP TABLE IF EXISTS {store.name}")
    delete(spark, store.path)


def fetch_from_parts(
    counted: DataFrame,
    store: Store,
    parts: Sequence[int],
    on_error: str = "fail",
    hot_copies: int = HOT_COPIES,
    hot: bool = True,
) -> DataFrame:
    """``path`` and ``bytes`` of every URI in ``counted``, a written table with ``video_uri``
    and ``copies`` whose URIs belong to ``parts``.

    The content is neither shuffled nor sorted: the URIs are dealt out as its buckets are
    and looked up in a hash table of URIs alone. ``hot`` says whether a URI may have more
    than ``hot_copies``; then its rows are split over many tasks.
    """
    check_error_mode(on_error)
    spark = counted.sparkSession
    held = table(spark, store).where(F.col("part").isin([int(p) for p in parts])).select("path", "bytes")
    held = held.withColumn("_held", F.lit(True))

    def looked_up(listed: DataFrame) -> DataFrame:
        return listed.withColumnRenamed(URI, "path").hint("shuffle_hash").join(held, "path", "left")

    if not hot:
        found = repeat_copies(looked_up(counted))
    else:
        few = F.col("copies") <= hot_copies
        found = repeat_copies(looked_up(counted.where(few))).unionByName(
            repeat_copies(split_copies(looked_up(counted.where(~few)), hot_copies))
        )
    return checked_content(found, on_error)
