"""Shared storage for staged tables, and shipping of the package to workers."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a ``local`` session, where driver and tasks share one machine, may
    leave it unset and then gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dirs.setdefault(context.applicationId, tempfile.mkdtemp(prefix="framesift-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


_staged: list[str] = []


#: For rows of many megabytes that are compressed already: Parquet else fills pages and row groups
#: with a hundred of them before it looks at their size, and compresses and reads them as one.
LARGE_ROWS = {
    "compression": "none",
    "parquet.enable.dictionary": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once and read it back: later uses neither recompute it nor
    depend on the executors that made it. ``options`` are those of the Parquet writer."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all that is in it; False if there is none."""
    filesystem, target = _hadoop_path(spark, path)
    return bool(filesystem.delete(target, True))


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables this process has staged. Only when no frame built on them is
    needed any more."""
    dropped = 0
    while _staged:
        dropped += delete(spark, _staged.pop())
    return dropped


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _hadoop_path(spark, path)
    return filesystem.exists(target)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """One small file on any storage Spark can write to."""
    filesystem, target = _hadoop_path(spark, path)
    stream = filesystem.create(target, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode("utf-8"))


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; False if there is. Of several that try at
    once one succeeds, on storage that can create files so."""
    filesystem, target = _hadoop_path(spark, path)
    try:
        stream = filesystem.create(target, False)
    except Py4JJavaError:
        if filesystem.exists(target):
            return False
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """One small file, whatever its name; Spark's readers skip names with ``_``."""
    filesystem, target = _hadoop_path(spark, path)
    stream = filesystem.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, so that models cached in
    its modules outlive single tasks."""
    context = spark.sparkContext
    if getattr(context, "_framesift_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as bundle:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(root)))
    shipped = new_path(spark, "package") + "/framesift.zip"
    write_bytes(spark, shipped, packed.getvalue())
    context.addPyFile(shipped)
    context._framesift_shipped = True
