"""Members of tar archives as rows."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.operators.ordering import first_n, running_total
from framesift.sources.fetch import BATCH_BYTES, MAX_BYTES, check_error_mode, column_sized
from framesift.sources.ranges import Ranges, ranges_of
from framesift.sources.storage import open_raw, open_uri
from framesift.workspace import ship_package

_MEMBERS = pa.schema(
    [("archive", pa.string()), ("member", pa.string()), ("bytes", pa.binary()), ("error_type", pa.string())]
)
_INDEX = pa.schema(
    [
        ("archive", pa.string()),
        ("member", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("error_type", pa.string()),
    ]
)
_INDEX_DDL = "archive string, member string, offset bigint, length bigint, error_type string"

# Bytes around a header that are read at once.
HEADER_BLOCK = 4096

# Bytes of members that one task of a ranged read is given.
TASK_BYTES = 256 << 20


def _wanted(member: tarfile.TarInfo, ending: str) -> bool:
    return member.isfile() and member.name.lower().endswith(ending)


def archive_members(
    archives: DataFrame,
    suffix: str = ".mp4",
    path: str = "path",
    opener: Callable = open_raw,
    on_error: str = "fail",
) -> DataFrame:
    """``archive``, ``member`` and ``bytes`` of the regular files with ``suffix``
    (any case) in gzipped tar archives.

    Archives are read as streams, one member at a time; one archive is one task, as gzip
    can only be read from the front. A frame with a ``bytes`` column is unpacked from there
    instead of being opened by path.

    ``fail`` stops the job at a broken archive. ``quarantine`` adds ``error_type``: the
    members before the break are kept, the archive gets a row without ``member``, and a
    member too large for a column a row without ``bytes``.
    """
    check_error_mode(on_error)
    ship_package(archives.sparkSession)
    inline = "bytes" in archives.columns
    failing = on_error == "fail"
    ending = suffix.lower()

    def members(name, data):
        stream = io.BytesIO(data) if inline else opener(name)
        with stream, tarfile.open(fileobj=stream, mode="r|gz") as archive:
            for member in archive:
                if not _wanted(member, ending):
                    continue
                if member.size > MAX_BYTES and not failing:
                    yield member.name, None, "fetch_failed:OverflowError"
                else:
                    yield member.name, column_sized(archive.extractfile(member).read()), None

    def unpack(batches):
        rows, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                found = members(name, batch.column(1)[i].as_py() if inline else None)
                for member, data, error in _until_broken(found, name, failing):
                    rows.append({"archive": name, "member": member, "bytes": data, "error_type": error})
                    size += len(data or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_MEMBERS)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_MEMBERS)

    columns = [F.col(path), F.col("bytes")] if inline else [F.col(path)]
    unpacked = archives.select(*columns).mapInArrow(
        unpack, "archive string, member string, bytes binary, error_type string"
    )
    return unpacked.drop("error_type") if failing else unpacked


def _until_broken(found, name: str, failing: bool):
    """What ``found`` gives; where it breaks off, a row for the archive itself."""
    try:
        yield from found
    except MemoryError:
        raise  # says nothing about the archive
    except Exception as problem:
        if failing:
            raise RuntimeError(f"cannot unpack {name!r}") from problem
        yield None, None, "unpack_failed:" + type(problem).__name__


class _Seekable(io.RawIOBase):
    """Ranges as the file object that ``tarfile`` wants."""

    def __init__(self, ranges: Ranges):
        self._ranges, self._at = ranges, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self._at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self._at, io.SEEK_END: len(self._ranges)}[whence]
        return self._at

    def tell(self) -> int:
        return self._at

    def read(self, size: int = -1) -> bytes:
        data = self._ranges.read_at(self._at, len(self._ranges) if size < 0 else size)
        self._at += len(data)
        return data


def index_members(
    archives: DataFrame,
    suffix: str = ".mp4",
    path: str = "path",
    opener: Callable = open_uri,
    on_error: str = "fail",
) -> DataFrame:
    """``archive``, ``member``, ``offset`` and ``length`` of the regular files with ``suffix``
    in uncompressed tar archives, found by reading headers alone, and ``error_type``.

    Seeks from header to header, so that an archive costs a read of some bytes for each
    member. Write the index: reading members, stopping at a target and splitting an archive
    over tasks all start from it. A broken archive stops the job or, with ``quarantine``,
    keeps the members before the break and gets a row without ``member``.
    """
    check_error_mode(on_error)
    ship_package(archives.sparkSession)
    failing, ending = on_error == "fail", suffix.lower()

    def members(name):
        with opener(name) as stream:
            ranges = ranges_of(stream, HEADER_BLOCK)
            size = len(ranges)
            with tarfile.open(fileobj=_Seekable(ranges), mode="r:") as archive:
                for member in archive:
                    if member.offset_data + member.size > size:
                        raise tarfile.ReadError("cut off")
                    if _wanted(member, ending):
                        yield member.name, (member.offset_data, member.size), None
                    archive.members = []  # else every header is held
                last = ranges.read_at(archive.offset, tarfile.BLOCKSIZE)
                if last.strip(b"\0") or 0 < len(last) < tarfile.BLOCKSIZE:
                    raise tarfile.ReadError("no header where one should be")

    def index(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                for member, place, error in _until_broken(members(name), name, failing):
                    offset, length = place or (None, None)
                    rows.append(
                        {"archive": name, "member": member, "offset": offset, "length": length, "error_type": error}
                    )
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)

    return archives.select(F.col(path)).mapInArrow(index, _INDEX_DDL)


def read_members(
    index: DataFrame, opener: Callable = open_uri, on_error: str = "fail", task_bytes: int = TASK_BYTES
) -> DataFrame:
    """``archive``, ``member`` and ``bytes`` of the members in ``index``, a written one.

    Members are dealt out by their place in pieces of about ``task_bytes``: a large archive
    is read by several tasks, each reading its own range, and small ones share a task.
    With ``quarantine`` there is ``error_type``, and rows of broken archives pass through.
    """
    check_error_mode(on_error)
    ship_package(index.sparkSession)
    failing = on_error == "fail"

    def content(stream, offset, length):
        if length > MAX_BYTES:
            raise OverflowError(f"{length} bytes do not fit a column")
        stream.seek(offset)
        data = stream.read(length)
        if len(data) != length:
            raise EOFError("cut off")
        return data

    def read(batches):
        rows, size, stream, opened = [], 0, None, None
        try:
            for batch in batches:
                for name, member, offset, length, error in zip(*(c.to_pylist() for c in batch.columns)):
                    data = None
                    if error is None:
                        try:
                            if opened != name:
                                if stream is not None:
                                    stream.close()
                                opened, stream = None, opener(name)
                                opened = name
                            data = content(stream, offset, length)
                        except MemoryError:
                            raise  # says nothing about the archive
                        except Exception as problem:
                            if failing:
                                raise RuntimeError(f"cannot read {member!r} of {name!r}") from problem
                            error = "fetch_failed:" + type(problem).__name__
                    rows.append({"archive": name, "member": member, "bytes": data, "error_type": error})
                    size += len(data or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_MEMBERS)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_MEMBERS)
        finally:
            if stream is not None:
                stream.close()

    total = index.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first().bytes
    tasks = max(1, -(-total // task_bytes))
    piece = F.floor(F.coalesce("offset", F.lit(0)) / task_bytes)
    dealt = index.repartition(tasks, "archive", piece).sortWithinPartitions("archive", "offset")
    columns = ["archive", "member", "offset", "length", "error_type"]
    found = dealt.select(*columns).mapInArrow(
        read, "archive string, member string, bytes binary, error_type string"
    )
    return found.drop("error_type") if failing else found


def members_until(index: DataFrame, target: int, have: int = 0) -> DataFrame:
    """The rows of ``index``, in order of archive and place, that are needed until ``target``
    members exist. The last archive is taken only up to there."""
    readable = index.where(F.col("error_type").isNull())
    return first_n(readable, ["archive", "offset"], max(target - have, 0))


def archives_until(member_counts: DataFrame, target: int, have: int = 0) -> DataFrame:
    """Archives, in name order, that are needed until ``target`` members exist.

    ``member_counts`` has ``archive`` and ``members``. The archive that reaches the
    target is taken whole.
    """
    totals = running_total(member_counts, ["archive"], "members", "members_so_far")
    earlier = F.col("members_so_far") - F.col("members")
    return totals.where(earlier < target - have)
