"""Words of texts, alike in every operator and in the SQL twins.

``WORD`` is what stands between white space, ``ALNUM`` what ASCII letters, digits and
characters beyond ASCII spell. Both are decided on UTF-8 bytes, so the byte forms below
and the patterns agree. A null text has no words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.workspace import ship_package

WORD = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Bytes to lower case, A to Z only.
TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())

_ALNUM_BYTES = set(b"0123456789" + LOWER.encode()) | set(range(128, 256))
#: Bytes to lower case, and all that ``ALNUM`` leaves out to spaces.
TO_ALNUM = bytes(b if b in _ALNUM_BYTES else 32 for b in TO_LOWER)

#: Bytes hashed in one go, so that a text of any length needs bounded memory.
PIECE = 1 << 18
#: Rows of one step over an Arrow batch, for the same reason.
ROWS = 512

_BETWEEN = {WORD: np.zeros(256, dtype=bool), ALNUM: np.ones(256, dtype=bool)}
_BETWEEN[WORD][[0x20, *range(0x09, 0x0E)]] = True
_BETWEEN[ALNUM][[*_ALNUM_BYTES, *UPPER.encode()]] = False


def key_text(column: str) -> Column:
    return F.col(column).cast("string")


def fold(column: str, of: int) -> Column:
    """``crc32(text of the id) mod of``; null for a null id."""
    return F.crc32(key_text(column)) % F.lit(of)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case of its letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return freed memory to the system: Arrow's and, where libc has a way to, that of
    ``malloc``, where numpy's arrays, Python's bytes and so the batches from Spark lie."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable in the workers, which give back the memory of
    a task when it ends: an executor keeps workers that wait for the next one."""
    ship_package(df.sparkSession)

    def released(batches):
        yield from function(batches)
        give_back()

    return df.mapInArrow(released, schema)


@contextmanager
def small_batches(spark: SparkSession, size: int):
    """Jobs that run inside send Arrow batches of about ``size`` bytes at most, for rows that are
    large themselves: a batch lies in the JVM and in the worker at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    # Spark gives its default back with a unit, and takes a number that is not positive as no limit
    known = int(before.rstrip("b")) if before.rstrip("b").lstrip("-").isdigit() else 0
    spark.conf.set(name, str(min(size, known) if known > 0 else size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batches) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``ROWS``."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row starts; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), offsets


def _random_words(count: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(
        0, 1 << 64, size=count, dtype=np.uint64
    )


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTER = _random_words(256, 17)
_POWERS = {}


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < length:
        count = max(length, PIECE + 4096)
        up = np.full(count, _BASE, dtype=np.uint64)
        down = np.full(count, _INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"], _POWERS["down"]


def _cuts(data: np.ndarray, offsets: np.ndarray, between: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE`` bytes that end with a row or, in long rows, between words."""
    at, row, last = int(offsets[0]), 0, len(offsets) - 1
    end = int(offsets[-1])
    while at < end:
        row = int(np.searchsorted(offsets, at + PIECE, side="right")) - 1
        stop = int(offsets[min(row, last)])
        if stop <= at:  # one row is longer than a piece
            stop = int(offsets[min(row + 1, last)])
            probe = at + PIECE
            while probe < stop:
                gaps = np.flatnonzero(between[data[probe : min(probe + PIECE, stop)]])
                if len(gaps):
                    stop = probe + int(gaps[0])
                    break
                probe += PIECE
        yield at, stop
        at = stop


def word_hashes(column: pa.Array, word: str = WORD) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (``WORD`` or ``ALNUM``) of a string column, A to Z
    lower-cased, and the offsets of the rows in them."""
    data, offsets = utf8(column)
    between = _BETWEEN[word]
    hashes, starts = [], []
    table = _LETTER.copy()
    table[np.arange(65, 91)] = _LETTER[np.arange(97, 123)]
    for begin, end in _cuts(data, offsets, between):
        piece = data[begin:end]
        inside = ~between[piece]
        breaks = np.zeros(len(piece) + 1, dtype=bool)
        cut = offsets[(offsets >= begin) & (offsets <= end)] - begin
        breaks[cut] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | breaks[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | breaks[1:-1]
        first, last = np.flatnonzero(first), np.flatnonzero(last)
        up, down = _powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(table[piece] * up[: len(piece)], out=sums[1:])
        hashes.append(mixed((sums[last + 1] - sums[first]) * down[first] + np.uint64(1)))
        starts.append(first + begin)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


_built: dict = {}


def built(name: str, key: str, build):
    """What ``build()`` returns, once per worker and ``key``. A worker keeps one object
    per ``name``; another key replaces it."""
    have = _built.get(name)
    if have is None or have[0] != key:
        _built.pop(name, None)
        _built[name] = have = (key, build())
    return have[1]
