"""Sampled units of one asset as one compact value, for samples that are written.

Neighbouring frames of an asset differ little, and frames that fill up a short one not at
all. A block holds the first unit and, where units are equally long, each next one as its
difference from the one before, compressed together.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from framesift.sources.fetch import column_sized

# Kind of the units, whether they are differences, number of units.
_HEADER = struct.Struct("<BBI")
_TEXT, _BYTES = 0, 1
_CODEC = "zstd"
LEVEL = 3


def pack_units(units: Sequence[str] | Sequence[bytes]) -> bytes:
    kind = _TEXT if units and isinstance(units[0], str) else _BYTES
    parts = [unit.encode("utf-8") if kind == _TEXT else bytes(unit) for unit in units]
    lengths = np.array([len(part) for part in parts], dtype="<u8")
    data = b"".join(parts)
    alike = bool(kind == _BYTES and len(parts) > 1 and (lengths == lengths[0]).all() and lengths[0] > 0)
    if alike:
        rows = np.frombuffer(data, np.uint8).reshape(len(parts), -1)
        steps = rows.copy()
        steps[1:] -= rows[:-1]  # modulo 256
        data = steps.tobytes()
    packed = pa.Codec(_CODEC, LEVEL).compress(data, asbytes=True)
    size = struct.pack("<Q", len(data))
    return column_sized(_HEADER.pack(kind, alike, len(parts)) + lengths.tobytes() + size + packed)


def unpack_units(block: bytes) -> list[str] | list[bytes]:
    kind, alike, count = _HEADER.unpack_from(block)
    at = _HEADER.size
    lengths = np.frombuffer(block, "<u8", count, at).astype(np.int64)
    at += 8 * count
    (size,) = struct.unpack_from("<Q", block, at)
    data = pa.Codec(_CODEC).decompress(memoryview(block)[at + 8 :], size, asbytes=True)
    if alike:
        steps = np.frombuffer(data, np.uint8).reshape(count, -1)
        data = np.cumsum(steps, axis=0, dtype=np.uint8).tobytes()
    ends = np.cumsum(lengths)
    units = [data[end - length : end] for end, length in zip(ends.tolist(), lengths.tolist())]
    return [unit.decode("utf-8") for unit in units] if kind == _TEXT else units


def unpacked(blocks: pa.ChunkedArray, unit: pa.DataType) -> pa.ChunkedArray:
    """The units of a column of blocks; null blocks have none."""
    lists = [None if block is None else unpack_units(block) for block in blocks.to_pylist()]
    return pa.chunked_array([pa.array(lists, pa.list_(unit))])
