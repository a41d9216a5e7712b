"""Reading parts of a long asset without holding it."""

from __future__ import annotations

import io
from collections import OrderedDict

#: Bytes of one read from storage, and blocks that are kept of one asset.
BLOCK_BYTES = 1 << 20
KEPT_BLOCKS = 8


class FetchError(Exception):
    """Storage failed while an asset was being read; says nothing about its content."""


class Ranges:
    """Random access to an asset's bytes through a cache of its last used blocks.

    ``stream`` is seekable; reads go through blocks of ``block`` bytes, of which ``kept``
    stay, so that an asset of any length needs bounded memory and only the blocks that are
    asked for are read. ``bytes_read`` counts them.
    """

    def __init__(self, stream, block: int = BLOCK_BYTES, kept: int = KEPT_BLOCKS):
        self._stream = stream
        self._block, self._kept = block, kept
        self._blocks: OrderedDict[int, bytes] = OrderedDict()
        self.bytes_read = 0
        try:
            self.size = stream.seek(0, io.SEEK_END)
        except Exception as problem:
            raise FetchError(type(problem).__name__) from problem

    def __len__(self) -> int:
        return self.size

    def _load(self, number: int) -> bytes:
        held = self._blocks.pop(number, None)
        if held is None:
            try:
                self._stream.seek(number * self._block)
                held = self._stream.read(self._block)
            except MemoryError:
                raise
            except Exception as problem:
                raise FetchError(type(problem).__name__) from problem
            self.bytes_read += len(held)
            while len(self._blocks) >= self._kept:
                self._blocks.popitem(last=False)
        self._blocks[number] = held
        return held

    def read_at(self, start: int, length: int) -> bytes:
        """The bytes from ``start`` on; fewer at the end of the asset."""
        end = min(start + length, self.size)
        found = []
        while start < end:
            number, skip = divmod(start, self._block)
            piece = self._load(number)[skip : skip + end - start]
            if not piece:
                raise FetchError("ShortRead")
            found.append(piece)
            start += len(piece)
        return found[0] if len(found) == 1 else b"".join(found)

    def pieces(self, length: int = BLOCK_BYTES):
        """All bytes from the front, piece by piece."""
        for start in range(0, self.size, length):
            yield self.read_at(start, length)


def read_whole(stream) -> bytes:
    try:
        return stream.read()
    except MemoryError:
        raise  # says nothing about the asset
    except Exception as problem:
        raise FetchError(type(problem).__name__) from problem


def ranges_of(stream, block: int = BLOCK_BYTES) -> Ranges:
    """Ranges of a stream. One that can't be sought in, as it is decompressed on the way, is
    read and held whole."""
    seekable = getattr(stream, "seekable", None)
    if seekable is not None and seekable():
        return Ranges(stream, block)
    return Ranges(io.BytesIO(read_whole(stream)), block)
