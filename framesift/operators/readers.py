"""Readers turn the bytes of one asset into ordered units.

A reader is a picklable object with

* ``unit_type``: Spark type of a kept unit,
* ``probe(data) -> (declared, duration)``: the unit count the asset declares, 0 if
  it does not say, and its duration in seconds,
* ``count(data) -> int``: units counted without decoding them,
* ``units(data)``: the units in order, as a sequence where any can be had at once, or
  as an iterator, which is read up to the last one wanted,
* ``keep(unit)``: the stored form of a unit that was sampled.

``data`` is the asset's bytes. A reader with a true ``ranged`` gets a
``sources.ranges.Ranges`` where an asset is opened by path, and reads from it what it needs:
the last wanted unit ends the reading, and an asset may be longer than memory or a column.
"""

from __future__ import annotations

import codecs
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np

from framesift.config import FRAME_SIZE
from framesift.sources.ranges import FetchError, Ranges, ranges_of, read_whole


class Unreadable(Exception):
    """An asset that yields no sample; the message is its error type."""


def sample_asset(reader, data: bytes, num_samples: int):
    """(sampled units, number of source units, duration) of one asset.

    The rule is that of ``functions.sampling.pick_even`` with a declared count.
    """
    declared, duration = reader.probe(data)
    total = declared if declared > 0 else reader.count(data)
    if total <= 0:
        raise Unreadable("no_units")
    sampled: list = []
    for unit, times in _found(reader.units(data), wanted_positions(total, num_samples)):
        sampled.extend([reader.keep(unit)] * times)
    if not sampled:
        raise Unreadable("nothing_decoded")
    sampled.extend(sampled[-1:] * (num_samples - len(sampled)))
    return sampled, total, float(duration)


def sample_fetched(reader, path: str, data: bytes | None, opener: Callable | None, num_samples: int):
    """``sample_asset`` of the bytes given, or of what ``opener`` opens at ``path``. A storage
    that fails raises ``FetchError``, whatever the reader was doing."""
    if opener is not None:
        try:
            stream = opener(path)
        except MemoryError:
            raise  # says nothing about the asset
        except Exception as problem:
            raise FetchError(type(problem).__name__) from problem
        with stream:
            if getattr(reader, "ranged", False):
                return sample_asset(reader, ranges_of(stream), num_samples)
            data = read_whole(stream)
    return sample_asset(reader, data, num_samples)


def attempt_sample(
    reader, path: str, data: bytes | None, opener: Callable | None, num_samples: int, on_fetch_error: str, on_error: str
) -> dict:
    """``frames``, ``num_frames`` and ``duration_sec`` of an asset, or its ``error_type``,
    unless the settings want the job to fail."""
    try:
        frames, total, duration = sample_fetched(reader, path, data, opener, num_samples)
    except MemoryError:
        raise  # says nothing about the asset
    except FetchError as problem:
        if on_fetch_error == "fail":
            raise RuntimeError(f"cannot fetch {path!r}") from problem
        return {"error_type": f"fetch_failed:{problem}"}
    except Exception as problem:
        if on_error == "fail":
            raise RuntimeError(f"cannot decode {path!r}") from problem
        return {"error_type": error_type(problem)}
    return {"frames": frames, "num_frames": total, "duration_sec": duration}


def _found(units, wanted: list[tuple[int, int]]) -> Iterator[tuple]:
    """The wanted units that exist, each with its number of slots."""
    if hasattr(units, "__getitem__"):
        yield from ((units[at], times) for at, times in wanted if at < len(units))
        return
    start = 0
    for at, times in wanted:
        for unit in islice(units, at - start, at - start + 1):
            yield unit, times
        start = at + 1


@lru_cache(maxsize=65_536)
def wanted_positions(total: int, num_samples: int) -> list[tuple[int, int]]:
    """The distinct even positions in ascending order, each with its number of slots."""
    spots = np.rint(np.arange(num_samples) * total / num_samples).astype(np.int64)
    distinct, times = np.unique(np.minimum(spots, total - 1), return_counts=True)
    return list(zip(distinct.tolist(), times.tolist()))


def error_type(problem: Exception) -> str:
    if isinstance(problem, Unreadable):
        return str(problem)
    return "decode_failed:" + type(problem).__name__


@dataclass(frozen=True)
class TextReader:
    """UTF-8 text; its units are the words between single spaces. A long text is read twice
    from the front, to be counted and up to its last wanted word, piece by piece."""

    chars_per_second: int = 25
    unit_type = "string"
    ranged = True

    @staticmethod
    def _pieces(data: bytes | Ranges) -> Iterator[str]:
        if not isinstance(data, Ranges):
            yield data.decode("utf-8")
            return
        decoder = codecs.getincrementaldecoder("utf-8")()
        for piece in data.pieces():
            yield decoder.decode(piece)
        yield decoder.decode(b"", final=True)

    def probe(self, data: bytes | Ranges) -> tuple[int, float]:
        spaces = chars = 0
        for text in self._pieces(data):
            spaces += text.count(" ")
            chars += len(text)
        return (spaces + 1 if chars else 0), chars / self.chars_per_second

    def count(self, data: bytes | Ranges) -> int:
        return 0

    def units(self, data: bytes | Ranges) -> list[str] | Iterator[str]:
        return self._words(data) if isinstance(data, Ranges) else data.decode("utf-8").split(" ")

    def _words(self, data: Ranges) -> Iterator[str]:
        begun: list[str] = []
        for text in self._pieces(data):
            first, *others = text.split(" ")
            begun.append(first)
            if others:
                yield "".join(begun)
                yield from others[:-1]
                begun = others[-1:]
        yield "".join(begun)

    def keep(self, unit: str) -> str:
        return unit


# Magic, width, height, channels, declared frames, duration ticks, time base.
_RAW_HEADER = struct.Struct("<4sIIIIqII")
_RAW_MAGIC = b"RAWF"


def _part(data: bytes | Ranges, start: int, length: int) -> bytes:
    if isinstance(data, Ranges):
        return data.read_at(start, length)
    return data[start : start + length]


class RawFrames(Sequence):
    """The frames of one asset, each read when it is asked for."""

    def __init__(self, data: bytes | Ranges, shape: tuple[int, int, int], count: int):
        self._data, self._shape, self._count = data, shape, count

    def __len__(self) -> int:
        return self._count

    def __getitem__(self, at: int) -> np.ndarray:
        length = int(np.prod(self._shape))
        frame = _part(self._data, _RAW_HEADER.size + at * length, length)
        return np.frombuffer(frame, np.uint8).reshape(self._shape)


@dataclass(frozen=True)
class RawFrameReader:
    """Uncompressed 8-bit frames behind a fixed header; kept frames are resized to a
    square. Ticks below 0 mean an unknown duration."""

    size: int = FRAME_SIZE
    unit_type = "binary"
    ranged = True

    @staticmethod
    def pack(frames: np.ndarray, declared: int, ticks: int, num: int = 1, den: int = 1) -> bytes:
        _, height, width, channels = frames.shape
        header = _RAW_HEADER.pack(_RAW_MAGIC, width, height, channels, declared, ticks, num, den)
        return header + frames.astype(np.uint8).tobytes()

    def _shape(self, data: bytes | Ranges):
        header = _part(data, 0, _RAW_HEADER.size)
        magic, width, height, channels, declared, ticks, num, den = _RAW_HEADER.unpack_from(header)
        if magic != _RAW_MAGIC:
            raise Unreadable("not_raw_frames")
        return (height, width, channels), declared, (ticks * num / den if ticks >= 0 else 0.0)

    def probe(self, data: bytes | Ranges) -> tuple[int, float]:
        _, declared, duration = self._shape(data)
        return declared, duration

    def count(self, data: bytes | Ranges) -> int:
        shape, _, _ = self._shape(data)
        return (len(data) - _RAW_HEADER.size) // int(np.prod(shape))

    def units(self, data: bytes | Ranges) -> RawFrames:
        return RawFrames(data, self._shape(data)[0], self.count(data))

    def keep(self, unit: np.ndarray) -> bytes:
        height, width, _ = unit.shape
        across, down = triangle_weights(width, self.size), triangle_weights(height, self.size)
        wide = np.tensordot(across, unit.astype(np.float64), axes=(1, 1))
        both = np.tensordot(down, np.floor(wide + 0.5), axes=(1, 1))
        return np.floor(both + 0.5).astype(np.uint8).tobytes()


@lru_cache(maxsize=64)
def triangle_weights(source: int, target: int) -> np.ndarray:
    """Bilinear resampling weights, target by source; widened when shrinking."""
    scale = source / target
    reach = max(scale, 1.0)
    centers = (np.arange(target) + 0.5) * scale
    distance = np.abs(np.arange(source)[None, :] + 0.5 - centers[:, None]) / reach
    weights = np.clip(1.0 - distance, 0.0, None)
    return weights / weights.sum(axis=1, keepdims=True)


READERS: dict[str, object] = {"text": TextReader(), "raw": RawFrameReader()}


def register_reader(name: str, reader) -> None:
    READERS[name] = reader


def get_reader(reader):
    if not isinstance(reader, str):
        return reader
    if reader not in READERS:
        raise ValueError(f"unknown reader: {reader!r}")
    return READERS[reader]
