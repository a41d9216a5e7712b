"""Reading of long assets by ranges."""

import io
import os

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framesift.config import RunConfig
from framesift.operators.decode import decode_assets
from framesift.operators.readers import RawFrameReader, TextReader, sample_asset, sample_fetched
from framesift.plans import captioning
from framesift.sources.ranges import FetchError, Ranges, ranges_of


@given(st.binary(max_size=200), st.integers(1, 40), st.integers(1, 4), st.lists(st.tuples(st.integers(0, 220), st.integers(0, 90))))
def test_ranges_equal_slices(data, block, kept, wanted):
    ranges = Ranges(io.BytesIO(data), block, kept)
    assert len(ranges) == len(data) and b"".join(ranges.pieces(7)) == data
    for start, length in wanted:
        assert ranges.read_at(start, length) == data[start : start + length]


@given(st.text(alphabet="a é\U0001f600", max_size=120), st.integers(1, 9), st.integers(1, 20))
def test_text_by_ranges_equals_text_by_bytes(text, block, samples):
    data, reader = text.encode(), TextReader()
    ranges = Ranges(io.BytesIO(data), block)
    ranges.pieces = lambda: Ranges.pieces(ranges, block)
    assert reader.probe(ranges) == reader.probe(data)
    assert list(reader.units(ranges)) == reader.units(data)
    if text:
        assert sample_asset(reader, ranges, samples) == sample_asset(reader, data, samples)


def test_a_long_asset_is_read_where_it_is_sampled(folder):
    path, frame = folder + "/long.raw", 64 * 64 * 3
    frames = np.zeros((1, 64, 64, 3), np.uint8)
    with open(path, "wb") as out:
        out.write(RawFrameReader.pack(frames, declared=200_000, ticks=10, num=1, den=1))
        out.truncate(out.tell() + 199_999 * frame)  # 2.4 GB, of which nothing is stored
    assert os.path.getsize(path) > 2 << 30
    with open(path, "rb") as stream:
        ranges = ranges_of(stream)
        units, total, _ = sample_asset(RawFrameReader(size=4), ranges, 16)
        assert (len(units), total) == (16, 200_000)
        assert ranges.bytes_read <= 17 * 2 * (1 << 20)


@pytest.mark.parametrize("settings", [{}, {"placement": "staged"}, {"backend": "request"}])
def test_assets_above_a_columns_size_decode_in_every_form(spark, folder, settings):
    path = folder + "/long.raw"
    with open(path, "wb") as out:
        out.write(RawFrameReader.pack(np.full((1, 64, 64, 3), 7, np.uint8), 200_000, 10))
        out.truncate(out.tell() + 199_999 * 64 * 64 * 3)
    listed = spark.createDataFrame([(path,)], "video_uri string")
    config = RunConfig(reader=RawFrameReader(size=2), model="frame-mean", partitions=1, **settings)
    captioning.run(spark, listed, folder + "/out", config)
    assert [r.caption for r in spark.read.parquet(folder + "/out").collect()] == ["200000 0.4"]


class Failing(io.BytesIO):
    def read(self, *args):
        if self.tell() > 0:
            raise OSError("connection lost")
        return super().read(10)


def test_storage_that_fails_while_decoding_is_a_failed_fetch(spark, monkeypatch):
    with pytest.raises(FetchError, match="OSError"):
        ranges = Ranges(Failing(b"x" * 100), block=10)
        list(ranges.pieces(10))
    listed = spark.createDataFrame([("/a/b.raw",), ("/a/c.raw",)], "path string")
    frames = np.zeros((40, 300, 300, 3), np.uint8)

    def opener(path):
        data = RawFrameReader.pack(frames, 40, 0)
        return Failing(data) if path.endswith("b.raw") else io.BytesIO(data)

    decoded = decode_assets(listed, RawFrameReader(size=2), 4, opener=opener, on_fetch_error="quarantine")
    found = {r.video_id: (r.error_type, r.n) for r in decoded.withColumn("n", F.size("frames")).collect()}
    assert found == {"b": ("fetch_failed:FetchError", None), "c": (None, 4)} or found["b"][0].startswith("fetch_failed:")
    assert found["c"] == (None, 4)
    with pytest.raises(Exception, match="cannot fetch"):
        decode_assets(listed, RawFrameReader(size=2), 4, opener=opener).collect()


def test_compressed_assets_are_read_on(folder):
    import gzip

    from framesift.sources.storage import open_uri

    with gzip.open(folder + "/a.txt.gz", "wb") as out:
        out.write(b"one two three")
    assert sample_fetched(TextReader(), folder + "/a.txt.gz", None, open_uri, 3)[0] == ["one", "two", "three"]
    with pytest.raises(FetchError, match="FileNotFoundError"):
        sample_fetched(TextReader(), folder + "/none.txt", None, open_uri, 3)
