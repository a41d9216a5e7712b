import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framesift.operators.decode import decode_assets, readable, rejected
from framesift.operators.readers import (
    RawFrameReader,
    TextReader,
    Unreadable,
    get_reader,
    sample_asset,
    triangle_weights,
)
from tests.test_sampling import picked


class Counting:
    """Integers as units; notes how far it was read."""

    unit_type = "string"

    def __init__(self, declared, held, counted=0):
        self.declared, self.held, self.counted, self.read = declared, held, counted, 0

    def probe(self, data):
        return self.declared, 1.5

    def count(self, data):
        return self.counted

    def units(self, data):
        for i in range(self.held):
            self.read += 1
            yield i

    def keep(self, unit):
        return unit


@given(st.integers(1, 400), st.integers(0, 400), st.integers(1, 40))
def test_sample_follows_the_rule(declared, held, samples):
    expected = picked(list(range(held)), declared, samples)
    if expected is None:
        with pytest.raises(Unreadable, match="nothing_decoded"):
            sample_asset(Counting(declared, held), b"", samples)
    else:
        assert sample_asset(Counting(declared, held), b"", samples) == (expected, declared, 1.5)


def test_reading_stops_at_the_last_wanted_unit():
    reader = Counting(1000, 1000)
    sample_asset(reader, b"", 16)
    assert reader.read == 939  # position 938 is the last


def test_count_fallback():
    assert sample_asset(Counting(0, 20, counted=20), b"", 4)[:2] == ([0, 5, 10, 15], 20)
    with pytest.raises(Unreadable, match="no_units"):
        sample_asset(Counting(0, 20), b"", 4)


def test_raw_frames():
    frames = np.arange(5 * 3 * 4 * 3, dtype=np.uint8).reshape(5, 3, 4, 3)
    reader = RawFrameReader(size=6)
    data = RawFrameReader.pack(frames, declared=0, ticks=50, num=1, den=25)
    units, total, duration = sample_asset(reader, data, 16)
    assert (len(units), total, duration) == (16, 5, 2.0)
    assert all(len(u) == 6 * 6 * 3 for u in units) and len(set(units)) == 5
    assert sample_asset(reader, RawFrameReader.pack(frames, 9, -1), 16)[1:] == (9, 0.0)
    with pytest.raises(Unreadable, match="nothing_decoded"):
        sample_asset(reader, RawFrameReader.pack(frames[:0], 9, -1), 16)
    cut = RawFrameReader.pack(frames, 5, -1)[:-1]
    assert len(set(sample_asset(reader, cut, 16)[0])) == 4
    with pytest.raises(Unreadable, match="not_raw_frames"):
        sample_asset(reader, b"x" * 64, 16)


def test_resize_keeps_flat_pictures_and_same_sizes():
    flat = np.full((7, 5, 3), 93, np.uint8)
    assert set(RawFrameReader(size=4).keep(flat)) == {93}
    assert np.array_equal(triangle_weights(6, 6), np.eye(6))
    for source, target in ((10, 4), (4, 10), (300, 384)):
        assert np.allclose(triangle_weights(source, target).sum(axis=1), 1)


def test_resize_by_hand():
    picture = np.arange(2 * 4, dtype=np.uint8).reshape(2, 4, 1) * 10
    # Halving 4 columns weighs them 3:3:1 from the left and 1:3:3 from the right.
    wide = [[(3 * a + 3 * b + c) / 7, (b + 3 * c + 3 * d) / 7]
            for a, b, c, d in picture[:, :, 0].tolist()]
    assert list(RawFrameReader(size=2).keep(picture)) == [int(x + 0.5) for row in wide for x in row]


def test_bad_assets_are_set_aside(spark):
    assets = spark.createDataFrame(
        [("/a/good.txt", b"one two three", None), ("/a/empty.txt", b"", None),
         ("/a/bad.txt", b"\xff\xfe", None), ("/a/null.txt", None, None),
         ("/a/lost.txt", None, "not_found")],
        "path string, bytes binary, error_type string",
    )
    decoded = decode_assets(assets, "text", 4)
    good = readable(decoded).collect()
    words = picked(["one", "two", "three"], 3, 4)
    assert [(r.video_id, r.frames, r.num_frames) for r in good] == [("good", words, 3)]
    assert {r.video_id: r.error_type for r in rejected(decoded).collect()} == {
        "empty": "no_units", "bad": "decode_failed:UnicodeDecodeError",
        "null": "decode_failed:AttributeError", "lost": "not_found",
    }


def test_unknown_reader():
    with pytest.raises(ValueError, match="unknown reader"):
        get_reader("tape")
    assert get_reader(TextReader()) == TextReader()


def test_frames_cross_as_binary(spark):
    frames = np.zeros((3, 2, 2, 1), np.uint8)
    assets = spark.createDataFrame(
        [("/v.raw", RawFrameReader.pack(frames, 3, 0))], "path string, bytes binary"
    )
    row = decode_assets(assets, RawFrameReader(size=384)).select(
        F.size("frames").alias("n"), F.octet_length(F.get("frames", F.lit(0))).alias("b")
    ).first()
    assert (row.n, row.b) == (16, 384 * 384)
