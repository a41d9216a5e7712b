"""Packed samples."""

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framesift.config import RunConfig
from framesift.operators.blocks import pack_units, unpack_units
from framesift.operators.caption import caption_batches
from framesift.operators.decode import decode_assets, unpack_samples
from framesift.operators.readers import RawFrameReader
from framesift.plans import captioning


@given(st.lists(st.text(max_size=9), max_size=20))
def test_texts_come_back(units):
    assert unpack_units(pack_units(units)) == units


@given(st.lists(st.binary(max_size=9), max_size=20))
def test_bytes_come_back(units):
    assert unpack_units(pack_units(units)) == units


@given(st.integers(1, 20), st.integers(0, 30), st.integers(0, 2**32 - 1))
def test_frames_come_back(count, size, seed):
    draw = np.random.default_rng(seed)
    units = [draw.integers(0, 256, size, dtype=np.uint8).tobytes() for _ in range(count)]
    assert unpack_units(pack_units(units)) == units


def moving(seed, frames=32, size=160):
    """A bright square that moves over a still picture, with some noise in every frame."""
    draw = np.random.default_rng(seed)
    film = np.repeat(draw.integers(0, 255, (1, size, size, 3), dtype=np.uint8), frames, axis=0)
    for i in range(frames):
        film[i, 4 * i : 4 * i + 20, 10:30] = 250
        film[i, draw.integers(0, size, 300), draw.integers(0, size, 300)] ^= 1
    return film


@pytest.fixture()
def films(spark):
    rows = [(f"/v/{i}.raw", RawFrameReader.pack(moving(i), 32, 10)) for i in range(6)] + [("/v/bad.raw", b"x" * 99)]
    return spark.createDataFrame(rows, "path string, bytes binary")


def test_packed_samples_are_small_and_give_the_same_captions(spark, folder, films):
    reader = RawFrameReader(size=160)
    sizes = {}
    for packed in (False, True):
        decode_assets(films, reader, packed=packed).coalesce(1).write.parquet(f"{folder}/{packed}")
        sizes[packed] = spark.read.format("binaryFile").load(f"{folder}/{packed}/*.parquet").agg(F.sum("length")).first()[0]
    assert sizes[True] * 2 <= sizes[False]
    plain, packed = (spark.read.parquet(f"{folder}/{name}") for name in (False, True))
    expected = sorted(map(tuple, plain.select("path", "frames", "error_type").collect()))
    found = unpack_samples(packed, reader).select("path", "frames", "error_type").collect()
    assert sorted(map(tuple, found)) == expected
    captions = [
        sorted((r.video_id, r.caption or "") for r in caption_batches(frame, "frame-mean", 4).collect())
        for frame in (plain, packed)
    ]
    assert captions[0] == captions[1] and len(captions[0]) == 7


@pytest.mark.parametrize("backend", ["batch", "request"])
def test_staged_runs_read_packed_samples(spark, folder, films, backend):
    store = (films, "path", "bytes")
    listed = films.selectExpr("path AS video_uri")
    results = {}
    for placement in ("fused", "staged"):
        config = RunConfig(reader=RawFrameReader(size=8), model="frame-mean", backend=backend, placement=placement)
        captioning.run(spark, listed, f"{folder}/{placement}", config, store=store, shards=2)
        results[placement] = sorted(map(tuple, spark.read.parquet(f"{folder}/{placement}").collect()))
    assert results["fused"] == results["staged"] and len(results["fused"]) == 6
