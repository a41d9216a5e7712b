import pytest
from pyspark.sql import functions as F

from framesift.functions import assets as A


@pytest.mark.parametrize(
    "path, expected, label",
    [("/a/b/x.y.mp4", "x.y", "b"), ("/a/.mp4", "", "a"), ("noext", "noext", None),
     ("s3://b/k/", "", "k"), ("s3://b/v.MP4", "v", "b"), ("/a.b/c", "c", "a.b")],
)
def test_asset_id_and_label(spark, path, expected, label):
    row = spark.createDataFrame([(path,)], "p string").select(
        A.asset_id("p").alias("id"), A.class_label("p").alias("label")
    ).first()
    assert (row.id, row.label) == (expected, label)


def test_strip_is_pythons(spark):
    assert set(A.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    texts = ["  a b ", "\t\na\n", " x　", "\x0b\x1c\x85y\x1f", "", "   ", "a\n\nb", "​z"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", A.strip_text("t").alias("s")
    )
    assert all(row.s == row.t.strip() for row in rows.collect())


def test_probe_fallbacks(spark):
    row = spark.sql("SELECT 0L header, 7L packets, cast(null AS bigint) ticks").select(
        A.unit_count("header", "packets").alias("a"),
        A.unit_count(F.lit(9), "packets").alias("b"),
        A.duration_seconds("ticks", 1, 24).alias("c"),
        A.duration_seconds(F.lit(48), 1, 24).alias("d"),
    ).first()
    assert tuple(row) == (7, 9, 0.0, 2.0)


def test_rates_and_cells(spark):
    row = spark.sql("SELECT 30L r, 120.0D e, 0L z, cast(null AS double) u").select(
        A.safe_rate("r", "e").alias("a"), A.safe_rate("z", "e").alias("b"),
        A.safe_rate("r", "u").alias("c"), A.format_cell("e", 1).alias("d"),
        A.format_cell("u", 1).alias("f"), A.format_cell("r").alias("g"),
    ).first()
    assert tuple(row) == (0.25, None, None, "120.0", "—", "30")
