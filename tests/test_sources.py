import csv
import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from framesift.sources import manifest as M
from framesift.sources.archives import (
    archive_members,
    archives_until,
    index_members,
    members_until,
    read_members,
)
from framesift.sources.fetch import fetch_from_store, fetch_uris
from framesift.sources.results import count_rows


def uris(df):
    return [row.video_uri for row in df.collect()]


def make_files(root, names):
    for name in names:
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as out:
            out.write(name.encode())
    return [os.path.join(root, name) for name in names]


@pytest.fixture()
def tree(folder):
    return make_files(folder, ["b/2.mp4", "a/1.MP4", "top.mp4", "a/deep/er/3.mp4", "a/no.txt"])


def test_listing(spark, folder, tree):
    found = M.list_assets(spark, folder)
    assert {r.path: r.length for r in found.collect()} == {
        p: os.path.getsize(p) for p in tree if p.lower().endswith(".mp4")
    }
    paths = sorted(r.path for r in found.collect())
    assert [r.path for r in M.list_assets(spark, folder, limit=2).collect()] == paths[:2]
    assert M.list_assets(spark, folder, limit=0).count() == 4


def test_listing_of_nothing(spark, folder):
    assert M.list_assets(spark, folder).count() == 0


def test_manifest_round_trip(spark, folder):
    names = ['/x/"quoted", comma.mp4', "/x/é ü.mp4", " /lead.mp4", "/x/1.mp4", "/x/1.mp4"]
    frame = spark.createDataFrame([(n,) for n in names], "video_uri string")
    M.write_manifest(frame, folder + "/m")
    assert sorted(uris(M.read_manifest(spark, folder + "/m"))) == sorted(names)


def test_manifest_keeps_file_order_under_limit(spark, folder):
    names = [f"/x/{(i * 37) % 101}.mp4" for i in range(101)]
    path = folder + "/m.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(["label", "video_uri"])
        writer.writerows([["x", n] for n in names])
    assert uris(M.read_manifest(spark, path)) == names
    assert uris(M.read_manifest(spark, path, limit=7)) == names[:7]
    assert uris(M.read_manifest(spark, path, limit=0)) == []


def test_parquet_manifest(spark, folder):
    names = [f"/x/{(i * 37) % 101}.mp4" for i in range(101)]
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "video_uri string, i int")
    rows.coalesce(1).sortWithinPartitions("i").write.parquet(folder + "/m")
    assert uris(M.read_manifest(spark, folder + "/m", kind="parquet")) == names
    assert uris(M.read_manifest(spark, folder + "/m", limit=9, kind="parquet")) == names[:9]
    with pytest.raises(ValueError):
        M.read_manifest(spark, folder + "/m", kind="xml")


def test_empty_manifest(spark, folder):
    with open(folder + "/m.csv", "w") as out:
        out.write("video_uri\n")
    assert uris(M.read_manifest(spark, folder + "/m.csv")) == []


def test_spread_does_not_gather_copies(spark):
    copies = spark.range(800).select(F.lit("/one.mp4").alias("video_uri"))
    sizes = M.spread(copies, 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) <= 110


def test_copies_do_not_share_a_file(spark, folder):
    copies = spark.range(0, 4000, numPartitions=8).select(F.lit("/one").alias("video_uri"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        M.write_manifest(copies, folder + "/m")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = spark.read.csv(folder + "/m", header=True).select("video_uri", "_metadata.file_path")
    sizes = [r["count"] for r in rows.groupBy("file_path").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) > 1
    assert M.limit_manifest(copies, 7).count() == 7


def test_too_large_for_a_column(spark, monkeypatch):
    from framesift.sources import fetch

    monkeypatch.setattr(fetch, "MAX_BYTES", 3)
    assert fetch.column_sized(b"abc") == b"abc"
    with pytest.raises(OverflowError):
        fetch.column_sized(b"abcd")


def test_shards_are_even_and_whole(spark, folder):
    copies = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "/hot").otherwise(F.concat(F.lit("/"), "id")).alias("video_uri")
    )
    M.write_shards(copies, folder + "/s", 4)
    parts = [uris(M.read_shard(spark, folder + "/s", i)) for i in range(4)]
    assert sorted(sum(parts, [])) == sorted(uris(copies))
    assert max(map(len, parts)) <= 300


def test_remaining(spark):
    manifest = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "video_uri string")
    done = spark.createDataFrame([("a",), ("a",), ("z",)], "path string")
    assert sorted(map(str, uris(M.remaining(manifest, done)))) == ["None", "b", "b"]


def test_remaining_spreads_copies(spark):
    manifest = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("video_uri")
    )
    left = M.remaining(manifest, manifest.where("video_uri = 'u1'").withColumnRenamed("video_uri", "path"))
    assert left.count() == 4999
    hot = left.where("video_uri = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in hot) == 1667 and len(hot) == 4


def test_fetch_keeps_copies_and_decompresses(spark, folder, tree):
    import gzip

    with gzip.open(folder + "/z.mp4.gz", "wb") as out:
        out.write(b"zipped")
    listed = tree[:2] + [tree[0], "file:" + tree[2], folder + "/z.mp4.gz"]
    frame = spark.createDataFrame([(u,) for u in listed], "video_uri string").coalesce(1)
    fetched = fetch_uris(frame)
    assert fetched.columns == ["path", "bytes"]
    assert [bytes(r.bytes) for r in fetched.collect()] == [
        b"b/2.mp4", b"a/1.MP4", b"b/2.mp4", b"top.mp4", b"zipped"
    ]


def test_fetch_errors(spark, tree):
    frame = spark.createDataFrame([(tree[0],), ("/gone.mp4",), (None,)], "video_uri string")
    with pytest.raises(Exception, match="cannot fetch"):
        fetch_uris(frame).collect()
    rows = {r.path: r for r in fetch_uris(frame, on_error="quarantine").collect()}
    assert rows[tree[0]].error_type is None
    assert rows["/gone.mp4"].error_type == "fetch_failed:FileNotFoundError"
    assert rows[None].bytes is None and rows[None].error_type.startswith("fetch_failed:")
    with pytest.raises(ValueError):
        fetch_uris(frame, on_error="ignore")


def test_fetch_with_own_opener(spark):
    frame = spark.createDataFrame([("mem://x",)], "video_uri string")
    fetched = fetch_uris(frame, opener=lambda uri: io.BytesIO(uri.upper().encode()))
    assert bytes(fetched.first().bytes) == b"MEM://X"


def test_store_errors_and_copies(spark):
    store = spark.createDataFrame([("a", "1"), ("b", None), ("unused", "9")], "url string, html string")
    listed = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "video_uri string")
    rows = fetch_from_store(listed, store, "url", "html", "quarantine").collect()
    assert sorted((str(r.path), r.bytes and bytes(r.bytes), r.error_type) for r in rows) == [
        ("None", None, "not_found"), ("a", b"1", None), ("a", b"1", None), ("b", None, None),
        ("c", None, "not_found"),
    ]
    with pytest.raises(Exception, match="not in the store: c"):
        fetch_from_store(listed.where("video_uri = 'c'"), store, "url", "html").collect()


@pytest.mark.parametrize("hot_copies", [1, 10, 10_000])
def test_hot_uri_is_split_and_whole(spark, hot_copies):
    listed = spark.range(3000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 50))
        .alias("video_uri")
    )
    store = listed.distinct().select("video_uri", F.concat(F.lit("of "), "video_uri").alias("c"))
    fetched = fetch_from_store(listed, store, "video_uri", "c", hot_copies=hot_copies)
    counts = {r.path: (r["n"], bytes(r.b)) for r in
              fetched.groupBy("path").agg(F.count("*").alias("n"), F.min("bytes").alias("b")).collect()}
    expected = {r.video_uri: r["count"] for r in listed.groupBy("video_uri").count().collect()}
    assert counts == {u: (n, f"of {u}".encode()) for u, n in expected.items()}
    if hot_copies == 10:
        tasks = fetched.where("path = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) == 4 and max(t["count"] for t in tasks) <= 300


def test_split_copies(spark):
    counted = spark.createDataFrame([("a", 25), ("b", 10), ("c", 1)], "video_uri string, copies bigint")
    split = M.split_copies(counted, 10)
    assert sorted(map(tuple, split.collect())) == [("a", 5), ("a", 10), ("a", 10), ("b", 10), ("c", 1)]
    assert M.repeat_copies(split).groupBy("video_uri").count().where("video_uri = 'a'").first()["count"] == 25


def tarball(path, members):
    with tarfile.open(path, "w:gz") as archive:
        folder = tarfile.TarInfo("dir.mp4")
        folder.type = tarfile.DIRTYPE
        archive.addfile(folder)
        for name in members:
            entry = tarfile.TarInfo(name)
            entry.size = len(name)
            archive.addfile(entry, io.BytesIO(name.encode()))


def test_archives(spark, folder):
    tarball(folder + "/1.tar.gz", ["a.mp4", "x/b.MP4", "c.txt"])
    tarball(folder + "/2.tar.gz", ["d.mp4"])
    tarball(folder + "/3.tar.gz", ["e.mp4"])
    members = archive_members(M.list_assets(spark, folder, ".tar.gz"))
    assert sorted((r.member, bytes(r.bytes)) for r in members.collect()) == [
        (n, n.encode()) for n in ("a.mp4", "d.mp4", "e.mp4", "x/b.MP4")
    ]
    counts = members.groupBy("archive").agg(F.count("*").alias("members"))
    needed = archives_until(counts, target=3)
    assert sorted((os.path.basename(r.archive), r.members_so_far) for r in needed.collect()) == [
        ("1.tar.gz", 2), ("2.tar.gz", 3)
    ]
    assert archives_until(counts, target=3, have=3).count() == 0


def test_count_of_missing_result(spark, folder):
    assert count_rows(spark, folder + "/none") == -1


def deep_tree(folder, width=30):
    names = [f"d{i:02}/e{j}/{k}.mp4" for i in range(width) for j in range(3) for k in range(2)]
    return sorted(make_files(folder, [*names, "d00.mp4", "d05-x.mp4", "a/only.txt", "d03/z.mp4"]))


@pytest.mark.parametrize("limit", [1, 5, 7, 40, 1000])
def test_a_limited_listing_has_the_first_paths(spark, folder, limit):
    paths = [p for p in deep_tree(folder) if p.endswith(".mp4")]
    found = M.list_assets(spark, folder, limit=limit).collect()
    assert sorted(r.path for r in found) == paths[:limit]
    assert all(r.length == os.path.getsize(r.path) for r in found)


def test_a_limited_listing_opens_few_folders(spark, folder, monkeypatch):
    deep_tree(folder + "/tree", 60)
    opened = spark.sparkContext.accumulator(0)
    children = M._children

    def counted(batches):
        def passing():
            for batch in batches:
                opened.add(batch.num_rows)
                yield batch

        yield from children(passing())

    monkeypatch.setattr(M, "_children", counted)
    assert M.list_assets(spark, folder + "/tree", limit=3).count() == 3
    few = opened.value
    opened.value = 0
    assert M.list_assets(spark, folder + "/tree").count() == 363
    assert few <= 20 < 200 < opened.value
    assert M.list_assets(spark, folder + "/tree", suffix=".none", limit=3).count() == 0


def make_tar(path, members, mode="w"):
    with tarfile.open(path, mode) as archive:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    return path


@pytest.fixture()
def tars(spark, folder):
    first = make_tar(folder + "/a.tar", {f"m{i:02}.mp4": bytes([i]) * (i * 700) for i in range(30)} | {"n.txt": b"no"})
    second = make_tar(folder + "/b.tar", {"x.MP4": b"x", "y/z.mp4": b"", "dir/é.mp4": b"utf"})
    empty = make_tar(folder + "/c.tar", {})
    return spark.createDataFrame([(p,) for p in (first, second, empty)], "path string")


def members_of(frame):
    return sorted((os.path.basename(r.archive), r.member, bytes(r.bytes)) for r in frame.collect())


def test_archives_are_read_by_the_places_of_members(spark, folder, tars):
    index = index_members(tars)
    index.write.parquet(folder + "/index")
    index = spark.read.parquet(folder + "/index")
    assert index.count() == 33 and index.where("error_type is not null").isEmpty()
    whole = members_of(read_members(index))
    assert whole == sorted(
        [("a.tar", f"m{i:02}.mp4", bytes([i]) * (i * 700)) for i in range(30)]
        + [("b.tar", "x.MP4", b"x"), ("b.tar", "y/z.mp4", b""), ("b.tar", "dir/é.mp4", b"utf")]
    )
    split = read_members(index, task_bytes=20_000)
    assert members_of(split) == whole
    tasks = split.where(F.endswith("archive", F.lit("a.tar"))).select(F.spark_partition_id()).distinct().count()
    assert tasks > 1  # one archive, several tasks
    until = members_until(index, target=32, have=10).orderBy("archive", "offset").collect()
    assert [r.member for r in until] == [f"m{i:02}.mp4" for i in range(22)]


def test_an_index_reads_headers_alone(spark, folder):
    path = make_tar(folder + "/big.tar", {f"{i}.mp4": bytes(2_000_000) for i in range(5)})
    read = spark.sparkContext.accumulator(0)

    class Counting(io.FileIO):
        def read(self, size=-1):
            data = super().read(size)
            read.add(len(data))
            return data

    frame = spark.createDataFrame([(path,)], "path string")
    assert index_members(frame, opener=lambda p: Counting(p)).count() == 5
    assert read.value < 100_000


def test_broken_archives_are_set_aside(spark, folder, tars):
    with open(folder + "/b.tar", "rb") as whole, open(folder + "/cut.tar", "wb") as out:
        out.write(whole.read()[:1600])
    with open(folder + "/junk.tar", "wb") as out:
        out.write(b"not a tar" * 200)
    paths = [folder + "/" + n for n in ("b.tar", "cut.tar", "junk.tar", "none.tar")]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    found = index_members(frame, on_error="quarantine").collect()
    by = {os.path.basename(p): [(r.member, r.error_type) for r in found if r.archive == p] for p in paths}
    assert [m for m, e in by["b.tar"]] == ["x.MP4", "y/z.mp4", "dir/é.mp4"]
    assert by["cut.tar"][0] == ("x.MP4", None) and by["cut.tar"][-1][1].startswith("unpack_failed:")
    assert by["junk.tar"] == [(None, "unpack_failed:ReadError")]
    assert by["none.tar"] == [(None, "unpack_failed:FileNotFoundError")]
    with pytest.raises(Exception, match="cannot unpack"):
        index_members(frame).collect()
    index = spark.createDataFrame(found, "archive string, member string, offset long, length long, error_type string")
    read = read_members(index, on_error="quarantine").collect()
    assert sum(r.bytes is not None for r in read) == 4 + len(by["cut.tar"]) - 2
    assert sum(r.error_type is not None for r in read) == 3


def test_broken_gzipped_archives_are_set_aside(spark, folder):
    good = make_tar(folder + "/g.tar.gz", {f"{i}.mp4": os.urandom(5000) for i in range(4)}, "w:gz")
    with open(good, "rb") as whole, open(folder + "/cut.tar.gz", "wb") as out:
        out.write(whole.read()[:12_000])
    frame = spark.createDataFrame([(good,), (folder + "/cut.tar.gz",)], "path string")
    found = archive_members(frame, on_error="quarantine").collect()
    assert sum(r.bytes is not None for r in found if r.archive == good) == 4
    cut = [r for r in found if r.archive != good]
    assert sum(r.bytes is not None for r in cut) >= 1 and sum(r.error_type is not None for r in cut) == 1
    with pytest.raises(Exception, match="cannot unpack"):
        archive_members(frame).collect()
