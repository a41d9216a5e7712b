import csv
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from framesift.config import RunConfig
from framesift.operators.models import Model, register_model
from framesift.operators.readers import TextReader
from framesift.plans import captioning, runs
from framesift.sinks.captions import preview_rows, write_captions, write_preview
from framesift.sources.results import count_rows, read_captions
from framesift.streaming.incremental import arrived_captions, arrived_rejected, caption_arrivals

CONFIG = RunConfig(on_fetch_error="quarantine", partitions=3)


@pytest.fixture()
def manifest(spark, folder):
    os.makedirs(folder + "/in")
    for i in range(12):
        with open(f"{folder}/in/{i:02}.txt", "w") as out:
            out.write(" ".join(f"w{j}" for j in range(i)))
    with open(folder + "/m.csv", "w") as out:
        out.write("video_uri\n")
        out.writelines(f"{folder}/in/{i:02}.txt\n" for i in range(13))
        out.write(f"{folder}/in/05.txt\n")
    return folder + "/m.csv"


def captions(spark, path):
    return sorted((r.video_id, r.caption) for r in read_captions(spark, path).collect())


EXPECTED = sorted([(f"{i:02}", f"{i} w0 w{i - 1}") for i in range(1, 12)] + [("05", "5 w0 w4")])


@pytest.mark.parametrize("backend", ["batch", "request"])
@pytest.mark.parametrize("shards", [1, 3])
def test_run(spark, folder, manifest, backend, shards):
    config = RunConfig(backend=backend, on_fetch_error="quarantine", partitions=3)
    output = config.output_path(folder + "/")
    assert output == f"{folder}/captions-{backend}"
    stats = captioning.run(spark, manifest, output, config, shards=shards)
    assert list(stats) == [
        "backend", "elapsed_sec", "output", "batch_size", "gpu_concurrency", "limit", "ledger", "rows", "rejected"
    ]
    assert (stats["rows"], stats["rejected"]) == (12, 2)
    assert captions(spark, output) == EXPECTED
    bad = spark.read.parquet(output + "_rejected").collect()
    assert {(r.video_id, r.error_type) for r in bad} == {
        ("00", "no_units"), ("12", "fetch_failed:FileNotFoundError")
    }
    with open(output + "_preview/preview.csv", newline="") as lines:
        table = list(csv.reader(lines))
    assert table[0] == ["video_id", "num_frames", "duration_sec", "caption"] and len(table) == 13
    with open(output + "_preview/preview.json") as text:
        assert len(json.load(text)) == 12
    assert count_rows(spark, output) == 12


@pytest.mark.parametrize("backend", ["batch", "request"])
def test_staged_samples_give_the_same(spark, folder, manifest, backend):
    config = RunConfig(backend=backend, placement="staged", on_fetch_error="quarantine")
    captioning.run(spark, manifest, folder + "/out", config)
    assert captions(spark, folder + "/out") == EXPECTED
    assert spark.read.parquet(folder + "/out_rejected").count() == 2


@pytest.mark.parametrize("backend", ["batch", "request"])
def test_strict_run_stops_at_a_bad_asset(spark, folder, manifest, backend):
    config = RunConfig(backend=backend, on_fetch_error="quarantine", on_error="fail")
    with pytest.raises(Exception, match="cannot decode"):
        captioning.run(spark, manifest, folder + "/out", config)
    with pytest.raises(Exception, match="cannot fetch"):
        captioning.run(spark, manifest, folder + "/out", RunConfig(backend=backend))
    assert not os.path.exists(folder + "/out")
    with open(folder + "/lost.csv", "w") as out:
        out.write(f"video_uri\n{folder}/in/99.txt\n{folder}/in/03.txt\n")
    captioning.run(spark, folder + "/lost.csv", folder + "/out", config)
    assert captions(spark, folder + "/out") == [("03", "3 w0 w2")]


def test_limits(spark, folder, manifest):
    captioning.run(spark, manifest, folder + "/two", CONFIG, limit=3)
    assert captions(spark, folder + "/two") == EXPECTED[:2]
    captioning.run(spark, manifest, folder + "/none", CONFIG, limit=0)
    assert captions(spark, folder + "/none") == []


def test_output_is_not_overwritten(spark, folder, manifest):
    captioning.run(spark, manifest, folder + "/out", CONFIG)
    with pytest.raises(FileExistsError):
        captioning.run(spark, manifest, folder + "/out", CONFIG)
    again = RunConfig(on_fetch_error="quarantine", write_mode="append")
    captioning.run(spark, manifest, folder + "/out", again)
    assert captions(spark, folder + "/out") == sorted(EXPECTED * 2)


def counting_model(folder, broken):
    def load():
        def answer(batch):
            with open(folder + "/asked", "a") as out:
                out.writelines(f"{name}\n" for name in batch["video_id"])
            if os.path.exists(broken) and "07" in list(batch["video_id"]):
                raise RuntimeError("model crashed")
            return ["x"] * len(batch["video_id"])

        return answer

    return load


def test_crashed_run_goes_on_where_it_stopped(spark, folder, manifest):
    broken = folder + "/broken"
    open(broken, "w").close()
    register_model(Model(folder, counting_model(folder, broken)))
    config = RunConfig(model=folder, batch_size=1, partitions=1, on_fetch_error="quarantine")
    with pytest.raises(Exception, match="model crashed"):
        captioning.run(spark, manifest, folder + "/out", config, shards=5, run_id="r")
    done = {
        shard for shard in os.listdir(folder + "/out_ledger/r/captions")
        if os.path.exists(f"{folder}/out_ledger/r/captions/{shard}/_SUCCESS")
    }
    os.rename(broken, folder + "/repaired")
    before = len(open(folder + "/asked").readlines())
    captioning.run(spark, manifest, folder + "/out", config, shards=5, run_id="r")
    after = len(open(folder + "/asked").readlines())
    assert [name for name, _ in captions(spark, folder + "/out")] == [n for n, _ in EXPECTED]
    kept = sum(
        spark.read.parquet(f"{folder}/out_ledger/r/captions/{s}").where("caption IS NOT NULL").count()
        for s in done
    )
    assert after - before == 12 - kept


def test_model_runs_once_per_asset(spark, folder, manifest):
    register_model(Model(folder, counting_model(folder, folder + "/no")))
    captioning.run(spark, manifest, folder + "/out", RunConfig(model=folder, on_fetch_error="quarantine"))
    assert len(open(folder + "/asked").readlines()) == 12


@pytest.mark.parametrize("change", [{"backend": "b"}, {"reader": "r"}, {"model": "m"},
                                    {"on_error": "e"}, {"placement": "p"}, {"on_fetch_error": "f"}])
def test_settings_are_checked_before_any_job(spark, folder, change):
    with pytest.raises(ValueError):
        captioning.run(spark, folder + "/absent.csv", folder + "/o", RunConfig(**change))


@pytest.mark.parametrize("settings", [{}, {"placement": "staged"}, {"backend": "request"}])
def test_run_with_own_reader_and_model(spark, folder, manifest, settings):
    class Letters:
        unit_type = "binary"

        def probe(self, data):
            return 0, 2.5

        def count(self, data):
            return len(data)

        def units(self, data):
            return (data[i:i + 1] for i in range(len(data)))

        def keep(self, unit):
            return unit

    def load():
        return lambda batch: [b"".join(units).decode() for units in batch["frames"]]

    config = RunConfig(
        reader=Letters(), model=Model("letters" + str(settings), load), num_units=2,
        on_fetch_error="quarantine", **settings
    )
    captioning.run(spark, manifest, folder + "/out", config)
    found = {r.video_id: r for r in read_captions(spark, folder + "/out").collect()}
    assert (found["02"].caption, found["02"].num_frames, found["02"].duration_sec) == ("w", 5, 2.5)
    assert found["01"].caption == "w0"


def test_task_count(spark):
    assert captioning.task_count(spark, 0) == 4
    assert captioning.task_count(spark, 1_000_000) == 1_000
    assert captioning.task_count(spark, 10**12) == captioning.MAX_TASKS


def test_preview_opens_few_files(spark, folder):
    rows = spark.range(0, 1000, numPartitions=50).select(
        F.col("id").cast("string").alias("video_id"), F.lit("c").alias("caption"),
        F.col("id").alias("num_frames"), F.lit(1.0).alias("duration_sec"),
    )
    write_captions(rows, folder + "/o")
    head = preview_rows(spark, folder + "/o", 30)
    assert [r.num_frames for r in head.collect()] == list(range(30))
    assert len(head.inputFiles()) == 2


def test_preview_never_fails_a_run(spark, folder):
    assert write_preview(spark, folder + "/missing") is False


def test_comparison_and_sweep(spark, folder, manifest):
    table = runs.compare(spark, manifest, folder, CONFIG)
    found = {r.backend: r for r in table.collect()}
    assert {r.rows for r in found.values()} == {12}
    assert all(r.throughput == r.rows / r.elapsed_sec and r.error is None for r in found.values())
    wide = runs.compare_backends(table.withColumn("o", F.lit(1)), "batch", "request", "o")
    assert wide.first().speedup == found["batch"].elapsed_sec / found["request"].elapsed_sec
    cells = {r.metric: r for r in runs.comparison_cells(wide, "batch", "request").collect()}
    assert cells["Captions"].request == "12"

    swept = runs.sweep(spark, manifest, folder + "/sweep", CONFIG, [1, 2], [1])
    assert {(r.batch_size, r.rows) for r in swept.collect()} == {(1, 12), (2, 12)}
    best = runs.best_run(swept).first()
    assert best.throughput == max(r.throughput for r in swept.collect())


def test_failed_runs_are_reported(spark, folder):
    table = runs.compare(spark, folder + "/absent.csv", folder, CONFIG, ["batch"])
    row = table.first()
    assert row.elapsed_sec is None and row.error and row.rows == -1 and row.throughput is None
    assert runs.best_run(table).first().backend is None
    assert runs.sweep_cells(table).first().wall == "—"
    wide = runs.compare_backends(table.withColumn("o", F.lit(1)), "batch", "request", "o").first()
    assert wide.speedup is None and wide.faster is None
    runs.record_runs(spark, [r.asDict() for r in table.collect()], folder + "/runs")
    runs.record_runs(spark, [r.asDict() for r in table.collect()], folder + "/runs")
    assert spark.read.parquet(folder + "/runs").count() == 2


def test_grid():
    configs = runs.sweep_configs(CONFIG, [1, 2, 4], [1, 2])
    assert [(c.batch_size, c.gpu_concurrency) for c in configs] == [
        (1, 1), (1, 2), (2, 1), (2, 2), (4, 1), (4, 2)
    ]


def test_arriving_manifests(spark, folder, manifest):
    arrivals = folder + "/arrivals"
    os.makedirs(arrivals)
    lines = open(manifest).readlines()

    def arrive(name, part):
        with open(f"{arrivals}/{name}", "w") as out:
            out.writelines([lines[0]] + part)
        caption_arrivals(spark, arrivals, folder + "/out", folder + "/progress", CONFIG).awaitTermination()
        return sorted((r.video_id, r.caption) for r in arrived_captions(spark, folder + "/out").collect())

    assert arrive("1.csv", lines[1:6]) == EXPECTED[:4]
    assert arrive("2.csv", lines[6:]) == EXPECTED
    caption_arrivals(spark, arrivals, folder + "/out", folder + "/progress", CONFIG).awaitTermination()
    assert arrived_captions(spark, folder + "/out").count() == 12


def fixed_model(text):
    def load():
        return lambda batch: [text] * len(batch["video_id"])

    return load


def test_another_model_of_a_name_replaces_the_one_held(spark, folder, manifest):
    for text in ("ONE", "TWO", "ONE"):
        config = RunConfig(model=Model("same", fixed_model(text)), partitions=2, on_fetch_error="quarantine")
        captioning.run(spark, manifest, f"{folder}/{text}{os.urandom(4).hex()}", config)
    found = {
        (name[:3], r.caption)
        for name in os.listdir(folder) if name[:3] in ("ONE", "TWO") and len(name) == 11
        for r in spark.read.parquet(f"{folder}/{name}").collect()
    }
    assert found == {("ONE", "ONE"), ("TWO", "TWO")}


def test_a_run_id_stands_for_one_run(spark, folder, manifest):
    captioning.run(spark, manifest, folder + "/out", CONFIG, run_id="r")
    with pytest.raises(ValueError, match="finished"):
        captioning.run(spark, manifest, folder + "/out", CONFIG, run_id="r")
    broken = folder + "/broken"
    open(broken, "w").close()
    register_model(Model(folder, counting_model(folder, broken)))
    config = RunConfig(model=folder, batch_size=1, partitions=1, on_fetch_error="quarantine")
    with pytest.raises(Exception, match="model crashed"):
        captioning.run(spark, manifest, folder + "/two", config, run_id="x")
    with pytest.raises(ValueError, match="another run"):
        captioning.run(spark, manifest, folder + "/two", config, limit=3, run_id="x")
    os.rename(broken, folder + "/repaired")
    captioning.run(spark, manifest, folder + "/two", config, run_id="y")
    with pytest.raises(FileExistsError):  # what y wrote stays
        captioning.run(spark, manifest, folder + "/two", config, run_id="x")
    assert spark.read.parquet(folder + "/two").count() == len(EXPECTED)


def test_left_over_rejected_folder_stops_a_run_at_once(spark, folder, manifest):
    os.makedirs(folder + "/out_rejected")
    with pytest.raises(FileExistsError):
        captioning.run(spark, manifest, folder + "/out", CONFIG)
    assert not os.path.exists(folder + "/out_ledger")


def test_a_new_checkpoint_adds_to_the_output(spark, folder, manifest):
    lines = open(manifest).read().splitlines(keepends=True)
    for number, part in enumerate((lines[1:6], lines[6:])):
        os.makedirs(f"{folder}/arrivals{number}")
        with open(f"{folder}/arrivals{number}/m.csv", "w") as out:
            out.writelines(lines[:1] + part)
        caption_arrivals(
            spark, f"{folder}/arrivals{number}", folder + "/out", f"{folder}/progress{number}", CONFIG
        ).awaitTermination()
    found = sorted((r.video_id, r.caption) for r in arrived_captions(spark, folder + "/out").collect())
    assert found == EXPECTED


class Enormous(bytes):
    """Bytes that report a length no column holds."""

    def __len__(self):
        return 3_000_000_000


class EnormousStream:
    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass

    def read(self):
        return Enormous(b"a b c")


@pytest.mark.parametrize("settings", [{}, {"placement": "staged"}, {"backend": "request"}])
def test_an_asset_of_any_size_is_read_in_every_form(spark, folder, settings):
    listed = spark.createDataFrame([("/big/one.txt",)], "video_uri string")
    captioning.run(
        spark, listed, folder + "/out", RunConfig(partitions=1, **settings), opener=lambda path: EnormousStream()
    )
    assert [r.caption for r in spark.read.parquet(folder + "/out").collect()] == ["3 a c"]


def test_memory_errors_are_not_dead_letters(spark, folder, manifest):
    def opener(path):
        raise MemoryError

    with pytest.raises(Exception, match="MemoryError"):
        captioning.run(spark, manifest, folder + "/out", CONFIG, opener=opener)


def test_a_shard_of_many_rows_has_several_files(spark, folder):
    from framesift.sources import manifest as M

    rows = spark.range(250_000, numPartitions=4).selectExpr("concat('/a/', id) AS video_uri")
    M.write_shards(rows, folder + "/shards", 1)
    files = [f for f in os.listdir(folder + "/shards/shard=0") if f.endswith(".parquet")]
    assert len(files) == 3
    assert M.read_shard(spark, folder + "/shards", 0).distinct().count() == 250_000


def test_sweep_cells_show_whole_errors(spark):
    row = ("b", 1.0, "o", 1, 1, None, "x" * 200, None, None)
    table = spark.createDataFrame(
        [row], "backend string, elapsed_sec double, output string, batch_size int, gpu_concurrency int,"
        " limit int, error string, rows bigint, throughput double")
    assert runs.sweep_cells(table).first().error == "x" * 200


class Noted(TextReader):
    """A text reader that notes every asset that it samples, and when."""

    def __init__(self, folder):
        super().__init__()
        object.__setattr__(self, "folder", folder)

    def probe(self, data):
        with open(self.folder + "/decoded", "a") as out:
            out.write(f"{time.time()}\n")
        return super().probe(data)


def slow_model(folder, broken):
    def load():
        def answer(batch):
            with open(folder + "/captioned", "a") as out:
                out.write(f"{time.time()}\n")
            time.sleep(0.1)
            if os.path.exists(broken) and len(open(folder + "/captioned").readlines()) > 4:
                raise RuntimeError("model crashed")
            return ["x"] * len(batch["video_id"])

        return answer

    return load


def test_samples_are_made_ahead_kept_over_a_crash_and_dropped(spark, folder, manifest):
    broken = folder + "/broken"
    open(broken, "w").close()
    config = RunConfig(
        reader=Noted(folder), model=Model(folder, slow_model(folder, broken)), batch_size=1, partitions=1,
        on_fetch_error="quarantine", placement="staged",
    )
    with pytest.raises(Exception, match="model crashed"):
        captioning.run(spark, manifest, folder + "/out", config, shards=4, run_id="r")
    made = os.listdir(folder + "/out_ledger/r/samples")
    before = len(open(folder + "/decoded").readlines())
    assert 1 <= len(made) <= 2  # the shard that broke off and the one ahead
    os.rename(broken, folder + "/repaired")
    stats = captioning.run(spark, manifest, folder + "/out", config, shards=4, run_id="r")
    assert (stats["rows"], stats["rejected"]) == (12, 2)
    assert before < 13 == len(open(folder + "/decoded").readlines())  # one path can't be opened
    assert not os.path.exists(folder + "/out_ledger/r/samples")
    decoded, captioned = ([float(t) for t in open(f"{folder}/{n}")] for n in ("decoded", "captioned"))
    assert min(captioned) < max(decoded)  # a later shard is decoded after the first is captioned


def test_statistics_are_counted_as_rows_pass(spark, folder, manifest):
    stats = captioning.run(spark, manifest, folder + "/out", CONFIG, shards=3, run_id="r")
    table = captioning.read_statistics(spark, stats["ledger"])
    sums = table.agg(*(F.sum(c).alias(c) for c in table.columns if c != "shard")).first()
    assert (sums.rows, sums.captioned, sums.rejected) == (14, 12, 2)
    rows = read_captions(spark, folder + "/out")
    again = rows.agg(F.sum("num_frames"), F.sum(F.length("caption"))).first()
    assert (sums.units, sums.caption_chars) == tuple(again) and sums.elapsed_sec > 0
    os.remove(f"{stats['ledger']}/stats/shard-1.json")  # as after a crash in between
    assert sum(one["rows"] for one in captioning._shard_stats(spark, stats["ledger"], [0, 1, 2])) == 14


def test_one_of_several_starts_makes_the_record(spark, folder):
    from framesift.workspace import create_text, read_text

    assert create_text(spark, folder + "/r", "a") and not create_text(spark, folder + "/r", "b")
    assert read_text(spark, folder + "/r") == "a"


def arrive(spark, folder, **settings):
    config = RunConfig(on_fetch_error="quarantine", partitions=1)
    caption_arrivals(spark, folder + "/arr", folder + "/out", folder + "/cp", config, **settings).awaitTermination()
    return sorted(r.video_id for r in arrived_captions(spark, folder + "/out").collect())


def test_a_uri_that_arrives_again_is_captioned_once(spark, folder, manifest):
    os.makedirs(folder + "/arr")
    lines = open(manifest).read().splitlines()[1:]
    for number, some in enumerate([lines[:6], lines[3:], lines]):
        with open(f"{folder}/arr/{number}.csv", "w") as out:
            out.write("\n".join(["video_uri", *some]) + "\n")
        found = arrive(spark, folder, repeats="skip")
        assert found == sorted(set(found))
    assert found == [f"{i:02}" for i in range(1, 12)]
    assert {r.video_id for r in arrived_rejected(spark, folder + "/out").collect()} == {"00", "12"}
    with pytest.raises(ValueError, match="repeats"):
        arrive(spark, folder, repeats="maybe")


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_manifests_with_other_columns_arrive(spark, folder, manifest, kind):
    uris = spark.read.csv(manifest, header=True).selectExpr("1 AS n", "video_uri", "'a,b' AS label")
    for _ in range(2):
        if kind == "csv":
            uris.write.mode("append").csv(folder + "/arr", header=True)
        else:
            uris.write.mode("append").parquet(folder + "/arr")
    assert arrive(spark, folder, kind=kind) == sorted(2 * [n for n, _ in EXPECTED])
    assert len(arrived_rejected(spark, folder + "/out").collect()) == 4


def test_a_manifest_with_another_header_stops_the_stream(spark, folder, manifest):
    os.makedirs(folder + "/arr")
    for name, header in (("a", "label,video_uri"), ("b", "video_uri,label")):
        with open(f"{folder}/arr/{name}.csv", "w") as out:
            out.write(f"{header}\nx,{folder}/in/05.txt\n")
    with pytest.raises(Exception, match="header"):
        arrive(spark, folder)


def alike_model(name, share):
    def load():
        return lambda batch: [v if int(v) < share else "a person" for v in batch["video_id"]]

    return Model(name, load)


@pytest.mark.parametrize("share, least, passes", [(12, 0.5, True), (0, 0.5, False), (6, 0.5, True), (6, 0.51, False)])
def test_a_degenerate_run_is_held_back(spark, folder, manifest, share, least, passes):
    config = RunConfig(model=alike_model(f"alike{share}", share), min_variety=least, on_fetch_error="quarantine")
    if passes:  # 12 captions; "a person" counts as one
        captioning.run(spark, manifest, folder + "/out", config, shards=3, run_id="r")
        assert count_rows(spark, folder + "/out") == 12
        return
    with pytest.raises(captioning.HeldBack, match="distinct captions among 12"):
        captioning.run(spark, manifest, folder + "/out", config, shards=3, run_id="r")
    assert not os.path.exists(folder + "/out") and not os.path.exists(folder + "/out_rejected")
    assert "share" in open(folder + "/out_ledger/r/_HELD").read()
    held = runs.run_once(spark, manifest, folder + "/two", config)
    assert held["elapsed_sec"] is None and "distinct captions" in held["error"]
    lenient = RunConfig(model=config.model, on_fetch_error="quarantine")
    captioning.run(spark, manifest, folder + "/out", lenient, shards=3, run_id="r")
    assert count_rows(spark, folder + "/out") == 12


def test_sketches_decide_but_near_the_threshold(spark):
    from framesift.operators import quality

    rows = [(g, p, f"{g}{i % (n or 1)}") for g, n in (("all", 4000), ("half", 2000), ("few", 10)) for p in (0, 1) for i in range(p, 4000, 2)]
    frame = spark.createDataFrame(rows, "g string, p int, caption string")
    sketches = frame.groupBy("g", "p").agg(F.count("*").alias("captions"), quality.caption_sketch().alias("sketch"))
    told = {r.g: r.degenerate for r in quality.sketched_variety(sketches, ["g"], 0.5).collect()}
    assert told == {"all": False, "half": None, "few": True}
    for least in (0.5, 0.501):
        want = {r.g: r.degenerate for r in quality.caption_variety(frame, ["g"], least).collect()}
        found = {r.g: (r.captions, r.degenerate) for r in quality.variety_gate(frame, ["p"], ["g"], least).collect()}
        assert found == {g: (4000, d) for g, d in want.items()}
    assert quality.variety_gate(frame, ["p"], (), 0.5).first().degenerate is False
