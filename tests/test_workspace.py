import os

import pytest

from framesift import workspace


def test_work_dir_is_the_configured_one(spark):
    assert workspace.work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stage_writes_once(spark, folder):
    df = spark.range(10).selectExpr("id", "uuid() AS u")
    staged = workspace.stage(df, "uuids")
    assert staged.schema == df.schema or staged.columns == df.columns
    assert staged.collect() == staged.collect()
    path = staged.inputFiles()[0].removeprefix("file://")
    assert workspace.drop_staged(spark) >= 1
    assert not os.path.exists(path)


class Elsewhere:
    """A session on a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.work_dir(Elsewhere())


def test_small_files(spark, folder):
    path = folder + "/a/b.txt"
    assert not workspace.exists(spark, path)
    workspace.write_text(spark, path, "é\n")
    assert workspace.exists(spark, path) and open(path, encoding="utf-8").read() == "é\n"
