"""Centroid clustering against plain Python."""

import hashlib
import math

import pytest

from framesift.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, v int, distance double"


def plain(rows, size=64, clusters=16, rounds=3):
    kept = [
        (i, [math.floor(64 * x) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(
        kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    )
    middle = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middle))

    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in kept]
        for j in range(len(middle)):
            some = [v for (_, v), k in zip(kept, mine) if k == j]
            if some:
                middle[j] = [sum(column) // len(some) for column in zip(*some)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    return found, middle


def vectors():
    import random

    draw = random.Random(8)
    rows = []
    for i in range(60):
        near = i % 7
        rows.append((i, [float(draw.gauss(near, 0.3)) if k % 7 == near else draw.uniform(-1, 1) for k in range(64)]))
    rows = [(i, [float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]
    bad = [
        (100, None), (101, []), (102, [0.5] * 63), (103, [0.5] * 65), (104, [0.5] * 63 + [None]),
        (105, [0.5] * 63 + [float("nan")]), (106, [0.5] * 63 + [float("-inf")]),
    ]
    odd = [(None, [0.25] * 64), (None, [-0.25] * 64), (3, rows[3][1]), (3, rows[3][1]), (107, [-0.001] * 64), (107, [0.0] * 64)]
    return [(i, v, "other", 5, 1.5) for i, v in rows + bad + odd]


@pytest.mark.parametrize("clusters", [1, 5, 16, 200])
def test_clusters_equal_plain_version(spark, clusters):
    rows = vectors()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assigned, found = centroids.clustered_vectors(frame, clusters=clusters)
    want, middle = plain(rows, clusters=clusters)
    assert found == middle
    got = [(r.id, r.cluster, r.distance) for r in assigned.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_columns(spark, tmp_path):
    rows = vectors()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = centroids.op12_centroid_clustering(spark, str(tmp_path))
    want, middle = plain(rows)
    got = found.collect()
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint",
        "inertia": "bigint", "centroid_sha256": "string",
    }
    assert {r.inertia for r in got} == {sum(d for _, _, d in want)}
    for r in got:
        assert r.cluster_inertia == sum(d for _, j, d in want if j == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, middle[r.cluster])).encode()).hexdigest()


@pytest.mark.parametrize("rows", [[], [(1, None, "x", 1, 0.0), (2, [1.0], "x", 1, 0.0)]])
def test_no_kept_vector(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = centroids.op12_centroid_clustering(spark, str(tmp_path))
    assert found.collect() == []
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_plan_has_no_python_and_no_join(spark, tmp_path):
    spark.createDataFrame(vectors(), SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = centroids.op12_centroid_clustering(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Exchange" not in plan
