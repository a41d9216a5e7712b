"""Centroid clustering of integer vectors, with expressions of the JVM alone.

A vector is kept if it has exactly ``size`` components, none null or non-finite; component x
becomes the integer ``floor(scale * x)``. The centroids start as the ``clusters`` kept vectors
with the smallest SHA-256 of ``<seed>:<id>``. A round assigns every vector to its nearest
centroid by squared Euclidean distance (ties: the smaller number) and moves every centroid
that has vectors to the floor of their componentwise mean; the others stay. After the last
round all vectors are assigned once more.

The centroids are literal arrays in the plan: ``zip_with`` and ``aggregate`` give the distance
to each, ``array_min`` of (distance, number) chooses. The update is one aggregation by the
number of the centroid with a sum for each component, combined on the map side, so a task
sends on one row for each centroid however many vectors it has. The driver sees ``clusters``
rows a round. The integer vectors are written once and read by every round; there is no join.

All arithmetic is in 64-bit integers, exact and independent of order; distances and sums
beyond them raise. A null id comes last among the first centroids; vectors with equal ids are
chosen by their components. Repeated rows are vectors of their own. With fewer kept vectors
than ``clusters`` there are as many centroids as vectors. An empty table, or one without kept
vectors, gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.workspace import stage

SIZE = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1


def integer_vectors(df: DataFrame, key: str, vector: str, size: int, scale: int) -> DataFrame:
    """(``id``, ``v``) of the kept vectors."""
    # finite values are those whose difference with themselves is zero
    finite = F.forall(F.col("x"), lambda x: F.coalesce(x - x == 0, F.lit(False)))
    return (
        df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("x"))
        .where((F.size("x") == size) & finite)
        .select("id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))
    )


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = vectors.orderBy(named.asc_nulls_last(), "v").limit(clusters)
    return [list(row["v"]) for row in chosen.select("v").collect()]


def distance_to(vector: Column, centroid: list[int]) -> Column:
    """Squared Euclidean distance to a literal centroid."""
    literal = F.expr("array(" + ", ".join(f"{c}L" for c in centroid) + ")")
    squares = F.zip_with(vector, literal, lambda x, c: (x - c) * (x - c))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, x: total + x)


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid; ties go to the smaller number."""
    return F.array_min(
        F.array(
            *(
                F.struct(distance_to(vector, c).alias("distance"), F.lit(j).alias("cluster"))
                for j, c in enumerate(centroids)
            )
        )
    )


def moved_centroids(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round."""
    size = len(centroids[0])
    assigned = vectors.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v")
    components = assigned.select("cluster", *(F.col("v")[i].alias(f"c{i}") for i in range(size)))
    sums = components.groupBy("cluster").agg(
        F.count("*").alias("count"), *(F.sum(f"c{i}").alias(f"c{i}") for i in range(size))
    )
    moved = list(centroids)
    for row in sums.collect():  # one row for each centroid at most
        moved[row["cluster"]] = [row[f"c{i}"] // row["count"] for i in range(size)]
    return moved


def clustered_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    size: int = SIZE,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """(``id``, ``v``, ``cluster``, ``distance``) of every kept vector, and the centroids that
    these belong to. Runs several jobs."""
    vectors = stage(integer_vectors(df, key, vector, size, scale), "vectors")
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids:
        none = vectors.select("id", "v", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return none, []
    for _ in range(rounds):
        centroids = moved_centroids(vectors, centroids)
    chosen = nearest(F.col("v"), centroids)
    assigned = vectors.select("id", "v", chosen.alias("chosen")).select(
        "id", "v", F.col("chosen.cluster").alias("cluster"), F.col("chosen.distance").alias("distance")
    )
    return stage(assigned, "clusters"), centroids


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def _by_cluster(values: list, kind: str) -> Column:
    """The literal of every row's cluster."""
    return F.array(*(F.lit(value).cast(kind) for value in values))[F.col("cluster")]


def op12_centroid_clustering(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assigned, centroids = clustered_vectors(vectors)
    sums = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())  # one row a centroid
    inertia = [sums.get(j, 0) for j in range(max(len(centroids), 1))]
    digests = [centroid_digest(c) for c in centroids] or [""]
    return assigned.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        _by_cluster(inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("bigint").alias("inertia"),
        _by_cluster(digests, "string").alias("centroid_sha256"),
    )


def _assigned(name: str, centroids: str) -> str:
    return f"""
{name} AS (
  SELECT row, id, v, j, d FROM (
    SELECT row, id, v, j, d, row_number() OVER (PARTITION BY row ORDER BY d, j) AS place FROM (
      SELECT x.row, x.id, x.v, c.j,
             CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(x.v, c.v)]) AS BIGINT) AS d
      FROM vectors x CROSS JOIN {centroids} c)) WHERE place = 1)"""


def _moved(name: str, assigned: str, before: str) -> str:
    return f"""
{name} AS (
  SELECT b.j, coalesce(m.v, b.v) AS v FROM {before} b LEFT JOIN (
    SELECT j, list((s - (((s % n) + n) % n)) // n ORDER BY i) AS v FROM (
      SELECT j, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT j, unnest(v) AS x, unnest(range(1, {SIZE + 1})) AS i FROM {assigned}) GROUP BY j, i)
    GROUP BY j) m USING (j))"""


OP12_SQL = (
    f"""
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id AS id,
         [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {SIZE} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {SIZE}),
c0 AS (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS j, v
  FROM (SELECT sha256('{SEED}:' || id) AS h, v FROM vectors ORDER BY h NULLS LAST, v LIMIT {CLUSTERS})),"""
    + ",".join(_assigned(f"a{k}", f"c{k}") + "," + _moved(f"c{k + 1}", f"a{k}", f"c{k}") for k in range(ROUNDS))
    + ","
    + _assigned("final", f"c{ROUNDS}")
    + f"""
SELECT f.id AS vec_id, CAST(f.j AS INTEGER) AS cluster, f.d AS distance,
       CAST(sum(f.d) OVER (PARTITION BY f.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(f.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM final f JOIN c{ROUNDS} c USING (j)
"""
)
