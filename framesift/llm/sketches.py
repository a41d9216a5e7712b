"""Near-duplicate detection by fast similarity sketches, banding and exact verification.

A document's set holds its distinct ``size``-word shingles; with fewer words it is the whole
sequence as one; without words it is empty and linked with nothing. Two documents are linked
when ``100 * |x and y| >= threshold * |x or y|``.

A sketch has ``COORDINATES`` coordinates, filled in rounds of hashed bin placement. In each of
the first ``COORDINATES`` rounds every shingle falls into one hashed bin with a hashed value,
and a bin that was empty before the round keeps the smallest one. In round
``COORDINATES + k`` all shingles fall into bin ``k``. So every coordinate is filled after
``2 * COORDINATES`` rounds at the latest, after a few for long texts, and the number of
coordinates in which two sketches agree is concentrated around the similarity of the sets as
for independent hashes, for small sets too.

1. Equal sets are found by a 64-bit digest; of each, one document is sketched on.
2. ``ROWS_OF_BAND`` coordinates are the key of a band. Sets that share no band are no
   candidates: at the threshold 0.85 a link has a chance of 6e-11 to be lost so, and less above.
   Only (band, set) is shuffled, counted on the map side; bands with the same sets are kept
   once, bands of one set dropped.
3. Within a band, sets whose sketches agree in less than ``agreeing(threshold)`` coordinates
   aren't candidates (chance below 1e-12 for a link). Each band gives no pairs but a spanning
   forest of its candidates; a band above ``BLOCK_SETS`` sets gives a star. The forests join to
   clusters, so that linked sets are in one cluster.
4. A cluster's whole shingle sets are compared exactly, most alike sketches first, and only
   sets that aren't connected yet. A cluster above ``BLOCK_SETS`` sets or ``BLOCK_SHINGLES``
   shingles is cut into chunks, each with ``PIVOTS`` pivots of the cluster: near copies of one
   text are connected through the pivots in one pass, in proportion to their number. What is
   not in the largest part of its cluster then, and only that, is compared with every chunk.

Shingles and sets are told apart by 64-bit hashes. Null and empty texts have an empty set; the
component of such a row is itself. A null id is never a component's smallest id unless all are
null; the component is then null, and ``kept`` compares a null id with it as equal. Repeated
rows are documents of their own, linked with each other unless empty. Other columns are not
read. An empty table gives no row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.llm.components import components
from framesift.llm.jaccard import set_digest, shingle_sets
from framesift.llm.membership import Filter
from framesift.llm.text import map_arrow, mixed, slices
from framesift.workspace import stage

SIZE = 3
THRESHOLD = 85
COORDINATES = 128
ROWS_OF_BAND = 4
#: Probability with which a link's sketches may agree in too few coordinates.
DOUBT = 1e-12
BLOCK_SETS = 1024
BLOCK_SHINGLES = 4_000_000
PIVOTS = 8
#: Sets whose sketches are compared in one step.
STEP = 256

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROUND_SEEDS = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Values have the number of their round in the upper 8 bits.
_VALUE_BITS = np.uint64(56)
_BIN_BITS = np.uint64(64 - COORDINATES.bit_length() + 1)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` 16-bit values for every set; the sets aren't empty."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    filled = np.full((len(sets), COORDINATES), _EMPTY, dtype=np.uint64)
    flat = filled.reshape(-1)
    rows = np.arange(len(sets))
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(rows, sizes)
    for number, seed in enumerate(_ROUND_SEEDS):
        if not len(items):
            break
        hashed = mixed(items ^ seed)
        value = (np.uint64(number) << _VALUE_BITS) | (hashed & np.uint64((1 << 56) - 1))
        if number < COORDINATES:
            bins = (mixed(hashed + seed) >> _BIN_BITS).astype(np.int64)
        else:
            bins = number - COORDINATES
        np.minimum.at(flat, owner * COORDINATES + bins, value)
        unfilled = (filled == _EMPTY).any(axis=1)
        if number < 8 or number % 16 == 0:
            wanted = unfilled[owner]
            items, owner = items[wanted], owner[wanted]
    return (mixed(filled) >> np.uint64(48)).astype(np.uint16)


def bands(sketch: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of every sketch."""
    keys = np.ascontiguousarray(sketch).view(np.uint64).copy()
    return mixed(keys + np.arange(1, keys.shape[1] + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def agreeing(threshold: int) -> int:
    """Coordinates in which the sketches of linked sets agree at least, but for a probability
    of ``DOUBT`` (Chernoff's bound)."""
    p = threshold / 100
    for least in range(int(p * COORDINATES), 0, -1):
        a = least / COORDINATES
        rest = (1 - a) * math.log((1 - a) / (1 - p)) if p < 1 else 0.0
        if p == 1 or COORDINATES * (a * math.log(a / p) + rest) >= -math.log(DOUBT):
            return least
    return 0


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def _set_rows(size: int):
    """A row for every document; the sketch only with the first one of a set in the batch."""

    def rows(batches):
        for whole in batches:
            for batch in slices([whole]):
                sets = list(shingle_sets(batch.column(1), size))
                keys = [set_digest(s) if len(s) else None for s in sets]
                first = {key: row for row, key in reversed(list(enumerate(keys))) if key is not None}
                packed = [None] * len(sets)
                chosen = list(first.values())
                for row, sketch in zip(chosen, sketches([sets[row] for row in chosen])):
                    packed[row] = sketch.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array(keys, pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    ["id", "ref", "set_key", "n", "sketch"],
                )

    return rows


def _matrix(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint16).reshape(len(packed), COORDINATES)


def _band_rows(kept: Filter | None = None):
    """(band, set) of every band, or of those that ``kept`` may have."""

    def rows(batches):
        for batch in batches:
            keys = np.asarray(batch.column(0))
            packed = batch.column(1).to_pylist()
            found = bands(_matrix(packed)) if packed else np.zeros((0, 1), np.uint64)
            names, found = np.repeat(keys, found.shape[1]), found.reshape(-1)
            if kept is not None:
                wanted = kept.has(found)
                names, found = names[wanted], found[wanted]
            yield pa.RecordBatch.from_arrays([_long(found), pa.array(names)], ["band", "set_key"])

    return rows


def likely_pairs(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, threshold: int):
    """(agreeing coordinates, left, right) of what may be linked by sketch and size, in steps
    of ``STEP`` sets."""
    least = agreeing(threshold)
    for at in range(0, len(left), STEP):
        some = left[at : at + STEP]
        alike = np.zeros((len(some), len(right)), dtype=np.int16)
        for k in range(COORDINATES):
            alike += some[:, k, None] == right[None, :, k]
        sizes = n_left[at : at + STEP]
        fits = alike >= least
        fits &= 100 * np.minimum(sizes[:, None], n_right[None]) >= threshold * np.maximum(sizes[:, None], n_right[None])
        a, b = np.nonzero(fits)
        yield alike[a, b], a + at, b


class Groups:
    """Disjoint sets of the numbers below ``count``."""

    def __init__(self, count: int):
        self.parent = list(range(count))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        """False if they were together before."""
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def _grouped(batches, width: int):
    """Rows of ``width`` columns that come sorted by the first one, key by key. Of a key rows
    are held as they come; the number of a key's rows is bounded by what dealt them out."""
    current, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(width))):
            if row[0] != current:
                if held:
                    yield held
                current, held = row[0], []
            held.append(row)
    if held:
        yield held


def _forests(threshold: int):
    """Edges of a spanning forest of each band's candidates."""

    def rows(batches):
        ends = []
        for held in _grouped(batches, 4):
            _, keys, sizes, packed = zip(*held)
            matrix, sizes, groups = _matrix(list(packed)), np.array(sizes), Groups(len(keys))
            for _, left, right in likely_pairs(matrix, matrix, sizes, sizes, threshold):
                ends += [(keys[a], keys[b]) for a, b in zip(left.tolist(), right.tolist()) if a < b and groups.join(a, b)]
            if len(ends) >= 100_000:
                yield _edges(ends)
                ends = []
        if ends:
            yield _edges(ends)

    return rows


def _edges(ends: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*ends)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _shingles(size: int):
    """The set of every row, as bytes, once for each set in the task."""

    def rows(batches):
        seen = set()
        for whole in batches:
            for batch in slices([whole]):
                keys, found = [], []
                for shingles in shingle_sets(batch.column(0), size):
                    key = set_digest(shingles) if len(shingles) else None
                    if key is not None and key not in seen:
                        seen.add(key)
                        keys.append(key)
                        found.append(shingles.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(found, pa.binary())], ["set_key", "shingles"]
                )

    return rows


def linked(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    """Whether two sorted sets are linked."""
    together = np.concatenate([x, y])
    together.sort(kind="stable")  # merges two sorted runs
    common = int((together[1:] == together[:-1]).sum())
    return 100 * common >= threshold * (len(x) + len(y) - common)


def connected(keys: list[int], roots: list[int], foreign: list[bool], packed: list[bytes], sets: list[bytes], threshold: int):
    """For every set of a task the smallest one that it is connected with. ``roots`` says what
    was connected before; pairs of two ``foreign`` sets are another task's."""
    count = len(keys)
    groups, place = Groups(count), {}
    for i, root in enumerate(roots):
        groups.join(place.setdefault(root, i), i)
    matrix = _matrix(packed)
    shingles = [np.frombuffer(data, np.uint64) for data in sets]
    sizes = np.array([len(s) for s in shingles])
    own = np.flatnonzero(~np.array(foreign))
    found = [(np.zeros(0, np.int16), own[:0], own[:0])]
    found += [
        (alike, own[a], b)
        for alike, a, b in likely_pairs(matrix[own], matrix, sizes[own], sizes, threshold)
    ]
    alike, left, right = (np.concatenate([f[k] for f in found]) for k in range(3))
    for k in np.argsort(-alike, kind="stable"):
        i, j = int(left[k]), int(right[k])
        if groups.root(i) != groups.root(j) and linked(shingles[i], shingles[j], threshold):
            groups.join(i, j)
    least: dict[int, int] = {}
    for i in range(count):
        root = groups.root(i)
        least[root] = min(least.get(root, keys[i]), keys[i])
    return [least[groups.root(i)] for i in range(count)]


def _connect_tasks(threshold: int):
    """(set, smallest set it is connected with, cluster) of the rows of each task. A set that
    comes twice, because a row is repeated, counts once."""
    names = ["set_key", "root", "cluster"]

    def rows(batches):
        for held in _grouped(batches, 7):
            held = list({row[2]: row for row in sorted(held, key=lambda row: row[4], reverse=True)}.values())
            _, cluster, keys, before, foreign, packed, sets = map(list, zip(*held))
            roots = connected(keys, before, foreign, packed, sets, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (keys, roots, cluster)], names)

    return rows


def _verified(tasks: DataFrame, threshold: int, name: str) -> DataFrame:
    """``tasks`` has task, cluster, set_key, before, foreign, sketch and shingles."""
    return stage(
        map_arrow(
            tasks.repartition("task").sortWithinPartitions("task"),
            _connect_tasks(threshold),
            "set_key bigint, root bigint, cluster bigint",
        ),
        name,
    )


def candidate_clusters(sets: DataFrame, threshold: int, block_sets: int) -> DataFrame:
    """(``node``, ``root``): every set that is a candidate of another one, the smallest set of a
    cluster being its root, with a row of its own. ``sets`` has set_key, n and sketch."""
    packed, row = sets.select("set_key", "sketch"), "band bigint, set_key bigint"
    several = (
        map_arrow(packed, _band_rows(), row)
        .groupBy("band")
        .agg(
            F.count("*").alias("sets"),
            F.min("set_key").alias("first"),
            F.sum(F.xxhash64("set_key").cast("decimal(38,0)")).alias("digest"),
        )
        .where("sets > 1")
        .groupBy("sets", "first", "digest")
        .agg(F.min("band").alias("band"))
    )
    several = stage(several.select("band", "sets", "first"), "bands")
    # the bitmap only keeps bands of one set from being moved again
    likely = map_arrow(packed, _band_rows(Filter(several, "band")), row)
    members = stage(likely.join(several, "band"), "members")
    small = (
        members.where(F.col("sets") <= block_sets)
        .select("band", "set_key")
        .join(sets.select("set_key", "n", "sketch"), "set_key")
        .select("band", "set_key", "n", "sketch")
    )
    forests = map_arrow(
        small.repartition("band").sortWithinPartitions("band"), _forests(threshold), "a bigint, b bigint"
    )
    stars = members.where(F.col("sets") > block_sets).select(F.col("set_key").alias("a"), F.col("first").alias("b"))
    found = components(forests.unionByName(stars))
    return stage(found.unionByName(found.select(F.col("root").alias("node"), "root").distinct()), "clusters")


def linked_sets(
    docs: DataFrame, sets: DataFrame, size: int, threshold: int, block_sets: int, block_shingles: int
) -> DataFrame:
    """(``node``, ``root``) of the sets that are linked with another one, over any number of
    links. ``docs`` has the texts as ``content`` and their hash ``ref``."""
    clusters = candidate_clusters(sets, threshold, block_sets)
    sized = clusters.join(sets, F.col("node") == F.col("set_key")).select(
        "set_key", F.col("root").alias("cluster"), "n", "sketch", "wanted_ref"
    )
    chunks = stage(
        sized.groupBy(F.col("cluster").alias("of")).agg(
            F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") / block_shingles))
            .cast("int")
            .alias("chunks")
        ),
        "chunks",
    )
    placed = stage(
        sized.join(chunks, F.col("cluster") == F.col("of")).select(
            "set_key", "cluster", "n", "sketch", "wanted_ref", "chunks",
            F.pmod(F.xxhash64("set_key"), F.col("chunks")).cast("int").alias("chunk"),
        ),
        "placed",
    )
    content = map_arrow(
        docs.where(Filter(placed, "wanted_ref").may_have("ref")).select("content"),
        _shingles(size),
        "set_key bigint, shingles binary",
    )
    ready = stage(placed.drop("wanted_ref").join(content, "set_key"), "shingles")
    return _connected_sets(ready, threshold, block_sets, block_shingles)


_TASK = ["task", "cluster", "set_key", "before", "foreign", "sketch", "shingles"]


def _connected_sets(ready: DataFrame, threshold: int, block_sets: int, block_shingles: int) -> DataFrame:
    """(``node``, ``root``) by exact links within the clusters of ``ready``."""
    own = {"before": F.col("set_key"), "foreign": F.lit(False)}
    whole = ready.where("chunks = 1").withColumns(own | {"task": F.col("cluster")})
    within = _verified(whole.select(*_TASK), threshold, "links").select(F.col("set_key").alias("node"), "root")
    cut = ready.where("chunks > 1")
    if cut.isEmpty():
        return within

    pivots = cut.groupBy("cluster", F.pmod(F.xxhash64("set_key", F.lit(1)), F.lit(PIVOTS))).agg(
        F.min("set_key").alias("set_key")
    )
    everywhere = (
        cut.join(stage(pivots.select("set_key"), "pivots"), "set_key")
        .drop("chunk")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    )
    chunk_task = F.xxhash64("cluster", "chunk")
    dealt = [df.withColumns(own | {"task": chunk_task}).select(*_TASK) for df in (cut, everywhere)]
    first = _verified(dealt[0].unionByName(dealt[1]), threshold, "chunk-links")
    first_edges = first.select(F.col("set_key").alias("a"), F.col("root").alias("b"))
    parts = components(first_edges)
    parts = stage(
        cut.select("set_key", "cluster", "n", "chunks")
        .dropDuplicates(["set_key"])
        .join(parts, F.col("set_key") == F.col("node"), "left")
        .select("set_key", "cluster", "n", "chunks", F.coalesce("root", "set_key").alias("part")),
        "parts",
    )
    sizes = parts.groupBy("cluster", "part").agg(F.count("*").alias("sets"))
    largest = sizes.groupBy("cluster").agg(F.max_by("part", F.struct("sets", "part")).alias("largest"))
    rest = parts.join(stage(largest, "largest"), "cluster").where("part <> largest")
    blocks = rest.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") / block_shingles)).cast("int").alias("blocks")
    )
    blocks = stage(blocks, "rest-blocks")
    block = F.pmod(F.xxhash64("set_key", F.lit(2)), F.col("blocks")).cast("int")
    rest = stage(
        rest.join(blocks, "cluster").select("set_key", F.col("part").alias("before"), "blocks", block.alias("block")),
        "rest",
    )
    task = F.xxhash64("cluster", "chunk", "block")
    apart = (
        cut.drop("chunk")
        .join(rest, "set_key")
        .withColumns({"chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)), "foreign": F.lit(False)})
        .withColumn("task", task)
    )
    against = (
        cut.join(parts.select("set_key", F.col("part").alias("before")), "set_key")
        .join(blocks, "cluster")
        .withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "foreign": F.lit(True)})
        .withColumn("task", task)
    )
    second = _verified(apart.select(*_TASK).unionByName(against.select(*_TASK)), threshold, "rest-links")
    second_edges = second.select(F.col("set_key").alias("a"), F.col("root").alias("b"))
    across = components(
        parts.select(F.col("set_key").alias("a"), F.col("part").alias("b")).unionByName(second_edges)
    )
    return within.unionByName(across)


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    threshold: int = THRESHOLD,
    block_sets: int = BLOCK_SETS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """For every row of ``df``: ``id``, ``n`` (size of the set), ``component_id`` (smallest id
    reachable by links, itself included) and ``kept`` (the id is the component's). Runs several
    jobs."""
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("content"))
    docs = docs.withColumn("ref", F.xxhash64("id", "content"))
    id_type = docs.schema["id"].dataType.simpleString()
    rows = stage(
        map_arrow(
            docs.select("id", "content", "ref"),
            _set_rows(size),
            f"id {id_type}, ref bigint, set_key bigint, n bigint, sketch binary",
        ),
        "set-rows",
    )
    sets = stage(
        rows.where(F.col("set_key").isNotNull())
        .groupBy("set_key")
        .agg(
            F.max("n").alias("n"),
            F.min("ref").alias("wanted_ref"),
            F.min("id").alias("least_id"),
            F.first("sketch", ignorenulls=True).alias("sketch"),
        ),
        "sets",
    )
    linked = linked_sets(
        docs, sets.select("set_key", "n", "wanted_ref", "sketch"), size, threshold, block_sets, block_shingles
    )
    known = stage(
        sets.select("set_key", "least_id")
        .join(linked, F.col("set_key") == F.col("node"), "left")
        .select("set_key", "least_id", F.coalesce("root", "set_key").alias("component")),
        "components",
    )
    # of single sets the component is known; the others are few
    several = known.where(F.col("component") != F.col("set_key")).select("component").distinct()
    smallest = known.join(stage(several, "several"), "component").groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = known.join(stage(smallest, "smallest"), "component", "left").select(
        "set_key", F.coalesce("component_id", "least_id").alias("component_id")
    )
    component = F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return (
        rows.select("id", "n", "set_key")
        .join(stage(known, "smallest-ids"), "set_key", "left")
        .select("id", "n", component.alias("component_id"))
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    )


def op11_near_duplicates(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "kept"
    )


OP11_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT row, array_to_string(w[i:i + {SIZE - 1}], ' ') AS shingle
  FROM d, unnest(range(1, greatest(len(w) - {SIZE - 2}, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT row, count(*) AS n FROM s GROUP BY row),
pairs AS (
  SELECT a.row AS a, b.row AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.row <> b.row GROUP BY a.row, b.row),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.row = a JOIN n nb ON nb.row = b
  WHERE 100 * common >= {THRESHOLD} * (na.n + nb.n - common)),
reach AS (SELECT row AS a, row AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT r.a AS row, min(d.doc_id) AS component_id FROM reach r JOIN d ON d.row = r.b GROUP BY r.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d LEFT JOIN n USING (row) JOIN least USING (row)
"""
