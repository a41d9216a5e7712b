"""N-gram Jaccard join: a prefix-tree join of shingle sets.

A document's set holds its distinct ``SIZE``-word shingles; with fewer words it is the whole
sequence as one; without words it is empty and linked with nothing. Two documents are linked
when ``100 * |x and y| >= THRESHOLD * |x or y|``. Shingles are 64-bit hashes, equal sets are
found by a 64-bit digest.

1. Every text gives the digest and the size of its set. Of the shingles, one in ``SAMPLE`` by
   hash is looked up in all documents. Linked documents share at least ``THRESHOLD`` percent
   of their shingles with another one; a set whose looked-up shingles are shared so rarely
   that this has a probability below ``DOUBT`` (Hoeffding's bound) has no link. Small sets
   are never left out that way.
2. The texts of the remaining sets are moved, one for each set, and their sets are written.
   Their shingles have one global order: by hash, but the ``HOT`` shingles that repeat most
   within batches come last. The order decides nothing but cost. Linked sets share a shingle
   among their first ``n - ceil(t * n) + 1`` ones. Only these are shuffled, already combined
   on the map side: of the sets with one shingle and of like size a task sends on the first
   one and one edge for each other. What meets is joined to clusters, so that linked sets
   are always in one cluster.
   A cluster above ``BLOCK_SETS`` sets or ``BLOCK_SHINGLES`` shingles is first taken apart, as
   with more documents more sets share a shingle by chance, and soon most sets are one cluster:
   linked sets share even ``SHARED`` shingles among that many more first ones. Sets that share
   a shingle which few have are paired, and pairs that meet less often are dropped; shingles that
   more than ``PAIRED`` sets have link as before.
3. Every cluster is joined in a prefix tree of its sets: walking the tree, a set adds up its
   overlap once for all sets that share a path, and leaves subtrees out of reach by their
   sizes and by what remains. A cluster that is still above those sizes is cut into blocks and
   every pair of blocks is a task of its own.
4. The links give components (``components.py``) and, for every set, their number.

No task emits pairs: it emits, for each set, the smallest set it is connected with and its
number of links.

Null and empty texts have an empty set. A null id is never a component's smallest id unless
all are null; the component is then null. Repeated rows are documents of their own, linked
with each other unless empty. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.llm.components import components
from framesift.llm.membership import Filter
from framesift.llm.text import ROWS, free_name, map_arrow, mixed, slices, utf8, word_hashes
from framesift.workspace import stage

SIZE = 5
THRESHOLD = 75
SAMPLE = 8
DOUBT = 1e-15
HOT = 1 << 17
BLOCK_SETS = 1024
BLOCK_SHINGLES = 4_000_000
#: Shingles that sets of a large cluster must share to stay together.
SHARED = 8
#: Sets that are paired one by one where they share a shingle; more are linked with one of them.
PAIRED = 32
#: Map-side buffer of prefix shingles.
BUFFER = 500_000
#: Sets of linkable size are at most one class apart.
CLASS_WIDTH = math.log(100 / THRESHOLD) * 1.0001

_MULTIPLIERS = np.array([pow(0xA24BAED4963EE407, k + 1, 1 << 64) for k in range(64)], np.uint64)


def shingle_sets(texts: pa.Array, size: int = SIZE):
    """The sorted shingle set of every text."""
    for at in range(0, len(texts), ROWS):
        yield from _shingle_sets(texts.slice(at, ROWS), size)


def _shingle_sets(texts: pa.Array, size: int):
    words, offsets = word_hashes(texts)
    rolled = np.zeros(max(len(words) - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        rolled += words[k : k + len(rolled)] * _MULTIPLIERS[k]
    rolled = mixed(rolled)
    for row in range(len(offsets) - 1):
        begin, end = int(offsets[row]), int(offsets[row + 1])
        if end - begin >= size:
            yield np.unique(rolled[begin : end - size + 1])
        elif end > begin:
            few = words[begin:end] * _MULTIPLIERS[size : size + end - begin]
            yield mixed(few.sum(keepdims=True) + np.uint64(end - begin))
        else:
            yield np.zeros(0, dtype=np.uint64)


def set_digest(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def _looked_up(shingles: np.ndarray) -> np.ndarray:
    return shingles[: np.searchsorted(shingles, np.uint64((1 << 64) // SAMPLE))]


def _set_rows(size: int):
    def rows(batches):
        for batch in slices(batches):
            keys, sizes, samples = [], [], []
            for shingles in shingle_sets(batch.column(2), size):
                keys.append(set_digest(shingles) if len(shingles) else None)
                sizes.append(len(shingles))
                samples.append(len(_looked_up(shingles)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(c, pa.int64()) for c in (keys, sizes, samples))],
                ["id", "ref", "set_key", "n", "looked_up"],
            )

    return rows


def _sampled_rows(size: int):
    """(shingle, set, 0) for a shingle that one set in this task has; (shingle, a set, 1) for
    one that several have, and (null, set, how many of its shingles these are)."""

    def combined(shingles, keys):
        shingles, keys = np.concatenate(shingles), np.concatenate(keys)
        order = np.argsort(shingles, kind="stable")
        shingles, keys = shingles[order], keys[order]
        starts = np.flatnonzero(np.r_[True, shingles[1:] != shingles[:-1]])
        counts = np.diff(np.r_[starts, len(shingles)])
        several = np.repeat(counts > 1, counts)
        names, times = np.unique(keys[several], return_counts=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([_long(shingles[starts]), pa.nulls(len(names), pa.int64())]),
                pa.array(np.r_[keys[starts], names]),
                pa.array(np.r_[counts > 1, times].astype(np.int32)),
            ],
            ["shingle", "set_key", "seen"],
        )

    def rows(batches):
        shingles, keys, held, seen = [], [], 0, set()
        for batch in batches:
            for found in shingle_sets(batch.column(0), size):
                if not len(found) or (key := set_digest(found)) in seen:
                    continue
                seen.add(key)
                some = _looked_up(found)
                shingles.append(some)
                keys.append(np.full(len(some), key, np.int64))
                held += len(some)
                if held >= BUFFER:
                    yield combined(shingles, keys)
                    shingles, keys, held, seen = [], [], 0, set()
        if held:
            yield combined(shingles, keys)

    return rows


def _shared_counts(batches):
    """(set, how many of its shingles another set has); the rows of a shingle come together.
    The rows of the last shingle wait for the next batch: one for each map task at most."""
    kept = None

    def counted(shingle, key, seen):
        starts = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        run = np.cumsum(np.r_[True, shingle[1:] != shingle[:-1]]) - 1
        shared = np.minimum.reduceat(key, starts) != np.maximum.reduceat(key, starts)
        shared |= np.maximum.reduceat(seen, starts) > 0
        names, times = np.unique(key[shared[run] & (seen == 0)], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(times)], ["set_key", "shared"])

    for batch in batches:
        shingle, key, seen = batch.columns
        given = np.asarray(shingle.is_valid())
        if not given.all():
            none = pa.array(~given)
            yield pa.RecordBatch.from_arrays(
                [key.filter(none), seen.filter(none).cast(pa.int64())], ["set_key", "shared"]
            )
        some = [np.asarray(column.filter(pa.array(given))) for column in (shingle, key, seen)]
        if kept is not None:
            some = [np.r_[old, new] for old, new in zip(kept, some)]
        if len(some[0]):
            cut = int(np.searchsorted(some[0], some[0][-1]))
            if cut:
                yield counted(*(column[:cut] for column in some))
            kept = [column[cut:] for column in some]
    if kept is not None:
        yield counted(*kept)


def _may_link(shared: Column, looked_up: Column, threshold: int, doubt: float) -> Column:
    if not doubt:
        return F.lit(True)
    least = threshold / 100 - F.sqrt(F.lit(-math.log(doubt) / 2) / looked_up)
    return (looked_up == 0) | (shared / looked_up >= least)


def _common(batches):
    """Shingles of several sets of a batch, with their number."""
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        together = data[offsets[0] : offsets[-1]].copy().view(np.uint64)
        together.sort()
        again = together[1:] == together[:-1]
        starts = np.flatnonzero(np.diff(np.r_[False, again, False].astype(np.int8)))
        first, last = starts[::2], starts[1::2]  # runs of equal ones
        yield pa.RecordBatch.from_arrays(
            [_long(together[first]), pa.array(last - first + 1)], ["shingle", "count"]
        )


def _hot(sets: DataFrame, most: int):
    """The most frequent shingles, sorted, and the place of each by rising frequency."""
    found = (
        map_arrow(sets.select("shingles"), _common, "shingle bigint, count bigint")
        .groupBy("shingle")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "shingle")
        .limit(most)
        .toPandas()
    )
    shingles = found["shingle"].to_numpy(dtype=np.int64).view(np.uint64)
    ranks = np.arange(len(shingles), 0, -1, dtype=np.int64)
    order = np.argsort(shingles)
    return shingles[order], ranks[order]


def must_share(n, threshold: int, shared: int):
    """How many shingles, ``shared`` or all that a link takes, sets of up to ``n`` must share
    among their first ``prefix_length(n, threshold, shared)`` ones."""
    return np.minimum(shared, -(-threshold * n // 100))


def prefix_length(n: int, threshold: int, shared: int = 1) -> int:
    """How many first shingles two linked sets must share one of, or ``shared``."""
    return n - -(-threshold * n // 100) + int(must_share(n, threshold, shared))


def _prefix(shingles: np.ndarray, hot, threshold: int, shared: int = 1) -> np.ndarray:
    length = prefix_length(len(shingles), threshold, shared)
    known, ranks = hot
    if not len(known):
        return shingles[:length]
    place = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
    common = known[place] == shingles
    rare = shingles[~common][:length]
    if len(rare) == length:
        return rare
    order = np.argsort(ranks[place[common]], kind="stable")
    return np.r_[rare, shingles[common][order[: length - len(rare)]]]


def _prefix_rows(threshold: int, shared_hot):
    """(shingle, size class, set) of the first set with both in this task, and an edge
    (null shingle) to it from every other one."""
    names = ["shingle", "size_class", "set_key", "first"]

    def combined(shingles, classes, keys):
        shingles, classes, keys = np.concatenate(shingles), np.concatenate(classes), np.concatenate(keys)
        order = np.lexsort((keys, classes, shingles))
        shingles, classes, keys = shingles[order], classes[order], keys[order]
        head = np.r_[True, (shingles[1:] != shingles[:-1]) | (classes[1:] != classes[:-1])]
        lead = keys[np.flatnonzero(head)][np.cumsum(head) - 1]
        edges = np.unique(np.stack([keys[~head], lead[~head]], axis=1), axis=0)
        edges = edges[edges[:, 0] != edges[:, 1]]
        rows, more = int(head.sum()), len(edges)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([_long(shingles[head]), pa.nulls(more, pa.int64())]),
                pa.array(np.r_[classes[head], np.full(more, -1)], pa.int32()),
                pa.array(np.r_[keys[head], edges[:, 0]]),
                pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(edges[:, 1])]),
            ],
            names,
        )

    def rows(batches):
        hot = shared_hot.value
        shingles, classes, keys, held = [], [], [], 0
        for batch in slices(batches):
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.frombuffer(data, np.uint64)
                some = _prefix(found, hot, threshold)
                shingles.append(some)
                classes.append(np.full(len(some), int(math.log(len(found)) / CLASS_WIDTH), np.int32))
                keys.append(np.full(len(some), key, np.int64))
                held += len(some)
                if held >= BUFFER:
                    yield combined(shingles, classes, keys)
                    shingles, classes, keys, held = [], [], [], 0
        if held:
            yield combined(shingles, classes, keys)

    return rows


def _cluster_edges(batches):
    """Edges between sets that share a shingle and are at most one size class apart; the
    rows of a shingle come together, by class. Sets of a class are linked with its first one,
    and the first ones of neighbouring classes with each other: stars, not chains. Only the
    first set of the last class is remembered."""
    last = None
    for batch in batches:
        shingle, size_class, key, first = (batch.column(i) for i in range(4))
        given = np.asarray(shingle.is_valid())
        edges = pa.Table.from_arrays(
            [key.filter(pa.array(~given)), first.filter(pa.array(~given))], ["a", "b"]
        )
        shingle = np.asarray(shingle.filter(pa.array(given)))
        size_class = np.asarray(size_class.filter(pa.array(given)))
        key = np.asarray(key.filter(pa.array(given)))
        if len(key):
            if last is not None:
                shingle, size_class, key = (
                    np.r_[[old], new] for old, new in zip(last, (shingle, size_class, key))
                )
            head = np.r_[True, (shingle[1:] != shingle[:-1]) | (size_class[1:] != size_class[:-1])]
            lead = key[head]
            near = (shingle[head][1:] == shingle[head][:-1]) & (np.diff(size_class[head]) <= 1)
            pairs = np.concatenate(
                [
                    np.stack([key, lead[np.cumsum(head) - 1]], axis=1)[~head],
                    np.stack([lead[1:], lead[:-1]], axis=1)[near],
                ]
            )
            pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
            last = shingle[-1], size_class[-1], lead[-1]
            edges = pa.concat_tables(
                [edges, pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])]
            )
        yield from edges.combine_chunks().to_batches()


def _leads(shingle, size_class, key):
    """Of rows by shingle and class, which ones are the first of both, and of every row the key of
    its first one."""
    head = np.r_[True, (shingle[1:] != shingle[:-1]) | (size_class[1:] != size_class[:-1])][: len(key)]
    return head, key[head][np.cumsum(head) - 1]


def _classes(n: np.ndarray) -> np.ndarray:
    return (np.log(n) / CLASS_WIDTH).astype(np.int32)


def _longer_prefix_rows(threshold: int, shared: int, shared_hot, wanted: Filter):
    """(shingle, size, set) of the sets that the filter takes, but of a shingle that more than
    ``PAIRED`` of them have in this task only the first set of each class, as ``many``, and an
    edge (null shingle) to it from every other one."""
    names = ["shingle", "n", "set_key", "first", "many"]

    def combined(shingles, sizes, keys):
        shingles, sizes, keys = (np.concatenate(column) for column in (shingles, sizes, keys))
        order = np.lexsort((keys, sizes, shingles))
        shingles, sizes, keys = shingles[order], sizes[order], keys[order]
        starts = np.flatnonzero(np.r_[True, shingles[1:] != shingles[:-1]])
        counts = np.diff(np.r_[starts, len(shingles)])
        many = np.repeat(counts > PAIRED, counts)
        head, lead = _leads(shingles, _classes(sizes), keys)
        stay = head | ~many
        edges = np.unique(np.stack([keys[~stay], lead[~stay]], axis=1), axis=0)
        rows, more = int(stay.sum()), len(edges)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([_long(shingles[stay]), pa.nulls(more, pa.int64())]),
                pa.array(np.r_[sizes[stay], np.zeros(more, np.int64)]),
                pa.array(np.r_[keys[stay], edges[:, 0]]),
                pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(edges[:, 1])]),
                pa.array(np.r_[many[stay], np.zeros(more, bool)].astype(np.int32)),
            ],
            names,
        )

    def rows(batches):
        hot = shared_hot.value
        shingles, sizes, keys, held = [], [], [], 0
        for batch in slices(batches):
            batch = batch.filter(pa.array(wanted.has(batch.column(0).to_numpy())))
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.frombuffer(data, np.uint64)
                some = _prefix(found, hot, threshold, shared)
                shingles.append(some)
                sizes.append(np.full(len(some), len(found), np.int64))
                keys.append(np.full(len(some), key, np.int64))
                held += len(some)
                if held >= BUFFER:
                    yield combined(shingles, sizes, keys)
                    shingles, sizes, keys, held = [], [], [], 0
        if held:
            yield combined(shingles, sizes, keys)

    return rows


def _met_often(threshold: int, shared: int):
    """(a, b, how often they met, how often they must) of sets of linkable size that share a
    shingle which at most ``PAIRED`` sets have. Sets that share another one are linked as by
    ``_cluster_edges`` and have met as often as they must. The rows of a shingle come together, by
    size; those of the last one wait for the next batch: some for each map task at most."""

    def linked(shingle, n, key):
        size_class = _classes(n)
        head, lead = _leads(shingle, size_class, key)
        leads = key[head]
        near = (shingle[head][1:] == shingle[head][:-1]) & (np.diff(size_class[head]) <= 1)
        return np.r_[key[~head], leads[1:][near]], np.r_[lead[~head], leads[:-1][near]]

    def pairs(shingle, n, key, many):
        starts = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        counts = np.diff(np.r_[starts, len(shingle)])
        many = np.repeat((counts > PAIRED) | (np.maximum.reduceat(many, starts) > 0), counts)
        a, b = linked(shingle[many], n[many], key[many])
        every = np.full(len(a), shared)
        yield a, b, every, every
        shingle, n, key = shingle[~many], n[~many], key[~many]
        for apart in range(1, PAIRED):
            alike = np.flatnonzero(shingle[apart:] == shingle[:-apart])
            alike = alike[100 * n[alike] >= threshold * n[alike + apart]]
            must = must_share(n[alike + apart], threshold, shared)
            yield key[alike], key[alike + apart], np.ones(len(alike), np.int64), must

    def counted(held):
        a, b, met, must = (np.concatenate(column) for column in zip(*held))
        a, b = np.minimum(a, b), np.maximum(a, b)
        order = np.lexsort((b, a))
        order = order[a[order] != b[order]]
        a, b, met, must = a[order], b[order], met[order], must[order]
        starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)])
        if len(starts):
            met, must = np.add.reduceat(met, starts), np.maximum.reduceat(must, starts)
            columns = a[starts], b[starts], met, must
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "met", "must"])

    def rows(batches):
        kept, held, size = None, [], 0
        for batch in batches:
            given = np.asarray(batch.column(0).is_valid())
            edges = batch.filter(pa.array(~given))
            every = np.full(edges.num_rows, shared)
            held.append((np.asarray(edges.column(2)), np.asarray(edges.column(3)), every, every))
            some = [np.asarray(column) for column in batch.select([0, 1, 2, 4]).filter(pa.array(given)).columns]
            if kept is not None:
                some = [np.r_[old, new] for old, new in zip(kept, some)]
            if len(some[0]):
                cut = int(np.searchsorted(some[0], some[0][-1]))
                if cut:
                    new = list(pairs(*(column[:cut] for column in some)))
                    held += new
                    size += sum(len(part[0]) for part in new)
                kept = [column[cut:] for column in some]
            size += len(every)
            if size >= BUFFER:
                yield from counted(held)
                held, size = [], 0
        if kept is not None:
            held += pairs(*kept)
        if held:
            yield from counted(held)

    return rows


class PrefixTree:
    """Sets of local shingle numbers in a path-compressed prefix tree, level by level."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.sizes = sizes
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        # nodes on the rightmost path: [depth, node]; children and parents come from it
        depth, parent, low, high, ends = [0], [-1], [0], [0], [[]]
        owner = [order[0] if order else -1]
        path, before = [0], None
        for i in order:
            tokens = sets[i]
            common = 0
            if before is not None:
                length = min(len(before), len(tokens))
                differ = np.flatnonzero(before[:length] != tokens[:length])
                common = int(differ[0]) if len(differ) else length
            below = -1
            while depth[path[-1]] > common:
                below = path.pop()
            if depth[path[-1]] < common:  # split the edge that was left
                node = len(depth)
                depth.append(common)
                parent.append(path[-1])
                ends.append([])
                owner.append(owner[below])
                parent[below] = node
                path.append(node)
            if len(tokens) > common:
                node = len(depth)
                depth.append(len(tokens))
                parent.append(path[-1])
                ends.append([])
                owner.append(i)
                path.append(node)
            ends[path[-1]].append(i)
            before = tokens
        count = len(depth)
        self.depth = np.array(depth)
        self.ends = ends
        low, high = np.full(count, 1 << 60), np.zeros(count, dtype=np.int64)
        children: list[list[int]] = [[] for _ in range(count)]
        for node in range(1, count):
            children[parent[node]].append(node)
        walk = [0]
        for node in walk:
            walk.extend(children[node])
        for node in reversed(walk):
            for i in ends[node]:
                low[node], high[node] = min(low[node], sizes[i]), max(high[node], sizes[i])
            if node:
                up = parent[node]
                low[up], high[up] = min(low[up], low[node]), max(high[up], high[node])
        self.low, self.high, self.children = low, high, [np.array(c, dtype=np.int64) for c in children]
        # what remains of the largest set below a node, counted in its own tokens
        rest = np.zeros(count, dtype=np.int64)
        for node in reversed(walk):
            if node:
                up = parent[node]
                rest[up] = max(rest[up], rest[node] + depth[node] - depth[up])
        self.rest = rest
        edges = [sets[owner[n]][depth[parent[n]] : depth[n]] if n else sets[0][:0] for n in range(count)]
        self.edge_start = np.cumsum([0] + [len(e) for e in edges])
        self.tokens = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        self.last = np.array([e[-1] if len(e) else -1 for e in edges])
        self.has_ends = np.array([bool(e) for e in ends])

    def linked(self, tokens: np.ndarray, size: int, mask: np.ndarray, threshold: int) -> list[int]:
        """Numbers of the sets linked with this one. ``mask`` marks its tokens."""
        found: list[int] = []
        survivors, overlap = np.array([0]), np.array([0])
        while len(survivors):
            nodes = [self.children[n] for n in survivors]
            above = np.repeat(overlap, [len(n) for n in nodes])
            nodes = np.concatenate(nodes)
            if not len(nodes):
                break
            fits = (100 * self.high[nodes] >= threshold * size) & (100 * size >= threshold * self.low[nodes])
            nodes, above = nodes[fits], above[fits]
            if not len(nodes):
                break
            starts, lengths = self.edge_start[nodes], self.edge_start[nodes + 1] - self.edge_start[nodes]
            begin = np.cumsum(lengths) - lengths
            at = np.repeat(starts - begin, lengths) + np.arange(int(lengths.sum()))
            overlap = above + np.add.reduceat(mask[self.tokens[at]].astype(np.int64), begin)
            rest = np.minimum(
                len(tokens) - np.searchsorted(tokens, self.last[nodes], side="right"), self.rest[nodes]
            )
            # |x and y| needed for any size in the subtree: the smallest one needs least
            least = np.maximum(self.low[nodes], -(-threshold * size // 100))
            reach = (100 + threshold) * (overlap + rest) >= threshold * (size + least)
            nodes, overlap = nodes[reach], overlap[reach]
            for k in np.flatnonzero(self.has_ends[nodes]):
                for i in self.ends[nodes[k]]:
                    if 100 * overlap[k] >= threshold * (size + self.sizes[i] - overlap[k]):
                        found.append(i)
            survivors = nodes
        return found


def join_sets(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: int):
    """Links between the sets ``left`` and the sets ``right`` (or within them, if they are
    the same): for each of ``left``, its linked sets of ``right``, itself left out."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    every = np.concatenate(sets)
    values, number, counts = np.unique(every, return_inverse=True, return_counts=True)
    # frequent shingles first: longer common paths. Shingles of one set overlap with nothing.
    order = np.lexsort((values, -counts))
    place = np.empty(len(values), dtype=np.int64)
    place[order] = np.arange(len(values))
    place = np.where(counts > 1, place, -1)[number]
    local, at = [], 0
    for size in sizes:
        tokens = place[at : at + size]
        local.append(np.sort(tokens[tokens >= 0]))
        at += size
    tree = PrefixTree([local[i] for i in right], sizes[right])
    mask = np.zeros(int((counts > 1).sum()), dtype=bool)
    for i in left:
        mask[local[i]] = True
        near = [right[k] for k in tree.linked(local[i], int(sizes[i]), mask, threshold)]
        mask[local[i]] = False
        yield i, [k for k in near if k != i]


def _joined(keys, copies, blocks, sets, threshold):
    """(set, smallest connected set, number of linked documents) within one task's rows."""
    keys, copies, blocks = np.array(keys), np.array(copies), np.array(blocks)
    label = np.arange(len(keys))
    links = np.zeros(len(keys), dtype=np.int64)
    names = np.unique(blocks)
    left = np.flatnonzero(blocks == names[0])
    right = np.flatnonzero(blocks == names[-1])
    for i, near in join_sets(sets, left, right, threshold):
        if near:
            near = np.array(near)
            links[i] += copies[near].sum()
            if len(names) > 1:
                links[near] += copies[i]
            groups = np.unique(label[np.r_[near, i]])
            if len(groups) > 1:
                label[np.isin(label, groups)] = groups[0]
    least = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(least, label, keys)
    return keys, least[label], links


def _join_tasks(threshold: int):
    """Rows come sorted by task; a task's rows are joined as soon as the next one begins. A task
    of two blocks of which one is empty has nothing to join: the other one has its own task."""

    def run(held):
        keys, copies, blocks, sets = [], [], [], []
        for key, count, block, _, data in held:
            keys.append(key)
            copies.append(count)
            blocks.append(block)
            sets.append(np.frombuffer(data, dtype=np.uint64))
        found = _joined(keys, copies, blocks, sets, threshold)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in found], ["set_key", "root", "links"]
        )

    def whole(held):
        wanted = {block for _, _, *pair, _ in held for block in pair}
        return len(held) > 1 and len({block for _, _, block, _, _ in held}) == len(wanted)

    def rows(batches):
        current, held, seen = None, [], set()
        for batch in slices(batches):
            for task, key, count, block, other, data in zip(*(c.to_pylist() for c in batch.columns)):
                if task != current:
                    if whole(held):
                        yield run(held)
                    current, held, seen = task, [], set()
                if key not in seen:
                    seen.add(key)
                    held.append((key, count, block, other, data))
        if whole(held):
            yield run(held)

    return rows


def _wanted_sets(size: int):
    """The sets of the rows whose text still has the wanted set, once in this task."""

    def rows(batches):
        seen = set()
        for batch in slices(batches):
            keys = batch.column(1).to_pylist()
            wanted, found = [], []
            for row, shingles in enumerate(shingle_sets(batch.column(0), size)):
                key = keys[row]
                if len(shingles) and key not in seen and set_digest(shingles) == key:
                    seen.add(key)
                    wanted.append(row)
                    found.append(shingles.tobytes())
            some = batch.select([1, 2, 3]).take(pa.array(wanted, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(found, pa.binary())], ["set_key", "copies", "n", "shingles"]
            )

    return rows


def linked_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    threshold: int = THRESHOLD,
    block_sets: int = BLOCK_SETS,
    hot: int = HOT,
    doubt: float = DOUBT,
) -> DataFrame:
    """For every row of ``df``: ``id``, ``ref`` (a hash of id and text), ``n`` (size of the
    set), ``component`` (null for an empty set), ``component_id`` (smallest id reachable by
    links, itself included) and ``links`` (number of linked rows). With ``doubt=0`` no set is
    left out by the shingles that are looked up. Runs several jobs."""
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("content"))
    id_type = docs.schema["id"].dataType.simpleString()
    docs = docs.withColumn("ref", F.xxhash64("id", "content"))

    rows = stage(
        map_arrow(
            docs.select("id", "ref", "content"),
            _set_rows(size),
            f"id {id_type}, ref bigint, set_key bigint, n bigint, looked_up bigint",
        ),
        "set-rows",
    )
    sampled = map_arrow(
        docs.select("content"), _sampled_rows(size), "shingle bigint, set_key bigint, seen int"
    )
    shared = map_arrow(
        sampled.repartition(F.coalesce("shingle", "set_key")).sortWithinPartitions("shingle"),
        _shared_counts,
        "set_key bigint, shared bigint",
    )
    per_set = stage(
        rows.where(F.col("set_key").isNotNull())
        .groupBy("set_key")
        .agg(
            F.count("*").alias("copies"),
            F.min("ref").alias("wanted_ref"),
            F.first("n").alias("n"),
            F.first("looked_up").alias("looked_up"),
            F.min("id").alias("least_id"),
        )
        .join(shared.groupBy("set_key").agg(F.sum("shared").alias("shared")), "set_key", "left"),
        "sets",
    )
    may_link = _may_link(F.coalesce("shared", F.lit(0)), F.col("looked_up"), threshold, doubt)
    wanted = per_set.where(may_link).select("wanted_ref", "set_key", "copies", "n")
    likely = docs.where(Filter(wanted, "wanted_ref").may_have("ref"))
    sets = stage(
        map_arrow(
            likely.join(wanted, F.col("ref") == F.col("wanted_ref")).select("content", "set_key", "copies", "n"),
            _wanted_sets(size),
            "set_key bigint, copies bigint, n bigint, shingles binary",
        ),
        "shingles",
    )
    shared_hot = spark.sparkContext.broadcast(_hot(sets, hot))  # at most HOT shingles
    prefixes = map_arrow(
        sets.select("set_key", "shingles"),
        _prefix_rows(threshold, shared_hot),
        "shingle bigint, size_class int, set_key bigint, first bigint",
    )
    met = map_arrow(
        prefixes.repartition(F.coalesce("shingle", "set_key")).sortWithinPartitions(
            "shingle", "size_class"
        ),
        _cluster_edges,
        "a bigint, b bigint",
    )
    size_of = sets.select(F.col("set_key").alias("node"), "n").dropDuplicates(["node"])

    def clusters_of(edges: DataFrame) -> DataFrame:
        found = components(edges)
        found = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
        return found.join(size_of, "node")

    def blocks_of(clusters: DataFrame) -> DataFrame:
        return clusters.groupBy("root").agg(
            F.greatest(
                F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") / BLOCK_SHINGLES)
            ).cast("int").alias("blocks")
        )

    clusters = stage(clusters_of(met), "clusters")
    blocks = stage(blocks_of(clusters), "block-counts")
    if not (large := blocks.where("blocks > 1")).isEmpty():
        members = stage(clusters.join(large, "root").select("node"), "members")
        longer = map_arrow(
            sets.select("set_key", "shingles"),
            _longer_prefix_rows(threshold, SHARED, shared_hot, Filter(members, "node")),
            "shingle bigint, n bigint, set_key bigint, first bigint, many int",
        )
        often = map_arrow(
            longer.repartition(F.coalesce("shingle", "set_key")).sortWithinPartitions("shingle", "n"),
            _met_often(threshold, SHARED),
            "a bigint, b bigint, met bigint, must bigint",
        )
        often = often.groupBy("a", "b").agg(F.sum("met").alias("met"), F.max("must").alias("must"))
        # the filter may have taken sets of other clusters
        finer = stage(clusters_of(often.where("met >= must")).join(members, "node"), "finer")
        label = stage(finer.groupBy("root").agg(F.min("node").alias("label")), "labels")
        finer = finer.join(label, "root").select("node", F.col("label").alias("root"), "n")
        clusters = stage(
            clusters.join(large, "root", "left_anti").select("node", "root", "n").unionByName(finer), "clusters"
        )
        blocks = stage(blocks_of(clusters), "block-counts")
    placed = stage(
        clusters.join(blocks, "root").select(
            "node",
            F.col("root").alias("cluster"),
            "blocks",
            F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        ),
        "blocks",
    )
    tasks = (
        sets.where(Filter(placed, "node").may_have("set_key"))
        .join(placed, sets["set_key"] == placed["node"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
            "set_key",
            "copies",
            "block",
            "other",
            "shingles",
        )
    )
    verified = stage(
        map_arrow(
            tasks.repartition("task").sortWithinPartitions("task"),
            _join_tasks(threshold),
            "set_key bigint, root bigint, links bigint",
        ),
        "links",
    )
    linked = components(verified.select(F.col("set_key").alias("a"), F.col("root").alias("b")))
    counted = verified.groupBy("set_key").agg(F.sum("links").alias("links"))
    known = (
        per_set.join(linked, per_set["set_key"] == linked["node"], "left")
        .join(counted, "set_key", "left")
        .select(
            "set_key",
            "least_id",
            F.coalesce(linked["root"], F.col("set_key")).alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        )
    )
    known = stage(known, "components")
    smallest = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    # a written table, so that the rows of a large component can be split
    known = known.join(stage(smallest, "smallest"), "component")
    return rows.join(known, "set_key", "left").select(
        "id",
        "ref",
        "n",
        "component",
        F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without those that are linked, over any number of links, with a row
    of a smaller id (nulls last) or, at equal ids, of a smaller hash. Of repeated rows the one
    stays that is smallest by its other columns, as far as these can be ordered; rows with an
    empty set all stay. All columns as they are.

    Rows that surely stay are not moved: only rows that the filter takes for dropped or
    repeated ones pass the exact join."""
    linked = stage(linked_documents(df, key, text, **options), "linked")
    named = linked.where(F.col("component").isNotNull())
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("ref").alias("ref"))
    first = named.groupBy("component").agg(F.min(order)["ref"].alias("first"))
    marked = stage(
        named.join(first, "component")
        .groupBy(F.col("ref").alias("marked"))
        .agg(F.max(F.col("ref") != F.col("first")).alias("dropped"), F.count("*").alias("times"))
        .where(F.col("dropped") | (F.col("times") > 1)),
        "marked",
    )
    ref = free_name(df, "ref")
    rows = df.withColumn(ref, F.xxhash64(key, text))
    likely = Filter(marked, "marked").may_have(ref)
    exact = (
        rows.where(likely)
        .join(marked.withColumnsRenamed({c: free_name(df, f"_{c}") for c in marked.columns}),
              F.col(ref) == F.col(free_name(df, "_marked")), "left")
    )
    dropped, times = F.col(free_name(df, "_dropped")), F.col(free_name(df, "_times"))
    single = exact.where(dropped.isNull()).select(*rows.columns)
    ordered = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    whole = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    repeated = (
        exact.where(~dropped & (times > 1))
        .groupBy(F.col(ref).alias(free_name(df, "_of")))
        .agg(F.min_by(whole, F.struct(*ordered)).alias(free_name(df, "_row")))
        .select(f"{free_name(df, '_row')}.*")
    )
    return rows.where(~likely).unionByName(single).unionByName(repeated).select(*df.columns)


def op9_jaccard_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return linked_documents(docs).select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("links").alias("n_links"),
    )


OP9_SQL = rf"""
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
least AS (SELECT r.a AS row, min(d.doc_id) AS component_id FROM reach r JOIN d ON d.row = r.b GROUP BY r.a),
many AS (SELECT a AS row, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN n USING (row) JOIN least USING (row) LEFT JOIN many USING (row)
"""
