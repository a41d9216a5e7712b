"""Near duplicates by sketches against brute force."""

import random
import re

import numpy as np
import pytest

from framesift.llm import sketches, text
from framesift.llm.components import components
from tests.llm.conftest import EDGES
from tests.llm.test_edges import near_copies


def shingles(content, size=3):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(text.WORD, content or "")]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(ids, rows, threshold=85):
    sets = [shingles(content) for content in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                old, new = label[i], label[j]
                label = [new if k == old else k for k in label]
    least = {}
    for i, k in enumerate(label):
        if ids[i] is not None:
            least[k] = min(least.get(k, ids[i]), ids[i])
    return [len(s) for s in sets], [least.get(k) for k in label]


def variants(count, seed=3):
    """Many copies of one text, each changed in places of its own, and chains of changes."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(500)}" for _ in range(150)]
    rows = []
    for _ in range(count):
        copy = list(base)
        for _ in range(draw.randrange(0, 7)):
            copy[draw.randrange(len(copy))] = f"x{draw.random()}"
        rows.append(" ".join(copy))
    chain = list(base)
    for _ in range(count // 3):
        chain[draw.randrange(len(chain))] = f"y{draw.random()}"
        rows.append(" ".join(chain))
    return rows


@pytest.mark.parametrize("blocks, most", [(1024, 4_000_000), (7, 4_000_000), (1024, 900)])
def test_near_duplicates_equal_brute_force(spark, blocks, most):
    rows = [row[1] for row in EDGES] + near_copies() + variants(45) + ["a b c", "a b c d", "a b", "a b", "A b "]
    ids = [None if i % 17 == 5 else 1000 - i for i in range(len(rows))]
    sizes, expected = brute_components(ids, rows)
    frame = spark.createDataFrame([(i, r, k) for k, (i, r) in enumerate(zip(ids, rows))], "doc_id bigint, text string, n long")
    found = sketches.near_duplicates(frame.repartition(3), block_sets=blocks, block_shingles=most)
    got = sorted(map(tuple, found.collect()), key=repr)
    want = [(i, n, c, i == c) for i, n, c in zip(ids, sizes, expected)]
    assert got == sorted(want, key=repr)


def test_edge_rows_and_clashing_names(spark, edges):
    found = sketches.near_duplicates(edges)
    ids, rows = [row[0] for row in EDGES], [row[1] for row in EDGES]
    sizes, expected = brute_components(ids, rows)
    want = [(i, n, c, i == c) for i, n, c in zip(ids, sizes, expected)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark, nothing):
    found = sketches.near_duplicates(nothing)
    assert found.columns == ["id", "n", "component_id", "kept"] and found.count() == 0


def test_every_coordinate_is_filled_and_agrees_as_the_sets_do():
    draw = np.random.Generator(np.random.PCG64(5))
    for n, shared in [(1, 1), (2, 1), (7, 6), (20, 17), (400, 340), (3000, 1500)]:
        union = 2 * n - shared
        errors = []
        for _ in range(40):
            items = draw.integers(0, 1 << 63, union, dtype=np.uint64)
            a, b = np.unique(items[:n]), np.unique(items[n - shared :])
            one, two = sketches.sketches([a, b])
            alone = sketches.sketches([b])[0]
            assert (alone == two).all()  # whatever else is in the batch
            errors.append((one == two).mean() - shared / union)
        assert abs(np.mean(errors)) < 0.04 and np.std(errors) < 0.06


def test_links_are_not_lost_by_bands_or_agreement():
    draw = np.random.Generator(np.random.PCG64(9))
    least = sketches.agreeing(sketches.THRESHOLD)
    assert 64 < least < 109 and sketches.agreeing(100) == sketches.COORDINATES
    for n in (6, 17, 60, 300, 2000):
        for _ in range(60):
            changed = int(n * 0.15 / 1.85)
            items = draw.integers(0, 1 << 63, n + changed, dtype=np.uint64)
            one, two = sketches.sketches([np.unique(items[:n]), np.unique(items[changed:])])
            assert (one == two).sum() >= least
            assert (sketches.bands(one[None]) == sketches.bands(two[None])).any()


def test_linked_is_exact_at_the_threshold():
    x = np.arange(100, dtype=np.uint64)
    assert sketches.linked(x, x[:85], 85) and not sketches.linked(x, x[:84], 85)


@pytest.mark.parametrize("rows", [3, 500_000])
def test_components_of_paths_stars_and_rings(spark, monkeypatch, rows):
    monkeypatch.setattr("framesift.llm.components.ROWS", rows)
    draw = random.Random(rows)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200 + i, 100) for i in range(50)] + [(300 + i, 300 + (i + 1) % 9) for i in range(9)]
    edges += [(b, a) for a, b in edges[:30]] + [(5, 5), (None, 4), (4, None), (-7, 900), (900, -3)]
    draw.shuffle(edges)
    label = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            old, new = label.get(b, b), label.get(a, a)
            label.setdefault(a, a), label.setdefault(b, b)
            label = {k: new if v == old else v for k, v in label.items()}
    least = {}
    for k, v in label.items():
        least[v] = min(least.get(v, k), k)
    frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {k: least[v] for k, v in label.items() if least[v] != k}
