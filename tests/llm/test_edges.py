"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import ctypes
import math
import os
import random
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framesift import workspace
from framesift.llm import (
    components, decontaminate, jaccard, language, mixture, quality, rollup, scoring, search, secrets,
    slots, text,
)
from tests import sqlcheck
from tests.llm.conftest import EDGES, LONG, NEAR


def words_of(content):
    return [w.lower() for w in re.findall(text.WORD, content or "", re.A)]


def test_word_hashes_follow_words(monkeypatch):
    monkeypatch.setattr(text, "PIECE", 16)
    texts = [None, "", "A b  a\tB", LONG[:500], "é É é", "x" * 100, " lead", "trail "]
    for pattern in (text.WORD, text.ALNUM):
        hashes, offsets = text.word_hashes(pa.array(texts), pattern)
        seen = {}
        for row, content in enumerate(texts):
            lowered = re.sub("[A-Z]", lambda m: m[0].lower(), content or "")
            words = re.findall(pattern, lowered)
            own = hashes[offsets[row] : offsets[row + 1]].tolist()
            assert len(own) == len(words)
            for word, value in zip(words, own):
                assert seen.setdefault(word, value) == value
        assert len(set(seen.values())) == len(seen)


def test_workers_give_memory_back(monkeypatch):
    """After a task's rows, when none of them is held any more."""
    seen = []

    class Frame:
        sparkSession = None

        def mapInArrow(self, function, schema):
            return function

    class Pool:
        def release_unused(self):
            seen.append("released")

    monkeypatch.setattr(text, "ship_package", lambda spark: None)
    monkeypatch.setattr(text.pa, "default_memory_pool", Pool)
    task = text.map_arrow(Frame(), lambda batches: (seen.append(batch) or batch for batch in batches), "n int")
    assert list(task([1, 2])) == [1, 2] and seen == [1, 2, "released"]


def test_workers_give_back_what_malloc_holds(monkeypatch):
    """Freed arrays below others that are still there, as tasks leave them behind."""
    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("libc has no way to")

    def resident():
        return int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    class Frame:
        sparkSession = None

        def mapInArrow(self, function, schema):
            return function

    kept = []

    def task(batches):
        arrays = [np.ones(100_000, np.uint8) for _ in range(2000)]
        kept.extend(np.ones(2000, np.uint8) for _ in range(100))
        yield resident()
        del arrays

    monkeypatch.setattr(text, "ship_package", lambda spark: None)
    before = resident()
    (most,) = text.map_arrow(Frame(), task, "n int")([])
    assert most - before > 100 << 20 and resident() - before < 50 << 20


def shingles(content):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(text.WORD, content or "")]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_links(rows):
    sets = [shingles(content) for content in rows]
    links = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                links[i].add(j)
                links[j].add(i)
    return sets, links


def near_copies():
    """Groups of near copies around the threshold, with common passages."""
    draw = random.Random(4)
    common = " ".join(f"c{i}" for i in range(60))
    rows = []
    for group in range(8):
        base = [f"g{group}w{draw.randrange(300)}" for _ in range(draw.randrange(8, 160))]
        for _ in range(draw.randrange(1, 9)):
            copy = list(base)
            for _ in range(draw.randrange(0, 1 + len(base) // 12)):
                copy[draw.randrange(len(copy))] = f"e{draw.random()}"
            rows.append(" ".join(copy) + (" " + common if draw.random() < 0.3 else ""))
    return rows


@pytest.mark.parametrize("blocks", [3, 1024])
def test_jaccard_join_equals_brute_force(spark, blocks):
    rows = [row[1] for row in EDGES] + near_copies()
    ids = list(range(100, 100 + len(rows)))
    sets, links = brute_links(rows)
    frame = spark.createDataFrame(list(zip(ids, rows)), "doc_id bigint, text string").repartition(4)
    found = {r.id: r for r in jaccard.linked_documents(frame, block_sets=blocks).collect()}
    for i in range(len(rows)):
        reach, ahead = {i}, [i]
        while ahead:
            new = links[ahead.pop()] - reach
            reach |= new
            ahead += new
        row = found[ids[i]]
        assert (row.n, row.component_id, row.links) == (len(sets[i]), ids[min(reach)], len(links[i]))


def by_chance(draw):
    """Documents that each share a passage with a few others, and near copies of some."""
    rows = [[] for _ in range(60)]
    for passage in range(150):
        for i in draw.sample(range(60), 4):
            rows[i] += [f"p{passage}w{k}" for k in range(5)] + [f"d{i}s{passage}"]
    rows = [row + [f"d{i}w{k}" for k in range(20)] for i, row in enumerate(rows)]
    return [" ".join(row) for row in rows + [row[1:] for row in rows[:5]]]


def test_a_cluster_by_chance_is_taken_apart(spark, monkeypatch):
    """Its sets are not compared with each other, and not copied to every block of it."""
    rows, staged = by_chance(random.Random(8)), {}
    stage = jaccard.stage

    def kept(df, name):
        staged.setdefault(name, []).append(stage(df, name))
        return staged[name][-1]

    monkeypatch.setattr(jaccard, "stage", kept)
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    found = {r.id: r for r in jaccard.linked_documents(frame, block_sets=12, hot=0).collect()}
    sets, links = brute_links(rows)
    assert {i: (r.n, r.links) for i, r in found.items()} == {i: (len(sets[i]), len(links[i])) for i in links}
    assert [found[60 + i].component_id for i in range(5)] == list(range(5))
    assert max(r["count"] for r in staged["clusters"][0].groupBy("root").count().collect()) > 24
    assert {r.blocks for r in staged["blocks"][0].collect()} == {1}


@pytest.mark.parametrize("paired, buffer", [(2, 40), (32, 500_000)])
def test_linked_sets_of_a_large_cluster_meet_often_enough(monkeypatch, paired, buffer):
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "BUFFER", buffer)
    near = list(dict.fromkeys(near_copies()))
    rows = near + by_chance(random.Random(8))
    _, links = brute_links(rows)
    sets = list(jaccard.shingle_sets(pa.array(rows)))
    class Everything:
        def has(self, hashes):
            return np.full(len(hashes), True)
    class Hot:
        value = np.sort(sets[3][:20]), np.arange(20)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(sets)), pa.int64()), pa.array([some.tobytes() for some in sets], pa.binary())], ["set_key", "shingles"]
    )
    for shared in (1, 8):
        prefixes = pa.Table.from_batches(jaccard._longer_prefix_rows(75, shared, Hot, Everything())([batch.slice(0, 30), batch.slice(30)]))
        prefixes = prefixes.sort_by([("shingle", "ascending"), ("n", "ascending")]).combine_chunks()
        found = pa.Table.from_batches(jaccard._met_often(75, shared)(prefixes.to_batches(max_chunksize=7)))
        found = found.group_by(["a", "b"]).aggregate([("met", "sum"), ("must", "max")]).to_pylist()
        kept = [(pair["a"], pair["b"]) for pair in found if pair["met_sum"] >= pair["must_max"]]
        edges = np.array(kept, np.int64)
        moved = dict(zip(*(column.tolist() for column in components.contracted(edges[:, 0], edges[:, 1]))))
        assert all(moved.get(i, i) == moved.get(j, j) for i in links for j in links[i])
        if paired == 32 and shared == 8:
            assert {pair for pair in kept if pair[0] >= len(near)} <= {(min(i, j), max(i, j)) for i in links for j in links[i]}


def test_jaccard_links_count_once_beside_an_empty_block(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 40)  # two blocks for each pair, filled by a hash
    rows = []
    for pair in range(12):
        words = [f"p{pair}w{i}" for i in range(40)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(words + ["more"]))]
    found = jaccard.linked_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.id: (r.component_id, r.links) for r in found} == {i: (i // 2 * 2, 1) for i, _ in rows}


def test_one_of_each(edges):
    kept = jaccard.one_of_each(edges)
    assert kept.columns == edges.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 4), (False, 5), (False, 6), (False, 7), (False, 8), (False, 9), (False, 10), (True, 0)
    ]


def test_components(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}
    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = {r.node: r.root for r in components.components(frame).collect()}
    assert found == {i: find(i) for i in root if find(i) != i}


@pytest.mark.parametrize("rows, most", [(components.ROWS, 2), (16, 40)])
def test_few_edges_take_one_round(spark, monkeypatch, rows, most):
    staged = []
    monkeypatch.setattr(components, "ROWS", rows)
    monkeypatch.setattr(components, "stage", lambda df, name: staged.append(name) or workspace.stage(df, name))
    pairs = [(i, i + 1) for i in range(1000, 1100)] + [(7, 5), (5, 3), (3, 3)]
    frame = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(8, "b")
    found = {r.node: r.root for r in components.components(frame).collect()}
    assert found == {5: 3, 7: 3} | {i: 1000 for i in range(1001, 1101)}
    assert len(staged) <= most


def test_steps_over_sets_hand_on_small_batches():
    texts = pa.array([f"one two three four five six {i}" for i in range(3 * text.ROWS)])
    keys = [jaccard.set_digest(found) for found in jaccard.shingle_sets(texts)]
    numbers = pa.array(range(len(texts)), pa.int64())
    whole = pa.RecordBatch.from_arrays([texts, pa.array(keys), numbers, numbers], ["content", "set_key", "copies", "n"])
    found = list(jaccard._wanted_sets(jaccard.SIZE)(iter([whole])))
    assert sum(batch.num_rows for batch in found) == len(texts)
    assert max(batch.num_rows for batch in found) <= text.ROWS


def test_common_shingles_of_a_batch():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 300, 40, dtype=np.uint64)) for _ in range(30)] + [np.zeros(0, np.uint64)]
    column = pa.array([b"never"] + [s.tobytes() for s in sets], pa.binary())
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    for some in (column.slice(1), column.slice(31)):
        (batch,) = jaccard._common([pa.RecordBatch.from_arrays([some], ["shingles"])])
        want = dict(zip(values[counts > 1].tolist(), counts[counts > 1].tolist())) if len(some) > 1 else {}
        assert dict(zip(*(c.to_pylist() for c in batch.columns))) == want


def test_a_shard_is_built_in_bounded_memory_for_each_posting(monkeypatch):
    import tracemalloc

    draw = np.random.default_rng(6)
    docs = np.repeat(np.arange(2000, dtype=np.int32), 200)
    words = np.concatenate([draw.choice(3000, 200, replace=False) for _ in range(2000)]).astype(np.int64)
    gains = draw.random(len(docs))
    monkeypatch.setattr(search, "STEP", 1 << 12, raising=False)
    tracemalloc.start()
    shard = search.Shard(docs, words, gains)
    peak = tracemalloc.get_traced_memory()[1] / len(docs)
    tracemalloc.stop()
    assert peak < 38
    ask = [(w, 1.0 + w / 3000) for w in range(0, 3000, 5)]
    best = [shard.best(ask, 10) for _ in range(2)]
    monkeypatch.setattr(search, "KEPT_BYTES", 0, raising=False)
    best.append(search.Shard(docs, words, gains).best(ask, 10))
    total = np.bincount(docs, np.where(words % 5 == 0, (1 + words / 3000) * gains, 0))
    want = np.lexsort((np.arange(2000), -np.round(total, search.DIGITS)))[:10]
    assert all(found.tolist() == want.tolist() for found, _ in best)


def test_decontamination_edges(spark, edges, nothing):
    items = [(1, " ".join(NEAR.split()[5:20]).upper()), (2, "two, WORDS!"), (3, None), (4, "..."), (None, "five six"),
             (1, "four five")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (2, 1000):  # several automata give what one gives
        rows = decontaminate.with_hits(edges, benchmark, block=block).collect()
        assert len(rows) == len(EDGES)
        for row in rows:
            assert row.hits.n_hit == sum(r["last"] - r["first"] + 1 for r in row.hits.runs)
            if row.doc_id in (1, 2):
                assert (row.hits.n_words, row.hits.n_hit, row.hits["items"]) == (400, 15, ["1"])
                (span,) = row.hits.spans
                assert row.text[span.start : span.end] == " ".join(NEAR.split()[5:20])
            if row.doc_id is None:
                assert (row.hits.n_hit, row.hits["items"]) == (3, ["1"])
            if row.doc_id in (4, 5, 7):
                assert (row.hits.n_words, row.hits.n_hit) == (0, 0)
            if row.doc_id == 10:
                assert row.hits["items"] == ["2"]
    kept = decontaminate.clean(edges, benchmark)
    assert kept.columns == edges.columns
    assert {r.doc_id for r in kept.collect()} == {4, 5, 7, 8, 9}
    assert decontaminate.with_hits(nothing, benchmark).count() == 0
    assert decontaminate.clean(edges, benchmark.limit(0)).count() == len(EDGES)


def test_secret_edges(spark, edges, nothing):
    ratios = secrets.train(secrets.labelled_strings(edges)).scalar()
    found = {r.doc_id: r for r in secrets.with_spans(edges.select("doc_id", "text"), ratios).collect()}
    spans = found[9].base
    assert [(s.ord, found[9].text[s.start : s.end]) for s in spans] == [
        (0, 'token: "aB3xK9qLmZ2vT7pW'), (2, "0123456789abcdef0")
    ]
    assert found[4].base == [] and found[4].content == ""
    assert secrets.train(secrets.labelled_strings(nothing)).first().ratios == pytest.approx([0.0] * 54**2)
    draw = random.Random(1)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    strings = [("".join(draw.choice(signs) for _ in range(40)), True) for _ in range(300)]
    strings += [(w, False) for w in "understanding configuration identifier parameters the and readable".split() * 50]
    model = secrets.train(spark.createDataFrame(strings, "string string, random boolean")).scalar()
    texts = ["see kQ7bX2mZr9LpV4tYw8Jc3N here", "the_configuration_parameters stay", "token = secret=abcdefghijklmnop",
             "token=password: abcdefghijklmnop"]
    rows = secrets.with_spans(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    assert [[r.text[s.start : s.end] for s in r.random] for r in rows] == [["kQ7bX2mZr9LpV4tYw8Jc3N"], [], [], []]
    assert [len(r["assign"]) for r in rows] == [0, 0, 1, 0]


def test_language_edges(spark, edges, nothing):
    assert language.fit(nothing) == {}
    rows = edges.select("doc_id", language.prediction({}, "text", spark).alias("p")).collect()
    assert {(r.p.lang, r.p.score) for r in rows} == {("und", 0.0)}
    samples = {"x": b"the cat sat on the mat", "y": b"le chat est sur le tapis"}
    rows = edges.select("doc_id", language.prediction(samples, "text", spark).alias("p")).collect()
    assert {r.doc_id for r in rows if r.p.lang == "und"} == {4, 5, 7, 8}
    parser = language.Parser({"a": b"abcabd", "b": b"bd"})
    def phrases(sample, content):
        count, at = 0, 0
        while at < len(content):
            end = at + 1
            while end < len(content) and content[at : end + 1] in sample:
                end += 1
            count, at = count + 1, end
        return count
    draw = random.Random(3)
    texts = ["".join(draw.choice("abcdx") for _ in range(n)).encode() for n in (1, 2, 5, 40, 300)]
    assert parser.phrases(texts).tolist() == [[phrases(s, t) for s in (b"abcabd", b"bd")] for t in texts]
    assert parser.predict(["abd", None, "4 5"])[0] == ["a", "und", "und"]


def test_quality_edges(spark, edges, nothing, labels):
    assert quality.fit(nothing, labels.limit(0)).share == 0.5
    model = quality.fit(edges, labels)
    rows = edges.select("doc_id", "text", quality.scores(model, "text", spark).alias("p")).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.p <= 1 for r in rows)
    assert {r.p for r in rows if not r.text} == {model.share}
    assert quality.accepted(edges, model).columns == edges.columns
    only = quality.fit(edges, labels.where("quality = 1"))
    assert quality.accepted(edges, only).count() == len(EDGES)


def test_mixture_edges(edges, nothing):
    rows = mixture.taken(edges).collect()
    assert len(rows) == len(EDGES)
    for row in rows:
        assert 0 <= row.taken <= 3 * row.size
    sizes = {}
    for _, content, _, source in EDGES:
        sizes[source] = sizes.get(source, 0) + len(words_of(content))
    assert {r.source_size for r in rows} == set(sizes.values())
    taken = sum(r.taken for r in rows)
    assert abs(taken - sum(sizes.values())) <= 3 * 64 * len(sizes)
    mixed = mixture.mixed(edges)
    assert mixed.columns == edges.columns
    assert sum(len(words_of(r.text)) for r in mixed.collect()) == taken
    assert mixture.taken(nothing).count() == 0 and mixture.mixed(nothing).count() == 0


def test_a_tiny_source_leaves_the_others_whole(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(100)), "en", "ab"[i % 2]) for i in range(120)]
    rows.append((999, "just three words", "en", "c"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    sizes, times = {}, {}
    for r in mixture.mixed(frame).collect():
        sizes.setdefault(r.source, []).append(len(r.text.split()))
    source = {i: name for i, _, _, name in rows}
    for r in mixture.taken(frame).collect():
        name = source[r.doc_id]
        times[name] = times.get(name, 0) + r.taken
        assert name != "c" or abs(r.taken - r.target) < 1
    assert {n: sum(s) for n, s in sizes.items()} == times
    for name in "ab":  # three repeats of a line of 6,000 words in blocks of 64, cut where rows end
        assert len(sizes[name]) <= 3 * (6000 / 64 + 60) and sum(sizes[name]) / len(sizes[name]) > 20


def test_apportionment_is_sainte_lague():
    draw = random.Random(9)
    for _ in range(200):
        votes = [float(draw.randrange(0, 50)) for _ in range(draw.randrange(1, 9))]
        most = [draw.randrange(0, 30) for _ in votes]
        seats = draw.randrange(0, 60)
        given = [0] * len(votes)
        for _ in range(seats):
            able = [i for i in range(len(votes)) if votes[i] > 0 and given[i] < most[i]]
            if not able:
                break
            given[max(able, key=lambda i: (votes[i] / (2 * given[i] + 1), -i))] += 1
        found = mixture.apportion(seats, votes, most)
        assert sum(found) == sum(given)
        assert sorted(v / (2 * g + 1) for v, g in zip(votes, found)) == pytest.approx(
            sorted(v / (2 * g + 1) for v, g in zip(votes, given)))


def test_targets():
    assert mixture.targets({"a": 10, "b": 10, None: 100}) == pytest.approx({"a": 22.5, "b": 30, None: 67.5})
    assert mixture.targets({"a": 0, "b": 5}) == {"a": 0.0, "b": 5.0}
    assert mixture.targets({}) == {}


def test_slot_edges(edges, nothing, tmp_path):
    from framesift.workspace import stage

    rows = slots.materialise(stage(edges, "edges"), str(tmp_path / "a"), length=16, per_shard=50).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert {r.id for r in rows} == {None, 1, 2, 3, 6, 7, 8, 9, 10}
    assert slots.materialise(stage(nothing, "none"), str(tmp_path / "b")).count() == 0


def test_search_equals_brute_force(spark, edges, nothing):
    docs = edges.select(F.col("doc_id").alias("id"), "text")
    statistics = search.Statistics(docs)
    asked = [(7, w) for w in ("one", "two", "words", "theta7")] + [(8, "two"), (9, "absent")]
    hashed = {w: int(text.word_hashes(pa.array([w]), text.ALNUM)[0].view(np.int64)[0]) for _, w in asked}
    rows = [[w.decode() for w in decontaminate.normalised(t)] for _, t, _, _ in EDGES]
    mean = sum(map(len, rows)) / len(rows)
    def idf(word):
        df = sum(word in r for r in rows)
        return math.log(1 + (len(rows) - df + 0.5) / (df + 0.5))
    queries = spark.createDataFrame([(q, hashed[w], idf(w)) for q, w in asked], "query bigint, word bigint, idf double")
    for shard_words in (50, 10**6):
        found = search.top_k(docs, queries, statistics, k=3, shard_words=shard_words).collect()
        for query in (7, 8, 9):
            want = []
            for (key, *_), row in zip(EDGES, rows):
                score = sum(
                    idf(w) * row.count(w) * (search.K1 + 1)
                    / (row.count(w) + search.K1 * (1 - search.B + search.B * len(row) / mean))
                    for q, w in asked if q == query)
                if score:
                    want.append((-round(score, 6), key is None, key or 0))
            got = [(-r.score, r.id is None, r.id or 0) for r in sorted(found, key=lambda r: r.rank) if r["query"] == query]
            assert got == sorted(want)[:3]
    assert search.by_example(docs, statistics, terms=8, least_df=1).where("query = 6").count() == 8
    assert search.by_example(docs, statistics, least_df=1).where("query = 6").count() == len(set(rows[8]))
    none = search.Statistics(nothing.select(F.col("doc_id").alias("id"), "text"))
    assert (none.documents, none.mean) == (0, 1.0)
    assert search.top_k(nothing.select(F.col("doc_id").alias("id"), "text"), queries, none).count() == 0


def test_search_asks_with_every_word(spark, tmp_path):
    draw = random.Random(8)
    common = [f"c{i}" for i in range(40)]
    rows = [(i, " ".join(draw.choices(common, k=60) + [f"r{i // 2}x{j}" for j in range(9)])) for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    split = [content.split() for _, content in rows]
    mean = sum(map(len, split)) / len(split)
    df = {w: sum(w in row for row in split) for row in split for w in row}
    idf = {w: math.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for w, n in df.items() if n >= search.LEAST_DF}
    found = {}
    for r in search.op7_top_k_search(spark, str(tmp_path)).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.doc_id, r.score)
    assert sorted(found) == [0, 20, 40]
    for query, hits in found.items():
        scores = []
        for i, row in enumerate(split):
            norm = search.K1 * (1 - search.B + search.B * len(row) / mean)
            tf = {w: row.count(w) for w in set(split[query]) & set(row) & set(idf)}
            scores.append((-sum(idf[w] * n * (search.K1 + 1) / (n + norm) for w, n in tf.items()), i))
        want = sorted(scores)[: search.TOP]
        assert [hits[k + 1][0] for k in range(len(want))] == [i for _, i in want]
        assert [hits[k + 1][1] for k in range(len(want))] == pytest.approx([-s for s, _ in want], abs=1e-5)


def test_repeated_words_win_over_rare_ones(spark):
    rows = [(1, "often " * 30 + "rare"), (2, "rare")] + [(i, "often" if i < 12 else "other") for i in range(3, 21)]
    docs = spark.createDataFrame(rows, "id bigint, text string")
    (best,) = search.by_example(docs.where("id = 1"), search.Statistics(docs), terms=1).collect()
    assert best.word == int(text.word_hashes(pa.array(["often"]), text.ALNUM)[0].view(np.int64)[0])


@pytest.mark.parametrize("block", [1, 7, 64, 4096])
def test_pruned_shard_equals_all_scores(monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK", block)
    random = np.random.default_rng(block)
    held = random.random((2000, 30)) < np.linspace(0.002, 0.9, 30)
    gains = np.round(random.random(held.shape), 1) * held  # many ties
    docs, words = np.nonzero(gains)
    shard = search.Shard(docs.astype(np.int32), words, gains[docs, words])
    for _ in range(100):
        terms = [(int(w), float(i)) for w, i in zip(random.integers(0, 32, 8), random.random(8) * 9)]
        every = np.round(sum(gains[:, w] * i for w, i in terms if w < 30) + np.zeros(2000), 6)
        want = [d for d in np.lexsort((np.arange(2000), -every))[:10] if every[d]]
        found, scores = shard.best(terms, 10)
        assert found.tolist() == want and scores.tolist() == every[want].tolist()


def test_postings_take_little_memory():
    """Of a large batch of documents only what is kept, 20 bytes a posting, and a small step."""
    rows, words = 20_000, 40
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(np.zeros(rows, np.int32)),
            pa.array(np.arange(rows)),
            pa.array(np.full(rows, words)),
            pa.array([np.arange(words).tobytes()] * rows, pa.binary()),
            pa.array([np.ones(words, "<u4").tobytes()] * rows, pa.binary()),
            pa.nulls(rows, pa.binary()),
        ],
        ["shard", "id", "length", "words", "counts", "asks"],
    )
    tracemalloc.start()
    try:
        assert list(search._search(10, 40.0)([batch])) == []
        assert tracemalloc.get_traced_memory()[1] < 30 * rows * words
    finally:
        tracemalloc.stop()


def test_shards_are_laid_out_in_little_memory(monkeypatch):
    """At rest 12 bytes a posting; on the way from parts little more, and the same index."""
    monkeypatch.setattr(search, "STEP", 1 << 14)
    rng = np.random.default_rng(3)
    parts = []
    for part in range(50):
        lengths = rng.integers(0, 300, 100)
        docs = np.repeat(np.arange(100, dtype=np.int32) + 100 * part, lengths)
        words = np.concatenate([rng.permutation(3000)[:n] for n in lengths]) * 1_000_003
        parts.append((docs, words, rng.integers(1, 50, len(docs)) / 8))
    postings = sum(len(docs) for docs, _, _ in parts)
    whole = search.Shard(*(np.concatenate(column) for column in zip(*parts)))
    tracemalloc.start()
    try:
        parts = [tuple(column.copy() for column in part) for part in parts]
        shard = search.Shard.of_parts(parts)
        now, peak = tracemalloc.get_traced_memory()
        assert not parts and now < 16 * postings and peak < 30 * postings
    finally:
        tracemalloc.stop()
    for name in ("words", "start", "docs", "gains", "doc_start", "doc_words", "doc_gains", "tie"):
        assert (getattr(shard, name) == getattr(whole, name)).all()
    spread = np.lexsort((np.argsort(shard.tie)[np.repeat(np.arange(shard.size), np.diff(shard.doc_start))], shard.doc_words))
    assert (shard.gains == shard.doc_gains[spread]).all()


def test_ids_hold_no_batches():
    """Columns from Spark are parts of one buffer, the whole batch; of a shard's documents only
    the ids wait for the queries."""
    rows, words, seen = 2000, 200, []

    def batch(first):
        some = pa.RecordBatch.from_arrays(
            [
                pa.array(np.zeros(rows, np.int32)),
                pa.array(np.arange(first, first + rows)),
                pa.array(np.full(rows, words)),
                pa.array([np.arange(words).tobytes()] * rows, pa.binary()),
                pa.array([np.ones(words, "<u4").tobytes()] * rows, pa.binary()),
                pa.nulls(rows, pa.binary()),
            ],
            ["shard", "id", "length", "words", "counts", "asks"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, some.schema) as stream:
            stream.write_batch(some)
        return next(pa.ipc.open_stream(sink.getvalue()))

    def batches():
        for k in range(4):
            yield batch(k * rows)
            seen.append(pa.total_allocated_bytes())

    assert list(search._search(10, float(words))(batches())) == []
    assert max(seen) < seen[0] + 12 * words * rows


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_shards_leave_few_hits_and_queries_move_once(spark, monkeypatch, kind):
    """However many shards there are, a query gives at most ``PARTS * k`` rows to the merge, and
    no shard moves the queries; with the same answers as one shard and as one block of queries."""
    monkeypatch.setattr(search, "ASK_WORDS", 300, raising=False)
    draw = random.Random(4)
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(400)]
    rows = [(i, " ".join(draw.choices(common, k=25) + draw.choices(rare, k=12))) for i in range(300)]
    rows += [(i, content) for i, content in rows[:20]] + [(None, rows[40][1]), (None, rows[41][1]), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "id bigint, text string").withColumn("id", F.col("id").cast(kind))
    statistics = search.Statistics(docs)
    queries = search.by_example(docs.where(F.col("id").cast("int") % 10 == 0), statistics)
    made, moved, plain = [], [], search.map_arrow

    def noted(df, function, schema):
        result = plain(df, function, schema)
        if "score" in schema:
            made.append(result)
            moved.append(df)
        return result

    monkeypatch.setattr(search, "map_arrow", noted)
    answers = []
    for shard_words, asked in ((400, 300), (10**6, 300), (400, 10**6)):
        monkeypatch.setattr(search, "ASK_WORDS", asked, raising=False)
        answers.append(sorted(map(str, search.top_k(docs, queries, statistics, k=5, shard_words=shard_words).collect())))
    assert answers[0] == answers[1] == answers[2] and len(answers[0]) == 30 * 5
    hits = made[0].select(F.expr("sum(size(ids))" if "ids" in made[0].columns else "count(*)")).first()[0]
    assert 30 * 5 <= hits <= 4 * 30 * 5
    plan = moved[0]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shard" not in plan and "CartesianProduct" in plan


def test_a_shard_that_is_read_back_and_a_threshold_change_no_answer():
    """Queries in a block meet several shards; sums in single precision decide nothing."""
    draw = np.random.default_rng(12)
    held = draw.random((3000, 60)) < np.linspace(0.004, 0.9, 60)
    gains = np.round(draw.random(held.shape), 2) * held
    gains[1500:] = gains[:1500] * (1 + 1e-7 * draw.integers(0, 3, (1500, 1)))  # nearly ties
    idf = np.round(draw.random(60) * 9, 3)
    queries = [draw.choice(62, 20, replace=False) for _ in range(40)] + [np.array([59]), np.array([61]), np.array([7, 7])]
    kind = pa.list_(pa.struct([("word", pa.int64()), ("idf", pa.float64())]))
    terms = [[{"word": int(w), "idf": float(idf[w % 60])} for w in sorted(q)] for q in queries]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(queries)) + 100), pa.array(terms, kind)], ["ask", "terms"])
    (block,) = search._packed_asks([batch])
    asked = search.Asked(block.column(0)[0].as_buffer(), 10)
    for begin in range(0, 3000, 1000):
        docs, words = np.nonzero(gains[begin : begin + 1000])
        shard = search.Shard(docs.astype(np.int32), words, gains[begin + docs, words])
        asked.meet(*search.Shard.read(shard.written(pa.array(np.arange(begin, begin + 1000)))))
    found = {}
    for some in asked.answers():
        for ask, i, score in zip(*(column.to_pylist() for column in some.columns)):
            found.setdefault(ask, []).append((i, score))
    for number, query in enumerate(queries):
        every = np.round(sum(gains[:, w] * idf[w] for w in query if w < 60) + np.zeros(3000), search.DIGITS)
        want = [i for i in np.lexsort((np.arange(3000), -every))[:10] if every[i]]
        got = found.get(number + 100, [])
        assert [score for _, score in got] == pytest.approx(every[want].tolist(), abs=2e-6)
        assert all(every[i] >= score - 2e-6 for i, score in got)
        assert len({i for i, _ in got}) == len(want)


def test_scoring_edges(spark, edges, nothing):
    docs = edges.select(F.col("doc_id").alias("id"), "text")
    target = spark.createDataFrame([(1,), (1,), (None,), (77,)], "id bigint")
    rows = scoring.cross_entropy_difference(docs, target, words=20).collect()
    assert len(rows) == len(EDGES)
    for row in rows:
        assert (row.score is None) == (row.n_tokens == 0)
    by_id = {r.id: r for r in rows}
    assert by_id[1].score == by_id[2].score < by_id[10].score
    empty = nothing.select(F.col("doc_id").alias("id"), "text")
    assert scoring.cross_entropy_difference(empty, target).count() == 0
    uniform = scoring.cross_entropy_difference(docs, target.limit(0), words=20).where("n_tokens > 0")
    assert {round(r.target_loss, 4) for r in uniform.collect()} == {round(math.log(21), 4)}


def test_scoring_over_all_words(spark, tmp_path):
    """More words than the vocabulary of a bound has; all of them tell documents apart."""
    draw = random.Random(5)
    rare = [f"w{i}" for i in range(scoring.WORDS + 1500)]
    texts = [" ".join(draw.choices(rare, [1 / (i + 9) for i in range(len(rare))], k=draw.randrange(1, 200))) for _ in range(300)]
    texts += [None, "", "alone", f"{rare[-1]} {rare[-2]}", f"{rare[-3]} {rare[-4]}", texts[0], "\u00c9t\u00c9 w1 W1"]
    rows = [(i if i % 17 else None, text) for i, text in enumerate([*texts, *texts[:5]])]
    rows[40:42] = [rows[39]] * 2
    marks = [(i, i % 3 % 2) for i in range(0, 330, 2)] + [(None, 1), (4, 1), (4, 1), (999, 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    spark.createDataFrame(marks, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/l")
    docs = spark.read.parquet(f"{tmp_path}/d").withColumnRenamed("doc_id", "id")
    target = spark.read.parquet(f"{tmp_path}/l").where("quality = 1").selectExpr("doc_id AS id")
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name[0]}/*.parquet'")
    for chunk in (scoring.CHUNK, 500):
        found = scoring.cross_entropy_difference(docs, target, words=None, chunk=chunk)
        ours, theirs = sqlcheck.compare(connection, found.withColumnRenamed("id", "doc_id"), scoring.ALL_WORDS_SQL)
        assert ours == theirs
    none = scoring.cross_entropy_difference(docs, target.limit(0), words=None)
    known = len({word for _, content in rows for word in words_of(content)})
    losses = {round(r.target_loss, 4) for r in none.where("n_tokens > 0").collect()}
    assert losses == {round(math.log(known + 1), 4)}
    assert scoring.cross_entropy_difference(docs.limit(0), target, words=None).count() == 0


def test_op1_tells_rare_words_apart(spark, tmp_path):
    """Two documents of one rare word each, of which only one is a word of a good document."""
    many = [" ".join(f"w{i}" for i in range(at, at + 100)) for at in range(0, scoring.WORDS + 100, 100)]
    texts = [*many * 4, "rare01 rare01", "rare01", "rare02 rare02", "rare02"]
    good = 4 * len(many)
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(good, 1), (0, 1), (1, 0)], "doc_id bigint, quality int")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = scoring.op1_lm_scoring(spark, str(tmp_path))
    score = {row.doc_id: row.score for row in found.collect()}
    assert score[good + 1] < score[good + 3]
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    ours, theirs = sqlcheck.compare(connection, found, scoring.ALL_WORDS_SQL)
    assert ours == theirs


def test_rollup(spark, tmp_path):
    book = rollup.TokenRollup(spark, str(tmp_path / "book"))
    schema = "op string, doc_id bigint, tokenizer string, source string, lang string, n_tokens bigint"
    def changes(*rows):
        return spark.createDataFrame(list(rows), schema)
    def totals():
        return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in book.totals().collect()}
    first = changes(("put", 1, "t", "a", "x", 5), ("put", 2, "t", "a", None, 7), ("put", 2, "t", "a", None, 7),
                    ("put", 3, "t", None, "x", None), (None, 4, "t", "a", "x", 1), ("put", None, "t", "a", "x", 1))
    assert totals() == {}
    assert book.commit("1", first) and not book.commit("1", first)
    assert totals() == {("a", "x", "t"): (1, 5), ("a", None, "t"): (1, 7), (None, "x", "t"): (1, 0)}
    with pytest.raises(rollup.Conflict):
        book.commit("1", changes(("put", 1, "t", "a", "x", 6)))
    assert book.commit("2", changes(("put", 1, "t", "b", "x", 9), ("delete", 2, "t", None, None, None),
                                    ("put", 2, "t", "a", "x", 3), ("delete", 88, "t", None, None, 0)))
    assert totals() == {("b", "x", "t"): (1, 9), (None, "x", "t"): (1, 0)}
    assert book.commit("3", changes(("put", 2, "u", "a", "x", 4)).limit(0))
    # a batch that broke off before its marker is invisible and can be repeated
    other = changes(("put", 5, "t", "b", "x", 1))
    marked, book._mark = book._mark, lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        book.commit("4", other)
    book._mark = marked
    assert totals()[("b", "x", "t")] == (1, 9)
    assert book.commit("4", other) and totals()[("b", "x", "t")] == (2, 10)


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(folder + "/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixture", "token_shards"]
    good = corpus_pipeline.good_quality(spark, docs, folder)
    model = quality.fit(docs, spark.read.parquet(folder + "/labels.parquet"))
    compressors = model.compressors()
    all_rows = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, t in all_rows.items() if model.score(t, compressors) >= 0.5}
    once = corpus_pipeline.one_of_near_duplicates(spark, docs, folder)
    ids = sorted(all_rows)
    _, links = brute_links([all_rows[i] for i in ids])
    kept = set()
    for i in range(len(ids)):
        reach, ahead = {i}, [i]
        while ahead:
            new = links[ahead.pop()] - reach
            reach |= new
            ahead += new
        if min(reach) == i:
            kept.add(ids[i])
    assert {r.doc_id for r in once.collect()} == kept
    clean = corpus_pipeline.without_benchmark(spark, docs, folder)
    windows = {
        w for r in spark.read.parquet(folder + "/benchmark.parquet").collect()
        for w in decontaminate.windows(r.text, decontaminate.WIDTH)
    }
    def leaks(content):
        line = " " + " ".join(w.decode() for w in decontaminate.normalised(content)) + " "
        return any(f" {w} " in line for w in windows)
    assert {r.doc_id for r in clean.collect()} == {i for i, t in all_rows.items() if not leaks(t)}
    index = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.slot for r in index) == list(range(len(index)))
    assert {r.doc_id for r in index} <= kept


def test_one_of_repeated_rows_is_chosen_by_its_columns(spark):
    rows = [(1, "same text here", f"k{i}", {"a": i}) for i in range(6)] + [(2, "another text", "z", None)]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "doc_id bigint, text string, _row string, m map<string,int>")
        kept = jaccard.one_of_each(frame.repartition(3))
        assert sorted((r.doc_id, r["_row"]) for r in kept.collect()) == [(1, "k0"), (2, "z")]


def test_no_set_is_left_out_without_doubt(spark):
    rows = near_copies()
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    found = [
        sorted((r.id, r.component_id, r.links) for r in jaccard.linked_documents(frame, doubt=doubt).collect())
        for doubt in (jaccard.DOUBT, 0)
    ]
    assert found[0] == found[1]


def test_cluster_edges_are_stars_over_batches():
    rows = [(5, 1, 10), (5, 1, 11), (5, 1, 12), (5, 2, 13), (5, 4, 14), (6, 1, 15), (6, 1, 16)]
    for cut in range(len(rows) + 1):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.int32()),
                 pa.array([r[2] for r in some], pa.int64()), pa.nulls(len(some), pa.int64())],
                ["shingle", "size_class", "set_key", "first"],
            )
            for some in (rows[:cut], rows[cut:])
        ]
        found = {(a, b) for batch in jaccard._cluster_edges(iter(batches)) for a, b in zip(*(c.to_pylist() for c in batch.columns))}
        assert found == {(11, 10), (12, 10), (13, 10), (16, 15)}


def test_a_language_of_long_texts_only_is_learned(spark):
    french = "le chat dort sur la table et la nuit tombe sur les toits de paris "
    english = "the cat sleeps on the table and the night falls over the roofs of london "
    rows = [(i, french * 500, "fr") for i in range(20)] + [(i, english * 2, "en") for i in range(20, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    samples = language.fit(docs)
    assert set(samples) == {"fr", "en"}
    asked = spark.createDataFrame([("la nuit sur les toits",), ("the night over the roofs",)], "text string")
    found = asked.select(language.prediction(samples, "text", spark)["lang"].alias("lang")).collect()
    assert [r.lang for r in found] == ["fr", "en"]


def test_labelled_texts_that_are_all_long_are_learned(spark):
    good, bad = "a careful account of the work that was done ", "BUY NOW!!! click $$$ here "
    rows = [(i, (good if i % 2 else bad) * 1000) for i in range(40)] + [(100 + i, None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(140)], "doc_id bigint, quality int")
    model = quality.fit(docs, known, rows=10)
    assert model.good and model.bad
    found = docs.where("doc_id < 2").select("doc_id", quality.scores(model, "text", spark).alias("score"))
    scores = {r.doc_id: r.score for r in found.collect()}
    assert scores[1] > 0.5 > scores[0]


def test_clean_leaves_columns_of_any_name_alone(spark):
    rows = [(1, "some clean text", "keep me"), (2, "one two three four five six seven eight nine ten", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _benchmark_hits string")
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    (kept,) = decontaminate.clean(docs, bench).collect()
    assert tuple(kept) == rows[0]
