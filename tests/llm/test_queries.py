"""Registered queries against SQL, or against plain versions where SQL has none."""

import hashlib
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from framesift.llm import mixture, queries, slots
from tests import sqlcheck

SF_DIR = "/root/testdata/sf0.001"
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(SF_DIR + "/documents.parquet").toPandas()


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_sql(spark, name):
    ours, theirs = sqlcheck.compare(
        sqlcheck.duck(SF_DIR), queries.QUERIES[name](spark, SF_DIR), queries.ORACLE_SQL[name]
    )
    assert ours == theirs


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secret_scan(spark, documents):
    rows = {r.doc_id: r for r in queries.QUERIES["op2_secret_scan"](spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    for doc, text in zip(documents.doc_id, documents.text):
        spans = base_spans(text)
        line = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        row = rows[doc]
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert row.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) <= set(row.spans.split(","))


def test_language_id(spark, documents):
    rows = queries.QUERIES["op4_language_id"](spark, SF_DIR).toPandas().merge(documents, on="doc_id")
    held = rows[rows.held_out]
    assert (held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4) == 2).all()
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert rows.score.between(0, 1).all()


def test_quality_classifier(spark, documents):
    labels = spark.read.parquet(SF_DIR + "/labels.parquet").toPandas()
    rows = queries.QUERIES["op10_quality_classifier"](spark, SF_DIR).toPandas()
    assert len(rows) == len(documents) and rows.score.between(0, 1).all()
    assert ((rows.score >= 0.5) == (rows.predicted == 1)).all()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.85


def test_source_mixture(spark, documents):
    rows = queries.QUERIES["op5_source_mixture"](spark, SF_DIR).toPandas()
    again = queries.QUERIES["op5_source_mixture"](spark, SF_DIR).toPandas()
    assert sorted(rows.itertuples(index=False)) == sorted(again.itertuples(index=False))
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in zip(documents.doc_id, documents.text)}
    assert dict(zip(rows.doc_id, rows["size"])) == sizes
    assert (rows.taken <= 3 * rows["size"]).all()
    by_source = rows.merge(documents[["doc_id", "source"]], on="doc_id").groupby("source")
    for _, some in by_source:
        assert abs(some.taken.sum() - some.target.iloc[0]) <= 3 * mixture.BLOCK_WORDS + 1
        assert some["size"].sum() == some.source_size.iloc[0]


def test_token_slots_round_trip(spark, documents, tmp_path):
    docs = spark.read.parquet(SF_DIR + "/documents.parquet")
    folder = str(tmp_path / "out")
    rows = slots.materialise(docs, folder, length=32, per_shard=100).toPandas().sort_values("slot")
    assert rows.slot.tolist() == list(range(len(rows)))
    assert (rows.shard == rows.slot // 100).all() and (rows.offset == rows.slot % 100 * 64).all()
    records = list(slots.read_slots(folder, 0, len(rows), length=32, per_shard=100))
    assert [zlib.crc32(r.tobytes()) for r in records] == rows.crc32.tolist()
    resumed = list(slots.read_slots(folder, 150, 120, length=32, per_shard=100))
    assert all((a == b).all() for a, b in zip(resumed, records[150:270], strict=True))
    tokenizer = slots.Tokenizer(open(slots.VOCABULARY, "rb").read())
    texts = dict(zip(documents.doc_id, documents.text))
    for doc, some in rows.groupby("id"):
        ids = np.concatenate([records[s] for s in some.sort_values("part").slot])
        assert tokenizer.decode(ids) == texts[doc]
        assert some.n_tokens.sum() == len(tokenizer.ids(texts[doc]))


@pytest.mark.parametrize("count", [1, 2, 3, 17, 1000, 4097])
def test_permutation(count):
    found = slots.permuted(np.arange(count), count, 5)
    assert sorted(found) == list(range(count))
    assert count < 100 or list(found) != list(slots.permuted(np.arange(count), count, 6))


def test_tokens_are_those_of_the_full_pattern():
    import random

    tokenizer = slots.Tokenizer(open(slots.VOCABULARY, "rb").read())
    draw, parts = random.Random(3), ["a", "don't", " ", "\n", "\t", " ", " ", "12", "é", "!?", "日本", "'s", "\x1c", "\r\n"]
    for length in (1, 2, 3, 5, 9, 40):
        for _ in range(200):
            text = "".join(draw.choice(parts) for _ in range(length))
            assert tokenizer.ids(text) == tokenizer._any.encode_ordinary(text)
            assert tokenizer.decode(np.array(tokenizer.ids(text))) == text
