"""Source divergence against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from framesift.llm import divergence
from tests.llm.conftest import EDGES, SCHEMA

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, least=3, ranks=200):
    docs = [(lang or "", source or "", Counter(terms_of(text))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        found = Counter(t for _, _, c in mine for t in c)
        kept = sorted(t for t, n in found.items() if n >= least)
        groups = defaultdict(Counter)
        for _, source, c in mine:
            groups[source].update({t: n for t, n in c.items() if t in set(kept)})
        whole = sum(groups.values(), Counter())

        def p(c):
            n = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // n for t in kept}

        shares, q = {g: p(c) for g, c in groups.items()}, p(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for g in groups:
            pairs = [(-sum(f(shares[g][t], shares[o][t]) for t in kept), o.encode()) for o in groups if o != g]
            terms = [(-f(shares[g][t], q[t]), t.encode()) for t in kept if groups[g][t] and shares[g][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                for rank, (value, item) in enumerate(sorted(found)[:most], 1):
                    out.append((lang, g, part, item.decode(), -value, rank))
    return sorted(out)


def invented():
    draw = random.Random(2)
    words = ["a", "an", "ant", "ante", "antechamber", "antechambers", "über", "übermut", "É", "é", "日本", "日本語"]
    words[3:3] = ["x" * n for n in (2, 3, 4, 5, 8, 9, 16, 17, 40, 64)]
    rows = []
    for i in range(60):
        source = draw.choice(["s1", "s1", "s1", "s2", "s3", None])
        text = " ".join(draw.choice(words[: 6 + 3 * len(source or "")] + [f"r{i}", "A1B"]) for _ in range(draw.randrange(0, 30)))
        rows.append((i, draw.choice([None, text, text, text]), draw.choice(["en", "en", "de", None]), source))
    return rows + rows[:5] + [(90, "rare words", "fr", "s1"), (91, "", "fr", "s9"), (92, None, "it", "s1")]


@pytest.mark.parametrize("rows", [invented(), EDGES])
def test_divergence_equals_plain_version(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS term", "1 AS count", "2 AS p", "'t' AS terms")
    found = divergence.source_divergence(frame.repartition(3))
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_ranks_end_at_the_limit(spark):
    rows = invented()
    found = divergence.source_divergence(spark.createDataFrame(rows, SCHEMA), ranks=2)
    assert sorted(map(tuple, found.collect())) == plain(rows, ranks=2)


def test_small_buffers_and_levels(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BUFFER", 8)
    rows = invented()
    docs = spark.createDataFrame(rows, SCHEMA)
    packed = divergence.document_terms(docs)
    levels = divergence.refined(packed)
    assert [width for width, _ in levels] == [4, 8, 16, 32, 64]
    kept, names = divergence.kept_terms(packed, levels=levels)
    groups = divergence.groups_of(docs).drop("lang")
    found = kept.join(names, "hash").join(groups, "group").select("lang", "source", "term", "count")
    want = Counter()
    by_lang = defaultdict(Counter)
    for _, text, lang, source in rows:
        by_lang[lang or ""].update(set(terms_of(text)))
    for _, text, lang, source in rows:
        for term, n in Counter(terms_of(text)).items():
            if by_lang[lang or ""][term] >= 3:
                want[lang or "", source or "", term] += n
    assert {tuple(r)[:3]: r["count"] for r in found.collect()} == dict(want)


def test_empty_table(spark, nothing):
    found = divergence.source_divergence(nothing)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.collect() == []


def test_counts_are_written_once(spark, monkeypatch):
    rows = [(i, "a ab abc abcdefg other" + " rare" * (i < 2), "en", f"s{i % 2}") for i in range(6)]
    docs = divergence.document_terms(spark.createDataFrame(rows, SCHEMA))
    levels, staged, real = divergence.refined(docs), [], divergence.stage
    monkeypatch.setattr(divergence, "stage", lambda df, name: staged.append(name) or real(df, name))
    kept, terms = divergence.kept_terms(docs, levels=levels)
    assert {r.term for r in terms.collect()} == {"a", "ab", "abc", "abcdefg", "other"}
    assert sorted(r["count"] for r in kept.collect()) == [3] * 10
    assert staged == ["kept-terms", "enough"]
