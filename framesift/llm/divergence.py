"""Source divergence audit: how far the terms of every source of a language are from those of
the language's other sources and of the whole language.

A term is a run of ASCII letters and characters beyond ASCII, A to Z lower-cased. A language
keeps the terms that at least ``least`` of its documents have. They are found by iceberg
prefix refinement on their UTF-8 bytes: at a level of ``width`` bytes every term stands for
its first ``width`` bytes, or for itself if it is no longer, and a prefix that fewer than
``least`` documents of the language have is discarded with all terms below it. The next level
doubles the width and counts only what is left, until no term is cut any more. As a document
with a term has all of its prefixes, nothing that should be kept is discarded.

1. Of every batch of documents and language the distinct terms, and which documents have
   them how often, are written once.
2. A level is one pass over them: tasks drop terms below discarded prefixes by a bitmap of
   bounded size (``membership.py``), count the documents of each prefix, combined on the map
   side, and only (64-bit hash of language and prefix, count) is shuffled. Neither the bitmap
   nor equal hashes discard a prefix wrongly; they only let rare ones pass.
3. The terms left are counted by language, source and hash, and the threshold is applied to
   exact document counts. A last pass brings the kept terms themselves; should two of a
   language have one hash, the job fails. So the rare terms, most of all terms, are never
   shuffled, and no task or driver holds a vocabulary.
4. Divergences of two sources are summed over the terms both have; terms that one or neither
   has come in by the histogram of the counts, as their share depends on the count alone.

With N, the sum of the counts over the V kept terms, a term of count c has the share
``p = 1 + floor(UNIT * (c + 1) / (N + V))``, and ``floor((p - q) * (p - q) / q)`` is its
divergence from the share q, all in exact integers.

Null text, language and source are read as empty texts. Every row is a document of its own,
whatever its id. Groups without terms have their rows of part ``pair``; a language without
kept terms has the value 0 there. Equal values are ranked by the item's bytes. An empty table
gives no row. Other columns are not read. Of a text a task holds the terms in memory, whatever
its length; it holds no more than a batch of texts and a buffer of ``BUFFER`` counts.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framesift.llm.membership import Filter
from framesift.llm.text import LOWER, TO_LOWER, map_arrow, mixed, slices
from framesift.workspace import stage

#: Documents of a language that a kept term must have.
LEAST = 3
#: Ranks of part ``term``.
RANKS = 200
UNIT = 1_000_000_000
FIRST_WIDTH = 4
#: Counts that a task combines before it sends them on.
BUFFER = 1_000_000
#: Cells of documents by prefixes that are counted in a table; more are sorted.
TABLE = 1 << 25
#: Longer prefixes are hashed one by one.
SHORT = 32

_LETTERS = set(LOWER.encode()) | set(range(128, 256))
#: Bytes to lower case, and all that is not part of a term to spaces.
_TO_TERMS = bytes(b if b in _LETTERS else 32 for b in TO_LOWER)


def term_counts(text: bytes | None) -> Counter:
    """The terms of a text, as bytes, with their numbers."""
    return Counter((text or b"").translate(_TO_TERMS).split())


def _packed(values: list[int]) -> bytes:
    """Numbers in the fewest bytes that hold them, after a byte that says how many."""
    array = np.array(values, dtype=np.int64)
    kind = np.min_scalar_type(int(array.max()) if len(array) else 0)
    return bytes([kind.itemsize]) + array.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.dtype(f"u{data[0]}"), offset=1).astype(np.int64)


def _document_terms(batches):
    """A row for each language of ``ROWS`` documents: its distinct terms; the group of each
    document and its number of distinct terms; the numbers and counts of these."""
    names = ["lang", "groups", "terms", "lengths", "numbers", "counts"]
    for batch in slices(batches):
        langs, groups = (batch.column(i).to_pylist() for i in range(2))
        texts = batch.column(2).cast(pa.large_binary())
        rows = []
        for lang in dict.fromkeys(langs):
            mine = [row for row, other in enumerate(langs) if other == lang]
            known: dict[bytes, int] = {}
            lengths, numbers, counts = [], [], []
            for row in mine:
                found = term_counts(texts[row].as_py())
                lengths.append(len(found))
                numbers += [known.setdefault(term, len(known)) for term in found]
                counts += found.values()
            packed = [_packed(column) for column in (lengths, numbers, counts)]
            rows.append((lang, [groups[row] for row in mine], b" ".join(known), *packed))
        kinds = [pa.string(), pa.list_(pa.int64()), *[pa.binary()] * 4]
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        if rows:
            yield pa.RecordBatch.from_arrays(columns, names)


def prefix_hashes(lang: str, terms: list[bytes], width: int) -> np.ndarray:
    """64-bit hashes of the language and the first ``width`` bytes of every term."""
    seed = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    size = -(-min(width, SHORT) // 8) * 8
    # no term has a zero byte, so filling up with them keeps prefixes apart
    cut = np.array([term[:width] for term in terms] if width < size else terms, dtype=f"S{size}")
    columns = cut.view(np.uint64).reshape(len(terms), -1)
    hashes = np.full(len(terms), seed, dtype=np.uint64)
    for k in range(columns.shape[1]):
        hashes = mixed(hashes + columns[:, k]) + np.uint64(k)
    if width > SHORT:
        for row, term in enumerate(terms):
            if len(term) > SHORT:
                data = term[:width] + seed.to_bytes(8, "little")
                hashes[row] = int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")
    return hashes


class _Terms:
    """What one row of ``document_terms`` has left. ``level`` is the last one's width and
    filter, or None."""

    def __init__(self, lang: str, terms: bytes, lengths: bytes, numbers: bytes, level):
        self.lang, terms = lang, terms.split()
        left = np.ones(len(terms), dtype=bool)
        if level is not None and terms:
            left = level[1].has(prefix_hashes(lang, terms, level[0]))
        self.terms = [terms[i] for i in np.flatnonzero(left).tolist()]
        number = np.cumsum(left) - 1
        numbers, lengths = _unpacked(numbers), _unpacked(lengths)
        #: which entries of the row are left; their documents and terms
        self.kept = left[numbers] if len(numbers) else np.zeros(0, dtype=bool)
        self.docs = np.repeat(np.arange(len(lengths)), lengths)[self.kept]
        self.numbers = number[numbers[self.kept]] if len(numbers) else numbers

    def hashes(self, width: int) -> np.ndarray:
        return prefix_hashes(self.lang, self.terms, width)

    def documents(self, group: np.ndarray, groups: int) -> np.ndarray:
        """Of every group of terms the number of documents that have any of it."""
        entries, size = group[self.numbers], self.docs.max(initial=-1) + 1
        if size * groups > TABLE:
            return np.bincount(np.unique(self.docs * groups + entries) % groups, minlength=groups)
        table = np.zeros((size, groups), dtype=bool)
        table[self.docs, entries] = True
        return table.sum(axis=0)

    def longer(self, width: int) -> np.ndarray:
        return np.fromiter(map(len, self.terms), np.int64, len(self.terms)) > width


def _level_counts(width: int, level):
    """(hash of a prefix, documents that have it, whether it is cut) of what is left."""

    def combined(hashes, docs, cut):
        names, place = np.unique(np.concatenate(hashes), return_inverse=True)
        longer = np.zeros(len(names), dtype=bool)
        longer[place[np.concatenate(cut)]] = True
        counts = np.bincount(place, np.concatenate(docs)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(names.view(np.int64)), pa.array(counts), pa.array(longer)], ["prefix", "docs", "cut"]
        )

    def rows(batches):
        hashes, docs, cuts, held = [], [], [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                some = _Terms(*row, level)
                if not some.terms:
                    continue
                longer = some.longer(width)
                found, place = np.unique(some.hashes(width), return_inverse=True)
                cut = np.zeros(len(found), dtype=bool)
                cut[place[longer]] = True
                hashes.append(found)
                docs.append(some.documents(place, len(found)))
                cuts.append(cut)
                held += len(found)
                if held >= BUFFER:
                    yield combined(hashes, docs, cuts)
                    hashes, docs, cuts, held = [], [], [], 0
        if held:
            yield combined(hashes, docs, cuts)

    return rows


def _left_counts(level):
    """(group, hash of a term, documents, occurrences) of the terms left, combined in the task.
    Terms that the last level cuts are none of them."""
    names = ["group", "hash", "docs", "count"]

    def combined(hashes, groups, counts):
        hashes, groups, counts = (np.concatenate(c) for c in (hashes, groups, counts))
        order = np.lexsort((groups, hashes))
        hashes, groups, counts = hashes[order], groups[order], counts[order]
        first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (groups[1:] != groups[:-1])])
        docs = np.diff(np.r_[first, len(hashes)])
        columns = groups[first], hashes[first].view(np.int64), docs, np.add.reduceat(counts, first)
        return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)

    def rows(batches):
        hashes, groups, counts, held = [], [], [], 0
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for lang, of, terms, lengths, numbers, times in zip(*columns):
                some = _Terms(lang, terms, lengths, numbers, level)
                whole = ~some.longer(level[0])[some.numbers]
                if not whole.any():
                    continue
                hashes.append(some.hashes(level[0])[some.numbers[whole]])
                groups.append(np.array(of, dtype=np.int64)[some.docs[whole]])
                counts.append(_unpacked(times)[some.kept][whole])
                held += int(whole.sum())
                if held >= 4 * BUFFER:
                    yield combined(hashes, groups, counts)
                    hashes, groups, counts, held = [], [], [], 0
        if held:
            yield combined(hashes, groups, counts)

    return rows


def _names(width: int, wanted: Filter):
    """(lang, hash, term) of the terms that ``wanted`` may have, once in a task or so."""

    def rows(batches):
        seen: set[int] = set()
        for batch in batches:
            for lang, terms, lengths, numbers in zip(*(column.to_pylist() for column in batch.columns)):
                some = _Terms(lang, terms, lengths, numbers, (width, wanted))
                if not some.terms:
                    continue
                hashes = some.hashes(width).view(np.int64).tolist()
                fresh = [i for i, h in enumerate(hashes) if h not in seen and len(some.terms[i]) <= width]
                seen.update(hashes[i] for i in fresh)
                if len(seen) > BUFFER:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(fresh), pa.string()),
                        pa.array([hashes[i] for i in fresh], pa.int64()),
                        pa.array([some.terms[i].decode("utf-8", "replace") for i in fresh], pa.string()),
                    ],
                    ["lang", "hash", "term"],
                )

    return rows


_TERMS = ["lang", "terms", "lengths", "numbers"]


def _named(df: DataFrame, lang: str, source: str, *more) -> DataFrame:
    """``lang`` and ``source`` as texts, and ``more``."""
    return df.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))),
        *more,
    )


def groups_of(df: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(``group``, ``lang``, ``source``) of every group; two with the same hash fail the job."""
    found = _named(df, lang, source).distinct().groupBy(F.xxhash64("lang", "source").alias("group"))
    clash = F.when(F.count("*") > 1, F.raise_error(F.lit("two groups have the same hash")).cast("string"))
    return found.agg(F.coalesce(clash, F.first("lang")).alias("lang"), F.first("source").alias("source"))


def document_terms(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The terms of all documents, packed."""
    return map_arrow(
        _named(df, lang, source, F.col(text).alias("content")).select("lang", F.xxhash64("lang", "source").alias("group"), "content"),
        _document_terms,
        "lang string, groups array<bigint>, terms binary, lengths binary, numbers binary, counts binary",
    )


def refined(docs: DataFrame, least: int = LEAST, width: int = FIRST_WIDTH) -> list[tuple[int, Filter]]:
    """The levels' widths and filters of kept prefixes, down to the level that cuts no term."""
    levels: list[tuple[int, Filter]] = []
    while True:
        counted = map_arrow(
            docs.select(*_TERMS),
            _level_counts(width, levels[-1] if levels else None),
            "prefix bigint, docs bigint, cut boolean",
        )
        kept = stage(
            counted.groupBy("prefix")
            .agg(F.sum("docs").alias("docs"), F.max("cut").alias("cut"))
            .where(F.col("docs") >= least)
            .select("prefix", "cut"),
            "prefixes",
        )
        levels.append((width, Filter(kept, "prefix")))
        if kept.where("cut").isEmpty():
            return levels
        width *= 2


def kept_terms(docs: DataFrame, least: int = LEAST, levels: list | None = None) -> tuple[DataFrame, DataFrame]:
    """(``group``, ``hash``, ``count``) of the kept terms that a group has, and (``lang``,
    ``hash``, ``term``); ``docs`` is what ``document_terms`` gives. A hash is of the language
    and the term."""
    width, left = (refined(docs, least) if levels is None else levels)[-1]
    # combined in their tasks, rows move once, by hash, and meet their threshold where they land
    counted = (
        map_arrow(
            docs.select("lang", "groups", "terms", "lengths", "numbers", "counts"),
            _left_counts((width, left)),
            "group bigint, hash bigint, docs bigint, count bigint",
        )
        .repartition("hash")
        .groupBy("hash", "group")
        .agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))
        .withColumn("holders", F.sum("docs").over(Window.partitionBy("hash")))
    )
    kept = stage(counted.where(F.col("holders") >= least).select("group", "hash", "count"), "kept-terms")
    enough = stage(kept.select("hash").distinct(), "enough")
    named = map_arrow(
        docs.select(*_TERMS), _names(width, Filter(enough, "hash")), "lang string, hash bigint, term string"
    )
    clash = F.when(F.count("*") > 1, F.raise_error(F.lit("two terms have the same hash")).cast("string"))
    terms = (
        named.repartition("hash")
        .distinct()
        .join(enough, "hash")
        .groupBy("hash")
        .agg(F.coalesce(clash, F.first("lang")).alias("lang"), F.first("term").alias("term"))
    )
    return kept, terms


def _div(a: Column, b: Column) -> Column:
    """Exact floor of a quotient of integers that aren't negative."""
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a term with this count. In decimals, as the product may exceed 64 bits."""
    scaled = (count + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.lit(1).cast("bigint") + _div(scaled, F.greatest(total + kept, F.lit(1)).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _source_pairs(terms: DataFrame, groups: DataFrame, histogram: DataFrame) -> DataFrame:
    """(``lang``, ``source``, ``item``, ``value``): the sum of the divergences of every source
    from every other one of its language."""
    other = terms.select("hash", F.col("group").alias("of"), F.col("p").alias("q"), F.col("zero").alias("q_zero"))
    both = (
        terms.select("hash", "group", "p", "zero")
        .join(other, "hash")
        .where(F.col("group") != F.col("of"))
        .select(
            "group",
            "of",
            (
                divergence(F.col("p"), F.col("q"))
                - divergence(F.col("p"), F.col("q_zero"))
                - divergence(F.col("zero"), F.col("q"))
                + divergence(F.col("zero"), F.col("q_zero"))
            ).alias("part"),
        )
    )
    left = groups.select("lang", "group", "zero", "kept", F.col("distinct").alias("own"))
    right = groups.select(
        "lang", F.col("group").alias("of"), F.col("zero").alias("q_zero"), F.col("distinct").alias("others")
    )
    # the terms that only one of the two has, by their counts
    alone = (
        histogram.select("lang", "group", "p", "terms")
        .join(right, "lang")
        .where(F.col("group") != F.col("of"))
        .select("group", "of", (F.col("terms") * divergence(F.col("p"), F.col("q_zero"))).alias("part"))
    )
    against = (
        histogram.select("lang", F.col("group").alias("of"), F.col("p").alias("q"), "terms")
        .join(left, "lang")
        .where(F.col("group") != F.col("of"))
        .select("group", "of", (F.col("terms") * divergence(F.col("zero"), F.col("q"))).alias("part"))
    )
    neither = (
        left.join(right, "lang")
        .where(F.col("group") != F.col("of"))
        .select(
            "group",
            "of",
            (
                (F.col("kept") - F.col("own") - F.col("others"))
                * divergence(F.col("zero"), F.col("q_zero"))
            ).alias("part"),
        )
    )
    every = both.unionByName(alone).unionByName(against).unionByName(neither)
    sums = every.groupBy("group", "of").agg(F.sum("part").alias("value"))
    named = groups.select("group", "lang", "source")
    items = groups.select(F.col("group").alias("of"), F.col("source").alias("item"))
    return sums.join(named, "group").join(items, "of").select("lang", "source", "item", "value")


def source_divergence(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, ranks: int = RANKS
) -> DataFrame:
    """(``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``): for every source the other
    sources of its language by falling divergence (part ``pair``), and the ``ranks`` terms that
    it has most above the language's share (part ``term``). Runs several jobs."""
    docs = stage(document_terms(df, text, lang, source), "document-terms")
    counted, names = kept_terms(docs, least)
    whole = counted.groupBy("hash").agg(F.sum("count").alias("lang_count"))
    whole = stage(whole.join(names, "hash"), "language-terms")
    langs = whole.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_count").alias("lang_total"))
    totals = counted.groupBy("group").agg(F.count("*").alias("distinct"), F.sum("count").alias("total"))
    nothing = F.lit(0).cast("bigint")
    groups = (
        groups_of(df, lang, source)
        .join(langs, "lang", "left")
        .join(totals, "group", "left")
        .select(
            "group", "lang", "source",
            *(F.coalesce(c, nothing).alias(c) for c in ("kept", "lang_total", "distinct", "total")),
        )
        .withColumn("zero", share(nothing, F.col("total"), F.col("kept")))
    )
    groups = stage(groups, "groups")
    sized = groups.select("group", "lang", "kept", "total", "lang_total", "zero")
    terms = counted.join(sized, "group").withColumn("p", share(F.col("count"), F.col("total"), F.col("kept")))
    terms = stage(terms.select("group", "lang", "hash", "p", "zero", "kept", "lang_total"), "shares")
    histogram = stage(terms.groupBy("lang", "group", "p").agg(F.count("*").alias("terms")), "histogram")

    pairs = _source_pairs(terms, groups, histogram)
    above = (
        terms.join(whole.select("hash", "term", "lang_count"), "hash")
        .withColumn("q", share(F.col("lang_count"), F.col("lang_total"), F.col("kept")))
        .where(F.col("p") > F.col("q"))
        .select("group", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    )
    falling = [F.desc("value"), F.col("item")]
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*falling)))
    first = above.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(*falling)))
    first = first.where(F.col("rank") <= ranks).join(groups.select("group", "lang", "source"), "group")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        ranked.withColumn("part", F.lit("pair"))
        .select(*columns)
        .unionByName(first.withColumn("part", F.lit("term")).select(*columns))
    )


def op13_source_divergence(spark, sf_dir):
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _p(count: str, total: str, kept: str) -> str:
    return f"(1 + ({UNIT}::HUGEINT * ({count} + 1)) // greatest({total} + {kept}, 1))"


OP13_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= {LEAST}),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, v.v AS v
  FROM g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang
       LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (SELECT lang, source, term, n, {_p('n', 'total', 'v')} AS p FROM dense),
whole AS (
  SELECT lang, term, {_p('n', 'total', 'v')} AS p FROM (
    SELECT lang, term, n, sum(n) OVER (PARTITION BY lang) AS total, v FROM (
      SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) JOIN v USING (lang))),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(max(s.value), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  GROUP BY a.lang, a.source, b.source),
term AS (
  SELECT s.lang, s.source, s.term AS item, (s.p - w.p) * (s.p - w.p) // w.p AS value
  FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE s.n > 0 AND s.p > w.p),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= {RANKS}
"""
