"""Mixing sources to target weights by Sainte-Lague apportionment.

The size of a text is its number of ``WORD`` words. Sources, in code point order and null
last, weigh 1, 2, 3, repeating, and share all words by weight; the target of a source stops
at ``REPEATS`` times its size and the excess is shared by weight among the others until none
is above.

Targets are apportioned in blocks of equal size: the highest quotients ``target / (2k + 1)``
get the blocks. Sources of fewer than ``LEAST_BLOCKS`` blocks have finer blocks of their own, as
many as come nearest to their target, so that only their texts are cut finer. A source is cut into shards of about ``SHARD_WORDS`` words by a hash of its
rows, so that a source of any size is many shards; its blocks are apportioned to its shards by
their sizes in the same way. Inside a shard the rows stand on one line in the order of a
seeded hash, the line is cut into blocks, and the quota takes every block equally often, the
remainder being drawn by a seeded permutation. A block is taken ``REPEATS`` times at most, so
no text is.

Blocks have ``BLOCK_WORDS`` words, those of a small source a ``LEAST_BLOCKS``-th of its words;
the last block of a shard may be shorter. What is taken of a source differs from its target by
less than ``REPEATS`` blocks for each shard.

Null texts and texts without words have size 0 and are taken 0 times. Null sources are a
source of their own. Repeated rows are rows of their own. An empty table gives no rows. Other
columns, whatever their names, are handed through by ``mixed`` and not read otherwise. The
sources, not their rows, are collected: a mixture is stated by its sources.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framesift.llm.text import WORD, free_name, give_back
from framesift.workspace import ship_package, stage

WEIGHTS = (1, 2, 3)
REPEATS = 3
BLOCK_WORDS = 64
LEAST_BLOCKS = 16
SHARD_WORDS = 1 << 19
SEED = 20240229

_WORD = re.compile(WORD)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: dict, weights=WEIGHTS, repeats: int = REPEATS) -> dict:
    """Words wanted from every source."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    wanted, open_names, left = {}, names, float(sum(sizes.values()))
    while open_names:
        share = left / sum(weight[name] for name in open_names)
        over = [n for n in open_names if share * weight[n] > repeats * sizes[n]]
        if not over:
            wanted |= {n: share * weight[n] for n in open_names}
            break
        wanted |= {n: float(repeats * sizes[n]) for n in over}
        left -= sum(repeats * sizes[n] for n in over)
        open_names = [n for n in open_names if n not in set(over)]
    return wanted


def apportion(seats: int, votes: list[float], most: list[int]) -> list[int]:
    """Sainte-Lague: seats to the highest quotients ``votes / (2k + 1)``, ties to the first;
    none above ``most``. Starts from rounded shares and mends the difference, so its cost
    depends on the number of parties and not of seats."""
    total = sum(votes)
    seats = min(seats, sum(m for v, m in zip(votes, most) if v > 0))
    if total <= 0 or seats <= 0:
        return [0] * len(votes)
    given = [min(int(v * seats / total + 0.5), m) for v, m in zip(votes, most)]

    def settle(rise: bool, change: int):
        # the next seat's quotient, or the last one's, of every party
        def entry(i):
            k = given[i] if rise else given[i] - 1
            quotient = votes[i] / (2 * k + 1)
            return (-quotient, i) if rise else (quotient, -i)

        able = (lambda i: votes[i] > 0 and given[i] < most[i]) if rise else (lambda i: given[i] > 0)
        heap = [entry(i) for i in range(len(votes)) if able(i)]
        heapq.heapify(heap)
        for _ in range(change):
            _, i = heapq.heappop(heap)
            i = abs(i)
            given[i] += 1 if rise else -1
            if able(i):
                heapq.heappush(heap, entry(i))

    change = seats - sum(given)
    settle(change > 0, abs(change))
    return given


def block_size(words: int) -> int:
    """Words in a block of a source of so many words."""
    return max(1, min(BLOCK_WORDS, words // LEAST_BLOCKS))


def quotas(sizes: dict, wanted: dict, blocks: dict) -> dict:
    """How many of its ``blocks`` every source gives: small ones by themselves, the others
    apportioned together."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    large = [n for n in names if blocks[n] == BLOCK_WORDS]
    quota = {}
    for some in [large, *([n] for n in names if blocks[n] != BLOCK_WORDS)]:
        votes = [wanted[n] for n in some]
        most = [REPEATS * -(-sizes[n] // blocks[n]) for n in some]
        seats = round(sum(votes) / blocks[some[0]]) if some else 0
        quota |= zip(some, apportion(seats, votes, most))
    return quota


def block_times(words: int, quota: int, block: int, seed: int) -> np.ndarray:
    """How often each block of a line of words is taken."""
    blocks = -(-words // block)
    if not blocks:
        return np.zeros(0, dtype=np.int64)
    times = np.full(blocks, quota // blocks, dtype=np.int64)
    whole = words // block  # a shorter last block is drawn last
    drawn = np.random.Generator(np.random.PCG64(seed & ((1 << 64) - 1))).permutation(whole)
    drawn = np.r_[drawn, np.arange(whole, blocks)]
    times[drawn[: quota % blocks]] += 1
    return times


def taken_words(sizes: np.ndarray, times: np.ndarray, block: int) -> np.ndarray:
    """Words taken from each row of a line, repeats counted."""
    ends = np.cumsum(sizes)
    lengths = np.full(len(times), block, dtype=np.int64)
    before = np.r_[0, np.cumsum(times * lengths)]
    padded = np.r_[times, 0]

    def upto(at):
        return before[at // block] + padded[at // block] * (at % block)

    return upto(ends) - upto(ends - sizes)


def runs(start: int, end: int, times: np.ndarray, block: int) -> Iterator[tuple[int, int]]:
    """Word ranges of a row that stands from ``start`` to ``end`` on its line, one for each
    uninterrupted stretch of each repeat, counted from the row's first word."""
    first, last = start // block, (end - 1) // block
    some = times[first : last + 1]
    for repeat in range(1, int(some.max(initial=0)) + 1):
        on = np.flatnonzero(np.diff(np.r_[0, some >= repeat, 0]))
        for a, b in zip(on[::2].tolist(), on[1::2].tolist()):
            yield max(start, (first + a) * block) - start, min(end, (first + b) * block) - start


def cut(text: str, first: int, last: int, size: int) -> str:
    """The words ``first`` to ``last`` of a text of ``size`` words, with what is between."""
    if first == 0 and last == size:
        return text
    begin = end = None
    for n, found in enumerate(_WORD.finditer(text)):
        if n == first:
            begin = found.start()
        if n == last - 1:
            end = found.end()
            break
    return text[begin:end]


class Plan:
    """Quotas of a mixture: ``df`` with shards (``rows``) and what each shard gives."""

    def __init__(self, df: DataFrame, source: str, text: str, keep: list[str], seed: int,
                 shard_words: int, weights):
        self.spark = spark = df.sparkSession
        ship_package(spark)
        self.keep, self.seed = keep, seed
        self.size, self.place, self.shard = (free_name(df, n) for n in ("size", "place", "shard"))
        self.source = free_name(df, "mix_source")
        sized = df.select(
            *keep,
            F.col(source).cast("string").alias(self.source),
            word_count(F.col(text)).alias(self.size),
            F.xxhash64(*(F.col(c) for c in keep if c != text), F.col(text), F.lit(seed)).alias(self.place),
        )
        if text not in keep:  # sizes are small: count words once
            sized = stage(sized, "sized")
        by_source = sized.groupBy(self.source).agg(F.sum(self.size)).collect()
        self.sizes = {name: size for name, size in by_source}
        self.targets = targets(self.sizes, weights)
        self.blocks = {name: block_size(size) for name, size in self.sizes.items()}
        shards = {name: max(1, -(-size // shard_words)) for name, size in self.sizes.items()}
        table = spark.createDataFrame(
            [(name, count) for name, count in shards.items()] or [(None, 1)],
            T.StructType([T.StructField("name", T.StringType()), T.StructField("shards", T.LongType())]),
        )
        count = free_name(df, "shards")
        self.rows = (
            sized.join(
                F.broadcast(table.withColumnsRenamed({"name": free_name(df, "_name"), "shards": count})),
                F.col(self.source).eqNullSafe(F.col(free_name(df, "_name"))),
            )
            .withColumn(self.shard, F.pmod(F.shiftright(self.place, 20), F.col(count)))
            .drop(count, free_name(df, "_name"))
        )
        self.quota = quotas(self.sizes, self.targets, self.blocks)

    def quotas(self) -> DataFrame:
        """(source, shard, quota) for every shard; a source's shards are apportioned in one
        group of one row for each shard."""
        blocks, quota = self.blocks, self.quota
        sizes = self.rows.groupBy(self.source, self.shard).agg(F.sum(self.size).alias("words"))
        source, shard = self.source, self.shard

        def give(table: pa.Table) -> pa.Table:
            table = table.sort_by(shard)
            words, name = table["words"].to_pylist(), table[source][0].as_py()
            most = [REPEATS * -(-w // blocks[name]) for w in words]
            given = apportion(quota[name], [float(w) for w in words], most)
            return table.select([source, shard]).append_column("quota", pa.array(given, pa.int64()))

        return sizes.groupBy(source).applyInArrow(
            give, f"`{source}` string, `{shard}` bigint, quota bigint"
        )

    def grouped(self, function, schema) -> DataFrame:
        """``function(rows in line order, times of the blocks, source)`` for every shard."""
        blocks, seed = self.blocks, self.seed
        source, shard, place, size = self.source, self.shard, self.place, self.size
        names = free_name(self.rows, "_source"), free_name(self.rows, "_shard")
        quota = free_name(self.rows, "_quota")
        quotas = stage(self.quotas(), "quotas").withColumnsRenamed(
            {source: names[0], shard: names[1], "quota": quota}
        )
        rows = self.rows.join(
            quotas,
            F.col(source).eqNullSafe(F.col(names[0])) & (F.col(shard) == F.col(names[1])),
        ).drop(*names)

        def run(table: pa.Table) -> pa.Table:
            give_back()  # what the shard before took
            sizes = table[size].to_numpy()
            order = np.lexsort((sizes, table[place].to_numpy()))
            table, sizes = table.take(pa.array(order)), sizes[order]
            name = table[source][0].as_py()
            draw = seed + 7919 * table[shard][0].as_py() + _code(name)
            times = block_times(int(sizes.sum()), table[quota][0].as_py(), blocks[name], draw)
            return function(table, sizes, times, name)

        return rows.groupBy(source, shard).applyInArrow(run, schema)


def _code(name: str | None) -> int:
    return 0 if name is None else zlib.crc32(name.encode("utf-8", "surrogatepass")) << 20


def taken(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
          seed: int = SEED, shard_words: int = SHARD_WORDS, weights=WEIGHTS) -> DataFrame:
    """For every row: its id, ``size``, ``source_size``, ``target`` and ``taken``, the words
    the mix takes from it. Runs jobs for the sizes of the sources and shards."""
    docs = df.select(F.col(key).alias("id"), F.col(source).alias("source"), F.col(text).alias("text"))
    plan = Plan(docs, "source", "text", ["id"], seed, shard_words, weights)
    blocks, sizes, wanted = plan.blocks, plan.sizes, plan.targets
    id_type = docs.schema["id"].dataType.simpleString()

    def rows(table, words, times, name):
        columns = [
            table["id"],
            pa.array(words, pa.int64()),
            pa.array([sizes[name]] * len(words), pa.int64()),
            pa.array([wanted[name]] * len(words), pa.float64()),
            pa.array(taken_words(words, times, blocks[name]), pa.int64()),
        ]
        return pa.Table.from_arrays(columns, ["id", "size", "source_size", "target", "taken"])

    return plan.grouped(
        rows, f"id {id_type}, size bigint, source_size bigint, target double, taken bigint"
    ).withColumnRenamed("id", key)


def mixed(df: DataFrame, source: str = "source", text: str = "text", n_chars: str | None = "n_chars",
          seed: int = SEED, shard_words: int = SHARD_WORDS, weights=WEIGHTS) -> DataFrame:
    """The mix itself: one row for each stretch of words that is taken of a row, as often as
    it is taken, with the columns of ``df``. ``text`` is the stretch, ``n_chars`` (if ``df``
    has it) its length. Texts without words are not taken."""
    plan = Plan(df, source, text, df.columns, seed, shard_words, weights)
    columns, blocks = df.columns, plan.blocks

    def rows(table, words, times, name):
        ends, places, texts = np.cumsum(words).tolist(), [], []
        content = table[text]
        for row, (end, count) in enumerate(zip(ends, words.tolist())):
            if count:
                for first, last in runs(end - count, end, times, blocks[name]):
                    places.append(row)
                    texts.append(cut(content[row].as_py(), first, last, count))
        at = pa.array(places, pa.int64())
        new = {text: pa.array(texts, pa.string()), n_chars: pa.array([len(t) for t in texts], pa.int64())}
        return pa.Table.from_arrays(
            [
                new[c].cast(table.schema.field(c).type) if c in new else table[c].take(at)
                for c in columns
            ],
            columns,
        )

    return plan.grouped(rows, df.schema)


def op5_source_mixture(spark, sf_dir):
    return taken(spark.read.parquet(f"{sf_dir}/documents.parquet"))
