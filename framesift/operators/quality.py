"""Checks on captions: backend agreement, degenerate output, match with references."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.operators.ordering import join_groups
from framesift.workspace import ship_package, stage


def backend_agreement(first: DataFrame, second: DataFrame, key: str = "path") -> DataFrame:
    """Per asset the rows of both results and whether all its captions are the same.

    Both sides meet in one aggregation, which merges equal captions of an asset before
    they are shuffled; copies are never joined with each other.
    """
    both = first.select(key, "caption", F.lit(1).alias("_side")).unionByName(
        second.select(key, "caption", F.lit(2).alias("_side"))
    )
    texts = both.groupBy(key, "caption").agg(
        F.count(F.when(F.col("_side") == 1, 1)).alias("_first"),
        F.count(F.when(F.col("_side") == 2, 1)).alias("_second"),
    )
    merged = texts.groupBy(key).agg(
        F.sum("_first").alias("first_rows"),
        F.sum("_second").alias("second_rows"),
        F.count(F.lit(1)).alias("_texts"),
        F.count("caption").alias("_known"),
    )
    return merged.select(
        key,
        "first_rows",
        "second_rows",
        (F.col("first_rows") == F.col("second_rows")).alias("rows_agree"),
        ((F.col("_texts") == 1) & (F.col("_known") == 1)).alias("captions_agree"),
    )


def caption_variety(captions: DataFrame, by: Sequence[str] = (), least: float = 0.5) -> DataFrame:
    """Share of distinct captions, and whether it is suspiciously low.

    One caption for everything is how a model that never saw its input looks. Equal
    captions are merged before the shuffle, so a caption that all rows share is no
    hot key.
    """
    counted = captions.groupBy(*by, "caption").agg(F.count(F.lit(1)).alias("_copies"))
    variety = F.count("caption") / F.sum("_copies")
    return counted.groupBy(*by).agg(
        F.sum("_copies").alias("captions"),
        F.count("caption").alias("distinct_captions"),
        variety.alias("variety"),
        (variety < least).alias("degenerate"),
    )


#: Logarithm of a caption sketch's size; its standard error is 1.04 / 2 ** (SKETCH_SIZE / 2).
SKETCH_SIZE = 14
#: Standard errors by which an estimate must differ from the threshold to decide alone.
SURE = 6.0


def caption_sketch(caption="caption") -> Column:
    """Aggregate: a sketch of the distinct captions, mergeable over shards and runs."""
    return F.hll_sketch_agg(caption, SKETCH_SIZE)


def sketched_variety(sketches: DataFrame, by: Sequence[str] = (), least: float = 0.5) -> DataFrame:
    """Whether captions are degenerate, from the sketches of their parts alone.

    ``sketches`` has ``captions``, a count, and ``sketch``, one row for each part of a group.
    ``degenerate`` is null where the estimate is too near the threshold to tell.
    """
    merged = sketches.groupBy(*by).agg(
        F.sum("captions").alias("captions"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )
    error = SURE * 1.04 / 2 ** (SKETCH_SIZE / 2)
    wanted, found = least * F.col("captions"), F.col("distinct_estimate")
    degenerate = F.when(found * (1 + error) < wanted, True).when(found * (1 - error) > wanted, False)
    return merged.withColumn("degenerate", F.when(F.col("captions") == 0, False).otherwise(degenerate))


def variety_gate(
    captions: DataFrame, parts: Sequence[str], by: Sequence[str] = (), least: float = 0.5
) -> DataFrame:
    """``captions`` and ``degenerate`` of every group in ``by``, as ``caption_variety`` finds
    it, but counted exactly only for groups whose sketches can't tell. ``parts`` are the
    columns that a group's sketches are made by, such as the shard."""
    sketches = captions.groupBy(*by, *parts).agg(
        F.count(F.lit(1)).alias("captions"), caption_sketch().alias("sketch")
    )
    told = stage(sketched_variety(sketches, by, least), "variety")
    unsure = told.where(F.col("degenerate").isNull()).select(*by, F.lit(True).alias("_unsure"))
    sure = told.where(F.col("degenerate").isNotNull()).select(*by, "captions", "degenerate")
    if unsure.isEmpty():
        return sure
    near = join_groups(captions, unsure, by) if by else captions
    exact = caption_variety(near, by, least).select(*by, "captions", "degenerate")
    return sure.unionByName(exact)


def tokens(text) -> Column:
    """Lower-case words between single spaces."""
    return F.split(F.lower(text), " ")


def ngrams(words: Column, n: int) -> Column:
    """Array of the runs of ``n`` words, joined by spaces."""
    starts = F.sequence(F.lit(1), F.size(words) - n + 1)
    runs = F.transform(starts, lambda at: F.array_join(F.slice(words, at, n), " "))
    return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<string>"))


def pair_ngrams(
    pairs: DataFrame, key: str, candidate: str, reference: str, by: Sequence[str] = (), order: int = 4
) -> DataFrame:
    """Per pair of texts the n-grams up to ``order`` words of both: ``n``, ``gram`` and
    how often the candidate (``made``) and the reference (``given``) hold it.

    ``key`` must be unique. The pairs are hashed on it before their texts unfold, so
    the n-grams, several times the size of the texts, are counted where they arise
    and not shuffled.
    """
    def tagged(words: str, side: int, n: int) -> Column:
        tags = F.lit(side).alias("side"), F.lit(n).alias("n")
        return F.transform(ngrams(F.col(words), n), lambda gram: F.struct(*tags, gram.alias("gram")))

    unfolded = F.concat(
        *[tagged("_words", 1, n) for n in range(1, order + 1)],
        *[tagged("_given_words", 2, n) for n in range(1, order + 1)],
    )
    # A fixed number of tasks: the short texts would else be coalesced before they unfold.
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pairs.select(key, *by, candidate, reference).repartition(tasks, key)
    words = placed.select(
        key,
        *by,
        tokens(F.col(candidate)).alias("_words"),
        tokens(F.col(reference)).alias("_given_words"),
    )
    # The outer form, lest Spark infer a filter that builds all n-grams once more.
    grams = words.select(key, *by, F.explode_outer(unfolded).alias("_g")).where("_g IS NOT NULL")
    side = F.col("_g.side")
    return grams.groupBy(key, *by, F.col("_g.n").alias("n"), F.col("_g.gram").alias("gram")).agg(
        F.count(F.when(side == 1, 1)).alias("made"), F.count(F.when(side == 2, 1)).alias("given")
    )


def _gram_matches(order: int, kept: list[str]):
    """Columns ``kept`` and, for each order, the candidate's n-grams and how many of them the
    reference holds too, and the reference's words, of every pair."""

    def counted(words: list[str], n: int) -> Counter:
        return Counter(zip(*(words[k:] for k in range(n))))

    def rows(batches):
        for batch in batches:
            made = np.zeros((2 * order + 1, batch.num_rows), dtype=np.int64)
            texts = zip(batch.column("_candidate").to_pylist(), batch.column("_reference").to_pylist())
            for row, (candidate, reference) in enumerate(texts):
                words, given = ([] if text is None else text.split(" ") for text in (candidate, reference))
                made[2 * order, row] = len(given)
                for n in range(1, order + 1):
                    made[n - 1, row] = max(len(words) - n + 1, 0)
                    held = counted(given, n)
                    shared = ((gram, count) for gram, count in counted(words, n).items() if gram in held)
                    made[order + n - 1, row] = sum(min(count, held[gram]) for gram, count in shared)
            names = [*kept, *(f"_grams{n}" for n in range(1, order + 1))]
            names += [*(f"_matches{n}" for n in range(1, order + 1)), "reference_words"]
            columns = [batch.column(name) for name in kept] + [pa.array(column) for column in made]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows


def bleu(
    pairs: DataFrame, key: str, candidate: str, reference: str, by: Sequence[str] = (), order: int = 4
) -> DataFrame:
    """Corpus BLEU of the candidates, per ``by`` group: n-gram precisions up to
    ``order``, brevity penalty and score. Within a pair an n-gram matches at most as
    often as the reference holds it. The score is 0 where some order has no match.

    N-grams are counted within the row of their pair, where they arise, and only their sums
    are shuffled, combined on the map side.
    """
    ship_package(pairs.sparkSession)
    texts = [F.lower(candidate).alias("_candidate"), F.lower(reference).alias("_reference")]
    sums = [f"_{kind}{n}" for kind in ("grams", "matches") for n in range(1, order + 1)] + ["reference_words"]
    kinds = {field.name: field.dataType.simpleString() for field in pairs.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in by] + [f"{name} bigint" for name in sums])
    counts = pairs.select(*by, *texts).mapInArrow(_gram_matches(order, list(by)), schema)
    wide = counts.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    precisions = [
        F.when(F.col(f"_grams{n}") > 0, F.col(f"_matches{n}") / F.col(f"_grams{n}")).otherwise(0.0)
        for n in range(1, order + 1)
    ]
    words, given = F.col("_grams1"), F.col("reference_words")
    brevity = (
        F.when(words >= given, F.lit(1.0)).when(words > 0, F.exp(1 - given / words)).otherwise(0.0)
    )
    # A precision of 0 has no logarithm: the sum is null then and the score 0.
    logs = sum((F.ln(p) for p in precisions[1:]), F.ln(precisions[0]))
    return wide.select(
        *by,
        words.alias("words"),
        "reference_words",
        *[p.alias(f"precision_{n}") for n, p in enumerate(precisions, 1)],
        brevity.alias("brevity"),
        F.coalesce(brevity * F.exp(logs / order), F.lit(0.0)).alias("bleu"),
    )


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    for _ in range(2):
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _gram_counts(order: int):
    """(key, n, two hashes of an n-gram, how often candidate and reference have it) of every key;
    the rows of a key come together."""
    factors = _mixed(np.arange(1, 2 * order + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    known: dict[str, tuple[int, int]] = {}

    def word(text: str) -> tuple[int, int]:
        if text not in known:
            if len(known) > 500_000:
                known.clear()
            digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            known[text] = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
        return known[text]

    def hashed(n: int, words: np.ndarray) -> np.ndarray:
        count = max(len(words) - n + 1, 0)
        found = np.full((count, 2), n, dtype=np.uint64)
        for k in range(n):
            found = _mixed(found + words[k : k + count] * factors[k])
        return found

    def counted(pairs):
        """The n-grams of all texts of one key."""
        grams, sizes, sides = [], [], []
        for side, text in ((side, text) for pair in pairs for side, text in enumerate(pair) if text is not None):
            words = np.array([word(w) for w in text.split(" ")], dtype=np.uint64)
            for n in range(1, order + 1):
                grams.append(hashed(n, words))
                sizes.append(np.full(len(grams[-1]), n, np.int32))
                sides.append(np.full(len(grams[-1]), side, np.int64))
        if not grams:
            return None
        grams, sizes, sides = map(np.concatenate, (grams, sizes, sides))
        place = np.lexsort((grams[:, 1], grams[:, 0], sizes))
        grams, sizes, sides = grams[place], sizes[place], sides[place]
        first = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]).any(axis=1) | (sizes[1:] != sizes[:-1])])
        given = np.add.reduceat(sides, first)
        made = np.diff(np.r_[first, len(sides)]) - given
        return sizes[first], grams[first, 0], grams[first, 1], made, given

    def batch_of(held):
        keys, columns = zip(*held)
        lengths = [len(column[0]) for column in columns]
        sizes, first, second, made, given = (np.concatenate(column) for column in zip(*columns))
        named = pa.concat_arrays(keys).take(pa.array(np.repeat(np.arange(len(keys)), lengths)))
        arrays = [sizes, first.view(np.int64), second.view(np.int64), made, given]
        names = ["_key", "n", "_hash", "_check", "made", "given"]
        return pa.RecordBatch.from_arrays([named, *map(pa.array, arrays)], names)

    def rows(batches):
        held, ready, now, texts = [], 0, None, []
        for batch in batches:
            keys = batch.column(0)
            columns = (batch.column(i).to_pylist() for i in range(3))
            for row, (key, *pair) in enumerate(zip(*columns)):
                if now is None or key != now[0]:
                    if now is not None and (found := counted(texts)) is not None:
                        held.append((now[1], found))
                        ready += len(found[0])
                    now, texts = (key, keys.slice(row, 1)), []
                    if ready >= 200_000:
                        yield batch_of(held)
                        held, ready = [], 0
                texts.append(pair)
        if now is not None and (found := counted(texts)) is not None:
            held.append((now[1], found))
        if held:
            yield batch_of(held)

    return rows


#: Most common n-grams whose numbers are broadcast.
COMMON_GRAMS = 100_000


def cider(
    pairs: DataFrame,
    key: str,
    candidate: str,
    reference: str,
    order: int = 4,
    hot_pairs: int = 1_000_000,
) -> DataFrame:
    """CIDEr of every pair: the cosine of both texts' n-gram counts, weighted by how
    rare an n-gram is among the references, as the mean over n-gram lengths.

    Of the n-grams of more than ``hot_pairs`` references the ``COMMON_GRAMS`` most common ones
    are no join keys: their numbers are broadcast, and their rows are added up where they are.
    Others are joined once, with the numbers of those that several references have. Between
    pairs n-grams are told apart by 128 bits of hashes; only the texts of a pair are moved.
    """
    total = pairs.count()
    gram = ["_hash", "_check"]
    ship_package(pairs.sparkSession)
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = [F.lower(candidate).alias("_candidate"), F.lower(reference).alias("_reference")]
    placed = pairs.select(F.col(key).alias("_key"), *texts).repartition(tasks, "_key").sortWithinPartitions("_key")
    kind = pairs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, n int, _hash bigint, _check bigint, made bigint, given bigint"
    grams = stage(placed.mapInArrow(_gram_counts(order), schema).withColumnRenamed("_key", key), "ngrams")
    # Partial counts are made before the shuffle, so a common n-gram is no hot key here.
    seen = grams.where("given > 0").groupBy(*gram).agg(F.count(F.lit(1)).alias("pairs"))
    seen = stage(seen.where("pairs > 1"), "ngram-pairs")  # one pair weighs as none
    common = stage(
        seen.where(F.col("pairs") > hot_pairs).orderBy(F.desc("pairs"), *gram).limit(COMMON_GRAMS), "common-ngrams"
    )
    if common.isEmpty():
        weighted = grams.join(seen, gram, "left")
    else:
        rest = grams.join(F.broadcast(common), gram, "left_anti")
        weighted = rest.join(seen, gram, "left").unionByName(grams.join(F.broadcast(common), gram))
    weight = F.ln(F.lit(float(total)) / F.coalesce("pairs", F.lit(1)))
    made, given = F.col("made") * weight, F.col("given") * weight
    sums = weighted.groupBy(key, "n").agg(
        F.sum(made * given).alias("_both"),
        F.sum(made * made).alias("_made"),
        F.sum(given * given).alias("_given"),
    )
    lengths = F.sqrt(F.col("_made")) * F.sqrt(F.col("_given"))
    cosine = F.when(lengths > 0, F.col("_both") / lengths).otherwise(0.0)
    return sums.groupBy(key).agg((F.sum(cosine) / order).alias("cider"))
