"""Quality classifier: how much better a text compresses with a zstandard dictionary of
good texts than with one of bad texts.

A text is compressed in pieces of ``PIECE`` bytes, all of them, once with each dictionary,
so that the dictionaries count as much at the end of a long text as in a short one. The
difference of the two compressed sizes over their sum, from -1 to 1, is turned into the
probability of label 1 by a logistic curve that is fitted on labelled texts the dictionaries
have not seen. A short text is weak evidence: the logit of a text of ``n`` bytes is the
curve's with weight ``n / (n + EVIDENCE)`` and that of the share of label 1 for the rest.

The classifier is fitted on a bounded sample: for each label the ``rows`` documents with the
smallest hash of their id among the labelled ones with a text outside the held-out fold, of
each the first ``MAX_CHARS`` characters. Every second one goes into a dictionary, the others fit the curve;
the shares of the two labels are counted over all labelled documents outside the fold.

Null and empty texts have nothing to compress and score the share of label 1. The same
holds for every text while one of the labels is missing; without any label it is 0.5. Null
ids and null or other labels are not learned from; an id with both labels neither. Repeated
rows get the same score each. Other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.llm.text import ROWS as SLICE, built, fold, give_back
from framesift.workspace import ship_package

ROWS = 2000
MAX_CHARS = 16 * 1024
DICTIONARY_BYTES = 112_640
LEVEL = 3
PIECE = 512
FOLDS, HELD_OUT = 3, 1

#: Spreads the difference, which is mostly within 0.1 of 0.
SCALE = 50.0
EVIDENCE = 64
RIDGE = 1e-2


@dataclass(frozen=True)
class Classifier:
    """Two dictionaries and the curve; without dictionaries every score is ``share``."""

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    intercept: float = 0.0
    share: float = 0.5

    def evidence(self, text: str | None, compressors) -> tuple[float, float]:
        """Difference of the compressed sizes, and its weight."""
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data or not compressors:
            return 0.0, 0.0
        good, bad = compressors
        with_good = with_bad = 0
        for at in range(0, len(data), PIECE):
            piece = data[at : at + PIECE]
            with_good += len(good.compress(piece))
            with_bad += len(bad.compress(piece))
        return (with_bad - with_good) / (with_bad + with_good), len(data) / (len(data) + EVIDENCE)

    def score(self, text: str | None, compressors) -> float:
        difference, weight = self.evidence(text, compressors)
        if not weight:
            return self.share
        curve = self.slope * SCALE * difference + self.intercept
        return _logistic(weight * curve + (1 - weight) * _logit(self.share))

    def compressors(self):
        if not self.good or not self.bad:
            return None
        return _compressor(self.good), _compressor(self.bad)


def _logistic(value: float) -> float:
    return 1 / (1 + math.exp(-value)) if value > -700 else 0.0


def _logit(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return math.log(share / (1 - share))


def _compressor(dictionary: bytes):
    import zstandard

    trained = zstandard.ZstdCompressionDict(dictionary)
    trained.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=trained,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


def dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; where the texts are too few to train one, their last bytes."""
    import zstandard

    encoded = [text.encode("utf-8", "surrogatepass") for text in texts]
    pieces = [data[at : at + 2048] for data in encoded for at in range(0, len(data), 2048)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(encoded)[-DICTIONARY_BYTES:]


def calibrate(evidence, labels, weights, share: float) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic regression, by Newton's method."""
    difference, known = np.asarray(evidence, dtype=float).T
    x = np.column_stack([SCALE * difference * known, known])
    given = (1 - known) * _logit(share)
    y, w = np.asarray(labels, dtype=float), np.asarray(weights, dtype=float)
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta + given, -500, 500)))
        gradient = x.T @ (w * (y - p)) - RIDGE * beta
        curvature = (x * (w * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def labelled(labels: DataFrame, label: str = "quality", key: str = "doc_id") -> DataFrame:
    """One row (``key``, ``good``) for each id with one label outside the held-out fold."""
    value = F.col(label).cast("int")
    return (
        labels.where(value.isin(0, 1) & (fold(key, FOLDS) != HELD_OUT))
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(value).alias("good"), F.max(value).alias("_most"))
        .where(F.col("good") == F.col("_most"))
        .select("key", "good")
    )


def sample(docs: DataFrame, known: DataFrame, rows: int, text: str = "text", key: str = "doc_id"):
    """(label, text) of at most ``rows`` documents for each label that have a text, in the order
    of a hash; of a long text the first ``MAX_CHARS`` characters."""
    spread = F.xxhash64("key")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("content")).where(F.octet_length("content") > 0)
    learnable = texts.select("key").join(known, "key").distinct()
    chosen = None
    for good in (0, 1):
        some = learnable.where(F.col("good") == good).orderBy(spread, "key").limit(rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    # ``chosen`` has at most 2 * rows ids
    return (
        texts.join(F.broadcast(chosen), "key")
        .orderBy(spread, "key", F.xxhash64("content"))
        .limit(2 * rows)
        .select("good", F.substring("content", 1, MAX_CHARS).alias("content"))
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = ROWS,
    label: str = "quality",
    text: str = "text",
    key: str = "doc_id",
) -> Classifier:
    known = labelled(labels, label, key)
    counts = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    if len(counts) < 2:
        return Classifier(share=share)
    texts: dict[int, list[str]] = {0: [], 1: []}
    for good, content in sample(docs, known, rows, text, key).collect():
        texts[good].append(content)
    if min(map(len, texts.values())) < 2:
        return Classifier(share=share)
    model = Classifier(dictionary(texts[1][::2]), dictionary(texts[0][::2]), share=share)
    compressors = model.compressors()
    unseen = [(good, content) for good in (0, 1) for content in texts[good][1::2]]
    weight = {0: (1 - share) / len(texts[0][1::2]), 1: share / len(texts[1][1::2])}
    slope, intercept = calibrate(
        [model.evidence(content, compressors) for _, content in unseen],
        [good for good, _ in unseen],
        [weight[good] * len(unseen) for good, _ in unseen],
        share,
    )
    return Classifier(model.good, model.bad, slope, intercept, share)


def scores(model: Classifier, text: Column | str, spark) -> Column:
    """The probability of label 1 for every text."""
    ship_package(spark)
    key = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY_BYTES

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        compressors = built("quality", key, shared.value.compressors)
        found = []
        for at in range(0, len(texts), SLICE):  # not all texts of a batch as Python strings at once
            found += [shared.value.score(content, compressors) for content in texts.slice(at, SLICE).to_pylist()]
        give_back()
        return pa.array(found, pa.float64())

    return score(text)


def accepted(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """The rows whose score is at least one half, all columns as they are."""
    return docs.where(scores(model, F.col(text), docs.sparkSession) >= 0.5)


def op10_quality_classifier(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        scores(model, "text", spark).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
