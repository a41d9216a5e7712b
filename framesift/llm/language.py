"""Language identification by cross-parsing: a text is cut, from left to right, into the
longest phrases that occur in sample text of a language. The language that needs fewest
phrases, normalised by the size of its sample, wins.

A suffix automaton of the sample text gives the longest match from any place in one walk:
a phrase ends where the automaton has no transition. Texts are lower-cased, what ASCII has
beside letters becomes one space, and the walk is over UTF-8 bytes. A text is walked in
blocks of ``BLOCK`` bytes, all of them; a phrase does not cross the end of a block. Blocks
of many texts advance side by side, so long texts are no slower than short ones.

Entropy of a text in bits a byte: ``phrases * log2(sample size + 1) / bytes``. The smallest
wins, ties go to the first code in code point order. The score is the runner-up's entropy
over the sum of both, 1 where only one language is known.

Samples are bounded: for each language the ``rows`` documents with the smallest hash of
their id outside the held-out fold, of each the first ``MAX_CHARS`` characters, cut after
``letters`` bytes together. With very many languages ``letters`` falls so that all automata together stay below
``CELLS`` table cells of 4 bytes.

Null texts, texts without a letter, and all texts while no language is known, are ``und``
with score 0. Null languages and ids are not learned from. Repeated rows get the same answer
each. Other columns are not read.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framesift.llm.text import LOWER, built, fold
from framesift.workspace import ship_package

ROWS = 200
MAX_CHARS = 20_000
LETTERS = 40_000
CELLS = 40_000_000
BLOCK = 1024
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

_KEEP = set(LOWER.encode()) | set(range(128, 256))
_FOLDED = bytes(b if b in _KEEP else 32 for b in range(256))
_LETTER = regex.compile(r"\p{L}")


def folded(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_FOLDED).split())


def suffix_automaton(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Transitions of the suffix automaton as a table (state, symbol); 0, the root, stands
    for none, since no transition leads to the root."""
    follow: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for symbol in symbols.tolist():
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in follow[at]:
            follow[at][symbol] = state
            at = link[at]
        if at != -1:
            target = follow[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                clone = len(follow)
                follow.append(dict(follow[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                link[target] = link[state] = clone
                while at != -1 and follow[at].get(symbol) == target:
                    follow[at][symbol] = clone
                    at = link[at]
        last = state
    table = np.zeros((len(follow), alphabet), dtype=np.int32)
    for state, edges in enumerate(follow):
        if edges:
            table[state, list(edges)] = list(edges.values())
    return table


class Parser:
    """The automata of all languages over one alphabet: the bytes of all samples, and one
    symbol without transitions for any other byte."""

    def __init__(self, samples: dict[str, bytes]):
        self.names = sorted(samples)
        seen = sorted(set().union(*samples.values())) if samples else []
        self.alphabet = len(seen) + 1
        self.symbol = np.full(256, len(seen), dtype=np.int64)
        self.symbol[seen] = np.arange(len(seen))
        self.bits = [math.log2(len(samples[name]) + 1) for name in self.names]
        self.tables = [
            suffix_automaton(self.symbol[np.frombuffer(samples[name], np.uint8)], self.alphabet).ravel()
            for name in self.names
        ]

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Number of phrases of every text (rows) in every language (columns)."""
        sizes = np.array([len(text) for text in texts], dtype=np.int64)
        found = np.zeros((len(texts), len(self.names)), dtype=np.int64)
        if not sizes.sum():
            return found
        symbols = self.symbol[np.frombuffer(b"".join(texts), np.uint8)]
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = np.repeat(np.cumsum(sizes) - sizes, blocks) + nth * BLOCK
        lengths = np.minimum(sizes[owner] - nth * BLOCK, BLOCK)
        order = np.argsort(-lengths, kind="stable")
        owner, starts, lengths = owner[order], starts[order], lengths[order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        for language, table in enumerate(self.tables):
            state = np.zeros(len(owner), dtype=np.int64)
            count = np.zeros(len(owner), dtype=np.int64)
            for step, some in enumerate(active):
                now = state[:some]
                symbol = symbols[starts[:some] + step]
                following = table[now * self.alphabet + symbol]
                fresh = (now == 0) | (following == 0)
                count[:some] += fresh
                state[:some] = np.where(following == 0, table[symbol], following)
            np.add.at(found[:, language], owner, count)
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        ready = [folded(text) if text and _LETTER.search(text) else b"" for text in texts]
        counts = self.phrases(ready) if self.names else None
        names, scores = [], []
        for row, text in enumerate(ready):
            if not text or counts is None:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            entropy = counts[row] * self.bits / len(text)
            best = int(np.argmin(entropy))
            others = np.delete(entropy, best)
            names.append(self.names[best])
            scores.append(float(others.min() / (entropy[best] + others.min())) if len(others) else 1.0)
        return names, scores


def fit(
    docs: DataFrame, rows: int = ROWS, letters: int = LETTERS, text: str = "text",
    lang: str = "lang", key: str = "doc_id",
) -> dict[str, bytes]:
    """Sample text of every language, at most ``letters`` bytes each."""
    known = docs.select(
        F.col(key).alias("key"), F.col(lang).cast("string").alias("code"), F.col(text).alias("content")
    ).where(F.col("code").isNotNull() & (fold("key", FOLDS) != HELD_OUT))
    spread = [F.xxhash64("key"), F.col("key"), F.xxhash64("code")]
    first = Window.partitionBy("code").orderBy(*spread)
    chosen = (
        known.where(F.length("content") > 0)
        .select("key", "code")
        .withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") <= rows)
        .select("key", "code", "_place")
    )
    found: dict[str, list[bytes]] = {}
    sized: dict[str, int] = {}
    # ``chosen`` has at most ``rows`` ids a language; of a long text its beginning is enough
    some = known.where(F.length("content") > 0).join(F.broadcast(chosen), ["key", "code"])
    some = some.withColumn("content", F.substring("content", 1, MAX_CHARS))
    for code, content in some.orderBy("code", "_place").select("code", "content").toLocalIterator():
        if sized.get(code, 0) < letters:
            found.setdefault(code, []).append(folded(content))
            sized[code] = sized.get(code, 0) + len(found[code][-1]) + 1
    most = min(letters, max(1, CELLS // (2 * 64 * max(1, len(found)))))
    samples = {code: b" ".join(parts)[:most] for code, parts in found.items()}
    return {code: sample for code, sample in samples.items() if sample}


def prediction(samples: dict[str, bytes], text: Column | str, spark) -> Column:
    """Struct of the language and its score for every text."""
    ship_package(spark)
    key = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast(samples)  # at most LETTERS bytes a language

    @F.pandas_udf("struct<lang: string, score: double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        parser = built("language", key, lambda: Parser(shared.value))
        names, scores = parser.predict([content for content in texts])
        return pd.DataFrame({"lang": names, "score": scores})

    return predict(text)


def op4_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = docs.select("doc_id", prediction(fit(docs), "text", spark).alias("found"))
    return found.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("found")["lang"].alias("lang_pred"),
        F.col("found")["score"].alias("score"),
    )
