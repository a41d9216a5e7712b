"""Token counts as delta-maintained rollups by source, language and tokenizer version.

A batch of changes is turned into signed rows: a new count adds a document and its tokens, a
deletion takes back what the log has of the document, a revised count does both. The signed
rows are the log; their sums by source, language and tokenizer are the batch's rollup, and
the totals are the sums of all rollups. Nothing that is committed is read again as text.

A batch is committed under an id. Its log and rollup are written first, then a marker that is
created only once; what has no marker is not read and is overwritten by the next attempt. A
batch whose id is committed is not applied again: with the same changes it is left out, with
other ones it is refused. So a job may be repeated from its start at any time.

Changes: ``op`` (``put`` or ``delete``), ``doc_id``, ``tokenizer``, ``source``, ``lang`` and
``n_tokens``. A ``put`` sets the count of a document, new or not; a document may move to
another source or language by it. Several changes of a document by one tokenizer in a batch
are one: a deletion wins, then the highest count (then source and language, nulls first).
Deletions of unknown documents do nothing. Null sources and languages are groups of their
own, a null count is 0, and null ids, tokenizers and ops are left out: nothing could take
them back. Repeated rows are one change. An empty batch is committed like any other.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.llm.text import ALNUM, WORD
from framesift.workspace import _hadoop_path, exists, new_path, read_text

GROUP = ["source", "lang", "tokenizer"]
_LOG = "doc_id string, source string, lang string, tokenizer string, docs bigint, tokens bigint"


class Conflict(Exception):
    """A committed batch was given again with other changes."""


class TokenRollup:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _committed(self) -> list[str]:
        filesystem, folder = _hadoop_path(self.spark, f"{self.root}/commits")
        if not filesystem.exists(folder):
            return []
        names = (status.getPath().getName() for status in filesystem.listStatus(folder))
        return sorted(name for name in names if not name.startswith((".", "_")))

    def _read(self, kind: str, schema: str) -> DataFrame:
        folders = [f"{self.root}/{kind}/{batch}" for batch in self._committed()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def log(self) -> DataFrame:
        return self._read("log", _LOG)

    def documents(self) -> DataFrame:
        """The counts that are in force, one row for each document and tokenizer."""
        return (
            self.log()
            .groupBy("doc_id", *GROUP)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where(F.col("docs") > 0)
        )

    def totals(self) -> DataFrame:
        """``source``, ``lang``, ``tokenizer``, ``n_docs`` and ``n_tokens`` of all groups that
        have documents."""
        schema = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
        return (
            self._read("rollup", schema)
            .groupBy(*GROUP)
            .agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
            .where(F.col("n_docs") > 0)
        )

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies a batch; False if it was committed before."""
        if not batch or batch.startswith((".", "_")) or "/" in batch:
            raise ValueError(f"not a batch id: {batch!r}")
        spark = self.spark
        staged = f"{self.root}/changes/{batch}"
        latest = F.struct(
            (F.col("op") == "delete").alias("gone"),
            F.coalesce(F.col("n_tokens").cast("bigint"), F.lit(0)).alias("tokens"),
            F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"),
        )
        one = (
            changes.where(F.col("op").isin("put", "delete"))
            .select(F.col("doc_id").cast("string").alias("doc_id"), F.col("tokenizer").cast("string").alias("tokenizer"), latest.alias("last"))
            .where(F.col("doc_id").isNotNull() & F.col("tokenizer").isNotNull())
            .groupBy("doc_id", "tokenizer")
            .agg(F.max("last").alias("last"))
            .select("doc_id", "tokenizer", "last.*")
        )
        marker = f"{self.root}/commits/{batch}"
        if exists(spark, marker):
            if json.loads(read_text(spark, marker)) != self._digest(one):
                raise Conflict(f"batch {batch} is committed with other changes")
            return False
        one.write.mode("overwrite").parquet(staged)
        one = spark.read.schema(one.schema).parquet(staged)
        known = self.documents().withColumnsRenamed({"doc_id": "_id", "tokenizer": "_by"})
        back = known.join(
            one, (F.col("_id") == F.col("doc_id")) & (F.col("_by") == F.col("tokenizer")), "left_semi"
        ).select(F.col("_id").alias("doc_id"), "source", "lang", F.col("_by").alias("tokenizer"),
                 (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        new = one.where(~F.col("gone")).select(
            "doc_id", "source", "lang", "tokenizer", F.lit(1).cast("bigint").alias("docs"), "tokens"
        )
        signed = f"{self.root}/log/{batch}"
        back.unionByName(new).write.mode("overwrite").parquet(signed)
        spark.read.schema(_LOG).parquet(signed).groupBy(*GROUP).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        ).write.mode("overwrite").parquet(f"{self.root}/rollup/{batch}")
        self._mark(marker, self._digest(one))
        return True

    def _digest(self, changes: DataFrame) -> list[str]:
        row = changes.agg(
            F.count("*"), F.sum(F.xxhash64(*changes.columns).cast("decimal(38,0)"))
        ).first()
        return [str(value) for value in row]

    def _mark(self, path: str, digest: list[str]) -> None:
        """Creates the marker whole, under its final name, or fails if it is there."""
        filesystem, target = _hadoop_path(self.spark, path)
        _, unfinished = _hadoop_path(self.spark, new_path(self.spark, "marker"))
        filesystem.mkdirs(target.getParent())
        stream = filesystem.create(unfinished, False)
        stream.write(bytearray(json.dumps(digest).encode()))
        stream.close()
        if filesystem.exists(target) or not filesystem.rename(unfinished, target):
            raise Conflict(f"{path} was committed meanwhile")


def counts(docs: DataFrame, tokenizers: dict, op: str = "put") -> DataFrame:
    """Changes that put the count of every tokenizer (name to column over ``docs``)."""
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("tokenizer"), count.cast("bigint").alias("n_tokens"))
            for name, count in tokenizers.items()
        )
    )
    return docs.select(F.lit(op).alias("op"), "doc_id", "source", "lang", F.explode(pairs).alias("c")).select(
        "op", "doc_id", "source", "lang", "c.tokenizer", "c.n_tokens"
    )


WORDS, BYTES = "words-1", "utf8-bytes-1"


def op8_token_rollup(spark, sf_dir):
    """All documents are put in with two tokenizers; those labelled low are then revised to
    the number of alphanumeric words, and toxic ones are deleted. Each batch is sent twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("doc_id", "labelled")
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_count(text, F.lit(WORD))
    low = labels.where(F.col("quality") == 0).select("labelled").distinct()
    toxic = labels.where(F.col("toxic") == 1).select(
        F.col("labelled").alias("doc_id"), F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("lang"), F.lit("").alias("text"),
    )
    rollup = TokenRollup(spark, new_path(spark, "token-rollup"))
    batches = {
        "1-insert": counts(docs, {WORDS: words, BYTES: F.octet_length(text)}),
        # counted first: an inner join moves ids and counts, not texts
        "2-revise": counts(docs, {WORDS: F.regexp_count(text, F.lit("(?i)" + ALNUM))}).join(
            low, F.col("doc_id") == F.col("labelled")
        ),
        "3-delete": counts(toxic, {WORDS: F.lit(0), BYTES: F.lit(0)}, op="delete"),
    }
    for name, changes in batches.items():
        rollup.commit(name, changes)
    for name in ("2-revise", "3-delete"):
        rollup.commit(name, batches[name])
    return rollup.totals()


OP8_SQL = rf"""
WITH c AS (
  SELECT d.doc_id, source, lang, coalesce(text, '') AS text,
         d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS low
  FROM documents d WHERE d.doc_id IS NOT NULL
    AND d.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)),
t AS (
  SELECT source, lang, '{WORDS}' AS tokenizer,
         CASE WHEN low THEN len(regexp_extract_all(text, '(?i){ALNUM}'))
              ELSE len(regexp_extract_all(text, '{WORD}')) END AS n FROM c
  UNION ALL SELECT source, lang, '{BYTES}', octet_length(encode(text)) FROM c)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM t GROUP BY source, lang, tokenizer
"""
