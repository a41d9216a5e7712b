"""Secret scan: fixed patterns, and two character Markov models compared by their
log-likelihood ratio. DataFrame functions only.

Base spans, leftmost and non-overlapping for each kind: ``assign`` (a keyword, a separator
and a value of 12 or more characters), ``access`` (AKIA and capitals or digits, 18 or more
characters) and ``hex`` (16 or more digits). A match whose value is too short takes up its
place and is dropped.

The models add spans of kind ``random``: runs of ``RUN`` or more characters that secrets and
identifiers are made of, apart from every base span, whose log-likelihood as a random string
exceeds that as an ordinary identifier by ``MARGIN`` nats or more. Both are first-order models
over letters, digits as one symbol and other characters as one symbol, with one added to every
count. They are trained on labelled strings; ``labelled_strings`` takes them from a bounded
sample of documents, the ``rows`` ones with the smallest hash of their id: the values of base
spans are random strings, what stands between them is ordinary. Without labelled strings all
transitions are as likely in either model and no span is added.

Offsets are code points, ends exclusive. Null texts are empty and have no spans. Null ids are
not trained from. Repeated rows give the same spans each. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{RUN},}}"
IDENTIFIER_GAP = r"[^A-Za-z0-9+/_=-]+"
SHORTEST_ASSIGNED = 12
MARGIN = 12.0
ROWS = 5000

KINDS = ("assign", "access", "hex", "random")
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0-"
_SIZE = len(SYMBOLS)
_SPAN = "array<struct<start: int, ord: int, end: int>>"


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """All matches of a pattern: what stands between them gives their places."""
    between = F.split(text, pattern, -1)
    lengths = F.zip_with(
        between, _matches(text, pattern),
        lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("n")),
    )
    none = F.array().cast(_SPAN)
    found = F.aggregate(
        F.filter(lengths, lambda x: x["n"].isNotNull()),
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda done, x: F.struct(
            (done["at"] + x["gap"] + x["n"]).alias("at"),
            F.array_append(
                done["spans"],
                F.struct(
                    (done["at"] + x["gap"]).alias("start"),
                    F.lit(KINDS.index(kind)).alias("ord"),
                    (done["at"] + x["gap"] + x["n"]).alias("end"),
                ),
            ).alias("spans"),
        ),
        lambda done: done["spans"],
    )
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(none)


def _strings(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kinds, s["ord"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def with_base_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with arrays ``assign``, ``access`` and ``hex`` of spans and ``content``, the
    text without null."""
    df = df.withColumn("content", F.coalesce(F.col(text), F.lit("")))
    content = F.col("content")
    empty = F.array().cast(_SPAN)
    values = F.filter(
        F.zip_with(
            _spans(content, ASSIGN, "assign"),
            _matches(content, ASSIGN, 2),
            lambda span, value: F.when(F.length(value) >= SHORTEST_ASSIGNED, span),
        ),
        lambda span: span.isNotNull(),
    )
    # no separator, no assignment; no AKIA, no access key
    separated = F.contains(content, F.lit("=")) | F.contains(content, F.lit(":"))
    return df.withColumns(
        {
            "assign": F.when(separated, values).otherwise(empty),
            "access": F.when(F.contains(content, F.lit("AKIA")), _spans(content, ACCESS, "access")).otherwise(empty),
            "hex": _spans(content, HEX, "hex"),
        }
    )


def labelled_strings(df: DataFrame, key: str = "doc_id", text: str = "text", rows: int = ROWS) -> DataFrame:
    """(``string``, ``random``) from the base spans of a bounded sample of documents."""
    keyed = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("content"))
    chosen = (
        keyed.select("key").where(F.col("key").isNotNull()).distinct()
        .orderBy(F.xxhash64("key"), "key").limit(rows)
    )
    # at most ``rows`` ids
    some = keyed.join(F.broadcast(chosen), "key").select("content")
    content = F.col("content")
    values = F.filter(_matches(content, ASSIGN, 2), lambda v: F.length(v) >= SHORTEST_ASSIGNED)
    secret = F.concat(values, _matches(content, ACCESS), _matches(content, HEX))
    rest = content
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    return some.select(F.explode(secret).alias("string"), F.lit(True).alias("random")).unionByName(
        some.select(F.explode(F.split(rest, IDENTIFIER_GAP)).alias("string"), F.lit(False).alias("random"))
    )


def _symbols(string: Column) -> Column:
    """Places of the characters in ``SYMBOLS``, from 0."""
    digits = F.translate(string, "123456789+/_.=", "000000000-----")
    return F.transform(
        F.filter(F.split(digits, ""), lambda c: c != ""), lambda c: F.instr(F.lit(SYMBOLS), c) - 1
    )


def train(labelled: DataFrame) -> DataFrame:
    """One row with ``ratios``: for every pair of symbols the log of how much likelier the
    second one follows the first one in a random string than in an ordinary one."""
    symbols = labelled.where(F.length("string") > 1).groupBy("string", "random").agg(
        F.count("*").alias("times")
    ).withColumn("symbols", _symbols(F.col("string")))
    steps = F.zip_with(
        F.slice("symbols", 1, F.size("symbols") - 1),
        F.slice("symbols", 2, F.size("symbols") - 1),
        lambda a, b: a * _SIZE + b,
    )
    counts = (
        symbols.select("random", "times", F.explode(steps).alias("pair"))
        .groupBy("pair")
        .agg(
            F.sum(F.when(F.col("random"), F.col("times"))).alias("random"),
            F.sum(F.when(~F.col("random"), F.col("times"))).alias("ordinary"),
        )
    )
    pairs = labelled.sparkSession.range(_SIZE * _SIZE).select(F.col("id").cast("int").alias("pair"))
    table = pairs.join(counts, "pair", "left").select(
        "pair",
        F.expr(f"pair div {_SIZE}").alias("first"),
        F.coalesce("random", F.lit(0)).alias("random"),
        F.coalesce("ordinary", F.lit(0)).alias("ordinary"),
    )
    rows = table.groupBy("first").agg(
        F.sum("random").alias("all_random"), F.sum("ordinary").alias("all_ordinary")
    )
    ratio = F.log(
        ((F.col("random") + 1) / (F.col("all_random") + _SIZE))
        / ((F.col("ordinary") + 1) / (F.col("all_ordinary") + _SIZE))
    )
    return (
        table.join(rows, "first")
        .agg(F.sort_array(F.collect_list(F.struct("pair", ratio.alias("ratio")))).alias("pairs"))
        .select(F.col("pairs.ratio").alias("ratios"))
    )


def _ratio(string: Column, ratios: Column) -> Column:
    symbols = _symbols(string)
    steps = F.zip_with(
        F.slice(symbols, 1, F.length(string) - 1),
        F.slice(symbols, 2, F.length(string) - 1),
        lambda a, b: F.get(ratios, a * _SIZE + b),
    )
    return F.aggregate(steps, F.lit(0.0), lambda total, x: total + x)


def with_spans(df: DataFrame, ratios: Column, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``df`` with the base spans and ``random`` ones, and ``content``. ``ratios`` is the
    trained table, for instance ``train(...).scalar()``: it has one row of fixed size."""
    df = with_base_spans(df, text)
    content = F.col("content")
    df = df.withColumns(
        {
            "runs": F.filter(
                F.zip_with(
                    _spans(content, CANDIDATE, "random"),
                    _matches(content, CANDIDATE),
                    lambda span, string: F.struct(span.alias("span"), string.alias("string")),
                ),
                lambda run: run["span"].isNotNull(),
            ),
            "base": F.sort_array(F.concat("assign", "access", "hex")),
        }
    )
    apart = F.filter(
        "runs",
        lambda run: ~F.exists(
            "base",
            lambda b: (b["start"] < run["span"]["end"]) & (b["end"] > run["span"]["start"]),
        ),
    )
    df = df.withColumn("runs", apart)
    df = df.withColumn("ratios", F.when(F.size("runs") > 0, ratios))
    likely = F.filter("runs", lambda run: _ratio(run["string"], F.col("ratios")) >= margin)
    return df.withColumn(
        "random", F.when(F.size("runs") > 0, F.transform(likely, lambda run: run["span"])).otherwise(F.array().cast(_SPAN))
    )


def op2_secret_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ratios = train(labelled_strings(docs)).scalar()
    found = with_spans(docs, ratios)
    return found.select(
        "doc_id",
        *(F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(_strings(F.col("base")), 256).alias("base_sha256"),
        _strings(F.sort_array(F.concat("base", "random"))).alias("spans"),
        F.size("random").cast("bigint").alias("n_random"),
    )
