"""Captioning: two interchangeable backends with one result schema."""

from __future__ import annotations

import itertools
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.config import MAX_NEW_TOKENS, NUM_UNITS, PROMPT
from framesift.functions.assets import asset_id, strip_text
from framesift.operators.blocks import unpack_units
from framesift.operators.models import Model, get_model, loaded
from framesift.operators.readers import attempt_sample, get_reader
from framesift.sources.results import CAPTION_COLUMNS
from framesift.sources.storage import open_uri
from framesift.workspace import ship_package

# Rows after which a task hands finished captions on.
_OUT_ROWS = 1_024

_CAPTIONED = pa.schema(
    [
        ("path", pa.string()),
        ("video_id", pa.string()),
        ("caption", pa.string()),
        ("num_frames", pa.int64()),
        ("duration_sec", pa.float64()),
        ("error_type", pa.string()),
    ]
)
_CAPTIONED_DDL = (
    "path string, video_id string, caption string, num_frames bigint, duration_sec double, "
    "error_type string"
)


def rebatch(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of exactly ``size`` rows, the last one of the partition excepted."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < size:
            continue
        table = pa.Table.from_batches(held)
        whole = rows - rows % size
        for start in range(0, whole, size):
            yield table.slice(start, size)
        held, rows = table.slice(whole).to_batches(), rows - whole
    if rows:
        yield pa.Table.from_batches(held)


def caption_batches(
    decoded: DataFrame, model="first-last", batch_size: int = 2, profile=None
) -> DataFrame:
    """Batch backend: the model sees dicts of arrays with up to ``batch_size`` rows.

    Every column but ``frames`` is kept, so a ``path`` beside the result columns
    comes through. Rows without units get no caption. Packed samples, with ``block`` instead
    of ``frames``, are unpacked batch by batch as the model asks for them.
    """
    packed = "block" in decoded.columns

    def units(table):
        return table.column("block" if packed else "frames")

    def ask(answer):
        def ask_model(part):
            fields = [c for c in part.column_names if c != "block"]
            batch = {c: part.column(c).to_numpy() for c in fields}
            if packed:
                blocks = part.column("block").to_pylist()
                batch["frames"] = np.empty(len(blocks), dtype=object)
                batch["frames"][:] = [np.array(unpack_units(block), dtype=object) for block in blocks]
            return answer(batch)

        return ask_model

    return _captioned(decoded, decoded, get_model(model), batch_size, units, ask, profile)


def _captioned(
    decoded: DataFrame,
    shown: DataFrame,
    model: Model,
    batch_size: int,
    units: Callable[[pa.Table], pa.ChunkedArray],
    ask: Callable,
    profile,
    at_once: Callable = lambda answer: 1,
) -> DataFrame:
    """Captions of the rows ``shown`` to the model, beside what ``decoded`` holds but
    its units. ``units`` finds these in a table; ``ask`` makes of the loaded model a
    function from a table to its texts; ``at_once`` says how many tables it takes at a time."""
    ship_package(decoded.sparkSession)
    kept = [field for field in decoded.schema.fields if field.name not in ("frames", "block")]
    names = [field.name for field in kept]

    def caption(batches):
        answer = None

        def finish(table):
            return table.select(names).append_column("caption", _answer_readable(table, units(table), answer))

        def finished():
            nonlocal answer
            tables = rebatch(batches, batch_size)
            for table in tables:
                answer = ask(loaded(model))
                yield from in_flight(finish, itertools.chain([table], tables), at_once(loaded(model)))

        done: list[pa.Table] = []
        for part in finished():
            done.append(part)
            if sum(part.num_rows for part in done) >= _OUT_ROWS:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
                done = []
        if done:
            yield from pa.concat_tables(done).combine_chunks().to_batches()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", caption string"
    captioned = shown.mapInArrow(caption, schema, profile=profile)
    extra = [c for c in names if c not in CAPTION_COLUMNS]
    return captioned.withColumn("caption", strip_text("caption")).select(*extra, *CAPTION_COLUMNS)


def in_flight(function: Callable, items: Iterable, window: int) -> Iterator:
    """Results in order of completion, with ``window`` calls at work as long as items are left.

    A slow call keeps none of the others waiting: whenever one ends, the next item is
    taken before the result is handed on. No more than ``window`` items are held.
    """
    if window <= 1:
        yield from map(function, items)
        return
    items = iter(items)
    pool = ThreadPoolExecutor(max_workers=window)
    try:
        waiting = {pool.submit(function, item) for item in itertools.islice(items, window)}
        while waiting:
            done, waiting = wait(waiting, return_when=FIRST_COMPLETED)
            waiting |= {pool.submit(function, item) for item in itertools.islice(items, len(done))}
            for call in done:
                yield call.result()
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def _answer_readable(table: pa.Table, units: pa.ChunkedArray, answer: Callable) -> pa.Array:
    """One text per row of ``table``, null where there are no units to show the model."""
    readable = units.is_valid()
    part = table if units.null_count == 0 else table.filter(readable)
    texts = [str(text) for text in answer(part)] if part.num_rows else []
    if len(texts) != part.num_rows:
        raise ValueError(f"the model gave {len(texts)} texts for {part.num_rows} assets")
    left = iter(texts)
    return pa.array([next(left) if ok else None for ok in readable.to_pylist()], pa.string())


def build_messages(num_units: int = NUM_UNITS, prompt: str = PROMPT) -> Column:
    """Chat messages: one placeholder per unit, then the instruction."""
    image = F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"))
    text = F.struct(F.lit("text").alias("type"), F.lit(prompt).alias("text"))
    content = F.concat(F.array_repeat(image, num_units), F.array(text))
    return F.array(F.struct(F.lit("user").alias("role"), content.alias("content")))


def build_requests(
    decoded: DataFrame, num_units: int = NUM_UNITS, prompt: str = PROMPT
) -> DataFrame:
    """Request form of every asset, with the columns to pass through beside it."""
    sampling = F.struct(
        F.lit(0.0).alias("temperature"), F.lit(MAX_NEW_TOKENS).cast("int").alias("max_tokens")
    )
    kept = [c for c in decoded.columns if c != "frames"]
    return decoded.select(
        build_messages(num_units, prompt).alias("messages"),
        sampling.alias("sampling_params"),
        F.struct(F.col("frames").alias("image")).alias("multi_modal_data"),
        *kept,
    )


def caption_requests(
    decoded: DataFrame,
    model="first-last",
    batch_size: int = 2,
    num_units: int = NUM_UNITS,
    prompt: str = PROMPT,
    profile=None,
) -> DataFrame:
    """Request backend: rows become requests, an engine answers them, and the result
    columns are projected back. Same result as ``caption_batches``.

    An engine has ``generate`` and gets lists of request dicts. If it has ``in_flight``, it
    takes that many lists at a time, from threads of their own, and is given the next one as
    soon as any is answered; rows then come as they are answered. A plain model gets its
    usual batch, with the units taken out of the requests.
    """
    requests = build_requests(decoded, num_units, prompt)

    def units(table):
        return pc.struct_field(table.column("multi_modal_data"), "image")

    def ask(answer):
        if hasattr(answer, "generate"):
            return lambda part: answer.generate(part.to_pylist())

        def ask_model(part):
            fields = [c for c in part.column_names if c in CAPTION_COLUMNS]
            batch = {c: part.column(c).to_numpy() for c in fields}
            return answer(batch | {"frames": units(part).to_numpy()})

        return ask_model

    def at_once(answer):
        return getattr(answer, "in_flight", 1) if hasattr(answer, "generate") else 1

    return _captioned(decoded, requests, get_model(model), batch_size, units, ask, profile, at_once)


def read_ahead(function: Callable, items: Iterable, threads: int) -> Iterator:
    """Results in order, computed by a few threads that stay just ahead. No threads
    are used for 0: readers that hold the interpreter lock gain nothing from them."""
    if threads <= 0:
        yield from map(function, items)
        return
    with ThreadPoolExecutor(max_workers=threads) as pool:
        pending: deque = deque()
        for item in items:
            pending.append(pool.submit(function, item))
            if len(pending) > 2 * threads:
                yield pending.popleft().result()
        while pending:
            yield pending.popleft().result()


def caption_assets(
    assets: DataFrame,
    reader="text",
    model="first-last",
    num_samples: int = NUM_UNITS,
    batch_size: int = 2,
    threads: int = 2,
    opener: Callable = open_uri,
    on_fetch_error: str = "fail",
    on_error: str = "drop",
    profile=None,
) -> DataFrame:
    """Fetch, decode and caption in one pass over the assets.

    ``assets`` has ``path`` and, when already fetched, ``bytes``; without bytes the
    task opens the path itself, so content never enters the JVM. Sampled units stay
    inside the task. Returns ``path``, the result columns and ``error_type``, one
    row per asset.
    """
    reader, model = get_reader(reader), get_model(model)
    ship_package(assets.sparkSession)
    assets = assets.withColumn("video_id", asset_id("path"))
    columns = [c for c in ("path", "video_id", "bytes", "error_type") if c in assets.columns]

    opening = None if "bytes" in columns else opener

    def sample(row):
        """The row as the model wants it, or with an error type."""
        if row.get("error_type") is not None:
            return row
        data = row.pop("bytes", None)
        return row | attempt_sample(
            reader, row["path"], data, opening, num_samples, on_fetch_error, on_error
        )

    def caption(batches):
        rows = (
            {c: batch.column(c)[i].as_py() for c in columns}
            for batch in batches
            for i in range(batch.num_rows)
        )
        finished: list[dict] = []
        waiting: list[dict] = []
        for row in read_ahead(sample, rows, threads):
            (finished if row.get("error_type") else waiting).append(row)
            if len(waiting) == batch_size:
                finished.extend(_answered(loaded(model), waiting))
                waiting = []
            if len(finished) >= _OUT_ROWS:
                yield pa.RecordBatch.from_pylist(finished, schema=_CAPTIONED)
                finished = []
        if waiting:
            finished.extend(_answered(loaded(model), waiting))
        if finished:
            yield pa.RecordBatch.from_pylist(finished, schema=_CAPTIONED)

    captioned = assets.select(*columns).mapInArrow(caption, _CAPTIONED_DDL, profile=profile)
    return captioned.withColumn("caption", strip_text("caption"))


def _answered(answer: Callable, rows: list[dict]) -> Iterator[dict]:
    """The rows with their captions and without their units."""
    fields = ("video_id", "frames", "num_frames", "duration_sec")
    texts = answer({name: [row[name] for row in rows] for name in fields})
    for row, text in zip(rows, texts, strict=True):
        yield {k: v for k, v in row.items() if k != "frames"} | {"caption": str(text)}


BACKENDS: dict[str, Callable] = {"batch": caption_batches, "request": caption_requests}


def get_backend(name: str) -> Callable:
    if name not in BACKENDS:
        raise ValueError(f"unknown backend: {name!r}")
    return BACKENDS[name]
