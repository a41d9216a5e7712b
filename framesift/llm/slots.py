"""Training-order materialisation: every sequence of token ids gets a global slot by a keyed
permutation and is written to fixed-stride binary shards.

A text is tokenised, one end mark is added, and the ids are cut into sequences of ``length``
ids, the last one filled up with end marks. Sequences are numbered from 0 in the order of
the table, partition by partition. A Feistel network over the smallest even number of bits
that holds all numbers permutes them, walking on while a value lies outside (cycle-walking),
so every one of N sequences gets one of the slots 0 to N-1 and the key alone fixes the order.
Shard ``k`` holds the slots from ``k * per_shard`` on; a record has ``length`` ids of 2 bytes
(4 bytes for larger vocabularies), little endian, so a slot's place in its shard is known and
reading can go on from any slot.

Two passes tokenise the texts: the first one counts the sequences of every partition, the
second one numbers them as they pass, so ids are moved once, straight to the partition that
writes their range of slots. Both need the same partitions in the same order: give a table
that is read from files, as ``stage`` returns one. A partition whose count differs in the
second pass fails the job. Shards are written under another name and renamed, so a repeated
task replaces a shard by the same bytes; ``index`` has one row for each sequence.

Null and empty texts have no ids and no sequence. Null ids of documents are kept as null.
Repeated rows give sequences of their own. An empty table gives no shard. Other columns are
not read. Ids that would not fit 4 bytes don't occur.
"""

from __future__ import annotations

import base64
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.llm.text import built, map_arrow
from framesift.sources.storage import resolve
from framesift.workspace import new_path, ship_package

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern the rank files' vocabularies were made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same pieces where no white space follows white space; without looking ahead it takes
#: two thirds of the time.
SINGLE_PATTERN = PATTERN.replace(r"|\s+(?!\S)|\s+", r"|\s")
#: White space after white space, of any kind the patterns know.
_SPACES = re.compile(r"\s\s")
LENGTH = 256
PER_SHARD = 1 << 14
#: A task writes several shards, one after the other, beyond this many.
MOST_TASKS = 10_000
KEY = 20240229
ROUNDS = 6


class Tokenizer:
    """Byte-level BPE by a file of ranks; ids as little-endian bytes."""

    def __init__(self, ranks: bytes):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.end = max(table.values()) + 1
        self.dtype = np.dtype("<u2" if self.end < 1 << 16 else "<u4")
        self._any, self._single = (
            tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            for pattern in (PATTERN, SINGLE_PATTERN)
        )
        self.text = self._any.decode

    def ids(self, text: str) -> list[int]:
        encoding = self._any if _SPACES.search(text) else self._single
        return encoding.encode_ordinary(text)

    def encode(self, text: str) -> bytes:
        return np.array(self.ids(text), dtype=self.dtype).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.text([int(i) for i in ids if i != self.end])


def permuted(numbers: np.ndarray, count: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The slots of some of the numbers 0 to ``count - 1``."""
    half = max(1, -(-max(count - 1, 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.random.Generator(np.random.PCG64(key)).integers(0, 1 << 64, rounds, dtype=np.uint64)

    def network(values):
        left, right = values >> np.uint64(half), values & mask
        for k in keys:
            mix = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mix ^= mix >> np.uint64(29)
            mix *= np.uint64(0xBF58476D1CE4E5B9)
            mix ^= mix >> np.uint64(32)
            left, right = right, left ^ (mix & mask)
        return (left << np.uint64(half)) | right

    slots = network(np.asarray(numbers, dtype=np.uint64))
    while len(out := np.flatnonzero(slots >= np.uint64(count))):
        slots[out] = network(slots[out])
    return slots.astype(np.int64)


def _sequences(tokenizer: Tokenizer, text: str | None, length: int) -> list[bytes]:
    if not text:
        return []
    width = length * tokenizer.dtype.itemsize
    end = np.array([tokenizer.end], dtype=tokenizer.dtype).tobytes()
    ids = tokenizer.encode(text) + end
    found = [ids[at : at + width] for at in range(0, len(ids), width)]
    found[-1] += end * ((width - len(found[-1])) // len(end))
    return found


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _counts(key: str, ranks, length: int):
    def rows(batches):
        tokenizer = built("tokenizer", key, lambda: Tokenizer(ranks.value))
        count = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    count += -(-(len(tokenizer.ids(text)) + 1) // length)
        yield pa.RecordBatch.from_arrays(
            [pa.array([_partition()], pa.int32()), pa.array([count], pa.int64())], ["part", "n"]
        )

    return rows


def _slotted(key: str, ranks, length: int, offsets: dict, total: int, seed: int):
    names = ["slot", "id", "part", "n_tokens", "ids"]

    def rows(batches):
        tokenizer = built("tokenizer", key, lambda: Tokenizer(ranks.value))
        number, most = offsets.get(_partition(), (0, 0))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                ids, parts, tokens, records = [], [], [], []
                for row, text in enumerate(some.column(1).to_pylist()):
                    found = _sequences(tokenizer, text, length)
                    records += found
                    parts += range(len(found))
                    ids += [row] * len(found)
                    if found:
                        last = np.frombuffer(found[-1], tokenizer.dtype)
                        tokens += [length] * (len(found) - 1) + [int((last != tokenizer.end).sum())]
                most -= len(records)
                if most < 0:
                    break
                slots = permuted(np.arange(number, number + len(records)), total, seed)
                number += len(records)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slots, pa.int64()),
                        some.column(0).take(pa.array(ids, pa.int64())),
                        pa.array(parts, pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array(records, pa.binary()),
                    ],
                    names,
                )
        if most:
            raise RuntimeError("the partitions of the table changed between two passes; stage it first")

    return rows


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _write(folder: str, shard: int, data: bytes) -> None:
    filesystem, path, _ = resolve(folder)
    filesystem.create_dir(path, recursive=True)
    final = f"{path}/{shard_name(shard)}"
    unfinished = f"{path}/.{shard_name(shard)}-{uuid.uuid4().hex}"
    with filesystem.open_output_stream(unfinished) as stream:
        stream.write(data)
    filesystem.move(unfinished, final)


def _written(folder: str, width: int, per_shard: int):
    """Writes the rows of a partition, sorted by slot, shard by shard."""
    names = ["slot", "shard", "offset", "id", "part", "n_tokens", "crc32"]

    def rows(batches):
        shard, held = None, bytearray()
        for batch in batches:
            slots = batch.column(0).to_numpy()
            records = batch.column(4).to_pylist()
            shards = slots // per_shard
            for number, record in zip(shards.tolist(), records):
                if number != shard:
                    if held:
                        _write(folder, shard, bytes(held))
                    shard, held = number, bytearray()
                held += record
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(shards, pa.int64()),
                    pa.array(slots % per_shard * width, pa.int64()),
                    *(batch.column(i) for i in (1, 2, 3)),
                    pa.array([zlib.crc32(record) for record in records], pa.int64()),
                ],
                names,
            )
        if held:
            _write(folder, shard, bytes(held))

    return rows


def materialise(
    df: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY, length: int = LENGTH, per_shard: int = PER_SHARD, seed: int = KEY,
) -> DataFrame:
    """Writes the shards to ``<folder>/shards`` and returns the index, read from
    ``<folder>/index``: ``slot``, ``shard``, ``offset`` in bytes, ``id``, ``part`` (sequence
    number in the document), ``n_tokens`` (without end marks) and ``crc32`` of the record."""
    spark = df.sparkSession
    ship_package(spark)
    with open(vocabulary, "rb") as file:
        data = file.read()
    name = uuid.uuid4().hex
    ranks = spark.sparkContext.broadcast(data)  # a vocabulary file, under 2 MB
    width = length * Tokenizer(data).dtype.itemsize
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    field = docs.schema["id"].dataType.simpleString()
    # the same two columns in both passes, so that files are split alike; one row a partition
    counts = map_arrow(docs.select("text", "id"), _counts(name, ranks, length), "part int, n bigint").collect()
    offsets, total = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in counts):
        offsets[part] = (total, n)
        total += n
    shards = -(-total // per_shard)
    tasks = max(1, min(shards, MOST_TASKS))
    slotted = map_arrow(
        docs,
        _slotted(name, ranks, length, offsets, total, seed),
        f"slot bigint, id {field}, part bigint, n_tokens bigint, ids binary",
    )
    in_order = slotted.repartitionById(
        tasks, F.expr(f"cast(floor((slot div {per_shard}) * {tasks} / {max(shards, 1)}) as int)")
    ).sortWithinPartitions("slot")
    map_arrow(
        in_order,
        _written(f"{folder}/shards", width, per_shard),
        f"slot bigint, shard bigint, offset bigint, id {field}, part bigint, n_tokens bigint, crc32 bigint",
    ).write.mode("overwrite").parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read_slots(folder: str, start: int, count: int, dtype="<u2", length: int = LENGTH,
               per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """The records of consecutive slots, read sequentially from ``start`` on."""
    filesystem, path, _ = resolve(f"{folder}/shards")
    width = length * np.dtype(dtype).itemsize
    while count > 0:
        shard, place = divmod(start, per_shard)
        some = min(count, per_shard - place)
        with filesystem.open_input_file(f"{path}/{shard_name(shard)}") as file:
            file.seek(place * width)
            data = file.read(some * width)
        yield from np.frombuffer(data, dtype).reshape(-1, length)
        if len(data) < some * width:
            return
        start, count = start + some, count - some


def op6_token_slots(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return materialise(docs, new_path(spark, "training-order")).withColumnRenamed("id", "doc_id")
