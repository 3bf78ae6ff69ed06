"""What the operators share: cutting lineage, reading documents, packing them in blocks.

Conventions that hold for every operator here:

* ``doc_id`` null: the row counts as if its id were the largest possible one, 2^63 - 1, and keeps its null in the
  result.  A row whose id is that very number keeps it, and neither of the two is smaller than the other.
* ``text`` null: the empty text.
* repeated rows: each is a document of its own.
* an empty table: an empty result.
* further columns, whatever their names, are ignored: inputs are projected first.
"""

from __future__ import annotations

import atexit
import ctypes
import math
import shutil
import struct
import tempfile
import weakref
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a null doc_id counts as where ids are compared; a flag beside it says that there is none.
LAST_ID = 2**63 - 1
#: Text bytes in a block; a longer document is a block of its own.
BLOCK_BYTES = 8 << 20
#: Text bytes that Python handles at once inside a block.
PART_BYTES = 2 << 20
#: Compressed bytes that a bucket of an exchange gets on average; a bucket is a group that one Python call holds.
BUCKET_BYTES = 9 << 20
#: Bytes of messages that leave Python together.
BATCH_BYTES = 1 << 20
#: Blocks by which frequent keys are told.
SAMPLE_BLOCKS = 8


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        at = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
        if not at:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            at = tempfile.mkdtemp(prefix="checkpoints-")
            atexit.register(shutil.rmtree, at, True)
        sc.setCheckpointDir(at)
    return sc._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """``df``, computed once and stored in the shared folder, so that lost executors lose nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text); no text is null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


_libc = ctypes.CDLL(None)
_caches: list = []


def relax() -> None:
    """Empties caches that weren't used since the last call, and gives what Python has freed back to the system: a worker
    lives on, idle or for other operators, while the JVM beside it needs the room."""
    for ref in _caches:
        if (cache := ref()) is not None:
            if not cache.used:
                cache.clear()
                cache.old = {}
            cache.used = False
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def relaxing(run: Callable) -> Callable:
    """``run`` over a task's batches, with ``relax`` at its end."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            relax()

    return wrapped


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def parts(batches: Iterator[pa.RecordBatch], most: int = PART_BYTES) -> Iterator[tuple[list[int | None], list[str]]]:
    """Lists of ids and of texts with about ``most`` bytes each, in row order."""
    for b in batches:
        ids, lengths = b.column(0).to_pylist(), np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(ids):
            end = int(np.searchsorted(lengths, (lengths[at - 1] if at else 0) + most, "right"))
            end = max(end, at + 1)
            yield ids[at:end], b.column(1).slice(at, end - at).to_pylist()
            at = end


# Blocks: rows (block long, blob binary); a blob has the ids, lengths and UTF-8 texts of some documents, compressed.


def to_blob(ids: list[int | None], raw: list[bytes]) -> bytes:
    numbers = np.asarray([LAST_ID if i is None else i for i in ids], "<i8")
    none = np.packbits([i is None for i in ids])
    head = struct.pack("<q", len(ids)) + numbers.tobytes() + np.asarray([len(x) for x in raw], "<i8").tobytes() + none.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(raw))


def from_blob(blob: bytes) -> tuple[Ids, np.ndarray, bytes]:
    """ids, offsets (one more than ids) and the texts' bytes one after the other."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = struct.unpack_from("<q", data)
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(np.frombuffer(data, "<i8", n, 8 + 8 * n), out=offsets[1:])
    none = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), 8 + 16 * n), count=n).astype(bool)
    return Ids(np.frombuffer(data, "<i8", n, 8), none), offsets, data[8 + 16 * n + len(none[::8]) :]


class Ids(NamedTuple):
    """A block's doc_ids; ``numbers`` has ``LAST_ID`` where there is ``none``."""

    numbers: np.ndarray
    none: np.ndarray

    def column(self) -> pa.Array:
        return pa.array(self.numbers, pa.int64(), mask=self.none)


BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("blob", pa.binary())])


class Blocks(NamedTuple):
    """A stored table (block, blob), how many blocks it has, the most that one task made, and the bytes of all."""

    table: DataFrame
    many: int
    width: int
    size: int

    def buckets(self, share: float) -> int:
        """Buckets of an exchange that moves ``share`` times the blocks' bytes: as many as give each about ``BUCKET_BYTES``, at any size of input."""
        return max(8, math.ceil(self.size * share / BUCKET_BYTES))

    def place(self):
        """A number for each block, to deal blocks out evenly."""
        return F.pmod(F.shiftright("block", 32) * self.width + F.col("block").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(self.many)).cast("int")


def blocks(docs: DataFrame, most: int = BLOCK_BYTES) -> Blocks:
    """``docs`` (doc_id, text) in blocks, stored: a block holds rows that were neighbours in one input
    partition.  Number of partition and of block give its id, and since the table is stored, later
    readers see the same blocks even if tasks ran twice."""

    def pack(batches):
        task, k, ids, raw, size = TaskContext.get().partitionId(), 0, [], [], 0
        for some_ids, some in parts(batches):
            for i, x in zip(some_ids, some):
                x = x.encode("utf-8", "surrogatepass")
                if ids and size + len(x) > most:
                    yield batch(BLOCK_SCHEMA, block=[(task << 32) + k], blob=[to_blob(ids, raw)])
                    k, ids, raw, size = k + 1, [], [], 0
                ids.append(i)
                raw.append(x)
                size += len(x)
        if ids:
            yield batch(BLOCK_SCHEMA, block=[(task << 32) + k], blob=[to_blob(ids, raw)])

    table = checkpoint(docs.mapInArrow(relaxing(pack), "block long, blob binary"))
    found = table.agg(F.count("*").alias("n"), F.max(F.col("block").bitwiseAND(F.lit(0xFFFFFFFF))).alias("k"), F.sum(F.octet_length("blob")).alias("size")).first()
    return Blocks(table, max(1, found["n"]), (found["k"] or 0) + 1, found["size"] or 0)


def frequent(stored: Blocks, keys_of: Callable[[bytes], tuple[np.ndarray, np.ndarray]], share: float) -> np.ndarray:
    """Sorted keys (uint64) that make up more than ``share`` of what ``keys_of(blob)`` counts, judged by ``SAMPLE_BLOCKS`` blocks.

    Which keys are treated as frequent decides about speed only, never about results."""
    chosen = [r["block"] for r in stored.table.select("block").orderBy(F.xxhash64("block"), "block").limit(SAMPLE_BLOCKS).collect()]
    if not chosen:
        return np.zeros(0, np.uint64)

    def run(batches):
        for b in batches:
            for blob in b.column(0):
                keys, counts = keys_of(blob.as_py())
                kept = counts > share / 4 * counts.sum()  # 4 / share rows at the most
                yield pa.RecordBatch.from_arrays([pa.array(keys[kept].view(np.int64)), pa.array(counts[kept].astype(np.int64)), pa.array(np.full(int(kept.sum()), counts.sum(), np.int64))], names=["key", "n", "of"])

    found = stored.table.where(F.col("block").isin(chosen)).select("blob").mapInArrow(relaxing(run), "key long, n long, of long")
    found = found.groupBy("key").agg(F.sum(F.col("n") / F.col("of")).alias("part")).where(F.col("part") > share * len(chosen))
    return np.sort(np.asarray([r["key"] for r in found.collect()], np.int64).view(np.uint64))  # 1 / share rows at the most


MESSAGE = "bucket int, block long, payload binary"
MESSAGE_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
REPLY = "block long, payload binary"
REPLY_SCHEMA = pa.schema([("block", pa.int64()), ("payload", pa.binary())])


def gathered(messages: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """(bucket, block, payload) in batches of about ``BATCH_BYTES``."""
    held, size = [], 0
    for m in messages:
        held.append(m)
        size += len(m[2])
        if size > BATCH_BYTES:
            yield batch(MESSAGE_SCHEMA, **dict(zip(MESSAGE_SCHEMA.names, zip(*held))))
            held, size = [], 0
    if held:
        yield batch(MESSAGE_SCHEMA, **dict(zip(MESSAGE_SCHEMA.names, zip(*held))))


def scatter(stored: Blocks, send: Callable[[int, bytes], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """What ``send(block, blob)`` yields as (bucket, payload), with the block it comes from."""

    def run(batches):
        for b in batches:
            for block, blob in zip(b.column(0).to_pylist(), b.column(1)):
                yield from gathered((bucket, block, payload) for bucket, payload in send(block, blob.as_py()))

    return stored.table.mapInArrow(relaxing(run), MESSAGE)


def answer(messages: DataFrame, many: int, reply: Callable[[list[int], list[bytes]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """``reply(blocks, payloads)`` once for each of ``many`` buckets, with messages in the order of their blocks; it yields (block, payload).

    A bucket is a partition of its own, so no two large ones meet in one task."""

    def run(group: pa.Table) -> pa.Table:
        own, payloads = group.column("block").to_pylist(), group.column("payload").to_pylist()
        order = sorted(range(len(own)), key=own.__getitem__)
        out = list(reply([own[i] for i in order], [payloads[i] for i in order]))
        del payloads, group
        relax()
        return pa.table({"block": pa.array([b for b, _ in out], pa.int64()), "payload": pa.array([p for _, p in out], pa.binary())})

    return messages.repartitionById(many, "bucket").groupBy("bucket").applyInArrow(run, REPLY)


def beside(stored: Blocks, replies: DataFrame) -> DataFrame:
    """(block, blob, payload): each block and the replies to it, where a block's rows have one of the two."""
    none = F.lit(None).cast("binary")
    return stored.table.select("block", "blob", none.alias("payload")).unionByName(replies.select("block", none.alias("blob"), "payload"))


def opened(group: pa.Table) -> tuple[int, bytes, list[bytes]]:
    """Block, blob and replies of a group of ``beside``."""
    blob = next(x for x in group.column("blob").to_pylist() if x is not None)
    return group.column("block")[0].as_py(), blob, [x for x in group.column("payload").to_pylist() if x is not None]


def by_block(stored: Blocks, replies: DataFrame, run: Callable[[int, bytes, list[bytes]], pa.Table], schema: str) -> DataFrame:
    """``run(block, blob, payloads)`` once for each block, with all replies to it."""

    def one(group: pa.Table) -> pa.Table:
        out = run(*opened(group))
        relax()
        return out

    both = beside(stored, replies).withColumn("place", stored.place())
    return both.repartitionById(stored.many, "place").groupBy("place", "block").applyInArrow(one, schema)


def resolve(stored: Blocks, replies: DataFrame, finish: Callable[[bytes, list[bytes]], pa.RecordBatch], schema: str) -> DataFrame:
    """``finish(blob, payloads)`` once for each block, with all replies to it."""
    return by_block(stored, replies, lambda _, blob, payloads: pa.Table.from_batches([finish(blob, payloads)]), schema)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Some arrays as one compressed payload."""
    out = [struct.pack("<i", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out += [struct.pack("<4sq", a.dtype.str.encode().ljust(4), len(a)), a.tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpack_arrays(payload: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    (n,), at, out = struct.unpack_from("<i", data), 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<4sq", data, at)
        dtype = np.dtype(kind.rstrip().decode())
        out.append(np.frombuffer(data, dtype, size, at + 12))
        at += 12 + size * dtype.itemsize
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close ones (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Generations(dict):
    """A cache of bounded size: entries not asked for during a whole generation go.  Callers keep long entries out of it.

    ``cache[key]`` raises KeyError for keys in neither generation."""

    def __init__(self, most: int):
        self.most, self.old, self.used = most, {}, False
        _caches.append(weakref.ref(self))

    def __missing__(self, key):
        self[key] = value = self.old[key]
        return value

    def turn(self) -> None:
        """To be called between pieces of work."""
        self.used = True
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
