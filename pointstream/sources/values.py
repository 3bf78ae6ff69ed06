"""The tables of raw values.

A task opens its files itself, from a folder that all executors see: Spark's own readers leave out names that
begin with an underscore, as those of logs do.  Column files are read in two steps: tasks that go through the
indexes of large ones alone cut them into ranges of keys with some 64 MB of blocks each, and these ranges are dealt out, so one
large file is the work of many tasks and no task holds more than a block.  Ranges of time and of keys are applied to
the index, so other blocks aren't read.  Rows leave in Arrow batches with an order that later stages can sort by."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.units import HIGHEST, LOWEST
from ..model import BOOLEAN, FLOAT, INTEGER, RAW, STRING, TSM, UNSIGNED, WAL
from . import tsm, wal
from .codecs import Damaged

BATCH = 65_536
#: Bytes of files for which there is a further task, if ranges are smaller; a task reads several then.
TASK_BYTES = 4 << 20
COLUMN = {FLOAT: "v_float", INTEGER: "v_int", UNSIGNED: "v_uint", BOOLEAN: "v_bool", STRING: "v_str"}
#: How numbers of a type are held on their way to a column.
HELD = {FLOAT: np.float64, INTEGER: np.int64, UNSIGNED: np.uint64, BOOLEAN: bool}
SHARD_COLUMNS = ("source_id", "database", "retention", "shard_id")
FILES = "source_id string, database string, retention string, shard_id string, src tinyint, file_seq int, path string"
PARTS = FILES + ", begin long, stop long, bytes long"


def _text(raw: bytes) -> str:
    """UTF-8, with other bytes shown as escapes rather than lost."""
    return raw.decode("utf-8", "backslashreplace")


class Batches:
    """Rows of one file in batches of many columns' values, as a block may have few."""

    def __init__(self, schema: pa.Schema, shard: dict, src: int, file_seq: int):
        self.schema, self.same = schema, {**shard, "src": src, "file_seq": file_seq}
        self.held: list[tuple] = []
        self.size = 0

    def add(self, frame: int, first: int, key: bytes, kind: int, times: np.ndarray, values) -> Iterator[pa.RecordBatch]:
        """One key's values; ``frame`` and ``first`` are the place of the first one in the file's order."""
        for at in range(0, len(times), BATCH):
            self.held.append((frame, first + at, _text(key), kind, times[at : at + BATCH], values[at : at + BATCH]))
            self.size += len(self.held[-1][4])
            if self.size >= BATCH:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        held, n = self.held, self.size
        self.held, self.size = [], 0
        frames, firsts, keys, kinds, times, values = zip(*held)
        counts = np.asarray([len(t) for t in times])
        ends = np.cumsum(counts)
        starts = ends - counts
        which = np.repeat(np.arange(len(held)), counts)
        columns = {
            "entry_seq": pa.array(np.asarray(frames, np.int64)[which]),
            "ord": pa.array(np.asarray(firsts, np.int64)[which] + np.arange(n) - starts[which]),
            "raw_key": pa.array(keys, pa.string()).take(pa.array(which)),
            "ts_ns": pa.array(np.concatenate(times).astype(np.int64)),
            "vtype": pa.array(np.asarray(kinds, np.int8)[which]),
        }
        for kind in set(kinds):
            mine = [k for k in range(len(held)) if kinds[k] == kind]
            if kind == STRING:
                column: list = [None] * n
                for k in mine:
                    column[starts[k] : ends[k]] = [_text(v) for v in values[k]]
                columns[COLUMN[kind]] = pa.array(column, pa.string())
                continue
            column, none = np.zeros(n, HELD[kind]), np.ones(n, bool)
            for k in mine:
                column[starts[k] : ends[k]], none[starts[k] : ends[k]] = values[k], False
            array = pa.array(column, mask=none)
            columns[COLUMN[kind]] = array.cast(pa.decimal128(20, 0)) if kind == UNSIGNED else array
        arrays = [columns[f.name] if f.name in columns else pa.repeat(pa.scalar(self.same[f.name], f.type), n) if f.name in self.same else pa.nulls(n, f.type) for f in self.schema]
        yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def wal_batches(schema: pa.Schema, shard: dict, file_seq: int, f, low: int, high: int, begin: int = 0, end: int | None = None, keys: tuple[bytes, bytes] | None = None) -> Iterator[pa.RecordBatch]:
    out, place = Batches(schema, shard, WAL, file_seq), 0
    for frame, key, kind, times, values in wal.columns(f, begin, end):
        first, place = place, place + len(times)
        if (not keys or keys[0] <= key <= keys[1]) and len(times) and times.max() >= low and times.min() <= high:
            yield from out.add(frame, first, key, kind, times, values)
    yield from out.flush()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


def read_values(spark: SparkSession, shards: list, start: int = LOWEST, end: int = HIGHEST, check: bool = True, keys: tuple[str, str] | None = None, split: int = tsm.SPLIT) -> DataFrame:
    """All values of the shards' files in the range of time and, if given, of raw keys (first and last, by their bytes);
    blocks outside these aren't read.  Damage is an error."""
    listing = [(s.source_id, s.database, s.retention, s.shard_id, src, k, f) for s in shards for src, own in ((TSM, s.tsm_files), (WAL, s.wal_files)) for k, f in enumerate(own)]
    if not listing:
        return spark.createDataFrame([], RAW)
    # fixed numbers of tasks, as these small rows stand for much work; by the files' sizes, which the listing has looked at
    names = spark.createDataFrame(listing, FILES).repartition(min(len(listing), 10_000), "path")
    tasks = min(len(listing) + sum(os.stat(r[-1]).st_size for r in listing) // max(split, TASK_BYTES), 100_000)
    schema, parts = to_arrow_schema(RAW), to_arrow_schema(spark.createDataFrame([], PARTS).schema)
    span = tuple(k.encode() for k in keys) if keys else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows_of(batches):
            try:
                with open(r["path"], "rb") as f:
                    found = list(tsm.parts(f, start, end, span, split)) if r["src"] == TSM else [tsm.Range(0, f.seek(0, 2), f.tell())]
            except Damaged as e:
                raise Damaged(f"{r['path']}: {e}") from e
            if found:
                yield pa.RecordBatch.from_pylist([r | {"begin": x.begin, "stop": x.end, "bytes": x.blocks} for x in found], schema=parts)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows_of(batches):
            shard = {c: r[c] for c in SHARD_COLUMNS}
            try:
                with open(r["path"], "rb") as f:
                    if r["src"] == WAL:
                        yield from wal_batches(schema, shard, r["file_seq"], f, start, end, keys=span)
                    else:
                        out = Batches(schema, shard, TSM, r["file_seq"])
                        for key, first, kind, times, values in tsm.read(f, start, end, span, check, (r["begin"], r["stop"])):
                            yield from out.add(0, first, key, kind, times, values)
                        yield from out.flush()
            except Damaged as e:
                raise Damaged(f"{r['path']}: {e}") from e

    dealt = names.mapInArrow(cut, PARTS).repartition(tasks, "path", "begin")
    return dealt.mapInArrow(decode, RAW).where(F.col("ts_ns").between(start, end))
