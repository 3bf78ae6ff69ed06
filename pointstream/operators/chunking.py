"""Byte-bounded chunks, the same ones in every run.

A line goes to the open chunk unless that would then hold more than the limit; a line as large as the limit is
a chunk of its own.  Cuts depend on all cuts before, so a shard's lines pass one cutter in order; what passes are
keys, times and sizes only, never the lines, which get their numbers back by a join on the key that they were
put together by."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import SHARD_KEY

DEFAULT_BYTES = 450 << 20
MOST_BYTES = 500 << 20


class Cutter:
    """The number of each line's chunk."""

    def __init__(self, limit: int):
        self.limit, self.held, self.seq = limit if limit > 0 else DEFAULT_BYTES, 0, 0

    def add(self, size: int) -> int:
        if self.held and self.held + size > self.limit:
            self.seq, self.held = self.seq + 1, 0
        at = self.seq
        self.held += size
        if self.held >= self.limit:
            self.seq, self.held = self.seq + 1, 0
        return at

    def add_all(self, sizes: np.ndarray) -> np.ndarray:
        """The same for many lines, a step for each chunk."""
        ends, out, at = np.cumsum(sizes, dtype=np.int64), np.empty(len(sizes), np.int32), 0
        while at < len(sizes):
            before = int(ends[at - 1]) if at else 0
            # lines that fit without closing the chunk; the next one closes it, or goes to another one
            fit = int(np.searchsorted(ends, before + self.limit - self.held, "left"))
            out[at:fit] = self.seq
            if fit > at:
                self.held += int(ends[fit - 1]) - before
            if fit < len(sizes):
                out[fit] = self.add(int(sizes[fit]))
            at = fit + 1
        return out


def cut(sizes: Iterable[int], limit: int) -> list[int]:
    cutter = Cutter(limit)
    return [cutter.add(s) for s in sizes]


def numbers(lines: DataFrame, limit: int = DEFAULT_BYTES) -> DataFrame:
    """(shard, series_key, ts_ns, nbytes, seq): each line's chunk, in order within the shards."""
    narrow = lines.select(*SHARD_KEY, "series_key", "ts_ns", F.col("nbytes").cast("long").alias("nbytes"))
    names = narrow.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, cutter = None, Cutter(limit)
        for b in batches:
            sizes, seq = b.column("nbytes").to_numpy(), np.empty(b.num_rows, np.int32)
            names_of = [pc.run_end_encode(b.column(c)).run_ends.to_numpy() for c in SHARD_KEY]
            at = 0
            for end in np.unique(np.concatenate(names_of)).tolist():
                now = [b.column(c)[at].as_py() for c in SHARD_KEY]
                if now != shard:
                    shard, cutter = now, Cutter(limit)
                seq[at:end] = cutter.add_all(sizes[at:end])
                at = end
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seq, pa.int32())], names=[*names, "seq"])

    schema = T.StructType([*narrow.schema, T.StructField("seq", T.IntegerType())])
    return narrow.repartition(*SHARD_KEY).sortWithinPartitions(*SHARD_KEY, "series_key", "ts_ns").mapInArrow(run, schema)


def numbered(lines: DataFrame, limit: int = DEFAULT_BYTES) -> DataFrame:
    """``lines`` with ``seq``, their chunk's number.  ``lines`` is read twice, so it had better be stored."""
    return lines.join(numbers(lines, limit).drop("nbytes"), [*SHARD_KEY, "series_key", "ts_ns"])


def chunk_sizes(numbers_: DataFrame) -> DataFrame:
    return numbers_.groupBy(*SHARD_KEY, "seq").agg(F.count("*").alias("nlines"), F.sum("nbytes").alias("nbytes"))
