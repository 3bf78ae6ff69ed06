"""Best-fit packing of tokenised documents by exact-complement hashing.

Only the number of pieces of each length matters for a plan, and there are at most ``capacity`` lengths:
the histogram goes to the driver, a plan of patterns (lengths that share a sequence, and how many such
sequences) comes back, and each piece finds its place by its rank among the pieces of its length."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import PART_BYTES, encoder
from .common import batch, checkpoint, parts, relaxing, texts

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, block int, nth long"
PIECES_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("block", pa.int32()), ("nth", pa.int64())])


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Rows for the pieces of each document, stored.  ``block`` is the task that made a row and ``nth``
    counts the task's earlier pieces of the same length."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        task, seen, model = TaskContext.get().partitionId(), defaultdict(int), encoder(vocabulary)
        for ids, some in parts(batches, PART_BYTES):
            rows = []
            for doc, tokens in zip(ids, model.encode(some)):
                tokens += end
                n = len(tokens) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n - start) % capacity or min(capacity, n - start)
                    rows.append((doc, piece, start, length, zlib.crc32(tokens[4 * start : 4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            if rows:
                yield batch(PIECES_SCHEMA, **dict(zip(PIECES_SCHEMA.names, zip(*rows))))

    return checkpoint(texts(docs).mapInArrow(relaxing(run), PIECES))


def _fillings(counts: np.ndarray, first: int, gap: int):
    """One, two or three available lengths besides ``first`` that fill ``gap`` exactly, or None."""
    left = counts.copy()
    left[first] -= 1
    if gap and left[gap] > 0:
        return (gap,)
    small = np.arange(1, gap // 2 + 1)
    ok = (left[small] > 0) & (left[gap - small] > 0) & ((small * 2 != gap) | (left[small] > 1))
    if ok.any():
        b = int(small[ok][-1])
        return (gap - b, b)
    have = np.flatnonzero(left[: gap - 1] > 0)
    for b in have[::-1]:  # the largest of a triple first
        if 3 * b < gap:
            break
        rest = gap - int(b)
        left[b] -= 1
        c = np.arange(1, rest // 2 + 1)
        c = c[rest - c <= b]
        ok = (left[c] > 0) & (left[rest - c] > 0) & ((c * 2 != rest) | (left[c] > 1))
        left[b] += 1
        if ok.any():
            x = int(c[ok][-1])
            return (int(b), rest - x, x)
    return None


def _times(counts: np.ndarray, pattern: tuple[int, ...]) -> int:
    """Sequences that the available pieces give by one pattern."""
    return min(int(counts[x]) // pattern.count(x) for x in set(pattern))


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over groups of like sequences instead of single ones."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in range(capacity, 0, -1):
        n = int(counts[length])
        while n:
            room = next((r for r in range(length, capacity + 1) if open_.get(r)), None)
            if room is None:
                k = capacity // length
                if n >= k:
                    open_[capacity - k * length].append(((length,) * k, n // k))
                    n %= k
                if n:
                    open_[capacity - n * length].append(((length,) * n, 1))
                n = 0
                continue
            pattern, times = open_[room].pop()
            used = min(times, n)
            open_[room - length].append((pattern + (length,), used))
            if times > used:
                open_[room].append((pattern, times - used))
            n -= used
    return [x for group in open_.values() for x in group]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and their multiplicities; ``counts[n]`` pieces have length n.

    Longest lengths first, the gap each leaves is looked up among the sums of one, two and three
    available lengths and filled as often as the pieces last; best fit places what remains.  Plain best
    fit is kept instead where it needs fewer sequences."""
    left, out = np.asarray(counts, np.int64).copy(), []
    for first in range(capacity, 0, -1):
        while left[first] > 0:
            rest = () if first == capacity else _fillings(left, first, capacity - first)
            if rest is None:
                break
            pattern = (first, *rest)
            times = _times(left, pattern)
            for x in pattern:
                left[x] -= times
            out.append((pattern, times))
    out += _best_fit(left, capacity)
    plain = _best_fit(np.asarray(counts, np.int64), capacity)
    return min(out, plain, key=lambda p: sum(n for _, n in p))


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """For each place in a pattern: length, the first rank that goes there, its sequence, the offset; sorted by the first two."""
    rank, rows, sequence = defaultdict(int), [], 0
    for pattern, times in patterns:
        offset = 0
        for x in pattern:
            rows.append((x, rank[x], sequence, offset))
            rank[x] += times
            offset += x
        sequence += times
    return tuple(np.asarray(c, np.int64) for c in zip(*sorted(rows))) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))


OUT = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: where it comes from and its place in a sequence of ``capacity`` tokens.

    Null texts count as empty and give the end id alone.  Rows with the same id are documents of their own.
    An empty table gives no rows."""
    stored = pieces(docs, vocabulary, capacity, end_id)
    by = stored.groupBy("block", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in by.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at the most
        counts[r["length"]] = r["n"]
    lengths, ranks, sequences, offsets = slots(plan(counts, capacity))
    keys = lengths << 40 | ranks
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = stored.join(by.select("block", "length", before.alias("base")), ["block", "length"])

    def run(batches):
        for b in batches:
            length, rank = (b.column(b.schema.names.index(x)).to_numpy(zero_copy_only=False) for x in ("length", "rank"))
            at = np.searchsorted(keys, length << 40 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])], schema=OUT)

    rows = placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    return rows.mapInArrow(relaxing(run), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
