"""The two runs: a report without any delivery, and delivery with a ledger.

Extraction, last write wins, lines and cuts are plans over all shards, whose results are stored.  Executors deliver:
as many tasks as there are workers get the shards' lines in the order of their chunks, send one chunk after the other
and put each acknowledgement into the ledger before the next, so a chunk's text never passes the driver.  What is
left to send is a join with the ledger.  An error ends the run: its task tells, the others stop before their next
chunk, and a shard with an error is never through."""

from __future__ import annotations

import json
import os
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.units import HIGHEST, LOWEST, PRECISIONS, fingerprint
from ..model import SHARD_KEY
from ..operators import chunking, rejoin, report, resume
from ..sinks.http import Exhausted, Rejected, Sink
from ..sinks.ledger import ACKS, ENDS, Ledger, Writer
from ..sources import catalog
from ..sources.values import read_values


@dataclass
class Settings:
    start: int = LOWEST
    end: int = HIGHEST
    chunk_bytes: int = chunking.DEFAULT_BYTES
    precision: str = "ns"
    rename: dict[str, str] = field(default_factory=dict)
    workers: int = 2


@dataclass
class Loaded:
    """``rows`` as the target reports them; ``skipped`` chunks it had already."""

    rows: int = 0
    chunks: int = 0
    skipped: int = 0
    shards: int = 0
    shards_skipped: int = 0


def extract(spark: SparkSession, shards: list[catalog.Shard], settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(values, points) of the shards."""
    values = read_values(spark, shards, settings.start, settings.end)
    return values, rejoin.points(values)


def in_precision(points: DataFrame, precision: str) -> DataFrame:
    """Times as the target reads them, rounded down; in nanoseconds they stay."""
    factor = PRECISIONS[precision]
    return points if factor == 1 else points.withColumn("ts_ns", F.floor(F.col("ts_ns").cast("decimal(20,0)") / factor).cast("bigint"))


def dry_run(spark: SparkSession, shards: list[catalog.Shard], settings: Settings, sample: int = 5) -> dict[str, DataFrame]:
    """Reports as tables: shards, databases, total, keys by shard and by database, and the first lines of each database.

    The files are decoded once, whatever is asked for: values and points stay on the executors' disks meanwhile."""
    values = read_values(spark, shards, settings.start, settings.end).persist(StorageLevel.DISK_ONLY)
    points = rejoin.points(values).persist(StorageLevel.DISK_ONLY)
    by_shard, keys = report.shard_stats(points), report.key_stats(values)
    return {
        "shards": by_shard,
        "databases": report.database_stats(by_shard),
        "total": report.grand_total(by_shard),
        "keys": keys,
        "database_keys": report.database_keys(keys),
        "samples": rejoin.lines(report.samples(points, sample)),
    }


class Progress:
    """A line now and then while executors deliver, from what they add to the ledger; each chunk's, if ``verbose``."""

    def __init__(self, folder: str, shards: int, say: Callable[[str], None] = print, verbose: bool = False, every: float | None = None):
        self.folder, self.shards, self.say, self.verbose, self.every = folder, shards, say, verbose, every or (30.0 if verbose else 5.0)
        self.seen = {t: {f: f.stat().st_size for f in Path(folder, t).glob("*.json")} for t in (ACKS, ENDS)}
        self.began, self.stop = time.monotonic(), threading.Event()
        self.done = self.chunks = self.rows = self.bytes = 0
        self.thread = threading.Thread(target=self.watch, daemon=True)

    def __enter__(self) -> Progress:
        self.thread.start()
        return self

    def __exit__(self, *_) -> None:
        self.stop.set()
        self.thread.join()
        self.look()
        self.say(self.line())

    def watch(self) -> None:
        while not self.stop.wait(self.every):
            self.look()
            self.say(self.line())

    def added(self, table: str) -> Iterator[dict]:
        """Rows since the last look."""
        for f in Path(self.folder, table).glob("*.json"):
            with f.open("rb") as data:
                data.seek(self.seen[table].get(f, 0))
                new = data.read()
            whole = new[: new.rfind(b"\n") + 1]
            self.seen[table][f] = self.seen[table].get(f, 0) + len(whole)
            yield from map(json.loads, whole.splitlines())

    def look(self) -> None:
        for r in self.added(ACKS):
            self.chunks, self.rows, self.bytes = self.chunks + 1, self.rows + r["rows"], self.bytes + r["bytes"]
            if self.verbose:
                self.say(f"{r['source_id']}/{r['shard_id']}: chunk {r['seq']}, {r['bytes']} bytes, {r['rows']} rows")
        self.done += sum(1 for _ in self.added(ENDS))

    def line(self) -> str:
        took = max(time.monotonic() - self.began, 1e-9)
        return f"{self.done}/{self.shards} shards, {self.chunks} chunks, {self.rows} rows, {self.bytes / 1e6:.1f} MB, {self.rows / took:.0f} rows/s, {self.bytes / 1e6 / took:.1f} MB/s"


def _bytes_of(texts: pa.StringArray) -> bytes:
    """Neighbouring strings as they lie in memory."""
    if not len(texts):
        return b""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return texts.buffers()[2][int(ends[0]) : int(ends[-1])].to_pybytes()


SENT = "source_id string, shard_id string, seq int, rows long, bytes long, error string, message string"


def deliver(rows: DataFrame, sink: Sink, ledger: str, rename: dict[str, str], workers: int, stop: str) -> DataFrame:
    """Sends ``rows`` (shard, seq, chunks, series_key, ts_ns, lp) in ``workers`` tasks and tells of each chunk, or of an error.

    A shard's chunks are one task's, in order.  A task that runs again passes over what it has acknowledged before."""
    schema = pa.schema([("source_id", pa.string()), ("shard_id", pa.string()), ("seq", pa.int32()), ("rows", pa.int64()), ("bytes", pa.int64()), ("error", pa.string()), ("message", pa.string())])

    def told(**row) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([row], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = set()
        if TaskContext.get().attemptNumber():
            for f in Path(ledger, ACKS).glob("*.json"):
                before |= {(r["source_id"], r["shard_id"], r["seq"]) for r in map(json.loads, f.read_bytes().rpartition(b"\n")[0].splitlines())}
        writer, now, held = Writer(ledger), None, []

        def send() -> pa.RecordBatch:
            source, shard, database, seq, chunks = now
            if (source, shard, seq) not in before:
                body = b"".join(held)
                got = sink.send(rename.get(database, database), body)
                writer.add(ACKS, source_id=source, shard_id=shard, seq=seq, rows=got.rows_imported, bytes=len(body))
                found = told(source_id=source, shard_id=shard, seq=seq, rows=got.rows_imported, bytes=len(body))
            else:
                found = told(source_id=source, shard_id=shard, seq=seq, rows=0, bytes=0)
            if seq == chunks - 1:
                writer.add(ENDS, source_id=source, shard_id=shard, chunks=chunks)
            return found

        try:
            for b in batches:
                marks = list(zip(*(b.column(c).to_pylist() for c in ("source_id", "shard_id", "database", "seq", "chunks"))))
                at = 0
                while at < len(marks):
                    end = at + 1
                    while end < len(marks) and marks[end] == marks[at]:
                        end += 1
                    if now != marks[at]:
                        if now:
                            yield send()
                        if os.path.exists(stop):
                            return
                        now, held = marks[at], []
                    held.append(_bytes_of(b.column(b.schema.names.index("lp")).slice(at, end - at)))
                    at = end
            if now:
                yield send()
        except (Rejected, Exhausted) as e:
            Path(stop).touch()
            yield told(source_id=now[0], shard_id=now[1], seq=now[3], rows=0, bytes=0, error=type(e).__name__, message=f"{now[0]}/{now[1]}, chunk {now[3]}: {e}")
        finally:
            writer.close()

    ordered = rows.repartition(workers, *SHARD_KEY).sortWithinPartitions(*SHARD_KEY, "seq", "series_key", "ts_ns")
    return ordered.select("source_id", "shard_id", "database", "seq", "chunks", "lp").mapInArrow(run, SENT)


def load(spark: SparkSession, shards: list[catalog.Shard], sink: Sink, ledger: Ledger, settings: Settings, folder: str, say: Callable[[str], None] = print, verbose: bool = False) -> Loaded:
    """Delivers what the ledger doesn't have yet; ``folder`` takes lines meanwhile, where all executors can write."""
    # a file that changes between two runs may move cuts in a shard that is half sent
    ledger.check(fingerprint(settings.chunk_bytes, settings.start, settings.end, settings.precision, settings.rename, catalog.file_stamps(shards)))
    out, by_key = Loaded(), {(s.source_id, s.shard_id): s for s in shards}
    if not shards:
        return out
    open_ = resume.without_done(catalog.shard_table(spark, shards), ledger.ends(spark)).select(*resume.LEDGER_KEY).collect()  # the list of shards is the driver's own
    todo = sorted((by_key[tuple(r)] for r in open_), key=lambda s: tuple(s[:4]))
    out.shards_skipped = len(shards) - len(todo)
    if not todo:
        return out
    _, points = extract(spark, todo, settings)
    rejoin.lines(in_precision(points, settings.precision)).write.mode("overwrite").parquet(f"{folder}/lines")
    lines = spark.read.parquet(f"{folder}/lines")
    chunking.numbers(lines, settings.chunk_bytes).write.mode("overwrite").parquet(f"{folder}/numbers")
    numbers = spark.read.parquet(f"{folder}/numbers")
    totals = numbers.groupBy(*SHARD_KEY).agg((F.max("seq") + 1).alias("chunks"))
    committed = resume.committed(ledger.acks(spark))
    had = {(r["source_id"], r["shard_id"]): r["committed"] + 1 for r in committed.collect()}  # a row for each shard
    left = resume.to_send(numbers.drop("nbytes"), committed).join(totals, SHARD_KEY)
    rows = lines.select(*rejoin.POINT_KEY, "lp").join(left, rejoin.POINT_KEY)
    stop = os.path.join(ledger.folder, f"stop-{uuid.uuid4().hex}")
    try:
        with Progress(ledger.folder, len(todo), say, verbose):
            sent = deliver(rows, sink, ledger.folder, settings.rename, settings.workers, stop).collect()  # a row for each chunk
    finally:
        Path(stop).unlink(missing_ok=True)
    for r in sent:
        if r["error"]:
            raise {"Rejected": Rejected, "Exhausted": Exhausted}[r["error"]](r["message"])
    # shards of which nothing was left to send, and those without lines, are through as well
    chunks = {(r["source_id"], r["shard_id"]): r["chunks"] for r in totals.collect()}
    writer, ended = Writer(ledger.folder), {(r["source_id"], r["shard_id"]) for r in ledger.ends(spark).select(*resume.LEDGER_KEY).collect()}
    for s in todo:
        key = (s.source_id, s.shard_id)
        out.skipped += min(had.get(key, 0), chunks.get(key, 0))
        if key not in ended:
            writer.add(ENDS, source_id=s.source_id, shard_id=s.shard_id, chunks=chunks.get(key, 0))
    writer.close()
    out.rows, out.chunks, out.shards = sum(r["rows"] for r in sent), len(sent), len(todo)
    return out
