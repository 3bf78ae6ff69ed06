"""Logs as they arrive: each micro-batch decodes what logs have gained and folds it into the points' latest values.

Late and out-of-order values need no watermark: a batch is folded into the stored values by the same last-write
rule, so any order of arrival ends in the same table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from ..functions.units import HIGHEST, LOWEST, floor_micros
from ..model import ORDER_COLUMNS, PAYLOAD_COLUMNS, RAW, SHARD_KEY
from ..operators.rejoin import parsed
from ..sources import catalog, wal
from ..sources.values import wal_batches


class Stretch(InputPartition):
    """Whole frames of one log."""

    def __init__(self, shard: dict, number: int, path: str, begin: int, end: int):
        self.shard, self.number, self.path, self.begin, self.end = shard, number, path, begin, end


class LogReader(DataSourceStreamReader):
    """An offset says up to which byte each log has whole frames; frames' heads are all that the driver reads."""

    def __init__(self, folder: str):
        self.folder = folder
        self.schema = to_arrow_schema(RAW)

    def logs(self) -> dict[str, tuple[dict, int]]:
        found = {}
        for s in catalog.shards("", self.folder, internal=True):
            shard = {"source_id": s.source_id, "database": s.database, "retention": s.retention, "shard_id": s.shard_id}
            found |= {str(Path(f).relative_to(self.folder)): (shard, k) for k, f in enumerate(s.wal_files)}
        return found

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        out = {}
        for name in self.logs():
            with open(Path(self.folder, name), "rb") as f:
                out[name] = wal.whole(f)
        return out

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        logs = self.logs()
        return [Stretch(*logs[name], str(Path(self.folder, name)), start.get(name, 0), to) for name, to in sorted(end.items()) if to > start.get(name, 0) and name in logs]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as f:
            yield from wal_batches(self.schema, partition.shard, partition.number, f, LOWEST, HIGHEST, partition.begin, partition.end)


class LogSource(DataSource):
    """Spark's own readers leave out files whose names begin with an underscore, as those of logs do."""

    @classmethod
    def name(cls) -> str:
        return "pointstream_logs"

    def schema(self):
        return RAW

    def streamReader(self, schema):  # noqa: N802
        return LogReader(self.options["path"])


def logs(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the raw values in the logs below ``folder`` (database, retention, shard), as frames are added to them."""
    spark.dataSource.register(LogSource)
    return spark.readStream.format(LogSource.name()).option("path", folder).load()


def latest(values: DataFrame) -> DataFrame:
    """Values with only the last write of each (shard, key, time), order columns kept for further merging."""
    columns = [*ORDER_COLUMNS, *PAYLOAD_COLUMNS]
    best = F.max_by(F.struct(*columns), F.struct(*ORDER_COLUMNS)).alias("v")
    return values.groupBy(*SHARD_KEY, "raw_key", "ts_ns").agg(best).select(*SHARD_KEY, *(F.col(f"v.{c}").alias(c) for c in ORDER_COLUMNS), "raw_key", "ts_ns", *(F.col(f"v.{c}").alias(c) for c in PAYLOAD_COLUMNS))


def follow(spark: SparkSession, path: str, checkpoint: str, write: Callable[[DataFrame, int], None], once: bool = True, raw: bool = False) -> StreamingQuery:
    """A stream over Parquet files of raw values in ``path``, or with ``raw`` over the logs below it; ``write`` gets each
    batch's latest values and its number.

    With the number ``write`` can make a repeated batch harmless.  ``once``: what is there now, then stop."""
    stream = logs(spark, path) if raw else spark.readStream.schema(RAW).parquet(path)
    writer = stream.writeStream.foreachBatch(lambda df, n: write(latest(df), n)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()


def windowed_counts(values: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Values for each series and window of event time; state older than the watermark goes."""
    timed = parsed(values).withColumn("at", F.timestamp_micros(floor_micros(F.col("ts_ns"))))
    return timed.withWatermark("at", late).groupBy("series_key", F.window("at", width)).agg(F.count("*").alias("n")).select("series_key", F.col("window.start").alias("start"), "n")
