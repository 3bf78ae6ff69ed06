"""Counts and samples of what was extracted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..model import FIELD_SEPARATOR, SHARD_KEY, TSM, WAL


def shard_stats(points: DataFrame) -> DataFrame:
    """Points, fields and the time range of each shard."""
    return points.groupBy(*SHARD_KEY).agg(F.count("*").alias("points"), F.sum(F.size("fields")).alias("fields"), F.min("ts_ns").alias("min_ts"), F.max("ts_ns").alias("max_ts"))


def key_stats(values: DataFrame) -> DataFrame:
    """For each shard: keys in column files (a key counts once a file), keys in logs, and occurrences of keys without a field."""
    has_field = F.locate(FIELD_SEPARATOR, "raw_key") > 0
    occurrence = values.select(*SHARD_KEY, "src", "file_seq", F.when(F.col("src") == WAL, F.col("entry_seq")).alias("entry"), "raw_key", has_field.alias("ok")).distinct()
    by_file = occurrence.groupBy(*SHARD_KEY, "src", "file_seq", "raw_key", "ok").agg(F.count("*").alias("entries"))
    return by_file.groupBy(*SHARD_KEY).agg(
        F.count_if((F.col("src") == TSM) & F.col("ok")).alias("keys"),
        F.count_if((F.col("src") == WAL) & F.col("ok")).alias("wal_keys"),
        F.coalesce(F.sum(F.when(~F.col("ok"), F.col("entries"))), F.lit(0)).alias("skipped"),
    )


def database_stats(shards: DataFrame) -> DataFrame:
    """Sums over the shards of a database; shards without points don't count for the time range."""
    return shards.groupBy("database").agg(F.count("*").alias("shards"), F.sum("points").alias("points"), F.sum("fields").alias("fields"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))


def grand_total(shards: DataFrame) -> DataFrame:
    return shards.agg(F.coalesce(F.sum("points"), F.lit(0)).alias("points"), F.coalesce(F.sum("fields"), F.lit(0)).alias("fields"), F.countDistinct("database").alias("databases"))


def database_keys(keys: DataFrame) -> DataFrame:
    """Sums of ``key_stats`` over the shards of a database."""
    return keys.groupBy("database").agg(*(F.sum(c).alias(c) for c in ("keys", "wal_keys", "skipped")))


def samples(points: DataFrame, many: int = 5) -> DataFrame:
    """The first points of each database in the order of delivery, with ``nth``; the limit runs before the exchange too,
    and only these points need be written as lines."""
    order = Window.partitionBy("database").orderBy("retention", "shard_id", "series_key", "ts_ns")
    return points.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= many)


def distinct_series(values: DataFrame) -> DataFrame:
    return values.select("database", "series_key").distinct()
