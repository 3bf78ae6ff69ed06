"""What a ledger says is done, as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A database's shown name may change between runs; a shard's source doesn't.
LEDGER_KEY = ["source_id", "shard_id"]


def committed(acks: DataFrame) -> DataFrame:
    """For each shard the last chunk of the unbroken row of acknowledged ones, and the rows sent; later acks never lower it."""
    each = acks.groupBy(*LEDGER_KEY, "seq").agg(F.max("rows").alias("rows"))
    whole = each.groupBy(*LEDGER_KEY).agg(F.array_sort(F.collect_list("seq")).alias("seqs"), F.sum("rows").alias("rows"))
    unbroken = F.size(F.filter("seqs", lambda s, k: s == k)) - 1
    return whole.select(*LEDGER_KEY, unbroken.alias("committed"), "rows")


def upserted(acks: DataFrame) -> DataFrame:
    return acks.groupBy(*LEDGER_KEY).agg(F.max("seq").alias("committed"), F.sum("rows").alias("rows"))


def summary(acks: DataFrame, done: DataFrame) -> DataFrame:
    started = acks.select(*LEDGER_KEY).distinct().agg(F.count("*").alias("started"))
    ended = done.agg(F.count("*").alias("done"))
    sent = acks.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    return started.crossJoin(ended).crossJoin(sent)  # of one row each


def without_done(shards: DataFrame, done: DataFrame) -> DataFrame:
    return shards.join(done.select(*LEDGER_KEY).distinct(), LEDGER_KEY, "left_anti")


def to_send(chunks: DataFrame, committed_: DataFrame) -> DataFrame:
    """Chunks behind the last acknowledged one of their shard."""
    return chunks.join(committed_.select(*LEDGER_KEY, "committed"), LEDGER_KEY, "left").where(F.col("seq") > F.coalesce("committed", F.lit(-1))).drop("committed")


def renamed(database: Column, names: dict[str, str]) -> Column:
    if not names:
        return database
    pairs = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.coalesce(F.element_at(pairs, database), database)


def with_bucket_names(shards: DataFrame, buckets: DataFrame, keep_system: bool = False) -> DataFrame:
    """Ids resolved to names; unknown ids stay, system buckets fall away.  ``buckets``: id, name, type (0: user's)."""
    named = shards.join(buckets.select(F.col("id").alias("database"), "name", "type"), "database", "left")
    if not keep_system:
        named = named.where(F.coalesce("type", F.lit(0)) == 0)
    return named.withColumn("database", F.coalesce("name", "database")).drop("name", "type")


def wanted(shards: DataFrame, databases: list[str] = (), internal: bool = False) -> DataFrame:
    if not internal:
        shards = shards.where("database <> '_internal'")
    return shards.where(F.col("database").isin(*databases)) if databases else shards
