"""Documents to packed training sequences: quality rules, near-duplicates, repeated passages, packing.

Each stage works on all rows that the one before kept and returns the columns it got; the last one returns
the pieces of packed sequences."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointstream.llm import near, packing, repeats, rules
from pointstream.llm.chunks import vocabulary
from pointstream.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.judge(docs, table(spark, sf_dir, "labels")).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest id, a row without an id coming last.

    Rows with equal id and text are one document, of which one row stays; others with the same id, or none, stand alone.
    Documents without words, null texts among them, link with nothing; an empty table stays one."""
    own = F.struct(F.col("doc_id").cast("long").isNull().alias("nameless"), F.col("doc_id").cast("long").alias("id"))
    work = F.shiftrightunsigned(F.xxhash64(own, F.coalesce(docs["text"].cast("string"), F.lit(""))), 1).alias("work")
    found = near.near_duplicates(docs.select(work.alias("doc_id"), "text"), percent=80)
    groups = found.select(F.col("doc_id").alias("work"), "component_id").distinct()
    first = F.min(F.struct("own", "work"))["work"].alias("work")
    kept = docs.select(work, own.alias("own")).distinct().join(groups, "work").groupBy("component_id").agg(first).select("work")
    rows = docs.select(F.struct(*docs.columns).alias("row"), work)
    return rows.join(kept, "work", "left_semi").dropDuplicates(["work"]).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand earlier, n_chars as they are now; documents of which nothing is left go, and so do
    those with an empty or null text.  Repeated rows have equal results; an empty table stays one."""
    # ids in a struct, as it is never null: so the join can use the exchange that drops the duplicates, and the new text
    # moves once, the old one not at all
    key = lambda c: F.struct(F.col(c).cast("long").isNull().alias("nameless"), F.coalesce(F.col(c).cast("long"), F.lit(0)).alias("id")).alias("key")
    found = repeats.remove_repeats(docs, characters=True).select(key("doc_id"), "text_md5", F.col("kept").cast("string").alias("cut"))
    found = found.dropDuplicates(["key", "text_md5"])
    others = F.struct(*(docs[c] for c in docs.columns if c not in ("text", "n_chars"))).alias("row")
    rest = docs.select(others, key("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5"))
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    joined = rest.join(found, ["key", "text_md5"]).where("cut <> ''")
    return joined.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as pieces of sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("repeated passages", repeated_passages), ("best-fit packing", pack)]
#: No SQL says these stages on whole tables; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet and read again, and go when the next one's are
    there.  The last one's are the result's and stay in the shared folder until the caller removes them."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            before = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
            before.getFileSystem(spark._jsc.hadoopConfiguration()).delete(before, True)
    return docs
