"""Further ways out: lines as text, points as wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import BOOLEAN, FLOAT, INTEGER, SHARD_KEY, STRING, UNSIGNED


def write_lines(lines: DataFrame, path: str) -> None:
    """Text files by database and shard, each in order."""
    rows = lines.select(*SHARD_KEY, "series_key", "ts_ns", F.regexp_replace("lp", "\n$", "").alias("value"))
    ordered = rows.repartition(*SHARD_KEY).sortWithinPartitions(*SHARD_KEY, "series_key", "ts_ns")
    ordered.select("database", "shard_id", "value").write.partitionBy("database", "shard_id").mode("overwrite").text(path)


def conflicts(points: DataFrame) -> DataFrame:
    """(database, measurement part of the key, field, types) of fields that have several types."""
    each = points.select("database", F.split("series_key", ",")[0].alias("measurement"), F.explode("fields").alias("f"))
    return each.groupBy("database", "measurement", F.col("f.name").alias("field")).agg(F.array_sort(F.collect_set("f.value.vtype")).alias("types")).where(F.size("types") > 1)


def wide(points: DataFrame, fields: dict[str, int]) -> DataFrame:
    """A row for each point with a column for each of ``fields`` (name to type); another type there is null, never cast."""
    columns = {FLOAT: "v_float", INTEGER: "v_int", UNSIGNED: "v_uint", BOOLEAN: "v_bool", STRING: "v_str"}

    def value(name: str, kind: int):
        hit = F.filter("fields", lambda f: (f["name"] == name) & (f["value"]["vtype"] == kind))
        return F.get(hit, F.lit(0))["value"][columns[kind]].alias(name)

    return points.select(*SHARD_KEY, "series_key", "ts_ns", *(value(n, k) for n, k in sorted(fields.items())))
