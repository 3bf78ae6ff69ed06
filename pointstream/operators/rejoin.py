"""From field values to points: time range, last write wins, assembly, lines.

One exchange and one sort serve both last write wins and assembly: values dealt by (shard, series, time) are together
for (shard, series, time, field) as well, and sorted by these and their order they are in order for both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys, lineproto
from ..functions.units import HIGHEST, LOWEST
from ..model import FLOAT, ORDER_COLUMNS, PAYLOAD_COLUMNS, SHARD_KEY

POINT_KEY = [*SHARD_KEY, "series_key", "ts_ns"]
#: The same with the most distinct column first, by which most comparisons of a sort end.
SORT_KEY = ["ts_ns", "series_key", *SHARD_KEY]


def in_range(values: DataFrame, start: int = LOWEST, end: int = HIGHEST) -> DataFrame:
    """Both ends belong to the range."""
    return values if (start, end) == (LOWEST, HIGHEST) else values.where(F.col("ts_ns").between(start, end))


def parsed(values: DataFrame) -> DataFrame:
    """Adds series_key and field; keys without a field fall away (``report.skipped`` counts them)."""
    return values.withColumns({"series_key": keys.series_key(F.col("raw_key")), "field": keys.field_name(F.col("raw_key"))}).where(F.col("field").isNotNull())


def last_write_wins(values: DataFrame) -> DataFrame:
    """One value for each (shard, series, time, field): the latest of source, file, entry and place, with its own type."""
    latest_first = Window.partitionBy(*SORT_KEY, "field").orderBy(*(F.desc(c) for c in ORDER_COLUMNS))
    won = values.withColumn("nth", F.row_number().over(latest_first)).where("nth = 1")
    return won.select(*POINT_KEY, "field", F.struct(*PAYLOAD_COLUMNS).alias("value"))


def points(values: DataFrame, start: int = LOWEST, end: int = HIGHEST) -> DataFrame:
    """(shard, series_key, ts_ns, fields): fields in order of their names, only those that the point has."""
    won = last_write_wins(parsed(in_range(values, start, end)).repartition(*POINT_KEY))
    own = Window.partitionBy(*SORT_KEY).orderBy("field")
    entry = F.struct(F.col("field").alias("name"), F.col("value"))
    every = F.collect_list(entry).over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return won.select(*POINT_KEY, every.alias("fields"), F.row_number().over(own).alias("nth")).where("nth = 1").drop("nth")


def lines(points_: DataFrame) -> DataFrame:
    """(shard, series_key, ts_ns, n_fields, lp, nbytes), and further columns of ``points_``.  Only floats that the JVM can't write as short decimals go to Python.

    All other lines are written before that step, so what waits for Python's answer is a line and not its fields."""
    is_float = lambda f: f["value"]["vtype"] == FLOAT
    short = lambda f: lineproto.format_short_decimal(f["value"]["v_float"])
    more = [c for c in points_.columns if c not in (*POINT_KEY, "fields")]
    texts = F.transform("fields", lambda f: F.struct(f["name"].alias("name"), lineproto.format_value(f["value"], short(f)).alias("text"), F.when(is_float(f), f["value"]["v_float"]).alias("float")))
    made = points_.select(*POINT_KEY, *more, F.size("fields").alias("n_fields"), lineproto.head_of(F.col("series_key")).alias("head"), texts.alias("texts"))
    # a point's floats without a text; Arrow's writer is slow with arrays that are null
    hard = lambda f: f["text"].isNull() & f["float"].isNotNull()
    rest = F.when(F.exists("texts", hard), F.filter("texts", hard)).otherwise(F.array().cast(made.schema["texts"].dataType))
    made = made.withColumn("rest", rest)
    easy = F.when(F.size("rest") == 0, lineproto.line(F.col("head"), F.col("texts"), F.col("ts_ns")))
    made = made.withColumns({"easy": easy, "texts": F.when(F.size("rest") > 0, F.col("texts")), "head": F.when(F.size("rest") > 0, F.col("head")), "floats": F.transform("rest", lambda f: f["float"]), "names": F.transform("rest", lambda f: f["name"])}).drop("rest")
    # easy lines are asked for twice, or they would be put off until after Python's step
    made = made.withColumns({"written": lineproto.format_floats("floats"), "easy": F.when(F.col("easy").isNotNull(), F.col("easy"))})
    by_name = lambda f: F.get("written", F.array_position("names", f["name"]).cast("int") - 1)
    fields = F.transform("texts", lambda f: F.struct(f["name"].alias("name"), F.coalesce(f["text"], by_name(f)).alias("text")))
    lp = F.when(F.col("easy").isNotNull(), F.col("easy")).otherwise(lineproto.line(F.col("head"), fields, F.col("ts_ns")))
    return made.select(*POINT_KEY, *more, "n_fields", lp.alias("lp")).withColumn("nbytes", F.octet_length("lp"))
