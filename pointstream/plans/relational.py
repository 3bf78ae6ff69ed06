"""The operators on the supplied tables, each with the SQL that says the same.

``events`` stand for field values: the event type is measurement and database, the user a tag, ``value`` a float
field and the number in ``props`` an integer field that every third event lacks.  Times are cut to days so that
writes collide; every seventh event counts as from a log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, lineproto
from ..functions.units import floor_micros
from ..model import FLOAT, INTEGER, PAYLOAD_COLUMNS, RAW, SHARD_KEY
from ..operators import chunking, rejoin, report, resume

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def micros(ts: str):
    """Independent of the session's time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    us = micros("ts")
    return read(spark, sf_dir, "events").select(
        "event_id", "event_type", "user_id", "value", us.alias("us"), F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )


DAY_US, WEEK_US = 86_400_000_000, 604_800_000_000


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw values; one pass over the table gives both fields."""
    e = events(spark, sf_dir)
    key = F.concat(F.col("event_type"), F.lit(",user="), F.col("user_id").cast("string"))
    fields = F.array(
        F.struct(F.lit("value").alias("field"), F.lit(FLOAT).cast("tinyint").alias("vtype"), F.col("value").alias("v_float"), F.lit(None).cast("bigint").alias("v_int")),
        F.when(F.col("event_id") % 3 != 0, F.struct(F.lit("k").alias("field"), F.lit(INTEGER).cast("tinyint").alias("vtype"), F.lit(None).cast("double").alias("v_float"), F.col("k").alias("v_int"))),
    )
    rows = e.select("*", F.explode(fields).alias("f")).where("f is not null")
    found = {
        "source_id": F.col("event_type"),
        "database": F.col("event_type"),
        "retention": F.lit("autogen"),
        "shard_id": F.floor(F.col("us") / WEEK_US).cast("string"),
        "src": F.when(F.col("event_id") % 7 == 0, 1).otherwise(0).cast("tinyint"),
        "file_seq": (F.col("event_id") % 2).cast("int"),
        "entry_seq": F.lit(0).cast("bigint"),
        "ord": F.col("event_id"),
        "raw_key": F.concat(key, F.lit("#!~#"), F.col("f.field")),
        "ts_ns": F.expr(f"us div {DAY_US}") * (DAY_US * 1000),
        "vtype": F.col("f.vtype"),
        "v_float": F.col("f.v_float"),
        "v_int": F.col("f.v_int"),
    }
    return rows.select(*(found.get(c.name, F.lit(None).cast(c.dataType)).alias(c.name) for c in RAW))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejoin.points(values(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejoin.lines(points(spark, sf_dir))


_E = """WITH e AS (SELECT event_id, event_type, user_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, epoch_us(ts) AS us FROM events),
h AS (SELECT *, event_type AS database, CAST(us // 604800000000 AS VARCHAR) AS shard_id, event_type || ',user=' || user_id AS series_key, (us // 86400000000) * 86400000000000 AS ts_ns,
  CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS src, event_id % 2 AS file_seq FROM e),
v AS (SELECT database, shard_id, series_key, ts_ns, src, file_seq, event_id AS ord, 'value' AS field, 0 AS vtype, value AS v_float, NULL::BIGINT AS v_int FROM h
  UNION ALL SELECT database, shard_id, series_key, ts_ns, src, file_seq, event_id, 'k', 1, NULL, k FROM h WHERE event_id % 3 <> 0)"""
_FLOAT = r"regexp_replace(regexp_replace(CAST(CAST({} AS DECIMAL(14,2)) AS VARCHAR), '0+$', ''), '\.$', '')"
_POINTS = (
    _E
    + """,
won AS (SELECT database, shard_id, series_key, ts_ns, field, arg_max(v_float, (src * 2 + file_seq) * 1000000000000 + ord) AS v_float, arg_max(v_int, (src * 2 + file_seq) * 1000000000000 + ord) AS v_int FROM v GROUP BY ALL),
p AS (SELECT database, shard_id, series_key, ts_ns, count(*) AS n_fields, string_agg(field || '=' || CASE WHEN field = 'k' THEN v_int || 'i' ELSE """
    + _FLOAT.format("v_float")
    + """ END, ',' ORDER BY field) AS fields FROM won GROUP BY ALL),
l AS (SELECT *, series_key || ' ' || fields || ' ' || ts_ns || chr(10) AS lp FROM p)"""
)


@query(_E + " SELECT database, series_key, field, ts_ns, ord, vtype, v_float, v_int FROM v")
def unpivot_field_streams(spark, sf_dir):
    return rejoin.parsed(values(spark, sf_dir)).select("database", "series_key", "field", "ts_ns", "ord", F.col("vtype").cast("int").alias("vtype"), "v_float", "v_int")


@query(_E + " SELECT src, field, count(*) AS n, CAST(sum(ts_ns // 1000000000) AS BIGINT) AS seconds FROM v GROUP BY ALL")
def source_union(spark, sf_dir):
    every = rejoin.parsed(values(spark, sf_dir))
    both = every.where("src = 0").unionByName(every.where("src = 1"))
    return both.groupBy(F.col("src").cast("int").alias("src"), "field").agg(F.count("*").alias("n"), F.sum(F.expr("ts_ns div 1000000000")).cast("bigint").alias("seconds"))


@query(_POINTS + " SELECT database, shard_id, series_key, ts_ns, n_fields, lp FROM l")
def field_rejoin(spark, sf_dir):
    return lines(spark, sf_dir).select("database", "shard_id", "series_key", "ts_ns", F.col("n_fields").cast("bigint").alias("n_fields"), "lp")


@query(_POINTS + " SELECT database, shard_id, series_key, ts_ns, field, v_float, v_int FROM won")
def lww_cross_source(spark, sf_dir):
    won = rejoin.last_write_wins(rejoin.parsed(values(spark, sf_dir)))
    return won.select("database", "shard_id", "series_key", "ts_ns", "field", "value.v_float", "value.v_int")


@query(_E + " SELECT series_key, field, ts_ns, file_seq, v_float, v_int FROM v WHERE src = 0 QUALIFY row_number() OVER (PARTITION BY series_key, field, ts_ns, file_seq ORDER BY ord DESC) = 1")
def lww_intra_stream(spark, sf_dir):
    """Within one file the later place wins."""
    one = rejoin.parsed(values(spark, sf_dir)).where("src = 0").withColumn("shard_id", F.col("file_seq").cast("string"))
    won = rejoin.last_write_wins(one)
    return won.select("series_key", "field", "ts_ns", F.col("shard_id").cast("bigint").alias("file_seq"), "value.v_float", "value.v_int")


@query(_E + ", n AS (SELECT series_key, ts_ns, string_agg(DISTINCT field, ',' ORDER BY field) AS names FROM v GROUP BY ALL) SELECT names, count(*) AS points FROM n GROUP BY names")
def sparse_point_assembly(spark, sf_dir):
    names = F.array_join(F.transform("fields", lambda f: f["name"]), ",")
    return points(spark, sf_dir).select(names.alias("names")).groupBy("names").agg(F.count("*").alias("points"))


@query(_POINTS + " SELECT series_key, ts_ns, max(v_int) FILTER (field = 'k') AS k, max(v_float) FILTER (field = 'value') AS value FROM won GROUP BY ALL")
def wide_pivot(spark, sf_dir):
    from ..sinks.files import wide

    return wide(points(spark, sf_dir), {"k": INTEGER, "value": FLOAT}).select("series_key", "ts_ns", "k", "value")


FROM_NS, TO_NS = 1704672000000000000, 1705276800000000000


@query(_POINTS + f" SELECT series_key, ts_ns, lp FROM l WHERE ts_ns BETWEEN {FROM_NS} AND {TO_NS}")
def time_range_inclusive(spark, sf_dir):
    """Both ends are days that have points."""
    found = rejoin.points(values(spark, sf_dir), FROM_NS, TO_NS)
    return rejoin.lines(found).select("series_key", "ts_ns", "lp")


_PAGES = "WITH r AS (SELECT page_id, url, replace(replace(url, '=', '\\='), ',', '\\,') AS safe FROM pages), k AS (SELECT page_id, 'page,url=' || safe || ',id=' || page_id || '#!~#len#!~#x' AS raw, safe FROM r)"


def page_keys(spark, sf_dir):
    safe = lineproto.escape_tag(F.col("url"))
    return read(spark, sf_dir, "pages").select("page_id", safe.alias("safe"), F.concat(F.lit("page,url="), safe, F.lit(",id="), F.col("page_id").cast("string"), F.lit("#!~#len#!~#x")).alias("raw"))


@query(_PAGES + " SELECT page_id, substr(raw, 1, instr(raw, '#!~#') - 1) AS series_key, substr(raw, instr(raw, '#!~#') + 4) AS field FROM k")
def parse_series_key(spark, sf_dir):
    """The first separator counts; the field may hold further ones."""
    return page_keys(spark, sf_dir).select("page_id", keys.series_key(F.col("raw")).alias("series_key"), keys.field_name(F.col("raw")).alias("field"))


@query(_PAGES + " SELECT page_id, 'page' AS measurement, 'url' AS k0, replace(replace(safe, '\\=', '='), '\\,', ',') AS v0, 'id' AS k1, CAST(page_id AS VARCHAR) AS v1 FROM k")
def parse_tags(spark, sf_dir):
    series = keys.series_key(F.col("raw"))
    t = page_keys(spark, sf_dir).select("page_id", keys.measurement(series).alias("measurement"), keys.tags(series).alias("t"))
    return t.select("page_id", "measurement", F.get("t", F.lit(0))["k"].alias("k0"), F.get("t", F.lit(0))["v"].alias("v0"), F.get("t", F.lit(1))["k"].alias("k1"), F.get("t", F.lit(1))["v"].alias("v1"))


_BACK = "replace(replace(text, 'e', '\\,'), 'a', '\\=')"


def escaped_texts(spark, sf_dir):
    text = F.replace(F.replace("text", F.lit("e"), F.lit("\\,")), F.lit("a"), F.lit("\\="))
    return read(spark, sf_dir, "documents").select("doc_id", text.alias("s"), "text")


def _digest(c):
    return F.md5(c).alias("out")


@query(f"SELECT doc_id, md5(replace(replace(replace({_BACK}, '\\,', ','), '\\ ', ' '), '\\=', '=')) AS out FROM documents")
def unescape_tag(spark, sf_dir):
    return escaped_texts(spark, sf_dir).select("doc_id", _digest(keys.unescape_tag(F.col("s"))))


@query(f"SELECT doc_id, md5(replace(replace({_BACK}, '\\,', ','), '\\ ', ' ')) AS out FROM documents")
def unescape_measurement(spark, sf_dir):
    return escaped_texts(spark, sf_dir).select("doc_id", _digest(keys.unescape_measurement(F.col("s"))))


@query("SELECT doc_id, md5(replace(replace(text, ',', '\\,'), ' ', '\\ ')) AS out FROM documents")
def escape_measurement(spark, sf_dir):
    return escaped_texts(spark, sf_dir).select("doc_id", _digest(lineproto.escape_measurement(F.col("text"))))


@query("SELECT doc_id, md5(replace(replace(replace(text, ',', '\\,'), ' ', '\\ '), '=', '\\=')) AS out FROM documents")
def escape_tag(spark, sf_dir):
    return escaped_texts(spark, sf_dir).select("doc_id", _digest(lineproto.escape_tag(F.col("text"))))


@query(f"SELECT doc_id, md5(replace(replace({_BACK}, '\\', '\\\\'), '\"', '\\\"')) AS out FROM documents")
def escape_string_field(spark, sf_dir):
    return escaped_texts(spark, sf_dir).select("doc_id", _digest(lineproto.escape_string(F.col("s"))))


def _one(vtype: int, column: str, value):
    return F.struct(F.lit(vtype).alias("vtype"), *(value.alias(c) if c == column else F.lit(None).cast(RAW[c].dataType).alias(c) for c in PAYLOAD_COLUMNS if c != "vtype"))


@query("SELECT l_orderkey, l_linenumber, l_partkey || 'i' AS i, l_suppkey || 'u' AS u FROM lineitem")
def lp_encode_int(spark, sf_dir):
    from ..model import UNSIGNED

    none = F.lit("")
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        lineproto.format_value(_one(INTEGER, "v_int", F.col("l_partkey")), none).alias("i"),
        lineproto.format_value(_one(UNSIGNED, "v_uint", F.col("l_suppkey").cast("decimal(20,0)")), none).alias("u"),
    )


@query("SELECT l_orderkey, l_linenumber, " + _FLOAT.format("l_extendedprice") + " AS price, " + _FLOAT.format("l_quantity") + " AS quantity, " + _FLOAT.format("l_discount") + " AS discount FROM lineitem")
def lp_encode_float(spark, sf_dir):
    """Zero has no decimals either; all are below a million and have two decimals at the most."""
    text = lambda c: lineproto.format_short_decimal(F.col(c))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text("l_extendedprice").alias("price"), text("l_quantity").alias("quantity"), text("l_discount").alias("discount"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS out FROM orders")
def lp_encode_bool(spark, sf_dir):
    from ..model import BOOLEAN

    return read(spark, sf_dir, "orders").select("o_orderkey", lineproto.format_value(_one(BOOLEAN, "v_bool", F.col("o_orderstatus") == "F"), F.lit("")).alias("out"))


@query(f"SELECT doc_id, md5('\"' || replace(replace({_BACK}, '\\', '\\\\'), '\"', '\\\"') || '\"') AS out FROM documents")
def lp_encode_string(spark, sf_dir):
    from ..model import STRING

    return escaped_texts(spark, sf_dir).select("doc_id", _digest(lineproto.format_value(_one(STRING, "v_str", F.col("s")), F.lit(""))))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, 'line,flag=' || l_returnflag || ',supp=' || l_suppkey || ' discount=' || "
    + _FLOAT.format("l_discount") + " || ',price=' || " + _FLOAT.format("l_extendedprice") + " || ',qty=' || " + _FLOAT.format("l_quantity")
    + " || ' ' || (epoch_us(l_shipdate) * 1000) || chr(10) AS lp FROM lineitem"
)
def lp_encode_point(spark, sf_dir):
    item = read(spark, sf_dir, "lineitem")
    names = {"discount": "l_discount", "price": "l_extendedprice", "qty": "l_quantity"}
    fields = F.array(*(F.struct(F.lit(n).alias("name"), lineproto.format_short_decimal(F.col(c)).alias("text")) for n, c in names.items()))
    tags = F.array(F.struct(F.lit("flag").alias("k"), F.col("l_returnflag").alias("v")), F.struct(F.lit("supp").alias("k"), F.col("l_suppkey").cast("string").alias("v")))
    return item.select("l_orderkey", "l_linenumber", "l_partkey", lineproto.encode(F.lit("line"), tags, fields, micros("l_shipdate") * 1000).alias("lp"))


@query(_POINTS + " SELECT series_key, series_key || ' ' || fields || ' ' || (ts_ns - 2000000000000000000) || chr(10) AS lp FROM l")
def lp_negative_ts(spark, sf_dir):
    early = values(spark, sf_dir).withColumn("ts_ns", F.col("ts_ns") - 2_000_000_000_000_000_000)
    early = early.withColumn("shard_id", F.lit("0"))
    return rejoin.lines(rejoin.points(early)).select("series_key", "lp")


def _fieldless(spark, sf_dir):
    """Every fifth event's keys lose their separator."""
    return values(spark, sf_dir).withColumn("raw_key", F.when(F.col("ord") % 5 == 0, F.replace("raw_key", F.lit("#!~#"), F.lit("_"))).otherwise(F.col("raw_key")))


_KEYS = (
    _E
    + """, o AS (SELECT DISTINCT database, shard_id, src, file_seq, CASE WHEN src = 1 THEN 0 END AS entry, series_key, field, ord % 5 = 0 AS lost FROM v),
q AS (SELECT database, shard_id, count(*) FILTER (src = 0 AND NOT lost) AS keys, count(*) FILTER (src = 1 AND NOT lost) AS wal_keys, count(*) FILTER (lost) AS skipped FROM o GROUP BY ALL)"""
)


@query(_KEYS + " SELECT database, CAST(sum(keys) AS BIGINT) AS keys, CAST(sum(wal_keys) AS BIGINT) AS wal_keys, CAST(sum(skipped) AS BIGINT) AS skipped FROM q GROUP BY database")
def skip_fieldless_keys(spark, sf_dir):
    return report.database_keys(report.key_stats(_fieldless(spark, sf_dir)))


_STATS = _POINTS + ", s AS (SELECT database, shard_id, count(*) AS points, CAST(sum(n_fields) AS BIGINT) AS fields, min(ts_ns) AS min_ts, max(ts_ns) AS max_ts FROM p GROUP BY ALL)"


@query(_STATS + " SELECT * FROM s")
def shard_stats(spark, sf_dir):
    return report.shard_stats(points(spark, sf_dir)).select("database", "shard_id", "points", "fields", "min_ts", "max_ts")


@query(_STATS + " SELECT database, count(*) AS shards, CAST(sum(points) AS BIGINT) AS points, CAST(sum(fields) AS BIGINT) AS fields, min(min_ts) AS min_ts, max(max_ts) AS max_ts FROM s GROUP BY database")
def database_stats(spark, sf_dir):
    return report.database_stats(report.shard_stats(points(spark, sf_dir)))


@query(_STATS + " SELECT CAST(sum(points) AS BIGINT) AS points, CAST(sum(fields) AS BIGINT) AS fields, count(DISTINCT database) AS databases FROM s")
def grand_total(spark, sf_dir):
    return report.grand_total(report.shard_stats(points(spark, sf_dir)))


@query(_KEYS + " SELECT * FROM q")
def key_count(spark, sf_dir):
    return report.key_stats(_fieldless(spark, sf_dir)).select("database", "shard_id", "keys", "wal_keys", "skipped")


@query(_E + " SELECT DISTINCT database, series_key FROM v")
def distinct_series(spark, sf_dir):
    return report.distinct_series(rejoin.parsed(values(spark, sf_dir)))


@query(_POINTS + " SELECT database, nth, lp FROM (SELECT *, row_number() OVER (PARTITION BY database ORDER BY shard_id, series_key, ts_ns) AS nth FROM l) WHERE nth <= 5")
def sample_first_n(spark, sf_dir):
    return rejoin.lines(report.samples(points(spark, sf_dir))).select("database", F.col("nth").cast("bigint").alias("nth"), "lp")


@query("SELECT CASE event_type WHEN 'click' THEN 'clicks' WHEN 'error' THEN 'faults' ELSE event_type END AS target, count(*) AS n FROM events GROUP BY 1")
def db_rename(spark, sf_dir):
    return events(spark, sf_dir).groupBy(resume.renamed(F.col("event_type"), {"click": "clicks", "error": "faults"}).alias("target")).agg(F.count("*").alias("n"))


def _supplier_shards(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    return s.select(F.col("s_nationkey").cast("string").alias("database"), F.col("s_suppkey").cast("string").alias("shard_id"))


def _buckets(spark, sf_dir):
    return read(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), F.when(F.col("n_regionkey") == 0, 1).otherwise(0).alias("type"))


_BUCKETS = "WITH b AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END AS type FROM nation WHERE n_nationkey < 20), s AS (SELECT CAST(s_nationkey AS VARCHAR) AS database, CAST(s_suppkey AS VARCHAR) AS shard_id FROM supplier)"


@query(_BUCKETS + " SELECT coalesce(b.name, s.database) AS database, s.shard_id FROM s LEFT JOIN b ON b.id = s.database")
def bucket_resolve(spark, sf_dir):
    return resume.with_bucket_names(_supplier_shards(spark, sf_dir), _buckets(spark, sf_dir), keep_system=True)


@query(_BUCKETS + " SELECT coalesce(b.name, s.database) AS database, s.shard_id FROM s LEFT JOIN b ON b.id = s.database WHERE coalesce(b.type, 0) = 0")
def drop_system_buckets(spark, sf_dir):
    return resume.with_bucket_names(_supplier_shards(spark, sf_dir), _buckets(spark, sf_dir))


@query("SELECT database, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN '_internal' ELSE event_type END AS database FROM events) WHERE database <> '_internal' GROUP BY database")
def drop_internal(spark, sf_dir):
    shards = events(spark, sf_dir).select(F.when(F.col("event_type") == "error", "_internal").otherwise(F.col("event_type")).alias("database"))
    return resume.wanted(shards).groupBy("database").agg(F.count("*").alias("n"))


@query("SELECT event_type AS database, count(*) AS n FROM events WHERE event_type IN ('click', 'error') GROUP BY 1")
def database_filter(spark, sf_dir):
    return resume.wanted(events(spark, sf_dir).select(F.col("event_type").alias("database")), ["click", "error"]).groupBy("database").agg(F.count("*").alias("n"))


def _acks(spark, sf_dir):
    """An order is a chunk of its customer's shard; those of status F are acknowledged."""
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return o.select(F.lit("orders").alias("source_id"), F.col("o_custkey").cast("string").alias("shard_id"), F.col("o_orderkey").alias("seq"), F.lit(10).cast("bigint").alias("rows"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS shard_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)")
def skip_done_shards(spark, sf_dir):
    shards = read(spark, sf_dir, "customer").select(F.lit("orders").alias("source_id"), F.col("c_custkey").cast("string").alias("shard_id"))
    return resume.without_done(shards, _acks(spark, sf_dir)).select("shard_id")


@query("WITH c AS (SELECT o_custkey, max(o_orderkey) AS m FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT CAST(o.o_custkey AS VARCHAR) AS shard_id, o.o_orderkey AS seq FROM orders o LEFT JOIN c USING (o_custkey) WHERE o.o_orderkey > coalesce(c.m, -1)")
def resume_chunks(spark, sf_dir):
    chunks = read(spark, sf_dir, "orders").select(F.lit("orders").alias("source_id"), F.col("o_custkey").cast("string").alias("shard_id"), F.col("o_orderkey").alias("seq"))
    return resume.to_send(chunks, resume.upserted(_acks(spark, sf_dir))).select("shard_id", "seq")


@query("SELECT CAST(o_custkey AS VARCHAR) AS shard_id, max(o_orderkey) AS committed, count(*) * 10 AS rows FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def ledger_upsert(spark, sf_dir):
    return resume.upserted(_acks(spark, sf_dir)).select("shard_id", "committed", "rows")


@query("SELECT count(DISTINCT o_custkey) AS started, (SELECT count(*) FROM customer WHERE c_custkey % 3 = 0) AS done, count(*) * 10 AS rows FROM orders WHERE o_orderstatus = 'F'")
def ledger_summary(spark, sf_dir):
    done = read(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.lit("orders").alias("source_id"), F.col("c_custkey").cast("string").alias("shard_id"))
    return resume.summary(_acks(spark, sf_dir), done)


CHUNK = 4000


@query(
    "WITH RECURSIVE"
    + _POINTS.removeprefix("WITH")
    + f""",
z AS (SELECT database, shard_id, row_number() OVER w AS i, strlen(lp) AS n, sum(strlen(lp)) OVER (w ROWS UNBOUNDED PRECEDING) AS upto, count(*) OVER (PARTITION BY database, shard_id) AS many FROM l WINDOW w AS (PARTITION BY database, shard_id ORDER BY series_key, ts_ns)),
c AS (SELECT database, shard_id, 0 AS seq, CAST(1 AS BIGINT) AS first, CAST(0 AS HUGEINT) AS base FROM z WHERE i = 1
  UNION ALL SELECT c.database, c.shard_id, c.seq + 1, z.i, CAST(z.upto - z.n AS HUGEINT) FROM c JOIN LATERAL (SELECT min_by(struct_pack(i, upto, n), i) AS z FROM z WHERE z.database = c.database AND z.shard_id = c.shard_id AND z.i > c.first AND z.upto - c.base > {CHUNK}) t ON true WHERE t.z IS NOT NULL)
SELECT z.database, z.shard_id, c.seq, count(*) AS nlines, CAST(sum(z.n) AS BIGINT) AS nbytes FROM z JOIN (SELECT *, lead(first) OVER (PARTITION BY database, shard_id ORDER BY seq) AS stop FROM c) c ON c.database = z.database AND c.shard_id = z.shard_id AND z.i >= c.first AND (c.stop IS NULL OR z.i < c.stop) GROUP BY ALL"""
)
def chunk_greedy(spark, sf_dir):
    found = chunking.chunk_sizes(chunking.numbers(lines(spark, sf_dir), CHUNK))
    return found.select("database", "shard_id", "seq", "nlines", "nbytes")


@query(_E + " SELECT database, shard_id, row_number() OVER (ORDER BY database, shard_id) AS place FROM (SELECT DISTINCT database, shard_id FROM v)")
def shard_order(spark, sf_dir):
    """Numbers compare as strings here; a list of shards is small."""
    from pyspark.sql import Window

    found = values(spark, sf_dir).select(*SHARD_KEY).distinct()
    return found.select("database", "shard_id", F.row_number().over(Window.orderBy("database", "retention", "shard_id")).cast("bigint").alias("place"))


@query("WITH t AS (SELECT event_id, (epoch_us(ts) - 1705000000000000) * 1000 + event_id % 1000 AS ns FROM events) SELECT event_id, ns, (ns - ((ns % 1000) + 1000) % 1000) // 1000 AS us FROM t")
def ns_floor_to_us(spark, sf_dir):
    t = events(spark, sf_dir).select("event_id", ((F.col("us") - 1_705_000_000_000_000) * 1000 + F.col("event_id") % 1000).alias("ns"))
    return t.select("event_id", "ns", floor_micros(F.col("ns")).alias("us"))


@query("SELECT event_type || ',user=' || user_id AS series_key, date_trunc('hour', ts) AS start, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark, sf_dir):
    from ..streaming.tail import windowed_counts as counts

    timed = values(spark, sf_dir).where("vtype = 0").drop("ts_ns")
    us = events(spark, sf_dir).select("event_id", (F.col("us") * 1000 + F.col("event_id") % 1000).alias("ts_ns"))
    found = counts(timed.join(us, timed["ord"] == us["event_id"]))
    return found.select("series_key", F.col("start").cast("timestamp_ntz").alias("start"), "n")
