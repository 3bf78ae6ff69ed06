"""The tables that stages exchange."""

from __future__ import annotations

from pyspark.sql import types as T

#: Value types, as in the column files; log files number them differently (see sources.wal).
FLOAT, INTEGER, BOOLEAN, STRING, UNSIGNED = 0, 1, 2, 3, 4
#: Where a value comes from; a later source wins.
TSM, WAL = 0, 1
#: Fixed value of the formats: stands between a series and a field.
FIELD_SEPARATOR = "#!~#"


def _fields(**kinds: T.DataType) -> list[T.StructField]:
    return [T.StructField(k, v) for k, v in kinds.items()]


_STRING, _LONG = T.StringType(), T.LongType()
SHARD = T.StructType(_fields(source_id=_STRING, database=_STRING, retention=_STRING, shard_id=_STRING))
PAYLOAD = T.StructType(_fields(vtype=T.ByteType(), v_float=T.DoubleType(), v_int=_LONG, v_uint=T.DecimalType(20, 0), v_bool=T.BooleanType(), v_str=_STRING))
ORDER = T.StructType(_fields(src=T.ByteType(), file_seq=T.IntegerType(), entry_seq=_LONG, ord=_LONG))
RAW = T.StructType([*SHARD, *ORDER, *_fields(raw_key=_STRING, ts_ns=_LONG), *PAYLOAD])
#: Identity of a shard, whatever its database is called now.
SHARD_KEY = ["source_id", "database", "retention", "shard_id"]
PAYLOAD_COLUMNS = [f.name for f in PAYLOAD]
ORDER_COLUMNS = [f.name for f in ORDER]
