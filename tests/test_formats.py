"""Files of many rows: the writer for whole tables against the plain one, and queries on tables made here."""

import datetime
import io
import json

import encoder as E
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pointstream.functions import keys, lineproto
from pointstream.model import RAW
from pointstream.operators import rejoin
from pointstream.plans import formats
from pointstream.sources import bulk, tsm, values

HOSTILE = [
    [5],
    [0, 0, 0, 0],
    list(range(0, 7000, 7)),
    [1] * 130 + [7, 9, 2**40],
    [k * 1000 for k in (1, 2, 4, 8, 2**50)],
    [2**63 - 1, -(2**63), 0, 3],
    np.cumsum([1] * 500 + [3] * 41 + [2**33]).tolist(),
    [-k for k in range(120)],
]


def blocks(rows):
    sizes = np.asarray([len(r) for r in rows])
    return np.cumsum(sizes) - sizes, sizes


@pytest.mark.parametrize("name", ["timestamps", "integers", "floats", "booleans", "strings"])
def test_bulk_writes_the_plain_bytes(name):
    rows = {
        "floats": [[0.0], [1.5, 1.5, -0.0, 0.1], [float(x) for x in HOSTILE[3]], [1e300, -1e-300, float("inf"), 98.5, 97.2] * 9],
        "booleans": [[True], [False] * 9, [True, False, True] * 40],
        "strings": [[b""], [b"a", b"x" * 300], [b"same"] * 50],
    }.get(name, HOSTILE)
    flat = [v for r in rows for v in r]
    got = getattr(bulk, name)(flat if name == "strings" else np.asarray(flat), *blocks(rows))
    assert got == [getattr(E, name)(r) for r in rows]


def test_bulk_file():
    times = np.asarray([10, 20, 20, 5, 7, 100])
    fields = [("a", 0, np.arange(6) / 3), ("b", 4, np.arange(6).astype(np.uint64) + np.uint64(2**63))]
    plain = {f"m,t={s}#!~#{n}": (k, list(zip(times[a:b].tolist(), v[a:b].tolist()))) for s, a, b in (("1", 0, 3), ("2", 3, 6)) for n, k, v in fields}
    assert bulk.tsm(["m,t=1#!~#", "m,t=2#!~#"], np.asarray([3, 3]), times, fields, 2) == E.tsm(plain, 2)


def test_times_of_a_series_are_read_once(monkeypatch):
    calls, own = [], tsm.timestamps
    monkeypatch.setattr(tsm, "timestamps", lambda data: calls.append(1) or own(data))
    raw = E.tsm({f"m#!~#f{k}": (1, [(3, k), (9, k + 1), (11, k)]) for k in range(5)})
    found = list(tsm.read(raw, -(2**63), 2**63 - 1))
    assert [t.tolist() for _, _, _, t, _ in found] == [[3, 9, 11]] * 5 and len(calls) == 1


def events_table(folder, rows):
    """rows: (event_id, microseconds, user_id, event_type, value, k)."""
    at = datetime.datetime(2024, 1, 1)
    pq.write_table(
        pa.table(
            {
                "event_id": pa.array([r[0] for r in rows], pa.int64()),
                "ts": pa.array([at + datetime.timedelta(microseconds=r[1]) for r in rows], pa.timestamp("us")),
                "user_id": pa.array([r[2] for r in rows], pa.int64()),
                "event_type": [r[3] for r in rows],
                "value": pa.array([r[4] for r in rows], pa.float64()),
                "props": [json.dumps({"k": r[5]}) for r in rows],
            }
        ),
        f"{folder}/events.parquet",
    )
    return str(folder)


def same_as_sql(spark, folder, name, table="events"):
    import duckdb

    from pointstream.plans import relational

    db = duckdb.connect()
    db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = db.execute(relational.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in relational.QUERIES[name](spark, folder).select(*columns).collect())


def test_small_ranges_share_tasks(spark, tmp_path, monkeypatch):
    """Files grow in number with the table; ranges of a few bytes aren't a task each."""
    monkeypatch.setattr(formats, "FILE_EVENTS", 100)
    folder = events_table(tmp_path, [(k, k * 1000, k % 50, "click", k / 4, k) for k in range(1000)])
    shards = formats.column_files(spark, folder)
    assert len(shards) == 1 and 5 < len(shards[0].tsm_files) <= 11
    found = values.read_values(spark, shards, split=64)
    assert found.count() == 5000 and found.rdd.getNumPartitions() == len(shards[0].tsm_files)
    same_as_sql(spark, folder, "tsm_values")


def test_groups_of_many_columns(spark, tmp_path, monkeypatch):
    """A group is no single column and no single task; numbers go on from one column to the next."""
    monkeypatch.setattr(formats, "COLUMN_VALUES", 100)
    n = 1234
    pq.write_table(pa.table({"o_orderkey": pa.array(range(n), pa.int64()), "o_orderstatus": ["OFP"[k % 3 if k > 600 else 0] for k in range(n)]}), f"{tmp_path}/orders.parquet")
    same_as_sql(spark, str(tmp_path), "zigzag_roundtrip", "orders")
    rows = spark.range(1000).selectExpr("'a' grp", "id", "id * 3 v")
    made = formats._encoded(rows, bulk.integers).collect()
    assert len(made) >= 10 and sorted(r["first"] for r in made)[0] == 0 and max(r["first"] for r in made) < 1000


def crowded(folder):
    """Several users and files, and events of one user at the same time."""
    return events_table(folder, [(k + 1000 * c, k // 3 * 86_400_000_000 // 7, k % 30, ("click", "view")[k % 2], k / 4, k % 9) for c in range(3) for k in range(400)])


@pytest.mark.parametrize("name", ["tsm_values", "tsm_key_range", "tsm_time_range"])
def test_shards_of_many_files(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(formats, "FILE_EVENTS", 100)
    same_as_sql(spark, crowded(tmp_path), name)


@pytest.mark.parametrize("name", ["tsm_wal_lines", "dry_run", "lines_as_text", "deliver_lines", "deliver_resumed"])
def test_crowded_points(spark, tmp_path, monkeypatch, name):
    """Many events at one point: the last one counts, and a log has later writes of that one only."""
    monkeypatch.setattr(formats, "FILE_EVENTS", 100)
    same_as_sql(spark, crowded(tmp_path), name)


@pytest.mark.parametrize("begin", [1704326400, 1705536000, 0, -1209600])
def test_shards_begin_at_rounded_seconds(spark, tmp_path, begin):
    """dry_run: an event of a fortnight's last half second counts to the next one, as does its key."""
    begin = (begin - 1704067200) * 1_000_000
    apart = [-1_000_000, -500_001, -500_000, -499_999, -1, 0, 499_999, 500_000, 500_001]
    rows = [(us, user, kind) for user, d in enumerate(apart) for us, kind in ((begin + d, "every"), (begin + 86_400_000_000, "every"), (begin + d, f"own{user}"), (begin + 86_400_000_000, f"own{user}"), (begin - 86_400_000_000, f"two{user}"), (begin + d, f"two{user}"))]
    same_as_sql(spark, events_table(tmp_path, [(k, us, user, kind, k / 4, k % 9) for k, (us, user, kind) in enumerate(rows)]), "dry_run")


def test_cuts_a_step_for_each_chunk():
    from pointstream.operators import chunking

    rng = np.random.default_rng(1)
    for limit in (1, 5, 25, 100):
        for _ in range(100):
            sizes, cutter = rng.choice([0, 1, 3, 10, 25, 26, 200], 60), chunking.Cutter(limit)
            assert [*cutter.add_all(sizes[:23]), *cutter.add_all(sizes[23:])] == chunking.cut(sizes.tolist(), limit)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_sort_for_writes_and_points(spark):
    """tsm_wal_lines: the latest writes and the points need one sort, which compares times first."""
    plan = _plan(rejoin.points(spark.createDataFrame([], RAW)))
    assert "Aggregate" not in plan and plan.count("Sort [") == 1 and "Sort [ts_ns" in plan


def test_lines_are_written_before_pythons_step(spark):
    """lines_as_text: only floats that aren't short decimals wait for Python, and no point's fields do."""
    above, _, below = _plan(rejoin.lines(rejoin.points(spark.createDataFrame([], RAW)))).partition("ArrowEvalPython")
    assert "array_join" in below.partition("Window")[0]


def test_heads_like_those_of_their_parts(spark):
    """lines_as_text: a plain key stays as it is; others are taken apart."""
    keys_ = ["m", "m,a=b", "m,a=b,c=d", "", "m,", "m,a", "m,a=b=c", "m,=", "m,a=", "m x,a=b", "m\\,x,a=b", "m,a=b\\ c", "m,a\\=b=c", "m=n,a=b", "m,a=b\n", "m\n,a=b", "é,ü=ö", "m,a=b,,c=d", "m,a=b\\"]
    rows = spark.createDataFrame([(k,) for k in keys_], "k string")
    apart = lineproto.head(keys.measurement(F.col("k")), keys.tags(F.col("k")))
    for r in rows.select("k", lineproto.head_of(F.col("k")).alias("got"), apart.alias("want")).collect():
        assert r["got"] == r["want"], r["k"]


def test_a_small_files_index_is_gone_through_once():
    """tsm_key_range: cutting a file smaller than a part reads nothing of its index."""
    data = bulk.tsm(["m,a=1#!~#", "m,a=2#!~#"], np.asarray([3, 2]), np.arange(5), [("v", 1, np.arange(5))])

    class Counted(io.BytesIO):
        many = 0

        def read(self, n=-1):
            found = super().read(n)
            self.many += len(found)
            return found

    f = Counted(data)
    (part,) = tsm.parts(f, 0, 9)
    assert f.many == 13
    assert [(k, v.tolist()) for k, _, _, _, v in tsm.read(f, 0, 9, part=part[:2])] == [(k, v.tolist()) for k, _, _, _, v in tsm.read(data, 0, 9)]
    assert list(tsm.parts(io.BytesIO(data), 0, 9, split=1)) == list(tsm.ranges(io.BytesIO(data), 0, 9, split=1))
