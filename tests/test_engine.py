"""From files to lines, chunks and deliveries."""

import email
import gzip
import http.server
import json
import random
import threading

import pytest

import encoder as E
from pointstream import cli
from pointstream.functions import keys, lineproto, units
from pointstream.operators import chunking, rejoin, report, resume
from pointstream.plans import load as L
from pointstream.sinks.files import conflicts, wide, write_lines
from pointstream.sinks.http import Exhausted, Rejected, Sink
from pointstream.sinks.ledger import ACKS, ENDS, Changed, Ledger, Writer
from pointstream.sources import catalog
from pointstream.sources.values import read_values

SEP = "#!~#"


def tree(top, files):
    for name, data in files.items():
        p = top / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    return str(top)


def extracted(spark, tmp_path, tsm=(), wal=(), start=units.LOWEST, end=units.HIGHEST):
    """Lines of one shard."""
    for k, c in enumerate(tsm):
        tree(tmp_path / "data", {f"db/rp/1/{k:03d}.tsm": E.tsm(c)})
    for k, e in enumerate(wal):
        tree(tmp_path / "wal", {f"db/rp/1/_{k:05d}.wal": E.wal(*map(E.wal_entry, e))})
    shards = catalog.shards(str(tmp_path / "data"), str(tmp_path / "wal"))
    lines = rejoin.lines(rejoin.points(read_values(spark, shards, start, end), start, end))
    return [r["lp"][:-1] for r in lines.orderBy("series_key", "ts_ns").collect()]


def test_fields_of_every_kind_meet_in_one_line(spark, tmp_path):
    """Fields in order of their names, each with its type's mark; a point has only the fields that were written at its time."""
    boiler = "boiler\\ 7,hall=north,unit=b\\,2"
    got = extracted(spark, tmp_path, [{
        f"{boiler}{SEP}zeta": (4, [(40, 2**63), (60, 0)]), f"{boiler}{SEP}alarm": (2, [(40, False), (50, True)]),
        f"{boiler}{SEP}level": (0, [(40, -0.125), (50, 1 / 3)]), f"{boiler}{SEP}note": (3, [(50, b"back\\slash \"q\""), (60, "h\u00e9".encode())]),
        f"{boiler}{SEP}ticks": (1, [(50, -(2**63)), (60, 12)]), "no separator here": (1, [(40, 1)]),
    }, {f"quiet{SEP}a=b c": (1, [(-(10**18), 5)])}])
    assert got == [
        "boiler\\ 7,hall=north,unit=b\\,2 alarm=false,level=-0.125,zeta=9223372036854775808u 40",
        'boiler\\ 7,hall=north,unit=b\\,2 alarm=true,level=0.3333333333333333,note="back\\\\slash \\"q\\"",ticks=-9223372036854775808i 50',
        'boiler\\ 7,hall=north,unit=b\\,2 note="h\u00e9",ticks=12i,zeta=0u 60',
        "quiet a\\=b\\ c=5i -1000000000000000000",
    ]


def test_parts_of_files_and_ranges_of_keys(spark, tmp_path):
    """A file in many parts has the rows that it has in one, in the same order; a range of keys leaves out the rest."""
    columns = {f"m,s={k:02d}{SEP}v": (1, [(t, t * k) for t in range(300)]) for k in range(40)}
    tree(tmp_path / "d", {"db/rp/1/1.tsm": E.tsm(columns, block=50)})
    found = catalog.shards(str(tmp_path / "d"))
    rows = lambda **how: sorted((r["raw_key"], r["ts_ns"], r["v_int"], r["ord"]) for r in read_values(spark, found, **how).collect())
    whole = rows()
    assert len(whole) == 12_000 and whole == rows(split=500)
    low, high = f"m,s=07{SEP}v", f"m,s=11{SEP}v"
    assert rows(keys=(low, high), split=500) == [r for r in whole if low <= r[0] <= high]
    assert rows(start=100, end=149, split=200) == [r for r in whole if 100 <= r[1] <= 149]


def test_large_files_need_little_memory(tmp_path):
    """The index and the blocks of a file of 1 GB (most of it a gap that no index entry names) are read piece by piece."""
    import subprocess
    import sys

    small = E.tsm({f"m,s={k:04d}{SEP}v": (1, [(t, t) for t in range(200)]) for k in range(2000)})
    (at,) = __import__("struct").unpack(">Q", small[-8:])
    with open(tmp_path / "1.tsm", "wb") as f:
        f.write(small[:at])
        f.seek(at + (1 << 30))
        f.write(small[at:-8] + (at + (1 << 30)).to_bytes(8, "big"))
    code = (
        "import resource, sys\nfrom pointstream.sources import tsm\nstart = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "f = open(sys.argv[1], 'rb')\nparts = list(tsm.ranges(f, 0, 10**6, None, 20_000))\n"
        "n = sum(len(t) for p in parts for *_, t, v in tsm.read(f, 0, 10**6, part=p[:2]))\n"
        "print(n, len(parts), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start) // 1024)"
    )
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path / "1.tsm")], capture_output=True, text=True, check=True, env={**__import__("os").environ, "PYTHONPATH": __import__("os").getcwd()}).stdout
    n, parts, more = map(int, out.split()[-3:])
    assert n == 400_000 and parts > 2 and more < 50


def test_last_write_wins(spark, tmp_path):
    k = f"m,t=x{SEP}v"
    got = extracted(spark, tmp_path, [{k: (0, [(1000, 1.0), (4000, 4.0)])}, {k: (0, [(1000, 9.0), (2000, 2.0)])}], [[[(k, 1, [(2000, 999.0)])], [(k, 1, [(3000, 1.0), (3000, 99.0)]), (k, 1, [(500, 0.5)])]]])
    assert got == ["m,t=x v=0.5 500", "m,t=x v=9 1000", "m,t=x v=999 2000", "m,t=x v=99 3000", "m,t=x v=4 4000"]


def test_order_and_range(spark, tmp_path):
    a, b = f"m{SEP}a", f"m{SEP}b"
    entry = [[[(a, 2, [(1000, 1), (2000, 2)]), (b, 2, [(2000, 4), (1000, 3)])], [(a, 2, [(9000, 9)])]]]
    assert extracted(spark, tmp_path, (), entry, end=5000) == ["m a=1i,b=3i 1000", "m a=2i,b=4i 2000"]
    assert extracted(spark, tmp_path, (), entry, start=2000, end=9000) == ["m a=2i,b=4i 2000", "m a=9i 9000"]
    assert extracted(spark, tmp_path, (), entry, start=9001) == []


def test_type_conflict_keeps_types(spark, tmp_path):
    k = f"m{SEP}v"
    tree(tmp_path / "d", {"db/rp/1/1.tsm": E.tsm({k: (0, [(1, 1.5), (2, 2.5)])}), "db/rp/1/2.tsm": E.tsm({k: (1, [(2, 7)])})})
    points = rejoin.points(read_values(spark, catalog.shards(str(tmp_path / "d"))))
    assert [tuple(r) for r in conflicts(points).collect()] == [("db", "m", "v", [0, 1])]
    assert sorted(tuple(r)[-1:] for r in wide(points, {"v": 0}).collect() if r["v"] is not None) == [(1.5,)]
    write_lines(rejoin.lines(points), str(tmp_path / "out"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["m v=1.5 1", "m v=7i 2"]


def split_by_hand(s, sep):
    out, at = [""], 0
    while at < len(s):
        if s[at] == "\\" and at + 1 < len(s):
            out[-1] += s[at : at + 2]
            at += 2
        elif s[at] == sep:
            out.append("")
            at += 1
        else:
            out[-1] += s[at]
            at += 1
    return out


def test_split_like_a_scanner(spark):
    r = random.Random(3)
    some = ["".join(r.choice("ab,=\\ \n") for _ in range(r.randint(0, 12))) for _ in range(3000)] + ["", ",", "\\", "a\\\\\\"]
    df = spark.createDataFrame([(s,) for s in some], "s string")
    for row in df.select("s", keys.split_unescaped(df["s"], ",").alias("x"), keys.split_unescaped(df["s"], "=").alias("y")).collect():
        assert row["x"] == split_by_hand(row["s"], ",") and row["y"] == split_by_hand(row["s"], "=")


def test_keys(spark):
    raw = ["a\\,b\\ c,k\\=1=v\\,2,bad,x=C:\\Users" + SEP + "f" + SEP + "g", "cpu,host=a"]
    df = spark.createDataFrame([(s,) for s in raw], "s string")
    one, none = df.select(keys.series_key(df["s"]).alias("series"), keys.field_name(df["s"]).alias("field")).collect()
    assert one["field"] == f"f{SEP}g" and none["series"] is None and none["field"] is None
    s = keys.series_key(df["s"])
    row = df.select(keys.measurement(s).alias("m"), keys.tags(s).alias("t")).first()
    assert row["m"] == "a,b c" and [tuple(t) for t in row["t"]] == [("k=1", "v,2"), ("bad", ""), ("x", "C:\\Users")]


@pytest.mark.parametrize("value,text", [(51.0, "51"), (1013.25, "1013.25"), (0.0, "0"), (-0.0, "-0"), (1e6, "1e+06"), (123456.0, "123456"), (1234567.0, "1.234567e+06"), (0.0001, "0.0001"), (0.00001, "1e-05"), (1e21, "1e+21"), (5e-324, "5e-324"), (1.7976931348623157e308, "1.7976931348623157e+308"), (-98.5, "-98.5"), (100000.5, "100000.5"), (float("inf"), "+Inf"), (float("-inf"), "-Inf"), (float("nan"), "NaN")])
def test_floats_as_text(value, text):
    assert lineproto.shortest(value) == text


def test_native_floats_agree(spark):
    r = random.Random(1)
    v = [round(r.uniform(-1e5, 1e5), r.randint(0, 4)) for _ in range(500)] + [0.0, 1e-4, 999999.0]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    assert all(t == lineproto.shortest(x) for x, t in df.select("v", lineproto.format_short_decimal(df["v"])).collect())
    assert all(t == lineproto.shortest(x) for x, t in df.select("v", lineproto.format_float("v")).collect())


def test_units():
    for text, n in (("450MB", 450 << 20), ("200mb", 200 << 20), ("1G", 1 << 30), ("1024B", 1024), (" 450MB ", 450 << 20), ("7", 7), ("3KiB", 3072)):
        assert units.parse_byte_size(text) == n
    for text in ("10XB", "-5MB", "1.5MB", "", "MB"):
        with pytest.raises(ValueError):
            units.parse_byte_size(text)
    assert units.parse_time("1959-12-16T00:00:00Z") == -317001600000000000 and units.parse_time("2024-01-01T00:00:00.000000001+01:00") == 1704063600000000001
    assert units.show_time(-317001600000000000) == "1959-12-16T00:00:00Z (-317001600000000000)"
    assert units.parse_rename(["a=b=c"]) == {"a": "b=c"}


def test_chunks(spark):
    assert chunking.cut([10] * 5, 25) == [0, 0, 1, 1, 2]
    assert chunking.cut([100, 6], 50) == [0, 1] and chunking.cut([], 5) == []
    rows = [("s", "d", "r", str(k % 3), f"k{k:04d}", k, 1 + k * 7 % 40) for k in range(600)]
    df = spark.createDataFrame(rows, "source_id string, database string, retention string, shard_id string, series_key string, ts_ns long, nbytes int")
    got = {r["series_key"]: r["seq"] for r in chunking.numbered(df, 100).collect()}
    for shard in "012":
        own = [r for r in rows if r[3] == shard]
        assert [got[r[4]] for r in own] == chunking.cut([r[-1] for r in own], 100)


def test_catalog(tmp_path):
    top = tmp_path / "v1" / "data"
    tree(top, {"db/rp/1/1.tsm": b"x", "_internal/m/9/1.tsm": b"x"})
    for name, data in {"db/rp/2/1.wal": b"x" * 50, "db/rp/3/1.wal": b"", "db/rp/10/1.wal": b"y"}.items():
        tree(tmp_path / "v1" / "wal", {name: data})
    (top / "db" / "_series").mkdir()
    found = catalog.shards(str(top), str(tmp_path / "v1" / "wal"))
    assert [s.shard_id for s in found] == ["1", "10", "2"]
    assert {s.database for s in catalog.shards(str(top), None, (), True)} == {"db", "_internal"}
    assert catalog.detect(str(tmp_path / "v1")) == (str(top), catalog.V1)
    tree(tmp_path / "v2" / "engine" / "data", {"00112233445566aa/autogen/1/1.tsm": b"x"})
    assert catalog.detect(str(tmp_path / "v2")) == (str(tmp_path / "v2" / "engine" / "data"), catalog.V2)
    (tmp_path / "none").mkdir()
    assert catalog.detect(str(tmp_path / "none")) == (str(tmp_path / "none"), catalog.UNKNOWN)


class Target:
    """An import endpoint in memory; ``answers`` are statuses to give first."""

    def __init__(self, answers=()):
        self.lines, self.calls, self.answers = [], 0, list(answers)
        lock = threading.Lock()

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):  # noqa: N802
                raw = self.rfile.read(int(self.headers["Content-Length"]))
                with lock:
                    target.calls += 1
                    status = target.answers.pop(0) if target.answers else 200
                    if status == 200:
                        part = email.message_from_bytes(b"Content-Type: " + self.headers["Content-Type"].encode() + b"\r\n\r\n" + raw).get_payload()[0]
                        text = gzip.decompress(part.get_payload(decode=True)).decode()
                        target.lines += [(self.headers["x-database"], x) for x in text.splitlines()]
                        target.token = self.headers["Authorization"]
                self.send_response(status)
                self.end_headers()
                self.wfile.write(json.dumps({"status": "ok", "result": {"rows_imported": 1}}).encode())

            def log_message(self, *_):
                pass

        target = self
        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/"


def test_sink():
    t = Target([503, 429, 200])
    assert Sink(t.url, "secret", sleep=lambda s: None).send("db", b"a v=1 1\n").rows_imported == 1
    assert t.calls == 3 and t.lines == [("db", "a v=1 1")] and t.token == "Bearer secret"
    with pytest.raises(Rejected):
        Sink(Target([400]).url, sleep=lambda s: None).send("db", b"x")
    bad = Target([500] * 9)
    with pytest.raises(Exhausted):
        Sink(bad.url, sleep=lambda s: None).send("db", b"x")
    assert bad.calls == 7


def test_sink_tries_again_after_answers_that_break_off():
    import socketserver

    class Broken(socketserver.StreamRequestHandler):
        tries = 0

        def handle(self):
            while self.rfile.readline().strip():
                pass
            Broken.tries += 1
            said = [b"HTTP/1.1 200 OK\r\nContent-Length: 99\r\n\r\n{", b"nonsense\r\n", b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\n{}"]
            self.wfile.write(said[min(Broken.tries, 3) - 1])

    server = socketserver.ThreadingTCPServer(("127.0.0.1", 0), Broken)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    assert Sink(f"http://127.0.0.1:{server.server_address[1]}", sleep=lambda s: None).send("db", b"x").rows_imported == 0
    assert Broken.tries == 3


def test_ledger(spark, tmp_path):
    ledger = Ledger(str(tmp_path / "ledger"))
    ledger.check({"chunk size": "1", "x": "2"})
    assert ledger.summary(spark) == (0, 0, 0)
    one, two = Writer(ledger.folder), Writer(ledger.folder)
    for w, seq in ((one, 0), (one, 1), (two, 1), (two, 4)):  # 1 twice, 2 and 3 missing
        w.add(ACKS, source_id="s", shard_id="7", seq=seq, rows=10, bytes=100)
    two.add(ENDS, source_id="s", shard_id="8", chunks=0)
    with open(next((tmp_path / "ledger" / ACKS).glob("*.json")), "a") as f:
        f.write('{"source_id": "s", "shard')  # a crash
    again = Ledger(str(tmp_path / "ledger"))
    again.check({"chunk size": "1", "x": "2"})
    with pytest.raises(Changed, match="chunk size$"):
        again.check({"chunk size": "2", "x": "2"})
    assert [r["committed"] for r in resume.committed(again.acks(spark)).collect()] == [1]
    shards = spark.createDataFrame([("s", "7"), ("s", "8")], "source_id string, shard_id string")
    assert [r["shard_id"] for r in resume.without_done(shards, again.ends(spark)).collect()] == ["7"]
    assert again.summary(spark) == (1, 1, 40)


def shard_tree(tmp_path, shards=4, series=12):
    return tree(tmp_path / "data", {f"db/rp/{s}/1.tsm": E.tsm({f"m,s={k:03d}{SEP}v": (1, [(t, t + k) for t in range(5)]) for k in range(series)}) for s in range(shards)})


def test_resume_after_a_crash(spark, tmp_path):
    found = catalog.shards(shard_tree(tmp_path))
    settings = L.Settings(chunk_bytes=256, workers=3, rename={"db": "target"})
    crash = Target([200] * 7 + [400] * 50)
    quiet = lambda line: None
    ledger = Ledger(str(tmp_path / "ledger"))
    with pytest.raises(Rejected):
        L.load(spark, found, Sink(crash.url), ledger, settings, str(tmp_path / "stage"), quiet)
    through, rows = ledger.summary(spark)[1:]
    assert through < 4 and rows == 7
    again, said = Target(), []
    second = L.load(spark, found, Sink(again.url), ledger, settings, str(tmp_path / "stage"), said.append, verbose=True)
    assert ledger.summary(spark)[1] == 4 and second.chunks == second.rows == again.calls  # the target says one row a chunk
    assert sum(": chunk " in x for x in said) == second.chunks and "4/4 shards" in said[-1].replace(f"{4 - through}/{4 - through}", "4/4")
    assert sorted(crash.lines + again.lines) == sorted([("target", f"m,s={k:03d} v={t + k}i {t}") for k in range(12) for t in range(5)] * 4)
    done = L.load(spark, found, Sink("http://127.0.0.1:1/"), ledger, settings, str(tmp_path / "stage"), quiet)
    assert (done.chunks, done.shards_skipped) == (0, 4)
    # an acknowledgement that was lost: its chunk alone is sent again
    for f in (tmp_path / "ledger" / ENDS).glob("*.json"):
        f.write_text("".join(x + "\n" for x in f.read_text().splitlines() if json.loads(x)["shard_id"] != "2"))
    last = max(json.loads(x)["seq"] for f in (tmp_path / "ledger" / ACKS).glob("*.json") for x in f.read_text().splitlines() if json.loads(x)["shard_id"] == "2")
    for f in (tmp_path / "ledger" / ACKS).glob("*.json"):
        f.write_text("".join(x + "\n" for x in f.read_text().splitlines() if (json.loads(x)["shard_id"], json.loads(x)["seq"]) != ("2", last)))
    once = Target()
    lost = L.load(spark, found, Sink(once.url), ledger, settings, str(tmp_path / "stage"), quiet)
    assert (lost.chunks, lost.skipped) == (1, last) and 0 < len(once.lines) <= 16
    with pytest.raises(Changed, match="chunk size"):
        L.load(spark, found, Sink(once.url), ledger, L.Settings(chunk_bytes=512), str(tmp_path / "stage"), quiet)


def test_damaged_shards_are_never_done(spark, tmp_path):
    top = shard_tree(tmp_path, 1)
    (tmp_path / "data/db/rp/0/2.tsm").write_bytes(b"rubbish, not a column file")
    ledger = Ledger(str(tmp_path / "ledger"))
    with pytest.raises(Exception, match="not a column file"):
        L.load(spark, catalog.shards(top), Sink("http://127.0.0.1:1/"), ledger, L.Settings(), str(tmp_path / "s"), lambda x: None)
    assert ledger.summary(spark)[1] == 0


def test_report_and_command_line(spark, tmp_path, capsys):
    top = tmp_path / "v2" / "engine" / "data"
    user, system = "0" * 15 + "1", "0" * 15 + "2"
    tree(top, {f"{user}/autogen/1/1.tsm": E.tsm({f"m,s=1{SEP}v": (1, [(1, 1), (2, 2)]), "nofield": (1, [(1, 1)])}), f"{system}/autogen/1/1.tsm": E.tsm({f"t{SEP}v": (1, [(1, 1)])})})
    (tmp_path / "v2" / "influxd.bolt").write_bytes(E.bolt({b"1": json.dumps({"id": user, "name": "telemetry", "type": 0}).encode(), b"2": json.dumps({"id": system, "name": "_tasks", "type": 1}).encode()}))
    assert cli.main(["--datadir", str(tmp_path / "v2"), "--dry-run", "--sample", "1"]) == 0
    said = capsys.readouterr().out
    assert "telemetry: 1 shards, 2 points, 2 fields, 1 keys, 0 keys in logs, 1 keys skipped" in said and "m,s=1 v=1i 1" in said and "_tasks" not in said and "v=2i" not in said
    args = cli.parser().parse_args(["--datadir", str(tmp_path / "v2"), "--dry-run"])
    tables = L.dry_run(spark, cli.find_shards(args), L.Settings())
    assert tuple(tables["keys"].first())[-3:] == (1, 0, 1) and tuple(tables["total"].first()) == (2, 2, 1)
    for bad in ([], ["--url", "http://x", "--chunk-bytes", "500MB"], ["--dry-run", "--start", "2024-01-02T00:00:00Z", "--end", "2024-01-01T00:00:00Z"]):
        with pytest.raises(SystemExit):
            cli.main(["--datadir", str(tmp_path / "v2"), *bad])


def test_precision(spark, tmp_path):
    tree(tmp_path / "d", {"db/rp/1/1.tsm": E.tsm({f"m{SEP}v": (1, [(-1500, 1), (2500, 2)])})})
    points = rejoin.points(read_values(spark, catalog.shards(str(tmp_path / "d"))))
    assert sorted(r["ts_ns"] for r in L.in_precision(points, "us").collect()) == [-2, 2]


def test_resume_tables(spark):
    acks = spark.createDataFrame([("s", "1", q, 10) for q in (0, 1, 3)] + [("s", "2", 5, 1), ("s", "1", 1, 10)], "source_id string, shard_id string, seq int, rows long")
    assert {r["shard_id"]: r["committed"] for r in resume.committed(acks).collect()} == {"1": 1, "2": -1}
    assert {r["shard_id"]: r["committed"] for r in resume.upserted(acks).collect()} == {"1": 3, "2": 5}


def test_stream(spark, tmp_path):
    from pointstream.streaming.tail import follow

    k = f"m{SEP}v"
    tree(tmp_path / "d", {"db/rp/1/1.tsm": E.tsm({k: (1, [(2, 1), (1, 5), (2, 9)])})})
    read_values(spark, catalog.shards(str(tmp_path / "d"))).write.parquet(str(tmp_path / "in"))
    got = []
    q = follow(spark, str(tmp_path / "in"), str(tmp_path / "ck"), lambda df, n: got.extend((r["ts_ns"], r["v_int"]) for r in df.collect()))
    q.awaitTermination(60)
    assert sorted(got) == [(1, 5), (2, 9)]


def test_stream_of_logs(spark, tmp_path):
    """What logs gain between two runs is read once, from whole frames on; a torn tail waits for its rest."""
    from pointstream.streaming.tail import follow

    k, log = f"m{SEP}v", tmp_path / "w" / "db" / "rp" / "1" / "_00001.wal"
    frames = [E.wal(E.wal_entry([(k, 2, [(t, 10 * t + r)])])) for t, r in ((1, 0), (2, 0), (1, 5))]
    tree(tmp_path / "w", {"db/rp/1/_00001.wal": frames[0] + frames[1][:-2]})
    got = []

    def run():
        follow(spark, str(tmp_path / "w"), str(tmp_path / "ck"), lambda df, n: got.extend(sorted((r["ts_ns"], r["v_int"], r["database"]) for r in df.collect())), raw=True).awaitTermination(60)

    run()
    assert got == [(1, 10, "db")]
    log.write_bytes(frames[0] + frames[1] + frames[2])
    run()
    assert got == [(1, 10, "db"), (1, 15, "db"), (2, 20, "db")]


def test_empty(spark):
    values = read_values(spark, [])
    assert rejoin.lines(rejoin.points(values)).collect() == []
    assert tuple(report.grand_total(report.shard_stats(rejoin.points(values))).first()) == (0, 0, 0)
