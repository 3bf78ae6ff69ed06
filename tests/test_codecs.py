"""Column and log formats: round trips with the test writer, vectors by hand, damage."""

import json
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import encoder as E
from pointstream.sources import bolt, codecs, tsm, wal

int64 = st.integers(-(2**63), 2**63 - 1)


@given(st.lists(int64, min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_integers(v):
    assert codecs.integers(E.integers(v)).tolist() == v


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=100))
@settings(max_examples=40, deadline=None)
def test_unsigned(v):
    assert codecs.unsigned(E.ENCODERS[4](v)).tolist() == v


@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=100))
@settings(max_examples=60, deadline=None)
def test_floats(v):
    assert codecs.floats(E.floats(v)).tolist() == v


@given(st.lists(st.integers(-(2**62), 2**62), min_size=1, max_size=200), st.integers(0, 9))
@settings(max_examples=60, deadline=None)
def test_timestamps(v, power):
    v = [x // 10**power * 10**power for x in v]
    assert codecs.timestamps(E.timestamps(v)).tolist() == v
    assert codecs.timestamps(E.timestamps(sorted(v))).tolist() == sorted(v)


@given(st.lists(st.booleans(), max_size=100), st.lists(st.binary(max_size=300), max_size=50))
@settings(max_examples=40, deadline=None)
def test_booleans_and_strings(b, s):
    assert codecs.booleans(E.booleans(b)).tolist() == b
    assert codecs.strings(E.strings(s)) == s


def test_runs_of_ones():
    """The first two selectors are runs of ones: a regular series with one gap keeps its times."""
    assert codecs.simple8b(struct.pack(">Q", 0)).tolist() == [1] * 240
    assert codecs.simple8b(struct.pack(">Q", 1 << 60)).tolist() == [1] * 120
    times = [*range(500), *range(700, 1200)]
    assert codecs.timestamps(E.timestamps(times)).tolist() == times


def test_runs_and_many_blocks():
    assert codecs.timestamps(bytes([2 << 4 | 3]) + struct.pack(">q", -5000) + E.uvarint(10) + E.uvarint(4)).tolist() == [-5000, 5000, 15000, 25000]
    assert codecs.integers(b"\x20" + struct.pack(">Q", E.zigzag(7)) + E.uvarint(E.zigzag(-2)) + E.uvarint(3)).tolist() == [7, 5, 3, 1]
    rows = [(k * 1000, k * k - 7) for k in range(5000)]
    found = list(tsm.read(E.tsm({"m#!~#f": (1, rows)}, block=700), 1_000_000, 1_500_000))
    assert sum(len(t) for _, _, _, t, _ in found) == 1400  # two of eight blocks can hold such times
    assert [x for *_, t, v in found for x in zip(t.tolist(), v.tolist())] == rows[700:2100]
    places = [at for _, at, *_ in tsm.read(E.tsm({"m#!~#f": (1, rows)}, block=700), -(2**63), 2**63 - 1)]
    assert places == sorted(set(places))


def test_damage():
    good = E.tsm({"a#!~#f": (0, [(1, 1.5), (2, 2.5)])})
    broken = bytearray(good)
    broken[20] ^= 255
    for bad in (b"", b"x" * 40, good[:-8] + struct.pack(">Q", 10**9), bytes(broken), good[:-20] + good[-8:]):
        with pytest.raises(codecs.Damaged):
            list(tsm.read(bad, -(2**63), 2**63 - 1))
    for f, bad in ((codecs.timestamps, b"\x20" + b"\0" * 8 + E.uvarint(1) + E.uvarint(2**40)), (codecs.integers, b"\x30" + b"\0" * 8), (codecs.floats, b"\x10" + b"\0" * 7), (codecs.simple8b, b"abc"), (codecs.strings, b"\x10\xff\xff")):
        with pytest.raises(codecs.Damaged):
            f(bad)
    assert codecs.booleans(b"\x10" + E.uvarint(2**40) + b"\xf0").tolist() == [True] * 4 + [False] * 4


ALL = [("k#!~#f", 1, [(1, 1.5)]), ("k#!~#i", 2, [(1, -7), (2, 8)]), ("k#!~#b", 3, [(1, True)]), ("k#!~#s", 4, [(1, b"a b")]), ("k#!~#u", 5, [(1, 2**64 - 1)])]


def test_log():
    data = E.wal(E.wal_entry(ALL), E.wal_entry(ALL[:1]))
    rows = list(wal.read(data))
    assert [(n, k.decode()[-1], t, v) for n, k, _, t, v in rows] == [(0, "f", 1, 1.5), (0, "i", 1, -7), (0, "i", 2, 8), (0, "b", 1, True), (0, "s", 1, b"a b"), (0, "u", 1, 2**64 - 1), (1, "f", 1, 1.5)]
    assert list(wal.read(data[:-3])) == rows[:-1]  # torn tail
    assert list(wal.read(data + b"\x01")) == rows
    assert list(wal.read(b"\x01\xff\xff\xff\xff")) == []
    assert list(wal.read(E.wal(b"gone", kind=2) + data))[0][0] == 1  # deletions don't apply
    for bad in (E.wal(b"x", kind=9), E.wal(E.wal_entry(ALL)[:-3]), E.wal(struct.pack(">BH", 1, 1) + b"k" + struct.pack(">I", 2**31))):
        with pytest.raises(codecs.Damaged):
            list(wal.read(bad))


def test_bucket_names(tmp_path):
    records = {b"1": json.dumps({"id": "a" * 16, "name": "telemetry", "type": 0}).encode(), b"2": json.dumps({"id": "b" * 16, "name": "_tasks", "type": 1}).encode(), b"3": b"{", b"4": json.dumps({"id": "", "name": "x"}).encode()}
    p = tmp_path / "influxd.bolt"
    p.write_bytes(E.bolt(records))
    assert bolt.load(str(p)) == [("a" * 16, "telemetry", 0), ("b" * 16, "_tasks", 1)]
    assert bolt.load(str(tmp_path / "none")) == []
    p.write_bytes(E.bolt(records, name=b"other"))
    assert bolt.load(str(p)) == []
    p.write_bytes(b"nothing" * 100)
    with pytest.raises(codecs.Damaged):
        bolt.load(str(p))
    assert bolt.default_path("/x/engine/data") == "/x/influxd.bolt"


def test_columns_are_numpy():
    assert codecs.floats(E.floats([1.0])).dtype == np.float64 and codecs.integers(E.integers([1])).dtype == np.int64
