"""Writers of the file formats, plain and one value at a time: for the tables that queries read back, and for tests."""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa

from .codecs import FLOAT_END, SIMPLE8B


def uvarint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def zigzag(n):
    return (n << 1 ^ n >> 63) & (2**64 - 1)


def simple8b(values):
    out, at = b"", 0
    while at < len(values):
        for selector, (count, bits) in enumerate(SIMPLE8B):
            some = values[at : at + count]
            if len(some) == count and all(v == 1 if not bits else v < 1 << bits for v in some):
                word = selector << 60
                if bits:
                    for k, v in enumerate(some):
                        word |= v << (k * bits)
                out += struct.pack(">Q", word)
                at += count
                break
        else:
            raise ValueError("value over 60 bits")
    return out


def timestamps(ts):
    deltas = [b - a for a, b in zip(ts, ts[1:])]
    first = struct.pack(">q", ts[0])
    if any(d < 0 or d >= 1 << 60 for d in deltas):
        return b"\x00" + first + b"".join(struct.pack(">Q", d % 2**64) for d in deltas)
    power = 0
    while power < 12 and deltas and all(d % 10 ** (power + 1) == 0 for d in deltas):
        power += 1
    scaled = [d // 10**power for d in deltas]
    if len(set(scaled)) == 1 and len(ts) > 1:
        return bytes([2 << 4 | power]) + first + uvarint(scaled[0]) + uvarint(len(ts))
    return bytes([1 << 4 | power]) + first + simple8b(scaled)


def integers(values):
    deltas = [zigzag((b - a + 2**63) % 2**64 - 2**63) for a, b in zip([0, *values], values)]
    if len(values) > 2 and len(set(deltas[1:])) == 1:
        return b"\x20" + struct.pack(">Q", deltas[0]) + uvarint(deltas[1]) + uvarint(len(values) - 1)
    if any(d >= 1 << 60 for d in deltas[1:]):
        return b"\x00" + b"".join(struct.pack(">Q", d) for d in deltas)
    return b"\x10" + struct.pack(">Q", deltas[0]) + simple8b(deltas[1:])


def floats(values):
    raw = [struct.unpack(">Q", struct.pack(">d", v))[0] for v in values] + [FLOAT_END]
    bits = f"{raw[0]:064b}"
    lead = size = None
    for a, b in zip(raw, raw[1:]):
        x = a ^ b
        if not x:
            bits += "0"
            continue
        n = min(31, 64 - x.bit_length())
        tail = (x & -x).bit_length() - 1
        if lead is not None and n >= lead and tail >= 64 - lead - size:
            bits += "10" + f"{x >> (64 - lead - size):0{size}b}"
        else:
            lead, size = n, 64 - n - tail
            bits += "11" + f"{lead:05b}{size & 63:06b}" + f"{x >> tail:0{size}b}"
    bits += "0" * (-len(bits) % 8)
    return b"\x10" + int(bits, 2).to_bytes(len(bits) // 8, "big")


def booleans(values):
    bits = "".join("1" if v else "0" for v in values)
    bits += "0" * (-len(bits) % 8)
    return b"\x10" + uvarint(len(values)) + (int(bits, 2).to_bytes(len(bits) // 8, "big") if bits else b"")


def snappy(raw):
    return pa.Codec("snappy").compress(raw, asbytes=True) if raw else b"\x00"


def strings(values):
    return b"\x10" + snappy(b"".join(uvarint(len(v)) + v for v in values))


ENCODERS = {0: floats, 1: integers, 2: booleans, 3: strings, 4: lambda v: integers([x - 2**64 if x >= 2**63 else x for x in v])}


def tsm(columns, block=1000):
    """columns: {key: (type, [(ts, value)])}."""
    out, index = struct.pack(">IB", 0x16D116D1, 1), b""
    for key, (kind, rows) in sorted(columns.items()):
        entries = b""
        blocks = [rows[k : k + block] for k in range(0, len(rows), block)]
        for some in blocks:
            t = timestamps([r[0] for r in some])
            body = bytes([kind]) + uvarint(len(t)) + t + ENCODERS[kind]([r[1] for r in some])
            body = struct.pack(">I", zlib.crc32(body)) + body
            entries += struct.pack(">qqQI", min(r[0] for r in some), max(r[0] for r in some), len(out), len(body))
            out += body
        k = key.encode()
        index += struct.pack(">H", len(k)) + k + struct.pack(">BH", kind, len(blocks)) + entries
    return out + index + struct.pack(">Q", len(out))


def wal_entry(columns):
    """columns: [(key, type as logs have it, [(ts, value)])]."""
    raw = b""
    for key, kind, rows in columns:
        k = key.encode()
        raw += struct.pack(">BH", kind, len(k)) + k + struct.pack(">I", len(rows))
        for ts, v in rows:
            raw += struct.pack(">q", ts) + {1: lambda v: struct.pack(">d", v), 2: lambda v: struct.pack(">q", v), 3: lambda v: bytes([v]), 4: lambda v: struct.pack(">I", len(v)) + v, 5: lambda v: struct.pack(">Q", v)}[kind](v)
    return raw


def wal(*entries, kind=1):
    return b"".join(struct.pack(">BI", kind, len(s := snappy(e))) + s for e in entries)


def bolt(buckets, size=4096, name=b"bucketsv1"):
    """A metadata file with one bucket of key-value pairs on a leaf page of its own."""

    def leaf(page, elements):
        head, body, at = b"", b"", 16 * len(elements)
        for k, (flags, key, value) in enumerate(elements):
            head += struct.pack("<IIII", flags, at + len(body) - 16 * k, len(key), len(value))
            body += key + value
        raw = struct.pack("<QHHI", page, 2, len(elements), 0) + head + body
        assert len(raw) <= size
        return raw.ljust(size, b"\0")

    def meta(page, tx):
        return (struct.pack("<QHHI", page, 4, 0, 0) + struct.pack("<IIIIQQQQQQ", 0xED0CDAED, 2, size, 0, 3, 0, 2, 5, tx, 0)).ljust(size, b"\0")

    free = struct.pack("<QHHI", 2, 16, 0, 0).ljust(size, b"\0")
    root = leaf(3, [(1, name, struct.pack("<QQ", 4, 0))])
    return meta(0, 1) + meta(1, 2) + free + root + leaf(4, [(0, k, v) for k, v in sorted(buckets.items())])
