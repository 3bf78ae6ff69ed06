"""Names of buckets from a metadata file: a B+tree of pages, read only.

A page is ``id8 flags2 count2 overflow4`` and its elements; the root is named by the newer of two meta pages."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from pathlib import Path

from .codecs import Damaged

#: Fixed values of the format: mark of a meta page, kinds of pages, the flag of an element that is a bucket, and the bucket's name.
MAGIC = 0xED0CDAED
BRANCH, LEAF = 1, 2
BUCKET = 1
ROOT = b"bucketsv1"
MOST_FILE = 512 << 20


def _page(data: bytes, page: int, size: int) -> tuple[int, int, int]:
    """(flags, count, place)."""
    at = page * size
    if at + 16 > len(data):
        raise Damaged("page outside the file")
    _, flags, count, _ = struct.unpack_from("<QHHI", data, at)
    return flags, count, at


def _leaf(data: bytes, at: int, count: int) -> Iterator[tuple[int, bytes, bytes]]:
    for k in range(count):
        here = at + 16 + 16 * k
        flags, pos, key, value = struct.unpack_from("<IIII", data, here)
        if here + pos + key + value > len(data):
            raise Damaged("leaf element")
        yield flags, data[here + pos : here + pos + key], data[here + pos + key : here + pos + key + value]


def items(data: bytes, page: int, size: int, depth: int = 0) -> Iterator[tuple[int, bytes, bytes]]:
    flags, count, at = _page(data, page, size)
    if depth > 64:
        raise Damaged("pages in a circle")
    if flags & LEAF:
        yield from _leaf(data, at, count)
    elif flags & BRANCH:
        for k in range(count):
            yield from items(data, struct.unpack_from("<IIQ", data, at + 16 + 16 * k)[2], size, depth + 1)
    else:
        raise Damaged("kind of page")


def read_bucket(data: bytes, name: bytes = ROOT) -> list[tuple[bytes, bytes]]:
    """Key-value pairs of a top-level bucket; none if it isn't there."""
    metas = []
    for size in dict.fromkeys([4096, struct.unpack_from("<I", data, 24)[0] if len(data) > 28 else 0, 8192, 16384, 65536]):
        for page in (0, 1):
            at = page * size + 16
            if size and at + 64 <= len(data):
                magic, version, page_size, _, root, _, _, _, tx, _ = struct.unpack_from("<IIIIQQQQQQ", data, at)
                if magic == MAGIC and version == 2 and page_size == size:
                    metas.append((tx, root, size))
    if not metas:
        raise Damaged("not a metadata file")
    _, root, size = max(metas)
    for flags, key, value in items(data, root, size):
        if flags & BUCKET and key == name:
            child, _ = struct.unpack_from("<QQ", value)
            if child:
                return [(k, v) for f, k, v in items(data, child, size) if not f & BUCKET]
            _, count = struct.unpack_from("<HH", value, 16 + 8)
            return [(k, v) for f, k, v in _leaf(value, 16, count) if not f & BUCKET]
    return []


def bucket_rows(data: bytes) -> list[tuple[str, str, int]]:
    """(id, name, type) of records that can be read; others are skipped."""
    out = []
    for _, value in read_bucket(data):
        try:
            record = json.loads(value)
            if record["id"] and record["name"]:
                out.append((str(record["id"]), str(record["name"]), int(record.get("type") or 0)))
        except (ValueError, KeyError, TypeError):
            continue
    return sorted(out)


def load(path: str) -> list[tuple[str, str, int]]:
    """Rows of a metadata file, or of a JSON list of such records; none if there is no file."""
    p = Path(path)
    if not p.exists():
        return []
    if p.stat().st_size > MOST_FILE:
        raise Damaged("metadata file is too large")
    data = p.read_bytes()
    if p.suffix == ".json":
        return sorted((r["id"], r["name"], int(r.get("type") or 0)) for r in json.loads(data))
    return bucket_rows(data)


def default_path(data_dir: str) -> str:
    """Two levels above ``engine/data``."""
    return str(Path(data_dir).parent.parent / "influxd.bolt")
