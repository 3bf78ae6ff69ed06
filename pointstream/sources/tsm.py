"""Column files: ``magic version | blocks | index | offset of the index``, all big-endian.

A block is ``checksum4 type1 uvarint(bytes of times) times values``; an index entry ``keyLen2 key type1 count2
{min8 max8 offset8 size4}*``.  A file is read from its end: the index in pieces, then one block at a time, so
memory is bounded by a piece and a block, whatever the file's size."""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import numpy as np

from .codecs import DECODERS, Damaged, timestamps, uvarint

#: Fixed values of the format.
MAGIC, VERSION = 0x16D116D1, 1
#: Bytes of an index that are read at once; an entry may be longer.
PIECE = 1 << 20
#: Bytes of blocks that one task reads.
SPLIT = 64 << 20
#: Times of so many blocks, with so many values at the most, are kept, as a series' fields mostly have the same ones.
KEPT_BLOCKS, KEPT_VALUES = 16, 8192
#: Places in a key's order that a block may have.
BLOCK_PLACES = 1 << 24


class Block(NamedTuple):
    low: int
    high: int
    offset: int
    size: int


class Entry(NamedTuple):
    """A key's blocks; the entry is at ``begin`` to ``end`` of the file."""

    key: bytes
    blocks: list[Block]
    begin: int
    end: int


class Range(NamedTuple):
    """Neighbouring entries of an index, and the bytes of their blocks."""

    begin: int
    end: int
    blocks: int


def index_place(f: BinaryIO) -> tuple[int, int]:
    """Where the index begins and ends."""
    f.seek(0)
    head = f.read(5)
    size = f.seek(0, 2)
    if size < 13 or struct.unpack(">IB", head) != (MAGIC, VERSION):
        raise Damaged("not a column file of this version")
    f.seek(size - 8)
    (at,) = struct.unpack(">Q", f.read(8))
    if not 5 <= at <= size - 8:
        raise Damaged("place of the index")
    return at, size - 8


def entries(f: BinaryIO, begin: int, end: int) -> Iterator[Entry]:
    """Index entries of a part of the index, which begins with one."""
    held, first, at = b"", begin, begin  # bytes from ``first`` on; the entry is at ``at``

    def need(n: int) -> int:
        """Where the entry is in ``held``, of which it has ``n`` bytes."""
        nonlocal held, first
        if at - first + n > len(held):
            f.seek(at)
            held, first = f.read(min(max(PIECE, n), end - at)), at
        if at - first + n > len(held):
            raise Damaged("index")
        return at - first

    while at < end:
        k = need(2)
        (size,) = struct.unpack_from(">H", held, k)
        k = need(5 + size)
        _, count = struct.unpack_from(">BH", held, k + 2 + size)
        whole = 5 + size + 28 * count
        k = need(whole)
        yield Entry(held[k + 2 : k + 2 + size], [Block(*x) for x in struct.iter_unpack(">qqQI", held[k + 5 + size : k + whole])], at, at + whole)
        at += whole


def wanted(entry: Entry, low: int, high: int, keys: tuple[bytes, bytes] | None) -> bool:
    """Whether an entry can have values in the range of time and of keys (both ends belong to it)."""
    return (not keys or keys[0] <= entry.key <= keys[1]) and any(b.high >= low and b.low <= high for b in entry.blocks)


def ranges(f: BinaryIO, low: int, high: int, keys: tuple[bytes, bytes] | None = None, split: int = SPLIT) -> Iterator[Range]:
    """The index in parts whose blocks have about ``split`` bytes; entries that aren't wanted make no part."""
    begin = end = size = 0
    for e in entries(f, *index_place(f)):
        if wanted(e, low, high, keys):
            if size >= split:
                yield Range(begin, end, size)
                size = 0
            begin, end = begin if size else e.begin, e.end
            size += sum(b.size for b in e.blocks if b.high >= low and b.low <= high)
    if size:
        yield Range(begin, end, size)


def parts(f: BinaryIO, low: int, high: int, keys: tuple[bytes, bytes] | None = None, split: int = SPLIT) -> Iterator[Range]:
    """The same, but a file with no more than ``split`` bytes of blocks is one part, whose index only its reader goes through."""
    begin, end = index_place(f)
    if begin - 5 > split:
        yield from ranges(f, low, high, keys, split)
    elif begin < end:
        yield Range(begin, end, begin - 5)


def read_index(f: BinaryIO) -> dict[bytes, list[Block]]:
    """Blocks of each key, keys in byte order."""
    return dict(sorted((e.key, e.blocks) for e in entries(f, *index_place(f))))


def _times(data: bytes, known: dict[bytes, np.ndarray]) -> np.ndarray:
    """Timestamps, from those that are kept if they are there."""
    if (found := known.get(data)) is None:
        found = timestamps(data)
        if len(found) <= KEPT_VALUES and len(data) <= 8 * KEPT_VALUES + 16:
            if len(known) >= KEPT_BLOCKS:
                del known[next(iter(known))]
            known[data] = found
    return found


def read_block(f: BinaryIO, block: Block, check: bool = True, known: dict[bytes, np.ndarray] | None = None) -> tuple[int, np.ndarray, np.ndarray | list[bytes]]:
    """(type, timestamps, values)."""
    f.seek(block.offset)
    raw = f.read(block.size)
    if len(raw) < block.size or block.size < 5:
        raise Damaged("place of a block")
    if check and struct.unpack_from(">I", raw)[0] != zlib.crc32(raw[4:]):
        raise Damaged("checksum of a block")
    kind = raw[4]
    if kind not in DECODERS:
        raise Damaged(f"block of type {kind}")
    size, at = uvarint(raw, 5)
    if at + size > len(raw):
        raise Damaged("bytes of timestamps")
    times, values = _times(raw[at : at + size], {} if known is None else known), DECODERS[kind](raw[at + size :])
    if len(times) != len(values):
        raise Damaged(f"{len(times)} times but {len(values)} values")
    return kind, times, values


def read(f: BinaryIO | bytes, low: int, high: int, keys: tuple[bytes, bytes] | None = None, check: bool = True, part: tuple[int, int] | None = None) -> Iterator[tuple[bytes, int, int, np.ndarray, np.ndarray | list[bytes]]]:
    """(key, place of the first value in its key, type, times, values) of blocks that can hold times in the range, in the
    order of the index, or of a ``part`` of it."""
    f, known = io.BytesIO(f) if isinstance(f, bytes) else f, {}
    for entry in entries(f, *(part or index_place(f))):
        if not wanted(entry, low, high, keys):
            continue
        for number, block in enumerate(entry.blocks):
            if block.high >= low and block.low <= high:  # else the block isn't even read
                kind, times, values = read_block(f, block, check, known)
                yield entry.key, number * BLOCK_PLACES, kind, times, values
