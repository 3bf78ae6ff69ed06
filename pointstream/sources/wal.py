"""Write-ahead logs: frames ``type1 length4 snappy-block``; a write entry is ``{type1 keyLen2 key count4 {time8 value}*}*``.

A write frame cut short, too long or not compressed as it should be ends a log without an error, as a crash leaves
such tails; a whole frame with a wrong inside, or of a type that isn't known, is an error.  Frames of deletions are
passed over, whatever they hold.  One frame is in memory at a time."""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

from ..model import BOOLEAN, FLOAT, INTEGER, STRING, UNSIGNED
from .codecs import Damaged, unsnappy

#: Fixed values of the format: types of frames, and value types as logs number them.
WRITE, DELETE, DELETE_RANGE = 1, 2, 3
TYPES = {1: FLOAT, 2: INTEGER, 3: BOOLEAN, 4: STRING, 5: UNSIGNED}
#: Values of these types have a fixed size behind their time.
WIDE = {FLOAT: np.dtype([("time", ">i8"), ("value", ">f8")]), INTEGER: np.dtype([("time", ">i8"), ("value", ">i8")]), UNSIGNED: np.dtype([("time", ">i8"), ("value", ">u8")]), BOOLEAN: np.dtype([("time", ">i8"), ("value", "u1")])}
MOST_FRAME = 256 << 20


def heads(f: BinaryIO, begin: int = 0, end: int | None = None) -> Iterator[tuple[int, int, int]]:
    """(type, place of what the frame holds, its bytes) of whole frames, from a frame's begin on."""
    size, at = f.seek(0, 2) if end is None else end, begin
    while at + 5 <= size:
        f.seek(at)
        head = f.read(5)
        if len(head) < 5:
            return
        kind, n = struct.unpack(">BI", head)
        if n > MOST_FRAME or at + 5 + n > size:
            return
        yield kind, at + 5, n
        at += 5 + n


def whole(f: BinaryIO, begin: int = 0) -> int:
    """Where the last whole frame ends, by the frames' heads alone."""
    end = begin
    for _, at, n in heads(f, begin):
        end = at + n
    return end


def entry(raw: bytes) -> Iterator[tuple[bytes, int, np.ndarray, np.ndarray | list[bytes]]]:
    """(key, type, times, values) of each column, in the order of the entry."""
    at = 0
    try:
        while at < len(raw):
            code, size = struct.unpack_from(">BH", raw, at)
            if code not in TYPES:
                raise Damaged(f"value of type {code}")
            kind, key = TYPES[code], raw[at + 3 : at + 3 + size]
            (count,) = struct.unpack_from(">I", raw, at + 3 + size)
            at += 7 + size
            if count > len(raw) - at:  # a value has nine bytes at least
                raise Damaged("number of values")
            if kind == STRING:
                times, values = np.zeros(count, np.int64), []
                for k in range(count):
                    times[k], n = struct.unpack_from(">qI", raw, at)
                    at += 12 + n
                    if at > len(raw):
                        raise Damaged("string length")
                    values.append(raw[at - n : at])
            else:
                rows = np.frombuffer(raw, WIDE[kind], count, at)
                at += rows.nbytes
                times, values = rows["time"].astype(np.int64), rows["value"]
                values = values == 1 if kind == BOOLEAN else values.astype(values.dtype.newbyteorder("="))
            yield key, kind, times, values
    except (struct.error, ValueError) as e:
        raise e if isinstance(e, Damaged) else Damaged("write entry") from None


def columns(f: BinaryIO | bytes, begin: int = 0, end: int | None = None) -> Iterator[tuple[int, bytes, int, np.ndarray, np.ndarray | list[bytes]]]:
    """(place of the frame, key, type, times, values) of all columns of write frames."""
    f = io.BytesIO(f) if isinstance(f, bytes) else f
    for kind, at, n in heads(f, begin, end):
        if kind in (DELETE, DELETE_RANGE):
            continue
        if kind != WRITE:
            raise Damaged(f"frame of type {kind}")
        f.seek(at)
        try:
            raw = unsnappy(f.read(n))
        except Damaged:
            return
        for column in entry(raw):
            yield (at - 5, *column)


def read(f: BinaryIO | bytes) -> Iterator[tuple[int, bytes, int, int, object]]:
    """(number of the frame, key, type, time, value) of all values."""
    f = io.BytesIO(f) if isinstance(f, bytes) else f
    number = {at - 5: k for k, (_, at, _) in enumerate(heads(f))}
    for place, key, kind, times, values in columns(f):
        for time, value in zip(times.tolist(), values if kind == STRING else values.tolist()):
            yield number[place], key, kind, time, value
