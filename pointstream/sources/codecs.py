"""Decoders of compressed columns; no Spark here."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

#: A word's upper 4 bits are its selector, which says how many numbers of how many bits follow.  The first
#: two stand for runs of ones.
SIMPLE8B = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
#: Fixed value: ends a stream of floats.
FLOAT_END = 0x7FF8000000000001
#: No column has more values; a larger count in a file is damage.
MOST_VALUES = 1 << 24
#: So many words are read faster one by one than by calls for all.
FEW_WORDS = 8


class Damaged(ValueError):
    """Bytes that aren't what the format says."""


def uvarint(data: bytes, at: int = 0) -> tuple[int, int]:
    """(number, where the next byte is)."""
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise Damaged("variable-length number")
        value |= (data[at] & 127) << shift
        at += 1
        if data[at - 1] < 128:
            return value, at
        shift += 7


def unzigzag(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.uint64)
    return ((v >> np.uint64(1)) ^ (np.uint64(0) - (v & np.uint64(1)))).view(np.int64)


def simple8b(data: bytes) -> np.ndarray:
    """All numbers in big-endian words, as uint64."""
    if len(data) % 8:
        raise Damaged("simple8b words")
    if len(data) <= 8 * FEW_WORDS:
        found: list[int] = []
        for word in struct.unpack(f">{len(data) // 8}Q", data):
            count, bits = SIMPLE8B[word >> 60]
            mask = (1 << bits) - 1
            found += [word >> k & mask for k in range(0, count * bits, bits)] if bits else [1] * count
        return np.asarray(found, np.uint64)
    words = np.frombuffer(data, ">u8").astype(np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.asarray([c for c, _ in SIMPLE8B])[selector]
    if int(counts.sum()) > MOST_VALUES:
        raise Damaged("too many values")
    out = np.ones(int(counts.sum()), np.uint64)
    starts = np.cumsum(counts) - counts
    for s in set(selector.tolist()):
        count, bits = SIMPLE8B[s]
        if bits:
            which = np.flatnonzero(selector == s)
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            out[starts[which][:, None] + np.arange(count)] = (words[which][:, None] >> shifts) & np.uint64((1 << bits) - 1)
    return out


def _head(data: bytes) -> int:
    if not data:
        raise Damaged("empty column")
    return data[0] >> 4


def _raw(data: bytes) -> np.ndarray:
    if len(data) % 8:
        raise Damaged("raw words")
    return np.frombuffer(data, ">u8").astype(np.uint64)


def _run(data: bytes, at: int) -> tuple[int, int]:
    delta, at = uvarint(data, at)
    count, _ = uvarint(data, at)
    if count > MOST_VALUES:
        raise Damaged("run length")
    return delta, count


def timestamps(data: bytes) -> np.ndarray:
    """First value and deltas: raw (0), simple8b times a power of ten (1), or one delta repeated (2)."""
    if not data:
        return np.zeros(0, np.int64)
    kind, scale = _head(data), np.uint64(10 ** (data[0] & 15))
    with np.errstate(over="ignore"):
        if kind == 0:
            return np.cumsum(_raw(data[1:]), dtype=np.uint64).view(np.int64)
        if kind not in (1, 2) or len(data) < 9:
            raise Damaged("timestamps")
        first = np.frombuffer(data, ">u8", 1, 1).astype(np.uint64)
        if kind == 1:
            return np.cumsum(np.concatenate([first, simple8b(data[9:]) * scale]), dtype=np.uint64).view(np.int64)
        delta, count = _run(data, 9)
        return (first + np.arange(count, dtype=np.uint64) * (np.uint64(delta % 2**64) * scale)).view(np.int64)


def integers(data: bytes) -> np.ndarray:
    """Zigzag deltas: raw (0), simple8b behind a first value (1), or one delta repeated (2)."""
    if not data:
        return np.zeros(0, np.int64)
    kind = _head(data)
    if kind == 0:
        return np.cumsum(unzigzag(_raw(data[1:])))
    if kind not in (1, 2) or len(data) < 9:
        raise Damaged("integers")
    first = np.frombuffer(data, ">u8", 1, 1).astype(np.uint64)
    if kind == 1:
        return np.cumsum(unzigzag(np.concatenate([first, simple8b(data[9:])])))
    delta, count = _run(data, 9)
    step = unzigzag(np.asarray([delta % 2**64], np.uint64))[0]
    return unzigzag(first)[0] + np.arange(count + 1, dtype=np.int64) * step


def unsigned(data: bytes) -> np.ndarray:
    return integers(data).view(np.uint64)


def floats(data: bytes) -> np.ndarray:
    """Each value is the one before, changed in a window of bits; a certain NaN ends the stream.

    After the type byte: the first value; then for each further one a 0 bit (same value), or 1 and either 0 (bits in
    the window before) or 1, 5 bits of leading zeros, 6 bits of window size (0 means 64) and the window's bits."""
    if not data:
        return np.zeros(0)
    if _head(data) != 1 or len(data) < 9:
        raise Damaged("floats")
    total = 8 * (len(data) - 1)
    padded = data[1:] + bytes(-(len(data) - 1) % 8 + 8)
    words = struct.unpack(f">{len(padded) // 8}Q", padded)
    at = 0

    def take(n: int) -> int:  # of two neighbouring words, so a column's cost grows with its length only
        nonlocal at
        if at + n > total:
            raise EOFError
        word, bit = at >> 6, at & 63
        at += n
        return ((words[word] << 64 | words[word + 1]) >> (128 - bit - n)) & ((1 << n) - 1)

    value, lead, size, out = words[0], 0, 64, []
    at = 64
    try:
        while value != FLOAT_END:
            out.append(value)
            if not take(1):
                continue
            try:
                if take(1):
                    lead, size = take(5), take(6) or 64
                value ^= take(size) << max(0, 64 - lead - size)
            except EOFError:
                raise Damaged("floats end inside a value") from None
    except EOFError:
        pass  # between two values: what is there counts
    return np.asarray(out, np.uint64).view(np.float64)


def booleans(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, bool)
    if _head(data) != 1:
        raise Damaged("booleans")
    count, at = uvarint(data, 1)
    return np.unpackbits(np.frombuffer(data, np.uint8, offset=at))[: min(count, 8 * (len(data) - at))].astype(bool)


def unsnappy(data: bytes) -> bytes:
    size, _ = uvarint(data)
    if size > 1 << 30:
        raise Damaged("snappy size")
    try:
        return pa.Codec("snappy").decompress(data, decompressed_size=size, asbytes=True) if size else b""
    except (OSError, ValueError) as e:
        raise Damaged("snappy") from e


def strings(data: bytes) -> list[bytes]:
    if not data:
        return []
    if _head(data) != 1:
        raise Damaged("strings")
    raw, at, out = unsnappy(data[1:]), 0, []
    while at < len(raw):
        size, at = uvarint(raw, at)
        if at + size > len(raw):
            raise Damaged("string length")
        out.append(raw[at : at + size])
        at += size
    return out


DECODERS = {0: floats, 1: integers, 2: booleans, 3: strings, 4: unsigned}
