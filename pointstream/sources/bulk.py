"""The plain writers' column files, byte for byte, with the work on all blocks of a file at once: for tables of many rows.

Functions get the values of all blocks in one array and where each block begins, and give each block's bytes."""

from __future__ import annotations

import struct
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa

from .codecs import FLOAT_END, SIMPLE8B
from .writer import uvarint

_ONE = np.uint64(1)
_WIDTHS = [b for _, b in SIMPLE8B[:1:-1]][::-1]
_LIMITS = np.asarray([1 << b for b in _WIDTHS], np.uint64)
_COUNTS = np.asarray([c for c, _ in SIMPLE8B])


def _cut(data: bytes, sizes) -> list[bytes]:
    ends = list(accumulate(sizes))
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _every(flags: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether all flags of a block are set; so it is for a block without any."""
    held = np.concatenate([[0], np.cumsum(~flags)])
    return held[starts + sizes] == held[starts]


def zigzag(v: np.ndarray) -> np.ndarray:
    return (v << 1 ^ v >> 63).view(np.uint64)


def simple8b(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Words that hold as many of the next numbers as they can; no word has numbers of two blocks."""
    n = len(values)
    if not n:
        return [b""] * len(starts)
    needs = np.searchsorted(_LIMITS, values, "right")
    if needs.max() == len(_WIDTHS):
        raise ValueError("value over 60 bits")
    end = np.repeat(starts + sizes, sizes)
    at = np.arange(n)
    selector = np.full(n, len(SIMPLE8B) - 1)
    most = {1: needs}  # the largest need of so many numbers from each place on, for powers of two

    def window(count: int) -> np.ndarray:
        power = 1 << count.bit_length() - 1
        for p in (1 << k for k in range(1, count.bit_length())):
            if p not in most:
                half = most[p // 2]
                most[p] = np.maximum(half, np.concatenate([half[p // 2 :], half[-1:].repeat(min(p // 2, n))])[:n])
        held = most[power]
        return np.maximum(held, held[np.minimum(at + count - power, n - 1)])

    others = np.concatenate([[0], np.cumsum(values != _ONE)])
    longest = int(sizes.max())
    for s in range(len(SIMPLE8B) - 2, -1, -1):
        count, bits = SIMPLE8B[s]
        if count > longest:
            continue
        fits = window(count) <= s - 2 if bits else others[np.minimum(at + count, n)] == others[:n]
        selector[fits & (at + count <= end)] = s
    after = (at + _COUNTS[selector]).tolist()
    places: list[int] = []
    words_of = []
    for a, b in zip(starts.tolist(), (starts + sizes).tolist()):
        before = len(places)
        while a < b:
            places.append(a)
            a = after[a]
        words_of.append(8 * (len(places) - before))
    place = np.asarray(places)
    chosen = selector[place]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen).tolist():
        count, bits = SIMPLE8B[s]
        if bits:
            which = np.flatnonzero(chosen == s)
            for k in range(count):
                words[which] |= values[place[which] + k] << np.uint64(k * bits)
    return _cut(words.astype(">u8").tobytes(), words_of)


def _inner(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all but the first value of each block; where each block's begin among these, and how many it has."""
    inside = np.ones(int(sizes.sum()), bool)
    inside[starts] = False
    return np.flatnonzero(inside), starts - np.arange(len(starts)), sizes - 1


def timestamps(times: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    at, begin, many = _inner(starts, sizes)
    deltas = times[at] - times[at - 1]
    small = _every((deltas >= 0) & (deltas < 1 << 60), begin, many)
    power, alive = np.zeros(len(starts), np.int64), small & (many > 0)
    for p in range(12):
        alive &= _every(deltas % 10 ** (p + 1) == 0, begin, many)
        if not alive.any():
            break
        power[alive] += 1
    scaled = (deltas // np.repeat(10**power, many)).astype(np.uint64)
    heads = scaled[np.minimum(begin, max(len(scaled) - 1, 0))] if len(scaled) else np.zeros(len(starts), np.uint64)
    regular = small & (many > 0) & _every(scaled == np.repeat(heads, many), begin, many)
    packed = np.flatnonzero(small & ~regular)
    kept = np.repeat(small & ~regular, many)
    ends = np.cumsum(many[packed])
    words = dict(zip(packed.tolist(), simple8b(scaled[kept], ends - many[packed], many[packed])))
    firsts = _cut(times[starts].astype(">i8").tobytes(), [8] * len(starts))
    out = []
    for k, (first, p, one, n) in enumerate(zip(firsts, power.tolist(), heads.tolist(), sizes.tolist())):
        if k in words:
            out.append(bytes([1 << 4 | p]) + first + words[k])
        elif regular[k]:
            out.append(bytes([2 << 4 | p]) + first + uvarint(one) + uvarint(n))
        else:
            out.append(b"\x00" + first + deltas[begin[k] : begin[k] + many[k]].astype(">i8").tobytes())
    return out


def integers(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    before = np.concatenate([[0], values[:-1]])
    before[starts] = 0
    deltas = zigzag(values - before)
    at, begin, many = _inner(starts, sizes)
    inner = deltas[at]
    heads = inner[np.minimum(begin, max(len(inner) - 1, 0))] if len(inner) else np.zeros(len(starts), np.uint64)
    regular = (sizes > 2) & _every(inner == np.repeat(heads, many), begin, many)
    small = ~regular & _every(inner < np.uint64(1 << 60), begin, many)
    packed = np.flatnonzero(small)
    ends = np.cumsum(many[packed])
    words = dict(zip(packed.tolist(), simple8b(inner[np.repeat(small, many)], ends - many[packed], many[packed])))
    firsts = _cut(deltas[starts].astype(">u8").tobytes(), [8] * len(starts))
    out = []
    for k, (first, one, n) in enumerate(zip(firsts, heads.tolist(), sizes.tolist())):
        if k in words:
            out.append(b"\x10" + first + words[k])
        elif regular[k]:
            out.append(b"\x20" + first + uvarint(one) + uvarint(n - 1))
        else:
            out.append(b"\x00" + deltas[starts[k] : starts[k] + n].astype(">u8").tobytes())
    return out


def unsigned(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    return integers(values.astype(np.uint64).view(np.int64), starts, sizes)


def _bit_length(x: np.ndarray) -> np.ndarray:
    high, low = x >> np.uint64(32), x & np.uint64(0xFFFFFFFF)
    return np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], np.frexp(low.astype(np.float64))[1]).astype(np.int64)


def floats(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    raw = np.insert(values.astype(np.float64).view(np.uint64), starts + sizes, np.uint64(FLOAT_END))
    begin = starts + np.arange(len(starts))  # each block has its end mark now
    x = raw.copy()
    x[1:] ^= raw[:-1]
    x[begin] = raw[begin]
    lead = np.minimum(31, 64 - _bit_length(x)).tolist()
    tail = np.maximum(0, _bit_length(x & (~x + _ONE)) - 1).tolist()
    bits = (x != 0).tolist()
    is_first = np.zeros(len(raw), bool)
    is_first[begin] = True
    head = np.zeros(len(raw), np.uint64)  # the bits before a value's window, and how many
    head_bits, low, width = np.ones(len(raw), np.int64), np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
    places, held = [], []
    now_lead, now_size = 65, 0
    for k, (n, t, some, first) in enumerate(zip(lead, tail, bits, is_first.tolist())):
        if first:
            now_lead, now_size = 65, 0
        elif some:
            if n >= now_lead and t >= 64 - now_lead - now_size:
                held.append((2, 2, 64 - now_lead - now_size, now_size))
            else:
                now_lead, now_size = n, 64 - n - t
                held.append((3 << 11 | n << 6 | now_size & 63, 13, t, now_size))
            places.append(k)
    if places:
        some = np.asarray(held, np.int64)
        head[places], head_bits[places], low[places], width[places] = some[:, 0].astype(np.uint64), some[:, 1], some[:, 2], some[:, 3]
    head_bits[begin], width[begin] = 0, 64
    pieces = np.stack([head, x >> low.astype(np.uint64)], 1).ravel()
    sizes_ = np.stack([head_bits, width], 1).ravel()
    ends = np.cumsum(sizes_)
    stop = 2 * np.concatenate([begin[1:], [len(raw)]]) - 1
    total = np.diff(ends[stop], prepend=0)
    nbytes = -(-total // 8)
    shift = 8 * (np.cumsum(nbytes) - nbytes) - (ends[stop] - total)
    at = ends - sizes_ + np.repeat(shift, 2 * (sizes + 1))
    some = sizes_ > 0
    pieces, many, at = pieces[some], sizes_[some], at[some]
    word, over = at >> 6, (at & 63) + many - 64
    words = np.zeros(int(nbytes.sum()) // 8 + 2, np.uint64)
    spilt = over > 0
    left = np.where(spilt, pieces >> np.maximum(over, 0).astype(np.uint64), pieces << np.maximum(-over, 0).astype(np.uint64))
    _put(words, word, left)
    _put(words, word[spilt] + 1, pieces[spilt] << (64 - over[spilt]).astype(np.uint64))
    return [b"\x10" + b for b in _cut(words.astype(">u8").tobytes(), nbytes.tolist())]


def _put(words: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
    """Sets bits; ``at`` is in order."""
    if len(at):
        heads = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        words[at[heads]] |= np.bitwise_or.reduceat(bits, heads)


def booleans(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    nbytes = -(-sizes // 8)
    bits = np.zeros(8 * int(nbytes.sum()), bool)
    bits[np.arange(len(values)) + np.repeat(8 * (np.cumsum(nbytes) - nbytes) - starts, sizes)] = values
    return [b"\x10" + uvarint(n) + b for n, b in zip(sizes.tolist(), _cut(np.packbits(bits).tobytes(), nbytes.tolist()))]


def strings(values: list[bytes], starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    compress = pa.Codec("snappy").compress
    marked = [uvarint(len(v)) + v for v in values]
    return [b"\x10" + compress(b"".join(marked[a : a + n]), asbytes=True) for a, n in zip(starts.tolist(), sizes.tolist())]


ENCODERS = {0: floats, 1: integers, 2: booleans, 3: strings, 4: unsigned}


def tsm(series: list[str], counts: np.ndarray, times: np.ndarray, fields: list[tuple[str, int, np.ndarray | list[bytes]]], block: int = 1000) -> bytes:
    """A file of ``series`` with ``counts`` rows each, which all have ``times`` and all ``fields`` (end of the key, type,
    values).  Keys must come in their order."""
    per = -(-counts // block)
    first = np.cumsum(counts) - counts
    nth = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    starts = np.repeat(first, per) + nth * block
    sizes = np.minimum(np.repeat(first + counts, per) - starts, block)
    low, high = (f.reduceat(times, starts).tolist() for f in (np.minimum, np.maximum))
    packed_times = timestamps(times, starts, sizes)
    bodies = []
    for _, kind, values in fields:
        head = bytes([kind])
        made = [head + uvarint(len(t)) + t + v for t, v in zip(packed_times, ENCODERS[kind](values, starts, sizes))]
        bodies.append([struct.pack(">I", zlib.crc32(b)) + b for b in made])
    out, index, place, at = [struct.pack(">IB", 0x16D116D1, 1)], [], 5, 0
    for name, n in zip(series, per.tolist()):
        for (field, kind, _), own in zip(fields, bodies):
            key = (name + field).encode()
            index.append(struct.pack(">H", len(key)) + key + struct.pack(">BH", kind, n))
            for k in range(at, at + n):
                index.append(struct.pack(">qqQI", low[k], high[k], place, len(own[k])))
                out.append(own[k])
                place += len(own[k])
        at += n
    return b"".join(out) + b"".join(index) + struct.pack(">Q", place)
