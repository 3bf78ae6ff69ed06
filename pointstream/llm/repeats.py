"""Repeated byte strings by enhanced suffix arrays and their trees of common-prefix intervals.

Equal strings of ``least`` bytes have the same minimiser: the least hash of ``GRAM`` bytes inside.  Starts in
a row that share one form a segment.  Documents are handled in blocks, in three steps:

1. Blocks send their minimisers, buckets answer which of them occur again.  The rest can't be in a repeat.
2. Blocks send their distinct segments with such minimisers, and a bucket that gets several different
   segments of one minimiser sorts all suffixes of these that can be in a repeat.  A stack scan of the suffix
   array goes through the tree of common-prefix intervals.  A node whose occurrences don't all follow the same
   byte is a group: a maximal repeat with all its occurrences.
3. In each group every occurrence but the first is removed, from the longest group that has it on.

A repeated string that is no group's has the occurrences of one that is, some bytes further on, so the bytes
that groups cover are all that a string with an earlier start covers.

Starts with a frequent minimiser have a finer key: the least hashes by further orders of the same strings of
``GRAM`` bytes.  So a line in a third of all documents makes no bucket larger than others."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MESSAGE, MESSAGE_SCHEMA, answer, batch, blocks, by_block, frequent, from_blob, mix, pack_arrays, resolve, scatter, texts, unpack_arrays
from .windows import runs_within, sliding_min

LEAST = 100
GRAM = 24
#: Bytes whose suffixes are sorted together, unless one minimiser's segments have more.
SORTED = 1_000_000
#: Further orders in the key of a frequent minimiser's starts.
FINER = 8
#: Bytes of minimisers and of segments that travel for each byte of the blocks.
MOVED_VALUES, MOVED_SEGMENTS = 0.5, 1.3
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWER = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each ``gram`` neighbouring bytes, put together from halves."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, done, part, span = None, 0, _LETTERS[data], 1
    while True:
        if gram & span:
            piece = part[done : done + n]
            total = piece.copy() if total is None else total * np.uint64(pow(_POWER, span, 2**64)) + piece
            done += span
        if span * 2 > gram:
            return mix(total)
        part = part[: len(part) - span] * np.uint64(pow(_POWER, span, 2**64)) + part[span:]
        span *= 2


def finer(hashes: np.ndarray, starts: np.ndarray, many: int) -> np.ndarray:
    """A key of the least of ``many`` hashes from each start on, in ``FINER`` orders."""
    out, windows = np.zeros(len(starts), np.uint64), np.lib.stride_tricks.sliding_window_view(hashes, many)
    for at in range(0, len(starts), 4096):
        some = windows[starts[at : at + 4096]]
        for k in range(FINER):
            out[at : at + 4096] = mix(out[at : at + 4096] + mix(some + _LETTERS[k]).min(1))
    return out


class Block:
    """The bytes of some documents and their segments."""

    def __init__(self, blob: bytes, least: int, hot: np.ndarray = np.zeros(0, np.uint64), inside: bool = False):
        """``hot``: sorted frequent minimisers.  ``inside``: find out too which segments have their minimiser twice, and so may repeat themselves."""
        gram = min(GRAM, least)
        self.ids, self.offsets, self.data = from_blob(blob)
        flat = np.frombuffer(self.data, np.uint8)
        sizes = np.diff(self.offsets)
        starts, lengths, value, of, twice = [], [], [], [], []
        low, n = 0, len(sizes)
        while low < n:  # pieces that stay in the processor's cache
            high = max(low + 1, int(np.searchsorted(self.offsets, self.offsets[low] + (1 << 18), "right")) - 1)
            base = self.offsets[low]
            hashes = gram_hashes(flat[base : self.offsets[high]], gram)
            least_hash = sliding_min(hashes, least - gram + 1)
            document = np.repeat(np.arange(low, high), sizes[low:high])
            at = np.flatnonzero(document[: len(least_hash)] == document[least - 1 : least - 1 + len(least_hash)]) if len(least_hash) else np.zeros(0, np.int64)
            key = least_hash[at]
            if len(hot) and len(often := np.flatnonzero(hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key)):
                key[often] = finer(hashes, at[often], least - gram + 1)
            s, m = runs_within(key, document[at])
            starts.append(at[s] + base)
            lengths.append(m)
            value.append(key[s])
            of.append(document[at[s]])
            if inside and len(s):
                each = m + least - gram
                first = np.cumsum(each) - each
                same = hashes[np.arange(int(each.sum())) + np.repeat(at[s] - first, each)] == np.repeat(least_hash[at[s]], each)
                twice.append(np.add.reduceat(same.astype(np.int32), first) > 1)
            low = high
        empty = [np.zeros(0, np.int64)]
        self.starts, self.lengths = np.concatenate(starts or empty), np.concatenate(lengths or empty) + least - 1  # bytes
        self.value, self.of = np.concatenate(value or [np.zeros(0, np.uint64)]), np.concatenate(of or empty)
        self.twice = np.concatenate(twice or [np.zeros(0, bool)])

    def distinct(self, wanted: np.ndarray) -> None:
        """Numbers the distinct segments whose value is in the sorted ``wanted``; ``place`` is where the first one starts."""
        if len(wanted):
            at = np.minimum(np.searchsorted(wanted, self.value), len(wanted) - 1)
            self.chosen = np.flatnonzero(wanted[at] == self.value)
        else:
            self.chosen = np.zeros(0, np.int64)
        numbers: dict[bytes, int] = {}
        a, b = self.starts[self.chosen].tolist(), (self.starts + self.lengths)[self.chosen].tolist()
        self.number = np.fromiter((numbers.setdefault(self.data[x:y], len(numbers)) for x, y in zip(a, b)), np.int64, len(a))
        self.strings = list(numbers)
        doc, start = self.ids.numbers[self.of[self.chosen]], self.starts[self.chosen] - self.offsets[self.of[self.chosen]]
        order = np.lexsort((start, doc, self.number))
        heads = order[np.concatenate([[True], np.diff(self.number[order]) > 0])] if len(order) else order
        self.place_doc, self.place_start, self.key = doc[heads], start[heads], self.value[self.chosen[heads]]
        self.later = (doc != self.place_doc[self.number]) | (start != self.place_start[self.number])


def minimisers(least: int):
    """A block's distinct minimisers, and how many bytes each one's distinct segments have."""

    def run(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
        own = Block(blob, least)
        own.distinct(np.unique(own.value))
        keys, of = np.unique(own.key, return_inverse=True)
        return keys, np.bincount(of, [len(x) for x in own.strings], len(keys))

    return run


def send_values(least: int, many: int, hot: np.ndarray):
    def run(block: int, blob: bytes):
        own = Block(blob, least, hot, inside=True)
        value, of, counts = np.unique(own.value, return_inverse=True, return_counts=True)
        counts += np.bincount(of, own.twice, len(value)).astype(np.int64)
        bucket = (value % np.uint64(many)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
            yield int(bucket[group[0]]), pack_arrays(value[group], counts[group] > 1)

    return run


def repeated_values(own: list[int], payloads: list[bytes]):
    """For each block, which of its values occur again, there or in another block."""
    values, again = zip(*map(unpack_arrays, payloads))
    flat = np.concatenate(values)
    order = np.argsort(flat, kind="stable")
    same = flat[order[1:]] == flat[order[:-1]]
    often = np.concatenate(again).astype(bool).copy()
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    at = 0
    for block, v in zip(own, values):
        mine = v[often[at : at + len(v)]]
        at += len(v)
        if len(mine):
            yield block, pack_arrays(np.sort(mine))


def send_segments(least: int, many: int, hot: np.ndarray):
    """From a block and its repeated values: distinct segments to their buckets."""

    def run(block: int, blob: bytes, payloads: list[bytes]):
        own = Block(blob, least, hot)
        own.distinct(_wanted(payloads))
        bucket = (own.key % np.uint64(many)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
            strings = [own.strings[k] for k in group]
            lengths = np.asarray([len(s) for s in strings], np.int64)
            yield int(bucket[group[0]]), pack_arrays(own.key[group], own.place_doc[group], own.place_start[group], group.astype(np.int32), lengths, np.frombuffer(b"".join(strings), np.uint8))

    return run


def _wanted(payloads: list[bytes]) -> np.ndarray:
    found = [unpack_arrays(p)[0] for p in payloads if p[:1] != b"R"]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def suffix_array(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of all strings in order, by prefix doubling: positions, common prefix with the one before, each position's string and the bytes left to its end."""
    flat = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.asarray([len(s) for s in strings], np.int64)
    of = np.repeat(np.arange(len(strings)), lengths)
    left = np.cumsum(lengths)[of] - np.arange(len(flat))
    n = len(flat)
    rank, span, levels = flat.astype(np.int32) + 1, 1, []
    order = np.argsort(rank, kind="stable")
    longest = int(lengths.max(initial=0))
    while True:
        levels.append((span, rank))
        if span >= longest:
            break
        after = np.zeros(n, np.int64)  # 0: the string ends before
        inside = np.flatnonzero(left > span)
        after[inside] = rank[inside + span]
        key = rank.astype(np.int64) * (n + 258) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
        span *= 2
        if rank[order[-1]] == n:
            levels.append((span, rank))
            break
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(0, n - 1), np.int64)
    left_a, left_b = left[a], left[b]
    for span, rank in reversed(levels):
        whole = (left_a >= span) & (left_b >= span)
        i = np.flatnonzero(whole)
        i = i[rank[np.minimum(a[i], n - 1)] == rank[np.minimum(b[i], n - 1)]]
        common[i] += span
        for x, y in ((a, left_a), (b, left_b)):
            x[i] += span
            y[i] -= span
    return order, np.concatenate([[0], common]) if n else np.zeros(0, np.int64), of, left


def intervals(common: np.ndarray, before: np.ndarray, least: int):
    """The nodes of the common-prefix tree with at least ``least`` bytes, children first: (low, high, bytes,
    whether what stands before the occurrences differs).  ``before``: by rank, the byte before, -1 at a start, which differs from all."""
    stack: list[list] = []  # low, bytes, byte before all (-1: they differ)
    values, prior = common.tolist(), before.tolist()
    values.append(0)
    for i in range(1, len(values)):
        size = values[i] if values[i] >= least else 0
        low, letter = i - 1, prior[i - 1]
        while stack and stack[-1][1] > size:
            low, bytes_, seen = stack.pop()
            if seen != letter:
                seen = -1
            yield low, i, bytes_, seen == -1
            letter = seen
        if size:
            if stack and stack[-1][1] == size:
                if stack[-1][2] != letter:
                    stack[-1][2] = -1
            else:
                stack.append([low, size, letter])


class Groups:
    """The maximal repeats of some strings: suffixes of ``least`` bytes and more in order, and groups as intervals of them.

    Occurrence r, of all those in a group's interval, is string ``text[r]`` from ``offset[r]`` on."""

    def __init__(self, strings: list[bytes], least: int):
        order, common, of, left = suffix_array(strings)
        # suffixes too short for a repeat go; what they stood between has no common prefix that counts
        kept = np.flatnonzero(left[order] >= least)
        common = np.where(np.diff(kept, prepend=-2) == 1, common[kept], 0)
        order = order[kept]
        first = np.cumsum([0, *map(len, strings)])
        flat = np.frombuffer(b"".join(strings), np.uint8)
        self.text = of[order]
        self.offset = order - first[self.text]
        before = np.where(self.offset == 0, -1, flat[np.maximum(order - 1, 0)].astype(np.int64)) if len(order) else np.zeros(0, np.int64)
        #: (low, high, bytes), shorter ones behind longer ones inside
        self.found = [(low, high, size) for low, high, size, differ in intervals(common, before, least) if differ]


def maximal_repeats(strings: list[bytes], least: int = LEAST) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """All maximal repeats of at least ``least`` bytes, each with all its occurrences (string, offset)."""
    groups, out = Groups(strings, least), []
    for low, high, size in groups.found:
        where = sorted(zip(groups.text[low:high].tolist(), groups.offset[low:high].tolist()))
        text, at = where[0]
        out.append((strings[text][at : at + size], where))
    return out


def repeated_runs(strings: list[bytes], least: int) -> list[tuple[int, int, int]]:
    """(string, from, to) of all maximal runs of windows of ``least`` bytes whose hash occurs again; the rest repeats nothing."""
    flat = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum([len(s) for s in strings])
    of = np.repeat(np.arange(len(strings), dtype=np.int32), [len(s) for s in strings])
    hashes = gram_hashes(flat, least)
    at = np.flatnonzero(of[: len(hashes)] == of[least - 1 :])
    hashes, order = hashes[at], np.argsort(hashes[at], kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = at[again]
    if not len(at):
        return []
    heads = np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]])) + 1])
    first, last = at[heads], at[np.concatenate([heads[1:], [len(at)]]) - 1]
    string = of[first]
    begin = ends[string] - np.asarray([len(s) for s in strings])[string]
    return list(zip(string.tolist(), (first - begin).tolist(), (last - begin + least).tolist()))


def later_spans(strings: list[bytes], places: list[tuple[int, int]], least: int) -> list[list[tuple[int, int]]]:
    """For each string, spans of the occurrences in ``Groups`` that aren't their group's first; string k starts at ``places[k]``.

    Groups come longest first, so an occurrence gets its span from the first group in which it is a later one;
    it needn't be looked at again in those around, which are shorter."""
    groups = Groups(strings, least)
    text, offset = groups.text, groups.offset
    doc, start = np.asarray(places, np.int64).reshape(-1, 2).T
    doc, start = doc[text], start[text] + offset
    by = np.lexsort((start, doc))
    when = np.empty(len(text), np.int64)
    when[by] = np.cumsum(np.concatenate([[0], (np.diff(doc[by]) != 0) | (np.diff(start[by]) != 0)])[: len(by)])
    spans: list[list[tuple[int, int]]] = [[] for _ in strings]
    when, text, offset = when.tolist(), text.tolist(), offset.tolist()
    head = list(range(len(when) + 1))  # from each occurrence on, the next that has no span yet

    def open_from(r: int) -> int:
        while head[r] != r:
            head[r] = r = head[head[r]]
        return r

    for low, high, size in groups.found:
        own, r = [], open_from(low)
        while r < high:
            own.append(r)
            r = open_from(r + 1)
        first = min([when[x] for x in own])  # a group's first has no span from a group inside
        for x in own:
            if when[x] != first:
                spans[text[x]].append((offset[x], offset[x] + size))
                head[x] = x + 1
    return spans


def spans_in(strings: list[bytes], places: list[tuple[int, int]], least: int) -> list[list[tuple[int, int]]]:
    """``later_spans`` of strings of which most repeat nothing: only their repeated runs, each distinct one once, are sorted."""
    spans: list[list[tuple[int, int]]] = [[] for _ in strings]
    runs: dict[bytes, list[tuple[int, int, int, int, int]]] = {}
    for k, a, b in repeated_runs(strings, least):
        runs.setdefault(strings[k][a:b], []).append((places[k][0], places[k][1] + a, k, a, b))
    for own in runs.values():
        lead = min(own)
        for doc, start, k, a, b in own:
            if (doc, start) != lead[:2]:
                spans[k].append((a, b))
    for found, own in zip(later_spans(list(runs), [min(o)[:2] for o in runs.values()], least) if runs else [], runs.values()):
        doc, start = min(own)[:2]
        for d, s, k, a, _ in own:
            if (d, s) == (doc, start):
                spans[k] += [(a + x, a + y) for x, y in found]
    return spans


def reply(least: int):
    """For each block, spans of its segments (number, from, to) that start earlier elsewhere."""

    def run(own: list[int], payloads: list[bytes]):
        by_value: dict[int, dict[bytes, list[tuple[int, int, int, int]]]] = {}
        for k, payload in enumerate(payloads):
            keys, docs, starts, numbers, lengths, data = unpack_arrays(payload)
            raw, at = data.tobytes(), 0
            for key, doc, start, number, n in zip(keys.tolist(), docs.tolist(), starts.tolist(), numbers.tolist(), lengths.tolist()):
                by_value.setdefault(key, {}).setdefault(raw[at : at + n], []).append((doc, start, k, number))
                at += n
        out: dict[int, list[tuple[int, int, int]]] = {}
        held: list[bytes] = []
        firsts: list[tuple[int, int, int, int]] = []
        size = 0

        def search():
            for spans, (doc, start, _, _), string in zip(spans_in(held, [f[:2] for f in firsts], least), firsts, held):
                for a, b in spans:
                    for d, s, k, number in at_first[string]:
                        if (d, s) == (doc, start):
                            out.setdefault(k, []).append((number, a, b))

        at_first: dict[bytes, list[tuple[int, int, int, int]]] = {}
        for key, strings in by_value.items():
            for string, entries in strings.items():
                lead = min(entries)
                for doc, start, k, number in entries:
                    if (doc, start) != lead[:2]:
                        out.setdefault(k, []).append((number, 0, len(string)))
                if len(strings) > 1 or _again(string, least):
                    held.append(string)
                    firsts.append(lead)
                    at_first[string] = entries
                    size += len(string)
            if size > SORTED:
                search()
                held, firsts, at_first, size = [], [], {}, 0
        if held:
            search()
        for k, rows in out.items():
            yield own[k], b"R" + pack_arrays(*(np.asarray(c, np.int32) for c in zip(*rows)))

    return run


def _again(string: bytes, least: int) -> bool:
    """Whether a segment may repeat itself: its minimiser would occur in it twice."""
    grams = gram_hashes(np.frombuffer(string, np.uint8), min(GRAM, least))
    return int((grams == grams.min()).sum()) > 1


OUT = pa.schema([("doc_id", pa.int64()), ("text_md5", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def _finish(least: int, hot: np.ndarray, digest: bool, characters: bool):
    def run(blob: bytes, payloads: list[bytes]) -> pa.RecordBatch:
        own = Block(blob, least, hot)
        own.distinct(_wanted(payloads))
        change = np.zeros(len(own.data) + 1, np.int64)
        begin = own.starts[own.chosen]
        np.add.at(change, begin[own.later], 1)
        np.add.at(change, (begin + own.lengths[own.chosen])[own.later], -1)
        found = [unpack_arrays(p[1:]) for p in payloads if p[:1] == b"R"]
        if found:
            number, a, b = (np.concatenate(c).astype(np.int64) for c in zip(*found))
            first = np.flatnonzero(~own.later)  # more than one only for repeated rows
            order = first[np.argsort(own.number[first], kind="stable")]
            low, high = np.searchsorted(own.number[order], number), np.searchsorted(own.number[order], number, "right")
            many = high - low
            which = np.repeat(np.arange(len(number)), many)
            at = begin[order[np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + low[which]]]
            np.add.at(change, at + a[which], 1)
            np.add.at(change, at + b[which], -1)
        gone = np.cumsum(change[:-1]) > 0
        flat = np.frombuffer(own.data, np.uint8)
        if characters and len(flat):
            heads = np.flatnonzero((flat & 0xC0) != 0x80)
            gone = np.repeat(np.logical_and.reduceat(gone, heads), np.diff(np.concatenate([heads, [len(flat)]])))
        removed, spans, kept, md5 = [], [], [], []
        for x, y in zip(own.offsets[:-1].tolist(), own.offsets[1:].tolist()):
            lost = gone[x:y]
            n = int(lost.sum())
            removed.append(n)
            spans.append(int((lost[1:] & ~lost[:-1]).sum() + lost[0]) if n else 0)
            text = flat[x:y][~lost].tobytes() if n else own.data[x:y]
            kept.append(hashlib.sha256(text).digest() if digest else text)
            md5.append(hashlib.md5(own.data[x:y]).hexdigest())
        return batch(OUT, doc_id=own.ids.column(), text_md5=md5, n_bytes=np.diff(own.offsets), n_removed=removed, n_spans=spans, kept=kept)

    return run


def remove_repeats(docs: DataFrame, least: int = LEAST, digest: bool = False, characters: bool = False) -> DataFrame:
    """(doc_id, text_md5 of the whole text, n_bytes, n_removed, n_spans, kept): each document without the bytes covered by a string of
    ``least`` bytes that also starts earlier, in a smaller doc_id or before in the same document; ``kept``
    has the remaining bytes or their SHA-256.  ``kept`` need not be UTF-8, unless ``characters`` are asked
    for: then those of which a byte stays do stay whole.

    Null texts are empty.  Rows with the same id start at the same places, so neither is earlier; a row
    without an id comes after all others."""
    stored = blocks(texts(docs))
    hot = frequent(stored, minimisers(least), 1 / (2 * stored.buckets(MOVED_SEGMENTS)))
    many = stored.buckets(MOVED_VALUES)
    values = answer(scatter(stored, send_values(least, many, hot)), many, repeated_values)
    many = stored.buckets(MOVED_SEGMENTS)
    segment = send_segments(least, many, hot)

    def ship(block: int, blob: bytes, payloads: list[bytes]) -> pa.Table:
        rows = list(segment(block, blob, payloads))
        return pa.Table.from_batches([batch(MESSAGE_SCHEMA, bucket=[r[0] for r in rows], block=[block] * len(rows), payload=[r[1] for r in rows])])

    replies = answer(by_block(stored, values, ship, MESSAGE), many, reply(least))
    return resolve(stored, values.unionByName(replies), _finish(least, hot, digest, characters), "doc_id long, text_md5 string, n_bytes long, n_removed long, n_spans long, kept binary")
