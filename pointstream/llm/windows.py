"""Repeated word windows by super-k-mers.

A window is ``width`` consecutive words of one document.  Windows in a row that share a minimiser (the least
hash of ``WIDE`` words inside) travel as one string, a super-k-mer, to the bucket of that minimiser, so equal
windows meet in one bucket.  Documents are handled in blocks: a block sends each distinct super-k-mer once,
with the smallest doc_id that has it, so a passage in a third of all rows costs a row a block.  A bucket sorts
its windows and answers which ones start in a smaller document than the sender's smallest.

Windows of a frequent minimiser travel one by one, dealt by a hash of all their words, so that no minimiser,
however frequent, makes a bucket larger than others."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import answer, batch, blocks, frequent, from_blob, mix, pack_arrays, resolve, scatter, texts, unpack_arrays

WIDTH = 13
#: Words in what minimisers are chosen from: single words would make hot buckets.
WIDE = 3
#: Bytes of messages for each byte of the blocks.
MOVED = 3.4
_PLACES = mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def sliding_min(values: np.ndarray, many: int) -> np.ndarray:
    """The least of each ``many`` neighbours."""
    if len(values) < many:
        return values[:0]
    span, low = 1, values
    while span * 2 <= many:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    return np.minimum(low[: len(values) - many + 1], low[many - span : many - span + len(values) - many + 1])


def runs_within(value: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values in one document."""
    if not len(value):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero((value[1:] != value[:-1]) | (document[1:] != document[:-1])) + 1])
    return starts, np.diff(np.concatenate([starts, [len(value)]]))


class Block:
    """The words of some documents and their super-k-mers; the same blob always gives the same ones."""

    def __init__(self, blob: bytes, width: int, hot: np.ndarray = np.zeros(0, np.uint64)):
        """``hot``: sorted minimisers whose windows are super-k-mers of their own."""
        self.ids, offsets, data = from_blob(blob)
        split = [data[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        self.counts = np.asarray([len(s) for s in split], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.words = words = [w for s in split for w in s]
        del split
        number = pa.array(words, pa.large_binary()).dictionary_encode()
        distinct = number.dictionary.to_pylist()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
        flat = hashes[number.indices.to_numpy()]
        del number, distinct
        wide = min(WIDE, width)
        grams = np.zeros(max(0, len(flat) - wide + 1), np.uint64)
        for k in range(wide):
            grams += flat[k : k + len(grams)] * _PLACES[k]
        least = sliding_min(mix(grams), width - wide + 1)
        document = np.repeat(np.arange(len(self.counts)), self.counts)
        at = np.flatnonzero(document[: len(least)] == document[width - 1 : width - 1 + len(least)]) if len(least) else np.zeros(0, np.int64)
        key = least[at]
        if len(hot):
            often = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key)
            whole = np.zeros(len(often), np.uint64)
            for k in range(width):
                whole += flat[at[often] + k] * _PLACES[64 + k]
            key[often] = mix(whole)  # differs from window to window
        starts, self.lengths = runs_within(key, document[at])
        self.starts, self.key_of = at[starts], key[starts]  # word positions; windows in a row are as many
        self.of = document[self.starts]
        numbers: dict[bytes, int] = {}
        ends = self.starts + self.lengths + width - 1
        self.kmer = np.fromiter((numbers.setdefault(b" ".join(words[a:b]), len(numbers)) for a, b in zip(self.starts.tolist(), ends.tolist())), np.int64, len(ends))
        self.strings = list(numbers)
        self.smallest = np.full(len(numbers), np.iinfo(np.int64).max)
        np.minimum.at(self.smallest, self.kmer, self.ids.numbers[self.of])
        first = np.zeros(len(numbers), np.int64)
        first[self.kmer[::-1]] = np.arange(len(self.kmer))[::-1]
        self.key = self.key_of[first]


def minimisers(width: int):
    """The distinct minimisers of a block's super-k-mers, and how many bytes each one's distinct super-k-mers have."""

    def run(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
        own = Block(blob, width)
        keys, of = np.unique(own.key, return_inverse=True)
        return keys, np.bincount(of, [len(x) for x in own.strings], len(keys))

    return run


def send(width: int, many: int, hot: np.ndarray):
    def run(block: int, blob: bytes):
        own = Block(blob, width, hot)
        bucket = (own.key % np.uint64(many)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for group in np.split(order, cuts) if len(order) else []:
            strings = [own.strings[k] for k in group]
            lengths = np.asarray([len(s) for s in strings], np.int32)
            yield int(bucket[group[0]]), pack_arrays(own.smallest[group], group.astype(np.int32), lengths, np.frombuffer(b"".join(strings), np.uint8))

    return run


def equal_groups(columns: np.ndarray, width: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of ``starts`` that has equal windows together, and where groups begin in it.

    Sorted by a hash; groups are then compared word by word, and another hash is tried should any differ."""
    for seed in range(8):
        random = mix(np.arange(int(columns.max(initial=0)) + 1, dtype=np.uint64) + np.uint64(seed * 0x51ED27 + 1))
        value, h = random[columns], np.zeros(len(starts), np.uint64)
        for k in range(width):
            h += value[starts + k] * _PLACES[64 * seed + k]
        order = np.argsort(h, kind="stable")
        h = h[order]
        same = np.flatnonzero(h[1:] == h[:-1])
        if all((columns[starts[order[same]] + k] == columns[starts[order[same + 1]] + k]).all() for k in range(width)):
            return order, np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1]) if len(h) else np.zeros(0, np.int64)
    raise AssertionError("eight 64-bit hashes in a row collided")


def numbered(lengths: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words each of some strings has, and a number for each word, the same for equal ones.  The strings lie one after
    the other in ``data`` (uint8) and have ``lengths`` bytes; one blank parts their words."""
    blanks, ends = np.flatnonzero(data == 32), np.cumsum(lengths, dtype=np.int64)
    counts = np.diff(np.searchsorted(blanks, ends), prepend=0) + 1
    # without the blanks, words end where these or strings did
    at = np.sort(np.concatenate([blanks, ends]))
    offsets = np.concatenate([[0], at - np.searchsorted(blanks, at)])
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[data != 32])])
    return counts, words.dictionary_encode().indices.to_numpy()


def reply(width: int):
    """For each block, runs of windows (super-k-mer, from, to) that a smaller document has."""

    def run(own: list[int], payloads: list[bytes]):
        entries = [unpack_arrays(p) for p in payloads]
        smallest = np.concatenate([e[0] for e in entries])
        sender = np.repeat(np.arange(len(entries)), [len(e[0]) for e in entries])
        counts, columns = numbered(*(np.concatenate([e[k] for e in entries]) for k in (2, 3)))
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        windows = counts - width + 1
        entry = np.repeat(np.arange(len(counts)), windows)
        within = np.arange(len(entry)) - np.repeat(np.cumsum(windows) - windows, windows)
        order, groups = equal_groups(columns, width, first[entry] + within)
        least = np.minimum.reduceat(smallest[entry[order]], groups)
        repeated = np.zeros(len(entry), bool)
        repeated[order] = np.repeat(least, np.diff(np.concatenate([groups, [len(order)]]))) < smallest[entry[order]]
        at = np.flatnonzero(repeated)
        if not len(at):
            return
        heads = np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1] + 1) | (entry[at[1:]] != entry[at[:-1]])) + 1])
        ends = np.concatenate([heads[1:], [len(at)]]) - 1
        kmers = np.concatenate([e[1] for e in entries])
        e = entry[at[heads]]
        for k in np.unique(sender[e]):
            mine = sender[e] == k
            yield own[k], pack_arrays(kmers[e[mine]], within[at[heads[mine]]].astype(np.int32), within[at[ends[mine]]].astype(np.int32) + 1)

    return run


def covered(own: Block, payloads: list[bytes], width: int) -> np.ndarray:
    """Which words to remove."""
    change = np.zeros(len(own.words) + 1, np.int64)
    # the block itself knows of a smaller document for all but the smallest
    own_later = np.flatnonzero(own.ids.numbers[own.of] > own.smallest[own.kmer])
    np.add.at(change, own.starts[own_later], 1)
    np.add.at(change, own.starts[own_later] + own.lengths[own_later] + width - 1, -1)
    if payloads:
        kmer, a, b = (np.concatenate(c).astype(np.int64) for c in zip(*map(unpack_arrays, payloads)))
        order = np.argsort(own.kmer, kind="stable")  # occurrences by super-k-mer
        low, high = np.searchsorted(own.kmer[order], kmer), np.searchsorted(own.kmer[order], kmer, "right")
        many = high - low
        which = np.repeat(np.arange(len(kmer)), many)
        at = own.starts[order[np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + low[which]]]
        np.add.at(change, at + a[which], 1)
        np.add.at(change, at + b[which] + width - 1, -1)
    return np.cumsum(change[:-1]) > 0


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def _finish(width: int, digest: bool, hot: np.ndarray):
    def run(blob: bytes, payloads: list[bytes]) -> pa.RecordBatch:
        own = Block(blob, width, hot)
        gone = covered(own, payloads, width)
        kept = []
        for a, b in zip(own.first[:-1].tolist(), own.first[1:].tolist()):
            lost = gone[a:b]
            words = [w for w, x in zip(own.words[a:b], lost.tolist()) if not x] if lost.any() else own.words[a:b]
            text = b" ".join(words)
            kept.append(hashlib.sha256(text).digest() if digest else text)
        removed = np.add.reduceat(np.concatenate([gone, [False]]).astype(np.int64), own.first[:-1]) * (own.counts > 0)
        return batch(OUT, doc_id=own.ids.column(), n_words=own.counts, n_removed=removed, kept=kept)

    return run


def remove_repeated_windows(docs: DataFrame, width: int = WIDTH, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without words covered by a window that also starts
    in a document with a smaller doc_id; ``kept`` has the remaining words, joined by one space, or the
    SHA-256 of that.

    Null texts have no words.  Texts with fewer than ``width`` words stay whole.  Rows with the same id are
    no smaller than each other; a row without an id comes after all others."""
    stored = blocks(texts(docs))
    many = stored.buckets(MOVED)
    hot = frequent(stored, minimisers(width), 1 / (2 * many))
    replies = answer(scatter(stored, send(width, many, hot)), many, reply(width))
    return resolve(stored, replies, _finish(width, digest, hot), "doc_id long, n_words long, n_removed long, kept binary")
