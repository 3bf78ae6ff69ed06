"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of contexts of up to ``ORDER`` bytes with the counts of the bytes that follow them in the
training documents.  A byte's probability is looked up from the longest context down; escapes are estimated by
method D, and bytes that a longer context knows are excluded from a shorter one's counts.  With whole counts,
what a context knows its suffixes know too, so a byte's probability depends on its ``ORDER`` bytes of context
only: it is worked out once for each distinct string of ``ORDER + 1`` bytes.

Blocks of documents send their distinct strings, with training counts, to buckets by the context's last two
bytes; there all counts of contexts of two bytes or more are local, and shorter contexts have at most 65,536
counts, which the driver hands on.  Strings of a frequent pair are dealt by the context's last three bytes, and
the pair's own counts (256 at the most) are handed on too.  Buckets answer with log probabilities.  Words travel
the same way for the unigram base.  Nothing the size of the corpus is broadcast or collected."""

from __future__ import annotations

import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import answer, batch, blocks, checkpoint, frequent, from_blob, mix, pack_arrays, relaxing, resolve, scatter, texts, unpack_arrays

ORDER = 5
#: Ends a document; no word has this byte, nor the blank between words.
END = 10
#: Text bytes whose strings are worked on together.
PIECE = 1 << 20
GRAMS, WORDS = 0, 1
#: Bytes of messages for each byte of the blocks.
MOVED = 0.9
#: Block of the words' totals.
EVERYWHERE = -1


def trains(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 != 2


class Block:
    """Tokens and strings of some documents."""

    def __init__(self, blob: bytes):
        self.ids, offsets, data = from_blob(blob)
        data = data.lower()
        self.tokens = [data[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        self.trains = np.asarray([trains(i) for i in self.ids.column().to_pylist()], bool)

    def pieces(self):
        """(first document, one past the last, strings as numbers, where each document's begin)."""
        at, n = 0, len(self.tokens)
        pad = bytes([END]) * ORDER
        while at < n:
            end, size, raw = at, 0, []
            while end < n and (end == at or size < PIECE):
                raw.append(b" ".join(self.tokens[end]) + bytes([END]))
                size += len(raw[-1])
                end += 1
            sizes = np.asarray([len(x) for x in raw], np.int64)
            flat = np.frombuffer(pad + pad.join(raw), np.uint8).astype(np.uint64)
            grams = flat[ORDER:].copy()
            for k in range(1, ORDER + 1):
                grams |= flat[ORDER - k : len(flat) - k] << np.uint64(8 * k)
            starts = np.cumsum(sizes) - sizes
            real = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)) * ORDER, sizes)
            yield at, end, grams[real], starts
            at = end

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct strings and their training counts."""
        found, counts = [], []
        for a, b, grams, starts in self.pieces():
            learnt = np.repeat(self.trains[a:b], np.diff(np.concatenate([starts, [len(grams)]])))
            keys = np.sort(grams << np.uint64(1) | learnt)  # sorted once, the flag in the lowest bit
            grams = keys >> np.uint64(1)
            heads = _heads(grams)
            found.append(grams[heads])
            counts.append(np.add.reduceat((keys & np.uint64(1)).astype(np.int64), heads))
        return merged(np.concatenate(found), np.concatenate(counts)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def words(self) -> tuple[list[bytes], np.ndarray]:
        """The distinct tokens, the first and empty one is a document's end, and which one each word is."""
        coded = pa.array([b"", *chain.from_iterable(self.tokens)], pa.large_binary()).dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.to_numpy()[1:].astype(np.int64)

    def word_counts(self) -> tuple[list[bytes], np.ndarray]:
        """The distinct tokens and their training counts."""
        words, flat = self.words()
        counts = np.bincount(flat[np.repeat(self.trains, [len(t) for t in self.tokens])], minlength=len(words))
        counts[0] = self.trains.sum()
        return words, counts

    def sums(self, logs_of) -> np.ndarray:
        """For each document the sum over its strings of what ``logs_of`` gives for the block's distinct ones, in order."""
        held, every = [], []
        for a, b, grams, starts in self.pieces():
            order = np.argsort(grams).astype(np.int32)
            grams = grams[order]
            heads = _heads(grams)
            every.append(grams[heads])
            held.append((a, b, starts, order, np.diff(np.concatenate([heads, [len(grams)]]))))
        out = np.zeros(len(self.tokens))
        if held:
            grams = np.sort(np.concatenate(every))
            grams = grams[_heads(grams)]
            logs = logs_of(grams)
            for (a, b, starts, order, many), own in zip(held, every):
                each = np.empty(len(order))
                each[order] = np.repeat(logs[np.searchsorted(grams, own)], many)
                out[a:b] = np.add.reduceat(each, starts)
        return out


def _heads(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1]) if len(ordered) else np.zeros(0, np.int64)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their sums."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = _heads(keys)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def _pair(grams: np.ndarray) -> np.ndarray:
    """The last two bytes of the context."""
    return grams >> np.uint64(8) & np.uint64(0xFFFF)


def _is_hot(grams: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Whether the context's last two bytes are one of the frequent pairs."""
    flags = np.zeros(1 << 16, bool)
    flags[hot.astype(np.int64)] = True
    return flags[_pair(grams).astype(np.int64)]


def _gram_bucket(grams: np.ndarray, many: int, hot: np.ndarray) -> np.ndarray:
    context = np.where(_is_hot(grams, hot), grams >> np.uint64(8) & np.uint64(0xFFFFFF) | np.uint64(1 << 24), _pair(grams))
    return (mix(context) % np.uint64(many)).astype(np.int64)


def _word_bucket(words: list[bytes], many: int) -> np.ndarray:
    return (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(many)).astype(np.int64)


def _groups(bucket: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []


def send(many: int, hot: np.ndarray):
    def run(block: int, blob: bytes):
        own = Block(blob)
        grams, counts = own.grams()
        for group in _groups(bucket := _gram_bucket(grams, many, hot)):
            steps = np.diff(grams[group], prepend=np.uint64(0))
            yield int(bucket[group[0]]), bytes([GRAMS]) + pack_arrays(steps, counts[group].astype(np.uint32))
        words, counts = own.word_counts()
        for group in _groups(bucket := _word_bucket(words, many)):
            some = [words[k] for k in group]
            yield int(bucket[group[0]]), bytes([WORDS]) + pack_arrays(np.asarray([len(w) for w in some], np.int32), counts[group].astype(np.uint32), np.frombuffer(b"".join(some), np.uint8), bucket[group[:1]])

    return run


def log_probabilities(grams: np.ndarray, counts: np.ndarray, short: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """log10 of the probability of each string's last byte after the others.

    ``short[a, s]`` counts byte s after a.  ``grams`` are distinct and complete for their contexts' last two bytes, or,
    with ``pairs``, for the last three: ``pairs`` are strings of three bytes, in order, and their counts."""
    n = len(grams)
    out, done = np.zeros(n), np.zeros(n, bool)
    last, before = (grams & np.uint64(255)).astype(np.int64), (grams >> np.uint64(8) & np.uint64(255)).astype(np.int64)
    single = short.sum(0)
    known_more, inside = np.zeros(n), np.zeros(n)  # bytes that the longer context knows, and their counts in this one

    def step(seen: np.ndarray, total: np.ndarray, known: np.ndarray) -> None:
        total, known = total - inside, known - known_more
        live = ~done & (known > 0)
        hit = live & (seen > 0)
        miss = live & ~hit
        out[hit] += np.log10((seen[hit] - 0.5) / total[hit])
        out[miss] += np.log10(0.5 * known[miss] / total[miss])
        done[hit] = True

    keys, sums = grams, counts  # strings with the order's context, and where each gram's is
    of = np.arange(n)
    for order in range(ORDER, 1, -1):
        if order == 2 and pairs:  # counts of all strings with these contexts, not of those here alone
            of = np.searchsorted(pairs[0], keys)[of]
            keys, sums = pairs
        contexts, context_of = np.unique(keys >> np.uint64(8), return_inverse=True)
        total = np.bincount(context_of, sums, len(contexts))
        known = np.bincount(context_of, sums > 0, len(contexts))
        mine = context_of[of]
        step(sums[of], total[mine], known[mine])
        known_more = known[mine]
        shorter = keys & np.uint64((1 << (8 * order)) - 1)
        if order > 2:
            short_keys, short_of = np.unique(shorter, return_inverse=True)
            if order == 3 and pairs:
                at = np.minimum(np.searchsorted(pairs[0], short_keys), len(pairs[0]) - 1)
                short_sums = np.where(pairs[0][at] == short_keys, pairs[1][at], 0)
            else:
                short_sums = np.bincount(short_of, sums, len(short_keys)).astype(np.int64)
            inside = np.bincount(context_of, np.where(sums > 0, short_sums[short_of], 0), len(contexts))[mine]
            keys, sums, of = short_keys, short_sums, short_of[of]
        else:
            counted = short[(shorter >> np.uint64(8)).astype(np.int64), (shorter & np.uint64(255)).astype(np.int64)]
            inside = np.bincount(context_of, np.where(sums > 0, counted, 0), len(contexts))[mine]
    step(short[before, last], short.sum(1)[before], (short > 0).sum(1)[before])
    known_more = (short > 0).sum(1)[before]
    inside = np.where(short > 0, single[None, :], 0).sum(1)[before]
    step(single[last], np.full(n, single.sum()), np.full(n, (single > 0).sum()))
    out[~done] -= np.log10(max(1, 256 - (single > 0).sum()))
    return out


def reply(short: np.ndarray, hot: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]):
    def run(own: list[int], payloads: list[bytes]):
        sent = [(block, p[0], unpack_arrays(p[1:])) for block, p in zip(own, payloads)]
        grams = [(block, np.cumsum(a[0], dtype=np.uint64), a[1]) for block, kind, a in sent if kind == GRAMS]
        if grams:
            keys, counts = merged(np.concatenate([g[1] for g in grams]), np.concatenate([g[2] for g in grams]).astype(np.int64))
            frequent_, logs = _is_hot(keys, hot), np.zeros(len(keys))
            logs[~frequent_] = log_probabilities(keys[~frequent_], counts[~frequent_], short)
            if frequent_.any():
                own = np.isin(pairs[0] >> np.uint64(8), np.unique(_pair(keys[frequent_])))
                logs[frequent_] = log_probabilities(keys[frequent_], counts[frequent_], short, (pairs[0][own], pairs[1][own]))
            for block, mine, _ in grams:
                at = np.searchsorted(keys, mine)
                yield block, bytes([GRAMS]) + pack_arrays(mine[:1], logs[at])
        number: dict[bytes, int] = {}
        rows = []
        for block, kind, a in sent:
            if kind == WORDS:
                raw, ends = a[2].tobytes(), np.cumsum(a[0]).tolist()
                rows.append((block, np.fromiter((number.setdefault(raw[x:y], len(number)) for x, y in zip([0, *ends], ends)), np.int64, len(ends)), a[1], a[3]))
        if rows:
            counts = np.zeros(len(number), np.int64)
            for _, at, n, _ in rows:
                counts[at] += n
            for block, at, _, bucket in rows:
                yield block, bytes([WORDS]) + pack_arrays(bucket, counts[at])
            yield EVERYWHERE, struct.pack("<2q", int(counts.sum()), int((counts > 0).sum()))

    return run


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def finish(many: int, hot: np.ndarray, total: int, distinct: int):
    def run(blob: bytes, payloads: list[bytes]) -> pa.RecordBatch:
        own = Block(blob)
        answers = [(p[0], unpack_arrays(p[1:])) for p in payloads]
        by_first = {int(a[0][0]): a[1] for kind, a in answers if kind == GRAMS}

        def logs_of(grams: np.ndarray) -> np.ndarray:
            logs = np.zeros(len(grams))
            for group in _groups(_gram_bucket(grams, many, hot)):
                logs[group] = by_first[int(grams[group[0]])]
            return logs

        score = own.sums(logs_of)
        words, flat = own.words()
        counts = np.zeros(len(words), np.int64)
        by_bucket = {int(a[0][0]): a[1] for kind, a in answers if kind == WORDS}
        for group in _groups(bucket := _word_bucket(words, many)):
            counts[group] = by_bucket[int(bucket[group[0]])]
        sizes = np.asarray([len(t) for t in own.tokens], np.int64)
        starts = np.cumsum(sizes) - sizes
        total_of = lambda v: np.add.reduceat(np.concatenate([v[flat], [0]]), starts) * (sizes > 0)
        gain = np.log10(counts + 1.0)
        base = total_of(gain) + gain[0] - (sizes + 1) * np.log10(total + distinct + 1)
        known = total_of((counts > 0).astype(np.int64)) + (counts[0] > 0)
        return batch(OUT, doc_id=own.ids.column(), held_out=~own.trains, n_tokens=sizes + 1, n_known=known, train_tokens=[total] * len(sizes), base_score=base, score=score)

    return run


def _all_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The contexts' last two bytes and how often each occurs in a block."""
    counts = np.zeros(1 << 16, np.int64)
    for _, _, grams, _ in Block(blob).pieces():
        counts += np.bincount(_pair(grams).astype(np.int64), minlength=1 << 16)
    keys = np.flatnonzero(counts)
    return keys.astype(np.uint64), counts[keys]


def _short_counts(hot: np.ndarray):
    """Training counts of strings of two bytes, and of those of three behind frequent pairs; these have the higher numbers."""
    place = np.zeros(1 << 16, np.int64)
    place[hot.astype(np.int64)] = np.arange(len(hot)) * 256

    def run(batches):
        for b in batches:
            for blob in b.column(0):
                own, counts = Block(blob.as_py()), np.zeros((1 << 16) + 256 * len(hot), np.int64)
                for first, last, grams, starts in own.pieces():
                    learnt = np.repeat(own.trains[first:last], np.diff(np.concatenate([starts, [len(grams)]])))
                    grams = grams[learnt]
                    counts[: 1 << 16] += np.bincount((grams & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)
                    grams = grams[_is_hot(grams, hot)]
                    counts[1 << 16 :] += np.bincount(place[_pair(grams).astype(np.int64)] + (grams & np.uint64(255)).astype(np.int64), minlength=256 * len(hot))
                keys = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts[keys])], names=["pair", "n"])

    return run


def _totals(batches):
    for b in batches:
        found = [struct.unpack("<2q", p) for p in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["n", "v"])


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    The model's text is that of the tokens: words in lower case, one blank between them, then an end.  Null
    texts have the end alone.  A row without an id trains (its doc_id as text is empty).  Repeated rows count
    each.  If nothing trains, all bytes are as likely."""
    stored = blocks(texts(docs))
    many = stored.buckets(MOVED)
    hot = frequent(stored, _all_pairs, 1 / (2 * many))
    short, triples = np.zeros((256, 256)), np.zeros(256 * len(hot), np.int64)
    found = stored.table.select("blob").mapInArrow(relaxing(_short_counts(hot)), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for r in found.collect():  # 65,536 rows at the most, and 256 for each of 2 * many pairs
        if r["pair"] < 1 << 16:
            short[r["pair"] >> 8, r["pair"] & 255] = r["n"]
        else:
            triples[r["pair"] - (1 << 16)] = r["n"]
    pairs = (np.repeat(hot << np.uint64(8), 256) + np.tile(np.arange(256, dtype=np.uint64), len(hot)), triples)
    replies = checkpoint(answer(scatter(stored, send(many, hot)), many, reply(short, hot, pairs)))
    both = replies.where(F.col("block") == EVERYWHERE).select("payload").mapInArrow(_totals, "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return resolve(stored, replies.where(F.col("block") != EVERYWHERE), finish(many, hot, both["n"] or 0, both["v"] or 0), schema)
