"""Byte-level BPE by DuckDB's recursive queries.

Each task finds its distinct words (matches of the splitting pattern) and hands them to a DuckDB of its
own: rows (word, position, token) join the merge table, every word contracts its leftmost pair of least
rank, until no word has a pair left.  Ordered aggregation of the tokens' bytes decodes.  Results stay in a
bounded cache by chunk of text (see ``chunks``), and Arrow numbers the chunks of many texts, so only distinct ones are
looked up."""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .chunks import KEPT_CHARACTERS, chunk, joined, split
from .common import Generations, batch, parts, relaxing, texts

#: Longer words (in bytes; positions have 8 bits in the query) are contracted outside SQL by the same rule, as a query's steps times its rows grow with the square of the length.
LONG_WORD = 255
#: Words in one recursive query; with 50,000 it took 5 to 20 % more time a word.
WORDS = 10_000
#: Words whose tokens are decoded together.
DECODED = 50_000
#: Text bytes whose chunks are numbered, and whose new words are solved, together.
TOGETHER = 12 << 20
#: Entries of a generation of each of the two caches in a worker; chunks and words over ``KEPT_CHARACTERS`` don't stay in them.
KEPT = 300_000

ENCODE = """
WITH RECURSIVE step(it, k, t) AS (
    SELECT 0, k, t FROM bytes_of_words
  UNION ALL
    SELECT it + 1, k, CASE WHEN k = head THEN (best >> 40)::INT ELSE t END
    FROM step s JOIN (
        SELECT w, best, best & 4294967295 AS head, best >> 32 & 255 AS size FROM (
            SELECT c.k >> 8 AS w, min((m.merged::BIGINT << 40) | (m.size::BIGINT << 32) | c.k) AS best
            FROM (SELECT k, t, lead(k) OVER o AS next_k, lead(t) OVER o AS next_t FROM step WINDOW o AS (ORDER BY k)) c
            JOIN merges m ON m.l = c.t AND m.r = c.next_t
            WHERE next_k >> 8 = k >> 8 GROUP BY 1
        )
    ) b ON b.w = s.k >> 8
    WHERE k <= head OR k >= head + size
), ended AS (SELECT k >> 8 AS w, max(it) AS it FROM step GROUP BY 1)
SELECT (s.k >> 8)::INT AS w, (s.k & 255)::INT AS p, s.t FROM step s JOIN ended e ON e.w = s.k >> 8 AND e.it = s.it
"""
DECODE = """
SELECT w, array_to_string(list(t ORDER BY p), ',') AS ids, count(*) AS n, array_to_string(list(hex(v.piece) ORDER BY p), '') AS decoded
FROM encoded JOIN vocabulary v ON v.id = t GROUP BY w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same contraction for one word with a heap of pairs: n log n steps."""
    n = len(word)
    piece, after, before = [word[i : i + 1] for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (r := ranks.get(piece[i] + piece[after[i]])) is not None:
            heapq.heappush(heap, (r, i, piece[i], piece[after[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        if piece[i] is not a and piece[i] != a or after[i] >= n or piece[after[i]] != b or not piece[i]:
            continue
        j = after[i]
        piece[i], piece[j], after[i] = a + b, b"", after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [ranks[x] for x in piece if x]


class BpeCodec:
    """Encodes and decodes by the ranks of a vocabulary file; ids and decoded bytes of texts."""

    def __init__(self, path: str, pattern: str, most: int = KEPT):
        import duckdb

        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        self.pieces = {i: x for x, i in self.ranks.items()}
        self.of_byte = np.asarray([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.cache = Generations(most)
        self.words = Generations(most)
        # all in memory: what a worker spilt would lie in a folder of its own
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": "", "preserve_insertion_order": False})
        merges = [(self.ranks[x[:k]], self.ranks[x[k:]], i, len(x)) for x, i in self.ranks.items() if len(x) <= LONG_WORD for k in range(1, len(x)) if x[:k] in self.ranks and x[k:] in self.ranks]
        self._load("merges", **{name: [m[k] for m in merges] for k, name in enumerate(("l", "r", "merged", "size"))})
        self._load("vocabulary", id=list(self.pieces), piece=list(self.pieces.values()))

    def _load(self, name: str, **columns: list | np.ndarray) -> None:
        given = pa.table({k: pa.array(v) if isinstance(v, np.ndarray) else pa.array(v, pa.int32() if not v or isinstance(v[0], int) else pa.binary()) for k, v in columns.items()})
        self.db.register("given", given)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def solve(self, words: list[str]) -> dict[str, tuple[str, int, bytes]]:
        """For distinct words their ids (decimal, joined by commas), how many, and what these decode to."""
        raw = [w.encode("utf-8") for w in words]
        single = {k: self.ranks[x] for k, x in enumerate(raw) if x in self.ranks}  # a whole word that is a token stays one
        long = {k: heap_merge(x, self.ranks) for k, x in enumerate(raw) if len(x) > LONG_WORD and k not in single}
        rest = [k for k in range(len(raw)) if k not in single and k not in long]
        self.db.execute("CREATE OR REPLACE TEMP TABLE encoded (w INT, p INT, t INT)")
        for at in range(0, len(rest), WORDS):
            own = rest[at : at + WORDS]
            sizes = np.asarray([len(raw[k]) for k in own])
            w, data = np.repeat(np.asarray(own), sizes), np.frombuffer(b"".join([raw[k] for k in own]), np.uint8)
            self._load("bytes_of_words", k=w << 8 | np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes), t=self.of_byte[data])
            self.db.execute(f"INSERT INTO encoded {ENCODE}")
        rest = [(k, 0, i) for k, i in single.items()] + [(k, q, i) for k, own in long.items() for q, i in enumerate(own)]
        if rest:
            self.db.register("given", pa.table({n: pa.array(c, pa.int64()) for n, c in zip("wpt", zip(*rest))}))
            self.db.execute("INSERT INTO encoded SELECT w, p, t FROM given")
            self.db.unregister("given")
        return {words[k]: (ids, n, bytes.fromhex(x)) for k, ids, n, x in self.db.execute(DECODE).fetchall()}

    def learn(self, chunks: list[str]) -> None:
        split = [self.pattern.findall(c) for c in chunks]
        new = [w for w in set().union(*split) if w not in self.words and w not in self.words.old]
        for at in range(0, len(new), DECODED):
            self.words.update(self.solve(new[at : at + DECODED]))
        get = self.words.__getitem__
        for c, s in zip(chunks, split):
            if len(s) == 1:
                self.cache[c] = get(s[0])
                continue
            ids, _, decoded = zip(*map(get, s))
            self.cache[c] = (",".join(ids), 0, b"".join(decoded))

    def texts(self, some: list[str]) -> list[tuple[str, bytes]]:
        """For each text its ids, joined by commas, and the bytes that they decode to.

        Python's search for cycles rests meanwhile: it would go through all of the caches' entries again and again, which
        make none."""
        searched = gc.isenabled()
        gc.disable()
        try:
            return self._texts(some)
        finally:
            if searched:
                gc.enable()

    def _texts(self, some: list[str]) -> list[tuple[str, bytes]]:
        self.cache.turn()
        self.words.turn()
        chunks, where, ends = split(some)
        if not len(chunks):
            return [("", b"")] * len(some)
        numbered = chunks.dictionary_encode()
        keys = [chunk(k) for k in numbered.dictionary.to_numpy(zero_copy_only=False).tolist()]
        entries = list(map(self.cache.get, keys))
        if missing := [n for n, x in enumerate(entries) if x is None]:
            self.learn([k for k in dict.fromkeys([keys[n] for n in missing]) if k not in self.cache.old])
            for n in missing:
                entries[n] = self.cache[keys[n]]
        ids = joined(pa.array(["," + x[0] for x in entries], pa.large_string()).take(numbered.indices), ends)
        decoded = joined(pa.array([x[2] for x in entries], pa.large_binary()).take(numbered.indices), ends)
        out = [("", b"")] * len(some)
        for k, x, y in zip(where, ids, decoded):
            out[k] = (x[1:].decode("ascii"), y)
        for cache in (self.cache, self.words):
            for long in [k for k in cache if len(k) > KEPT_CHARACTERS]:
                del cache[long]
        return out


_codecs: dict[tuple[str, str], BpeCodec] = {}


def codec(path: str, pattern: str) -> BpeCodec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = BpeCodec(path, pattern)
    return _codecs[path, pattern]


def encode_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (decimal, joined by commas), decoded (bytes) of each document; nothing is shuffled.

    Null texts count as empty: no ids and no bytes.  Special tokens' strings in a text are ordinary text.  A row
    without an id keeps its null, repeated rows have a row each, and an empty table gives none."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.string()), ("decoded", pa.binary())])

    def run(batches):
        model = codec(path, pattern)
        for own, some in parts(batches, TOGETHER):
            done = model.texts(some)
            yield batch(schema, doc_id=own, ids=[d[0] for d in done], decoded=[d[1] for d in done])

    return texts(docs).mapInArrow(relaxing(run), "doc_id long, ids string, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The same with digests in place of the data, made next to them: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        model = codec(path, pattern)
        for own, some in parts(batches, TOGETHER):
            done = model.texts(some)
            yield batch(schema, doc_id=own, n_tokens=[d[0].count(",") + 1 if d[0] else 0 for d in done], ids_sha256=[hashlib.sha256(d[0].encode()).hexdigest() for d in done], decoded_sha256=[hashlib.sha256(d[1]).hexdigest() for d in done])

    return texts(docs).mapInArrow(relaxing(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
