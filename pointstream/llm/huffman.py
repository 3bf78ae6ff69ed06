"""Token ids as files: canonical length-limited Huffman codes from global counts, in blocks that decode on their own.

A file's bytes: ``MAGIC``; seven little-endian 64-bit numbers (shard, documents, ids, ids in a block, longest
code, bytes of the bit stream, documents without an id, which come last); the documents' ids (int64) and numbers
of token ids (int64); the
distinct token ids (uint32) in canonical order and, for each code length up to the longest, how many
there are (uint32); the bit offset at which each block begins (uint64); the bit stream, most significant
bit first, padded to 8 bytes and followed by 8 zero bytes.

Spark's writers are the only way to any store, so a file travels as a row (shard, name, ids, image) of a
table; ``image`` is the whole file, to be written anywhere as it is."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import PART_BYTES, encoder
from .common import LAST_ID, batch, checkpoint, pack_arrays, parts, relax, relaxing, texts, unpack_arrays

MAGIC = b"TOKHUF02"
LONGEST = 17
BLOCK_IDS = 1024
SHARD_DOCS = 2048
#: Shard of the rows that carry counts.
COUNTS = -1
#: Files whose numbers of ids are summed up together.
SUMMED = 4096
#: Ids whose codes are put into the bit stream together.
TOGETHER = 1 << 15


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits for positive counts, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if 2**longest < n:
        raise ValueError(f"{n} symbols need codes of more than {longest} bits")
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.int64)[order]
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(longest):
        weights = np.concatenate([leaves, packages])
        by = np.argsort(weights, kind="stable")
        levels.append(by < n)
        weights = weights[by]
        packages = weights[0 : len(weights) // 2 * 2 : 2] + weights[1::2][: len(weights) // 2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        used = int(leaf[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """The canonical code of some symbols: sorted by length, then by symbol."""

    def __init__(self, symbols: np.ndarray, per_length: np.ndarray):
        self.symbols, self.per_length = np.asarray(symbols, np.uint32), np.asarray(per_length, np.uint32)
        self.longest = len(per_length) - 1
        lengths = np.repeat(np.arange(self.longest + 1), self.per_length)
        spans = np.left_shift(1, self.longest - lengths).astype(np.int64)
        firsts = np.concatenate([[0], np.cumsum(spans)[:-1]]) if len(spans) else spans
        self.lengths, self.codes, self.spans = lengths, firsts >> (self.longest - lengths), spans

    @classmethod
    def of(cls, symbols: np.ndarray, counts: np.ndarray, longest: int = LONGEST) -> Code:
        lengths = code_lengths(counts, longest)
        by = np.lexsort((symbols, lengths))
        return cls(np.asarray(symbols)[by], np.bincount(lengths, minlength=longest + 1))

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bit stream, and the bit offset of each id; ``TOGETHER`` ids at a time, which stay in a processor's cache."""
        size = int(self.symbols.max()) + 1 if len(self.symbols) else 1
        length_of, code_of = np.zeros(size, np.uint8), np.zeros(size, np.uint64)
        length_of[self.symbols], code_of[self.symbols] = self.lengths, self.codes.astype(np.uint64)
        lengths = length_of[ids]
        ends = np.cumsum(lengths, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        starts = ends - lengths
        words = np.zeros((total + 63) // 64 + 1, np.uint64)
        for at in range(0, len(ids), TOGETHER):
            own = slice(at, at + TOGETHER)
            word, codes = starts[own] >> 6, code_of[ids[own]]
            shift = 64 - (starts[own] & 63) - lengths[own]
            fits = np.where(shift >= 0, codes << np.maximum(shift, 0).astype(np.uint64), codes >> np.maximum(-shift, 0).astype(np.uint64))
            heads = np.concatenate([[0], np.flatnonzero(word[1:] != word[:-1]) + 1])
            words[word[heads]] |= np.bitwise_or.reduceat(fits, heads)
            over = np.flatnonzero(shift < 0)
            words[word[over] + 1] |= codes[over] << (64 + shift[over]).astype(np.uint64)
        return words.astype(">u8").tobytes(), starts

    def decode(self, stream: bytes, offsets: np.ndarray, n: int, block: int) -> np.ndarray:
        """``n`` ids; all blocks advance together, one look-up each a step."""
        words = np.concatenate([np.frombuffer(stream, ">u8").astype(np.uint64), np.zeros(2, np.uint64)])
        symbol = np.zeros(1 << self.longest, np.uint32)
        length = np.zeros(1 << self.longest, np.int64)
        filled = int(self.spans.sum())
        symbol[:filled], length[:filled] = np.repeat(self.symbols, self.spans), np.repeat(self.lengths, self.spans)
        out, at = np.zeros((block, len(offsets)), np.uint32), np.asarray(offsets).astype(np.int64)  # a step's ids side by side
        last = n - (len(offsets) - 1) * block
        down = np.uint64(64 - self.longest)
        for step in range(block):
            if step == last:
                at = at[:-1]
            if not len(at):
                break
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            seen = (words[word] << bit) | ((words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - bit))
            seen >>= down
            out[step, : len(at)] = symbol[seen]
            at = at + length[seen]
        return out.T.reshape(-1)[:n]


def to_image(shard: int, docs: np.ndarray, lengths: np.ndarray, ids: np.ndarray, code: Code, block: int = BLOCK_IDS, nameless: int = 0) -> bytes:
    stream, starts = code.encode(ids)
    return b"".join([
        MAGIC,
        struct.pack("<7q", shard, len(docs), len(ids), block, code.longest, len(stream), nameless),
        np.asarray(docs, "<i8").tobytes(),
        np.asarray(lengths, "<i8").tobytes(),
        struct.pack("<q", len(code.symbols)),
        code.symbols.astype("<u4").tobytes(),
        code.per_length.astype("<u4").tobytes(),
        starts[::block].astype("<u8").tobytes(),
        stream,
    ])


def from_image(image: bytes) -> tuple[int, np.ma.MaskedArray, np.ndarray, np.ndarray]:
    """shard, the documents' ids (masked where there is none), their numbers of token ids, all token ids."""
    if image[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    shard, docs, n, block, longest, size, nameless = struct.unpack_from("<7q", image, 8)
    at = 64

    def take(kind: str, many: int) -> np.ndarray:
        nonlocal at
        a = np.frombuffer(image, kind, many, at)
        at += a.nbytes
        return a

    ids, lengths = take("<i8", docs), take("<i8", docs)
    symbols = take("<u4", int(take("<i8", 1)[0]))
    code = Code(symbols, take("<u4", longest + 1))
    offsets = take("<u8", -(-n // block))
    return shard, np.ma.masked_array(ids, np.arange(docs) >= docs - nameless), lengths, code.decode(image[at : at + size], offsets, n, block)


def _bounds(docs: DataFrame, shard_docs: int) -> np.ndarray:
    """The ids at which files end, in order, from the ids alone: one for every ``shard_docs`` rows at the most, as often as it
    ends a file.  Rows are dealt and sorted by ranges; each task tells every ``shard_docs``-th of its ids, so the driver
    gets a number for each file."""

    def run(batches):
        at = 0
        for b in batches:
            found = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(found[-at % shard_docs :: shard_docs])], names=["id"])
            at += len(found)

    ids = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"))
    found = ids.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(run, "id long")
    return np.sort(found.toPandas()["id"].to_numpy(np.int64))[1:]


def _tokenised(docs: DataFrame, vocabulary: str, end_id: int, bounds: np.ndarray) -> DataFrame:
    """Rows (shard, payload), stored: ids of one task's documents that belong to a shard, and the task's counts.

    Shard k has ids from ``bounds[k - 1]`` to ``bounds[k]``; rows with an id that ends several are dealt to these in turn."""
    schema = pa.schema([("shard", pa.int32()), ("payload", pa.binary())])
    shared = docs.sparkSession.sparkContext.broadcast(bounds)  # a number for each file

    def run(batches):
        model, counts, held, size, turn = encoder(vocabulary), np.zeros(0, np.int64), {}, 0, 0

        def flush():
            for shard, (own, found) in held.items():
                tokens = np.frombuffer(b"".join(found), "<u4")
                narrow = tokens.astype("<u2") if not len(tokens) or tokens.max() < 65536 else tokens
                lengths = np.asarray([len(x) // 4 for x in found], "<i8")
                none = np.asarray([i is None for i in own])
                yield batch(schema, shard=[shard], payload=[pack_arrays(np.asarray([LAST_ID if i is None else i for i in own], "<i8"), none, lengths, narrow)])

        end = np.asarray([end_id], "<u4").tobytes()
        for own, some in parts(batches, PART_BYTES):
            found = [x + end for x in model.encode(some)]
            new = np.bincount(np.frombuffer(b"".join(found), "<u4"))
            if len(new) > len(counts):
                new[: len(counts)] += counts
                counts = new
            else:
                counts[: len(new)] += new
            keys = np.asarray([LAST_ID if i is None else i for i in own], np.int64)
            first, last = np.searchsorted(shared.value, keys, "left"), np.searchsorted(shared.value, keys, "right")
            places = first + (turn + np.arange(len(keys))) % (last - first + 1)
            turn += len(keys)
            for shard, doc, tokens in zip(places.tolist(), own, found):
                a, b = held.setdefault(shard, ([], []))
                a.append(doc)
                b.append(tokens)
                size += len(tokens)
            if size > 16 << 20:
                yield from flush()
                held, size = {}, 0
        yield from flush()
        if len(counts):
            yield batch(schema, shard=[COUNTS], payload=[pack_arrays(np.flatnonzero(counts), counts[counts > 0])])

    return checkpoint(docs.mapInArrow(relaxing(run), "shard int, payload binary"))


def _explode(batches):
    for b in batches:
        for payload in b.column(0):
            ids, counts = unpack_arrays(payload.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(counts)], names=["id", "n"])


def write_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, shard_docs: int = SHARD_DOCS, longest: int = LONGEST) -> None:
    """Token ids of all documents, an end id after each, in files that ascend by doc_id; one table row is one file.

    Null texts count as empty.  Rows with the same id come one after the other; inside a file, in the order of their token
    ids.  Rows without an id come last.  An empty table gives no files."""
    docs = texts(docs)
    stored = _tokenised(docs, vocabulary, end_id, _bounds(docs, shard_docs))
    counts = stored.where(F.col("shard") == COUNTS).select("payload").mapInArrow(_explode, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toPandas()  # the vocabulary's size bounds it
    code = Code.of(counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64), longest)
    symbols, per_length = code.symbols, code.per_length

    def encode(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        rows = []
        for payload in group.column("payload").to_pylist():
            own, none, lengths, tokens = unpack_arrays(payload)
            ends = np.cumsum(lengths)
            rows += [(bool(x), int(d), tokens[e - n : e].astype("<u4")) for d, x, n, e in zip(own, none, lengths, ends)]
        rows.sort(key=lambda r: r[:2])
        if any(a[:2] == b[:2] for a, b in zip(rows, rows[1:])):
            rows.sort(key=lambda r: (*r[:2], r[2].tolist()))
        ids = np.concatenate([x for *_, x in rows])
        image = to_image(shard, [d for _, d, _ in rows], [len(x) for *_, x in rows], ids, Code(symbols, per_length), nameless=sum(x for x, *_ in rows))
        del rows
        relax()
        return pa.table({"shard": pa.array([shard], pa.int32()), "name": [f"ids-{shard:08d}.tokhuf"], "ids": pa.array([len(ids)], pa.int64()), "image": pa.array([image], pa.binary())})

    files = stored.where(F.col("shard") != COUNTS).groupBy("shard").applyInArrow(encode, "shard int, name string, ids long, image binary")
    files.write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold, a row for each document: doc_id, start, n_tokens, ids_crc32."""
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches):
        for b in batches:
            for image in b.column(0):
                shard, docs, lengths, ids = from_image(image.as_py())
                ends, raw = np.cumsum(lengths), ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for n, e in zip(lengths.tolist(), ends.tolist())]
                names = pa.array(docs.data, pa.int64(), mask=np.ma.getmaskarray(docs))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), shard), pa.int32()), names, pa.array(ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], schema=schema)

    files = spark.read.parquet(path)
    rows = files.select("image").mapInArrow(relaxing(decode), "shard int, doc_id long, local long, n_tokens long, ids_crc32 long")
    # ids before each file: sums within stretches of files, and of the stretches before
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = files.select("shard", F.expr(f"shard div {SUMMED}").alias("stretch"), F.col("ids").alias("n"))
    stretches = totals.groupBy("stretch").agg(F.sum("n").alias("n")).select("stretch", before(Window.orderBy("stretch")).alias("ahead"))
    base = totals.select("shard", "stretch", before(Window.partitionBy("stretch").orderBy("shard")).alias("within")).join(F.broadcast(stretches), "stretch")
    return rows.join(base, "shard").select("doc_id", (F.col("ahead") + F.col("within") + F.col("local")).cast("long").alias("start"), "n_tokens", "ids_crc32")
