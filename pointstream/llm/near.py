"""Near-duplicate documents by SetSketch registers.

1. Each document's set of word shingles gives one SetSketch: register i holds the truncated logarithm of the
   least of exponentially distributed values, one for each shingle.  Sketches of parts merge by the maximum.
2. Documents with equal sets are one class; its smallest id stands for it.
3. Bands of register values are the buckets.  A bucket links its members to its smallest one, which needs
   one row a member; connected components of these links hold every pair that shares a bucket.
4. Inside a component, links are found by breadth-first search: a document is held against those not yet
   reached, first by the likelihood estimate from both sketches, then exactly on the full sets.  Nothing is
   compared twice, and no pairs are listed.  A component with more than ``GROUP`` shingles is searched bucket
   by bucket instead, and a bucket with more than that in chunks that all hold its smallest member; the members
   that no chunk links with that one, and only they, are then searched together with each chunk.
5. Connected components of the confirmed links are the result."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Generations, batch, checkpoint, mix, parts, relax, relaxing, texts

WORDS = 5
#: Bands and registers in each: a pair with similarity 0.85 shares no band with probability 8e-7.
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: SetSketch's parameters: base and rate.
BASE, RATE = 1.001, 20.0
#: Pairs whose likelihood estimate is lower by this, over eight standard deviations, aren't compared exactly: by the
#: share of equal registers 5e-15 of the pairs at 0.85 and 2e-13 of those at 0.80 (with 0.17: 1e-6 at 0.85).
MARGIN = 0.30
#: Shingles that one search holds.
GROUP = 4_000_000
#: Links that one task may join at the end.
LINKS = 50_000

_MULTIPLIERS = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PLACES = mix(np.arange(1001, 1101, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class WordHash(Generations):
    """Hashes of words; longer ones than an entry should hold are hashed again."""

    def __missing__(self, word: bytes) -> int:
        value = self.old.get(word) or xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_words = WordHash(100_000)


def shingle_sets(some: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingles of each text; shorter texts have one, empty ones none."""
    _words.turn()
    split = [x.lower().split() for x in some]
    counts = np.asarray([len(s) for s in split], np.int64)
    flat = np.fromiter((h for s in split for h in map(_words.__getitem__, s)), np.uint64, int(counts.sum()))
    n = max(0, len(flat) - words + 1)
    every = np.zeros(n, np.uint64)
    for k in range(words):
        every += flat[k : k + n] * _PLACES[k]
    every = mix(every)
    out, at = [], 0
    for c in counts.tolist():
        if c >= words:
            out.append(np.unique(every[at : at + c - words + 1]))
        elif c:
            out.append(mix((flat[at : at + c] * _PLACES[:c]).sum(keepdims=True) ^ np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (uint16) of each non-empty set."""
    least = np.empty((len(sets), REGISTERS), np.uint64)
    at = 0
    while at < len(sets):  # pieces that stay in the processor's cache
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 16_384):
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at : end - 1]])]).astype(np.int64)
        for k in range(REGISTERS):
            least[at:end, k] = np.minimum.reduceat((flat ^ _MULTIPLIERS[REGISTERS + k]) * _MULTIPLIERS[k], starts)
        at = end
    x = -np.log1p(-(least.astype(np.float64) + 1) / 2.0**64.001) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, 65535).astype("<u2")


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    r = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    keys = np.zeros(r.shape[:2], np.uint64)
    for k in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + r[:, :, k] + np.uint64(1))
    return mix(keys + np.arange(BANDS, dtype=np.uint64) * _PLACES[99]).view(np.int64)


_GRID = np.linspace(0.3, 1.0, 71)


def estimates(one: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Similarities of largest likelihood, from how many registers are larger, equal and smaller; the sizes are known."""
    above = (one > others).sum(1)[:, None]
    below = (one < others).sum(1)[:, None]
    equal = others.shape[1] - above - below
    u = (size / (size + sizes))[:, None]
    v = 1 - u

    def p(x):  # the chance that one register is larger, with the share x that only one set has
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    most = np.minimum(u / v, v / u)
    j = np.minimum(_GRID[None, :], most)
    more, less = p(u - v * j), p(v - u * j)
    tiny = 1e-9
    fit = above * np.log(np.maximum(more, tiny)) + below * np.log(np.maximum(less, tiny)) + equal * np.log(np.maximum(1 - more - less, tiny))
    return np.take_along_axis(j, fit.argmax(1)[:, None], 1)[:, 0]


def links(ids: list[int], sets: list[np.ndarray], registers: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join all documents whose sets have 100 * intersection >= percent * union, directly or through others."""
    order = sorted(range(len(ids)), key=ids.__getitem__)
    sizes = np.asarray([len(s) for s in sets], np.int64)
    left, found = np.asarray(order, np.int64), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            hub = queue.pop()
            n = sizes[hub]
            near = left[(100 * np.minimum(n, sizes[left]) >= percent * np.maximum(n, sizes[left]))]
            if len(near):
                near = near[estimates(registers[hub], int(n), registers[near], sizes[near]) >= percent / 100 - MARGIN]
            if not len(near):
                continue
            flat = np.concatenate([sets[k] for k in near])
            starts = np.concatenate([[0], np.cumsum(sizes[near])[:-1]])
            own = sets[hub]
            both = np.add.reduceat((own[np.minimum(np.searchsorted(own, flat), n - 1)] == flat).astype(np.int64), starts)
            linked = near[100 * both >= percent * (n + sizes[near] - both)]
            found += [(ids[hub], ids[k]) for k in linked]
            queue += linked.tolist()
            left = left[~np.isin(left, linked)]
    return found


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _forest(batches):
    """Links from each node to the smallest one of its tree, by union-find over this task's links."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            u, v = root(u), root(v)
            if u != v:
                up[max(u, v)] = min(u, v)
    nodes = [x for x in up if root(x) != x]
    for at in range(0, len(nodes), 100_000):
        some = nodes[at : at + 100_000]
        yield batch(EDGES, u=some, v=[root(x) for x in some])


def components(edges: DataFrame, most: int = LINKS) -> DataFrame:
    """(u, v): each node of ``edges`` (u, v) that isn't its component's smallest, with the smallest.

    Rounds contract the graph: every task reduces its links to a forest, every node goes to its smallest
    neighbour, pointers are followed to their ends.  Each round at least halves the nodes; the last ``most``
    links are joined in one task."""
    edges = checkpoint(edges.mapInArrow(_forest, "u long, v long"))
    levels = []
    while True:
        n = edges.count()
        if n <= most:
            levels.append(checkpoint(edges.coalesce(1).mapInArrow(_forest, "u long, v long")))
            break
        up = checkpoint(edges.groupBy("u").agg(F.min("v").alias("v")))
        while True:  # until all pointers lead to nodes that have none
            after = up.select(F.col("u").alias("v"), F.col("v").alias("w"))
            up = checkpoint(up.join(after, "v", "left").select("u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved")))
            moved = not up.where("moved").isEmpty()
            up = up.select("u", "v")
            if not moved:
                break
        levels.append(up)
        a, b = up.select("u", F.col("v").alias("a")), up.select(F.col("u").alias("v"), F.col("v").alias("b"))
        both = edges.join(a, "u", "left").join(b, "v", "left").select(F.coalesce("a", "u").alias("a"), F.coalesce("b", "v").alias("b")).where("a <> b")
        edges = checkpoint(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().mapInArrow(_forest, "u long, v long"))
    out = levels[-1]
    for up in reversed(levels[:-1]):
        after = out.select(F.col("u").alias("v"), F.col("v").alias("w"))
        out = up.join(after, "v", "left").select("u", F.coalesce("w", "v").alias("v")).unionByName(out)
    return out if len(levels) == 1 else checkpoint(out)


SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("registers", pa.binary())])


def _sketch(words: int):
    def run(batches):
        for ids, some in parts(batches):
            sets = shingle_sets([x.encode() for x in some], words)
            full = [k for k, s in enumerate(sets) if len(s)]
            registers: list = [None] * len(sets)
            if full:
                for k, r in zip(full, sketches([sets[k] for k in full])):
                    registers[k] = r.tobytes()
            yield batch(SKETCH, doc_id=ids, n_shingles=[len(s) for s in sets], digest=[_digest(s) if len(s) else None for s in sets], registers=registers)

    return run


def _bands(batches):
    for b in batches:
        if not b.num_rows:
            continue
        registers = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").reshape(-1, REGISTERS)
        keys = band_keys(registers)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), BANDS))], names=["key", "doc_id"])


FOUND = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("left", pa.bool_())])


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = 85, group: int = GROUP, most: int = LINKS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Null or wordless texts have no shingles, link with nothing and stay; so do rows without an id, whose
    component_id is null.  Rows with the same id are one document as to ids: links of one are links of all."""
    docs = texts(docs)
    rows = checkpoint(docs.mapInArrow(relaxing(_sketch(words)), "doc_id long, n_shingles long, digest binary, registers binary"))
    full = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = checkpoint(full.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")))
    # a member of the buckets that have two classes at least, and each bucket's smallest
    bands = classes.select("doc_id", "registers").mapInArrow(relaxing(_bands), "key long, doc_id long")
    hubs = bands.groupBy("key").agg(F.min("doc_id").alias("v"), F.max("doc_id").alias("w")).where("v <> w").select("key", "v")
    stars = checkpoint(bands.join(hubs, "key").select("key", "doc_id", "v"))
    candidates = components(stars.where("doc_id <> v").select(F.col("doc_id").alias("u"), "v").distinct(), most)
    candidates = candidates.select(F.col("u").alias("doc_id"), F.col("v").alias("root")).unionByName(candidates.select(F.col("v").alias("doc_id"), F.col("v").alias("root")).distinct())

    members = checkpoint(candidates.join(classes, "doc_id"))
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    sizes = members.groupBy("root").agg(F.sum("n_shingles").alias("size"))
    own = ["doc_id", "root", "digest", "registers"]
    alone = F.lit(0).alias("chunk"), F.lit(-1).alias("rest")
    # small components share a search's group, which keeps them apart by root
    bins = max(1, math.ceil(2 * total / group))
    small = members.join(sizes.where(F.col("size") <= group), "root").select(*own, F.pmod(F.xxhash64("root"), F.lit(bins)).alias("g"), *alone)
    dealt, found = small, None
    if not (large := sizes.where(F.col("size") > group)).isEmpty():
        # the root is the bucket now, as a member of several is searched in each
        bucketed = members.join(large.select("root"), "root", "left_semi").drop("root").join(stars, "doc_id").withColumnRenamed("key", "root")
        chunks = F.ceil(F.sum("n_shingles") / group).cast("int")
        counts = bucketed.groupBy("root").agg(chunks.alias("chunks"))
        bucketed = checkpoint(bucketed.join(counts, "root").withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")))
        every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        parts_ = bucketed.where("doc_id <> v").select(*own, "v", F.col("mine").alias("chunk")).unionByName(bucketed.where("doc_id = v").select(*own, "v", every.alias("chunk")))
        first = parts_.select(*own, F.col("root").alias("g"), "chunk", F.lit(-1).alias("rest"))
        several = bucketed.where("chunks > 1")
        found = checkpoint(_searched(docs, first, words, percent, several.select("root").distinct()))
        # of buckets in several chunks: who isn't linked with the smallest member meets all the chunks
        lone = several.join(found.where("left").select(F.col("u").alias("doc_id"), F.col("v").alias("root")).distinct(), ["doc_id", "root"], "left_semi")
        lone = lone.join(lone.groupBy("root").agg(chunks.alias("rests")), "root").withColumn("rest", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("rests")).cast("int"))
        most_rest = lone.groupBy("root").agg(F.first("rests").alias("rests"))
        others = several.join(most_rest, "root").select(*own, F.col("root").alias("g"), F.col("mine").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("rest"))
        asked = lone.select(*own, F.col("root").alias("g"), every.alias("chunk"), "rest")
        dealt = small.unionByName(others).unionByName(asked)
    confirmed = _searched(docs, dealt, words, percent, None).select("u", "v")
    if found is not None:
        confirmed = confirmed.unionByName(found.where("not left").select("u", "v"))
    # stored first: two Python operators in one task would need two workers, which live on beside each other
    reached = components(checkpoint(confirmed), most).select(F.col("u").alias("doc_id"), F.col("v").alias("smallest"))
    ids = classes.select("digest", "doc_id").join(reached, "doc_id", "left").select("digest", F.coalesce("smallest", "doc_id").alias("component_id"))
    named = F.when(F.col("doc_id").isNotNull(), F.col("digest"))
    out = rows.select("doc_id", "n_shingles", named.alias("digest")).join(ids, "digest", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _searched(docs: DataFrame, dealt: DataFrame, words: int, percent: int, split: DataFrame | None) -> DataFrame:
    """(u, v, left): links u to v inside the groups (g, chunk, rest) of ``dealt``.  For buckets of which ``split`` has the
    root there are rows too, with ``left``, of members u that bucket v's smallest member isn't joined with in their group."""
    dealt = dealt.withColumn("tell", F.lit(False)) if split is None else dealt.join(split.withColumn("tell", F.lit(True)), "root", "left").withColumn("tell", F.coalesce("tell", F.lit(False)))

    def search(table: pa.Table) -> pa.Table:
        sets = shingle_sets([x.encode() for x in table.column("text").to_pylist()], words)
        registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
        by_root: dict[int, dict[tuple, int]] = {}  # repeated rows, and other texts of the same id, fall away
        for k, (root, doc, digest) in enumerate(zip(*(table.column(c).to_pylist() for c in ("root", "doc_id", "digest")))):
            if _digest(sets[k]) == digest:
                by_root.setdefault(root, {})[doc, digest] = k
        told = dict(zip(table.column("root").to_pylist(), table.column("tell").to_pylist()))
        found = []
        for root, own in by_root.items():
            at = list(own.values())
            joined = links([doc for doc, _ in own], [sets[k] for k in at], registers[at], percent)
            found += [(max(x), min(x), False) for x in joined]
            if told[root]:
                hub, reached = min(doc for doc, _ in own), set()
                reached.add(hub)
                for a, b in joined:  # breadth first: an end is reached before the links on from it
                    if a in reached or b in reached:
                        reached.update((a, b))
                found += [(doc, root, True) for doc, _ in own if doc not in reached]
        del sets, registers
        relax()
        return pa.table(dict(zip(FOUND.names, zip(*found))) if found else {n: [] for n in FOUND.names}, schema=FOUND)

    rows = docs.join(dealt, "doc_id").select("g", "chunk", "rest", "root", "doc_id", "text", "digest", "registers", "tell")
    return rows.groupBy("g", "chunk", "rest").applyInArrow(search, "u long, v long, left boolean")
