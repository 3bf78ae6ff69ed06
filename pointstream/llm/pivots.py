"""Exact top-k by inner product with a pivot-distance index.

Vectors become integers and get one more component that makes all of them equally long, which turns the
largest inner products into the least Euclidean distances.  A vector's key is its nearest pivot and the
distance to it; sorted by key, vectors are cut into annuli.  A query's k-th best score inside its own annulus
bounds how far away better vectors can be, so by the triangle inequality only annuli whose distances from a
pivot overlap its own by that much are searched; each again ends early for queries that can't gain.

Equal vectors are one class, of which the smallest ``k + 1`` ids can matter, and equal queries are one query."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, checkpoint, pack_arrays, unpack_arrays

K = 5
EVERY = 50
SCALE = 256
PIVOTS = 48
#: Vectors that pivots are chosen from; all vectors are indexed.
SAMPLE = 2048
#: Classes in an annulus.
ANNULUS = 1024
#: Queries that one search of an annulus handles.
QUERIES = 4096
#: Annuli of a pivot that share a cell of distances.
CELL = 32
#: Sums of products below this are exact in doubles.
EXACT = 2.0**52

CLASSES = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary())])


def _integers(scale: int):
    def run(batches):
        for b in batches:
            ids, vectors = [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
                    continue
                ids.append(i)
                vectors.append((np.floor(np.asarray(v, np.float64) * scale) + 0.0).astype("<f8").tobytes())
            yield batch(CLASSES, vec_id=ids, vector=vectors)

    return run


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """One row a vector; shorter ones are filled with zeros."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v) // 8] = np.frombuffer(v, "<f8")
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as int64; those outside its range become its ends."""
    if not len(a) or not len(b) or np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    low, high = -(2**63), 2**63 - 1
    return np.asarray([[min(high, max(low, sum(x * y for x, y in zip(r, s)))) for s in whole[1]] for r in whole[0]], np.int64)


def distances(m: np.ndarray, pivots: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """From each vector, as a query or with its further component, to each pivot (which has its own)."""
    norms = (m**2).sum(1)
    further = np.zeros(len(m)) if query else np.sqrt(np.maximum(longest - norms, 0))
    square = norms[:, None] + further[:, None] ** 2 + (pivots**2).sum(1)[None, :] - 2 * (m @ pivots[:, :-1].T + further[:, None] * pivots[None, :, -1])
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, longest: float, many: int = PIVOTS) -> np.ndarray:
    """Each pivot is the sampled vector farthest from those before."""
    full = np.hstack([sample, np.sqrt(np.maximum(longest - (sample**2).sum(1), 0))[:, None]])
    chosen, far = [0], ((full - full[0]) ** 2).sum(1)
    while len(chosen) < min(many, len(full)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((full - full[chosen[-1]]) ** 2).sum(1))
    return full[chosen]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k highest scores with their ids, ties to smaller ids."""
    if len(scores) > k:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        scores, ids = scores[kept], ids[kept]
    order = np.lexsort((ids, -scores))[:k]
    return list(zip(ids[order].tolist(), scores[order].tolist()))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, pivots: int = PIVOTS, annulus: int = ANNULUS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by ``every`` the ``k`` other rows of largest inner product.

    ``vectors``: vec_id, embedding.  Rows without id, vector, or with components null or not finite take no
    part.  Vectors of unequal lengths are filled with zeros.  Rows with the same id count as the query's own.  An id with
    several different vectors has them all in one ranking: as a query, the best of the ``k + 1`` best rows of each of its
    vectors; as a candidate, a rank for each vector that is good enough.  Repeated rows count once.  An empty table
    gives no rows."""

    rows = checkpoint(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(_integers(scale), "vec_id long, vector binary").distinct())
    first = Window.partitionBy("vector").orderBy("vec_id")  # limited before the exchange as well
    ids = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    classes = ids.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asks = rows.where(F.pmod("vec_id", F.lit(every)) == 0).select("vector").distinct().withColumn("asks", F.lit(True))
    classes = checkpoint(classes.join(asks, "vector", "left").select(F.monotonically_increasing_id().alias("class"), "ids", "vector", F.coalesce("asks", F.lit(False)).alias("asks")))

    def norms(batches):
        for b in batches:
            found = [np.frombuffer(v, "<f8") for v in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([float((v**2).sum()) for v in found]), pa.array([len(v) for v in found], pa.int32())], names=["norm", "width"])

    most = classes.select("vector").mapInArrow(norms, "norm double, width int").agg(F.max("norm").alias("norm"), F.max("width").alias("width"), F.count("*").alias("n")).first()
    longest, width, many = most["norm"] or 0.0, most["width"] or 0, most["n"]
    sample = _matrix([r["vector"] for r in classes.orderBy(F.xxhash64("vector"), "vector").select("vector").limit(SAMPLE).collect()], width)
    centres = choose_pivots(sample, longest, pivots) if len(sample) else np.zeros((1, width + 1))

    def keyed(batches):
        for b in batches:
            if b.num_rows:
                d = distances(_matrix(b.column(2).to_pylist(), width), centres, longest, False)
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(near, pa.int32()), pa.array(d[np.arange(len(near)), near]), *b.columns], names=["pivot", "distance", *b.schema.names])

    index = classes.select("class", "ids", "vector", "asks").mapInArrow(keyed, "pivot int, distance double, class long, ids array<long>, vector binary, asks boolean")
    index = checkpoint(index).repartitionByRange(max(8, -(-many // (8 * annulus))), "pivot", "distance", "class").sortWithinPartitions("pivot", "distance", "class")

    ring = pa.schema([("annulus", pa.int64()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("payload", pa.binary())])

    def cut(batches):
        task, count, held = TaskContext.get().partitionId(), 0, []

        def close():
            counts = np.asarray([len(r["ids"]) for r in held], np.int32)
            payload = pack_arrays(np.concatenate([r["ids"] for r in held]).astype(np.int64), counts, _matrix([r["vector"] for r in held], width).reshape(-1), np.asarray([r["asks"] for r in held]), np.asarray([r["distance"] for r in held]), np.asarray([r["class"] for r in held], np.int64))
            return batch(ring, annulus=[(task << 32) + count], pivot=[held[0]["pivot"]], low=[held[0]["distance"]], high=[held[-1]["distance"]], payload=[payload])

        for b in batches:
            for r in b.to_pylist():
                if held and (len(held) == annulus or held[0]["pivot"] != r["pivot"]):
                    yield close()
                    count, held = count + 1, []
                held.append(r)
        if held:
            yield close()

    rings = checkpoint(index.mapInArrow(cut, "annulus long, pivot int, low double, high double, payload binary"))

    def opened(payload: bytes):
        ids, counts, flat, asks, distance, classes = unpack_arrays(payload)
        return ids, counts, flat.reshape(len(counts), width), asks, distance, classes

    reach = pa.schema([("home", pa.int64()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("queries", pa.binary())])

    def ask(batches):
        """Queries of an annulus: the bound that its own members give, and the distances from each pivot where better ones can be."""
        for b in batches:
            for home, payload in zip(b.column(0).to_pylist(), b.column(1)):
                _, counts, m, asks, _, names = opened(payload.as_py())
                if not asks.any():
                    continue
                q, names = m[asks], names[asks]
                scores = np.repeat(products(q, m), counts, axis=1)
                bound = np.partition(scores, scores.shape[1] - k - 1, axis=1)[:, scores.shape[1] - k - 1] if scores.shape[1] > k else np.full(len(q), -(2**63))
                radius = np.where(bound > -(2**63), np.sqrt(np.maximum((q**2).sum(1) + longest - 2.0 * bound, 0)), np.inf)
                radius = radius * (1 + 1e-9) + 1e-6 * (1 + math.sqrt(longest))  # what rounding may cost
                d = distances(q, centres, longest, True)
                low, high = d - radius[:, None], d + radius[:, None]
                packed = pack_arrays(names, q.reshape(-1), bound)
                # near queries share a row; their own reach is looked at again in the search
                yield batch(reach, home=[home] * len(centres), pivot=range(len(centres)), low=low.min(0), high=high.max(0), queries=[packed] + [None] * (len(centres) - 1))

    asked = checkpoint(rings.select("annulus", "payload").mapInArrow(ask, "home long, pivot int, low double, high double, queries binary"))
    # a range join by cells of distance: a pivot's annuli are neighbours, so a cell holds CELL of them on average
    bounds = rings.groupBy("pivot").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.ceil(F.count("*") / CELL).cast("int").alias("cells"))
    bounds = F.broadcast(bounds)  # a row for each pivot
    across = F.greatest((F.col("most") - F.col("least")) / F.col("cells"), F.lit(1e-12))
    cell = lambda c: F.least(F.floor((F.greatest(F.least(F.col(c), F.col("most")), F.col("least")) - F.col("least")) / across).cast("int"), F.col("cells") - 1)
    wanted = asked.select("home", "pivot", F.col("low").alias("from"), F.col("high").alias("to")).join(bounds, "pivot").where((F.col("from") <= F.col("most")) & (F.col("to") >= F.col("least")))
    wanted = wanted.withColumn("began", cell("from")).select("home", "pivot", "from", "to", "began", F.explode(F.sequence("began", cell("to"))).alias("cell"))
    there = rings.select("annulus", "pivot", "low", "high").join(bounds, "pivot").withColumn("begins", cell("low")).select("annulus", "pivot", "low", "high", "begins", F.explode(F.sequence("begins", cell("high"))).alias("cell"))
    once = F.col("cell") == F.greatest("began", "begins")  # of the cells in which both are, the first
    pairs = there.join(wanted, ["pivot", "cell"]).where(once & (F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from"))).select("annulus", "home")
    questions = asked.where("queries is not null").select("home", "queries")
    shares = max(1, -(-questions.count() * 64 // QUERIES))
    none = F.lit(None).cast("binary")
    pairs = checkpoint(pairs.select("annulus", "home", F.pmod(F.xxhash64("home"), F.lit(shares)).alias("share")))
    sides = pairs.join(questions, "home").select("annulus", "share", none.alias("payload"), "queries", F.lit(None).cast("int").alias("pivot"))
    # an annulus goes to those shares only that ask it
    rows_ = pairs.select("annulus", "share").distinct().join(rings, "annulus").select("annulus", "share", "payload", none.alias("queries"), "pivot")
    found_schema = pa.schema([("class", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(group: pa.Table) -> pa.Table:
        at = next((x for x, p in enumerate(group.column("payload").to_pylist()) if p is not None), None)
        out = []
        ids, counts, m, _, distance, _ = opened(group.column("payload")[at].as_py())
        pivot = centres[[group.column("pivot")[at].as_py()]]
        for packed in group.column("queries").to_pylist():
            if packed is None:
                continue
            names, flat, bound = unpack_arrays(packed)
            q = flat.reshape(len(names), width)
            radius = np.where(bound > -(2**63), np.sqrt(np.maximum((q**2).sum(1) + longest - 2.0 * bound, 0)), np.inf)
            radius = radius * (1 + 1e-9) + 1e-6 * (1 + math.sqrt(longest))
            d = distances(q, pivot, longest, True)[:, 0]
            low, high = np.searchsorted(distance, d - radius), np.searchsorted(distance, d + radius, "right")
            for x in np.flatnonzero(high > low):
                some = slice(low[x], high[x])
                scores = products(q[x : x + 1], m[some])[0]
                start = int(counts[: low[x]].sum())
                per = counts[some]
                scores = np.repeat(scores, per)
                own = ids[start : start + len(scores)]
                kept = scores >= bound[x]
                out += [(int(names[x]), i, s) for i, s in best(scores[kept], own[kept], k + 1)]
        return pa.table(dict(zip(found_schema.names, ([r[c] for r in out] for c in range(3)))), schema=found_schema)

    hits = rows_.unionByName(sides).groupBy("annulus", "share").applyInArrow(search, "class long, vec_id long, score long")
    order = Window.partitionBy("class").orderBy(F.desc("score"), "vec_id")
    hits = hits.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    members = classes.where("asks").select("class", "vector").join(rows.where(F.pmod("vec_id", F.lit(every)) == 0), "vector").select("class", F.col("vec_id").alias("query_id"))
    ranked = members.join(hits, "class").where("vec_id <> query_id").withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
