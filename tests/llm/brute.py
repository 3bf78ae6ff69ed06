"""Plain versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().split()


def sha(b):
    return hashlib.sha256(b).hexdigest()


def near(docs, percent=85, n=5):
    sets = {}
    for i, t in docs:
        w = [x.lower() for x in words(t)]
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    by, up = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            by[x].append(i)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in by[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (i, len(s), root(i), root(i) == i) for i, s in sets.items()}


def windows(docs, width=13):
    first = {}
    split = {i: words(t) for i, t in docs}
    for i, w in split.items():
        for k in range(len(w) - width + 1):
            x = tuple(w[k : k + width])
            first[x] = min(first.get(x, i), i)
    out = {}
    for i, w in split.items():
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out[i] = (i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def repeats(docs, least=100):
    seen, out = set(), {}
    for i, t in sorted(docs):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - least + 1):
            x = hashlib.blake2b(b[k : k + least], digest_size=12).digest()
            if x in seen:
                gone[k : k + least] = b"\x01" * least
            seen.add(x)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def rule_counts(docs):
    out = {}
    for i, t in docs:
        t = t or ""
        w = words(t)
        lines = [x for x in t.split("\n") if words(x)]
        at = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {j for k in range(len(w) - 2) if at[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        out[i] = (i, len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed)
    return out


def base(docs):
    trains = {i: zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in docs}
    tokens = {i: [x.lower() for x in words(t)] + [b""] for i, t in docs}
    c = Counter(w for i, t in tokens.items() if trains[i] for w in t)
    n, v = sum(c.values()), len(c)
    return {i: (i, not trains[i], len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for i, t in tokens.items()}


def ppm(docs, order=5):
    """log10 probabilities, byte by byte, from counts kept for every context."""
    seen = defaultdict(Counter)
    text = {i: b" ".join(x.lower() for x in words(t)) + b"\n" for i, t in docs}
    for i, t in text.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            full = b"\n" * order + t
            for k in range(order, len(full)):
                for j in range(order + 1):
                    seen[full[k - j : k]][full[k]] += 1
    known = {}

    def p(context, byte):
        if (context, byte) in known:
            return known[context, byte]
        total, gone = 0.0, set()
        for j in range(len(context), -1, -1):
            counts = {x: n for x, n in seen.get(context[len(context) - j :], {}).items() if x not in gone}
            if not counts:
                continue
            size = sum(counts.values())
            if byte in counts:
                total += math.log10((counts[byte] - 0.5) / size)
                break
            total += math.log10(0.5 * len(counts) / size)
            gone |= set(counts)
        else:
            total -= math.log10(256 - len(gone))
        known[context, byte] = total
        return total

    out = {}
    for i, t in text.items():
        full = b"\n" * order + t
        out[i] = sum(p(full[k - order : k], full[k]) for k in range(order, len(full)))
    return out


def top(rows, k=5, every=50):
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in whole:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:k]
            out |= {(q, r + 1, i, -x) for r, (x, i) in enumerate(s)}
    return out


def rule_scores(docs, labels, buckets, low, xx):
    """(score of each document, threshold), from the same hashes: ``xx(value, seed)`` of a word or number."""
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    half = {i: (signed(xx(i, 42)) >> 20) % 2 == 0 for i in labels}
    grams = {}
    for i, t in docs:
        h = [signed(xx(w, 42)) for w in words(t)]
        grams[i] = [x % buckets for x in h] + [signed(xx(b, xx(a, 42))) % buckets for a, b in zip(h, h[1:])]
    raw, target = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if labels.get(i) == 1 and half[i]:
            target.update(g)
    if not target:
        return {i: 0.0 for i in grams}, float("-inf")
    n, m = sum(target.values()), sum(raw.values())
    ratio = [math.log((target[g] + 1) / (n + buckets)) - math.log((raw[g] + 1) / (m + buckets)) for g in range(buckets)]
    score = {i: sum(ratio[x] for x in g) / len(g) if g else 0.0 for i, g in grams.items()}
    failed = {i: r[-1] for i, r in rule_counts(docs).items()}
    held = [i for i in labels if i in score and not half[i] and not failed[i]]
    good = sorted(score[i] for i in held if labels[i] == 1)
    if not good:
        return score, float("-inf")

    def quantile(q):
        at = q * (len(good) - 1)
        k = int(at)
        return good[k] + (good[min(k + 1, len(good) - 1)] - good[k]) * (at - k)

    least = quantile(low)
    below = [score[i] for i in held if labels[i] != 1 and score[i] < least]
    return score, (least + max(below)) / 2 if below else least - (quantile(0.5) - least) / 2
