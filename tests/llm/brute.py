"""Brute-force versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def simhash(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def link_components(fps):
    """Smallest position reachable over distances of up to three bits."""
    values = np.array(fps, np.uint64)
    parent = list(range(len(fps)))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3) + i + 1:
            a, b = find(parent, i), find(parent, int(j))
            parent[max(a, b)] = min(a, b)
    return [find(parent, i) for i in range(len(fps))]


def substring(texts, window=35):
    """(n_words, n_removed, sha256 of the kept words) of each text."""
    split = [words(t) for t in texts]
    met = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if met[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [s for _, _, s in sorted(out)]


def vector_links(rows, cosine=0.93):
    """rows: (id, vector or None, label) -> id -> (n_links, component)."""
    good = []
    for k, (_, v, label) in enumerate(rows):
        if v is None or label is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float64)
        good.append((k, x / np.linalg.norm(x), label))
    parent, links = list(range(len(rows))), Counter()
    by = defaultdict(list)
    for k, x, label in good:
        by[label, len(x)].append((k, x))
    for group in by.values():
        m = np.stack([x for _, x in group])
        for a, b in zip(*np.nonzero(np.triu(m @ m.T >= cosine, 1))):
            i, j = group[a][0], group[b][0]
            links[i] += 1
            links[j] += 1
            p, q = find(parent, i), find(parent, j)
            parent[max(p, q)] = min(p, q)
    low = {}
    for k in range(len(rows)):
        r = find(parent, k)
        if rows[k][0] is not None:
            low[r] = min(low.get(r, rows[k][0]), rows[k][0])
    return [(rows[k][0], links[k], low.get(find(parent, k))) for k in range(len(rows))]


class Ppm:
    """Prediction by partial matching, method C, with exclusion, of one language: by the book, over dictionaries."""

    def __init__(self, texts, order=4):
        self.order, self.after, self.known = order, [defaultdict(Counter) for _ in range(order + 1)], {}
        for text in texts:
            data = b"\n" * order + text.encode("utf-8", "replace")
            for at in range(order, len(data)):
                for k in range(order + 1):
                    self.after[k][data[at - k : at]][data[at]] += 1

    def probability(self, context, byte):
        """Of ``byte`` after the last bytes ``context``."""
        key = context, byte
        if key not in self.known:
            self.known[key] = self._probability(context, byte)
        return self.known[key]

    def _probability(self, context, byte):
        k = len(context)
        seen = self.after[k].get(context)
        shorter = (lambda b: self.probability(context[1:], b)) if k else (lambda b: 1 / 256)
        if seen is None:
            return shorter(byte)
        total = sum(seen.values()) + len(seen)
        if byte in seen:
            return seen[byte] / total
        return len(seen) / total * shorter(byte) / (1 - sum(shorter(b) for b in seen))

    def nats(self, text):
        data = b"\n" * self.order + text.encode("utf-8", "replace")
        return -sum(math.log(self.probability(data[at - self.order : at], data[at])) for at in range(self.order, len(data)))


def gumbel_keys(docs, good, buckets, bucket_of, seed=0):
    """docs: (id, text); good: ids -> (log weight, key) of each document. ``bucket_of(words)`` numbers an n-gram."""

    def grams(text):
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
        return Counter([bucket_of((x,)) for x in w] + [bucket_of(p) for p in zip(w, w[1:])])

    raw, target, own = Counter(dict.fromkeys(range(buckets), 1)), Counter(dict.fromkeys(range(buckets), 1)), []
    for i, text in docs:
        own.append(grams(text))
        raw.update(own[-1])
        if i in good:
            target.update(own[-1])
    n, m = sum(raw.values()), sum(target.values())
    out = []
    for (i, text), g in zip(docs, own):
        weight = sum(c * (math.log(target[b] / m) - math.log(raw[b] / n)) for b, c in g.items())
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=42)
        for part in ("" if i is None else str(i), text or ""):
            h = xxhash.xxh64_intdigest(part.encode(), seed=h)
        h = h - (1 << 64) if h >> 63 else h
        uniform = (h % (1 << 52) + 0.5) / (1 << 52)
        out.append((weight, weight - math.log(-math.log(uniform))))
    return out
