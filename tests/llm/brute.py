"""Plain versions of the operators, for comparison on small fixtures."""
import hashlib
import math
import random
import re
from collections import Counter, defaultdict


def split_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def jaccard_components(rows):
    sets = []
    for i, t in rows:
        w = split_words(ascii_lower(t))
        g = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        sets.append((i, g))
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return sorted((i, len(g), find(i)) for i, g in sets)


def substring(rows, window=50):
    first = {}
    words = [(i, split_words(t)) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def ppm_bits(counts, order, data):
    """Code length of ``data`` under one language's context counts {(k, context): Counter}."""
    def cost(ctx, s, k):
        if k < 0:
            return 8.0
        seen = counts.get((k, ctx))
        if not seen:
            return cost(ctx[1:], s, k - 1)
        n, d = sum(seen.values()), len(seen)
        if s in seen:
            return -math.log2(seen[s] / (n + d))
        return -math.log2(d / (n + d)) + cost(ctx[1:], s, k - 1)
    return sum(cost(data[max(0, i - order):i], data[i], min(i, order)) for i in range(len(data)))


def ppm_counts(texts, order):
    out = defaultdict(Counter)
    for t in texts:
        for k in range(order + 1):
            for i in range(k, len(t)):
                out[(k, t[i - k:i])][t[i]] += 1
    return out


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    make = random.Random(7)
    words = ["".join(make.choice(["ta", "ri", "no", "le", "sun", "ka", "vor", "e"]) for _ in range(make.randint(1, 4))) for _ in range(vocabulary)]
    return [rng.choice(words) for _ in range(n)]
