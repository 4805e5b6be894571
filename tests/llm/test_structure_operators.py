"""Operators 11 to 13 against plain versions, on odd rows, and on their paths for large data."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from brute import ascii_lower, split_words
from loanlab.llm import linededup, merkle, periodic

LONG = "This line is long enough to count. "


def plain_lines(rows):
    held = {}
    keyed = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keys = [ascii_lower(x.strip(" \t\n\x0b\x0c\r")) for x in lines]
        keyed.append((i, lines, keys))
        for k in keys:
            if len(k) >= 20 and i is not None:
                held.setdefault(k, set()).add(i)
    out = []
    for i, lines, keys in keyed:
        gone = [i is not None and len(held.get(k, ())) >= 3 and i < max(held[k]) for k in keys]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def line_rows():
    rng = random.Random(3)
    stock = [f"{LONG}{k} stock" for k in range(12)] + ["short", "", "  ", "\t" + LONG.upper() + "Ä\r"]
    rows = [(i, "\n".join(rng.choice(stock) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(100 + i, LONG + "hot\n" + (LONG + "hot\n") * (i % 3) + f"own line of document {i}") for i in range(70)]
    rows += [(7, "\n".join(stock)), (7, None), (7, LONG + "hot"), (None, LONG + "hot\n" + LONG + "hot"), (None, None), (200, None), (201, ""), (202, "\n\n"), (203, LONG + "hot\n" * 2), (203, LONG + "hot\n" * 2)]
    rows += [(300 + i, f"É{LONG}\né{LONG}\n" + "x" * 19 + "\n" + "y" * 20) for i in range(4)] + [(400, "\n".join(f"{LONG}{j % 700}" for j in range(20_000)))]
    return rows + [(401 + i, "\n".join(f" {LONG}{j * 3}\t" for j in range(200))) for i in range(3)]


@pytest.mark.parametrize("piece, limit", [(1 << 13, None), (8, None), (8, 0)])
def test_line_dedup_equals_plain(spark, docs, monkeypatch, piece, limit):
    monkeypatch.setattr(linededup, "PIECE", piece)
    if limit is not None:  # every join by shuffle
        monkeypatch.setattr(linededup, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(linededup, "broadcast_if_small", lambda df, size: df)
    got = linededup.line_dedup(docs(line_rows()).repartition(5)).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=str) == plain_lines(line_rows())
    for r in got:
        ends = [0, *r.keep]
        assert ends[-1] == r.n_lines and sum(b - a for a, b in zip(ends[1::2], ends[2::2])) == r.n_dropped


def test_line_dedup_of_nothing(docs):
    assert linededup.line_dedup(docs(line_rows()).limit(0)).count() == 0
    got = linededup.keep_bitmaps(docs([(1, None), (None, "a\nb")])).collect()
    assert sorted((r.n_lines, r.n_dropped, r.keep) for r in got) == [(1, 0, [1]), (2, 0, [2])]


def test_line_hashes_are_native(spark, docs):
    d = docs(line_rows()).select("doc_id", "text")
    plan = linededup.line_hashes(d)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def sample_words(rng):
    d = [str(rng.randrange(rng.randint(1, 4))) for _ in range(rng.randint(0, 90))]
    if rng.random() < 0.6 and len(d) > 8:
        a, p = rng.randrange(len(d)), rng.randint(1, 7)
        d = d[:a] + [d[a + (i - a) % min(p, len(d) - a)] for i in range(a, len(d))]
    return d


def test_runs_equal_brute_force(monkeypatch):
    rng, found = random.Random(8), 0
    monkeypatch.setattr(periodic, "GRID", 16)
    for _ in range(150):
        every = [sample_words(rng) for _ in range(rng.randint(1, 9))]
        number = {}
        coded = [np.array([number.setdefault(w, len(number)) for w in d], np.int64) for d in every]
        for d, got in zip(every, periodic.runs(coded)):
            want = plain_runs(d)
            assert [tuple(r) for r in got.tolist()] == want
            found += len(want)
    assert found > 300


def test_extension_equals_comparison():
    rng = np.random.default_rng(5)
    seq = np.concatenate([[-1], np.repeat(rng.integers(0, 3, 400), rng.integers(1, 9, 400)), [-2], np.tile([1, 2, 0, 2], 90), [-3]])
    g = periodic.Grammar(seq)
    a, b = rng.integers(1, len(seq) - 1, (2, 3000))
    a, b = a[a != b], b[a != b]
    for way in (1, -1):
        got = g.extension(a, b, way)
        for x, y, n in zip(a, b, got):
            k = 0
            while seq[x + way * k] == seq[y + way * k]:
                k += 1
            assert n == k


def test_run_rows(spark, docs):
    rng = random.Random(2)
    rows = [(i, " ".join(sample_words(rng))) for i in range(120)]
    rows += [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a a"), (5, "na " * 30_000), (6, "\x0bna x na x na x na x na x\rna x"), (5, "na " * 30_000), (900, "x y " * 2 + "x y x")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        w = split_words(t)
        w = w if i is None or not w or zlib.crc32(str(i).encode()) % 10 else periodic_words(i, w)
        found = plain_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in found)]
        best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
        want.append((i, len(found), *best, found and 1000 * best[1] // best[2] or None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(kept))))
    got = periodic.run_digests(docs(rows).repartition(4), prepare=periodic.made_periodic).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    one = periodic.periodic_runs(docs([(9, "b " + "a " * 7 + "c")])).first()
    assert [tuple(r) for r in one.runs] == [(1, 7, 1)] and one.collapsed == "b a c"
    assert periodic.run_digests(docs(rows).limit(0)).count() == 0


def periodic_words(i, w):
    h, n = zlib.crc32(str(i).encode()), len(w)
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves, fanout):
    """Top, and each leaf's list of (siblings before, siblings after) by level."""
    ways, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for j in range(len(leaves)):
            lo = at[j] - at[j] % fanout
            run = level[lo:lo + fanout]
            ways[j].append((run[:at[j] - lo], run[at[j] - lo + 1:]))
            at[j] //= fanout
        level = [sha(*level[k:k + fanout]) for k in range(0, len(level), fanout)]
    return level[0], ways


def plain_manifest(rows, fanout):
    code = lambda *f: sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in f])
    groups = {}
    for r in rows:
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
        groups.setdefault(r[2], []).append((r[0], code(*r), code(*r[:3], r[3] + 1, r[4]) if changed else code(*r)))
    order = sorted(groups, key=lambda g: b"" if g is None else b"." + g.encode())
    trees = []
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(plain_tree([x[1] for x in groups[g]], fanout))
    root, over = plain_tree([t[0] for t in trees], fanout)
    out = []
    for g, (top, ways), high in zip(order, trees, over):
        for (i, leaf, offered), way in zip(groups[g], ways):
            now = offered
            for lo, hi in way + high:
                now = sha(*lo, now, *hi)
            out.append((i, leaf, top, root, sha(*[x for lo, hi in way + high for x in lo + hi]), now, now == root))
    return sorted(out, key=str)


def manifest_rows():
    rng = random.Random(6)
    rows = [(i * 3, rng.choice(["a", None, "ü"]), rng.choice(["en", "en", "en", "de", "ß", None]), rng.choice([5, 99, None]), rng.choice([None, "", "text ä", "x" * 5000])) for i in range(150)]
    return rows + rows[:5] + [(4, "a", "one", 9, "t"), (4, "b", "", 9, "t"), (4, "b", "two", 9, "t"), (4, "c", "two", 99, "t"), (None, "c", "two", 7, "t"), (None, None, None, None, None)]


@pytest.mark.parametrize("fanout, limit", [(2, None), (3, None), (17, None), (2, 0)])
def test_manifest_equals_plain(spark, monkeypatch, fanout, limit):
    if limit is not None:
        monkeypatch.setattr(merkle, "broadcast_if_small", lambda df, size: df)
    kind = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame([(*r, "other", 1) for r in manifest_rows()], kind + ", path string, place int").repartition(7)
    got = merkle.document_manifest(docs, fanout).collect()
    assert sorted(map(tuple, got), key=str) == plain_manifest(manifest_rows(), fanout)
    assert {r.verified for r in got} == {True, False}


def test_small_manifests(spark):
    kind = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.document_manifest(spark.createDataFrame([], kind)).count() == 0
    lone = [(1, "s", "en", 3, "abc")]
    assert [tuple(r) for r in merkle.document_manifest(spark.createDataFrame(lone, kind)).collect()] == plain_manifest(lone, 2)


