"""Operator 12: periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q and at least max(6, 4 q) words that
cannot be made longer on either side.  Within a task the documents of a batch become one sequence of word
numbers, with a symbol of its own before and after each document.  Recompression rewrites the sequence in turn: blocks
of one repeated symbol become one symbol, then pairs of a left and a right symbol (the alphabet is halved
by a hash) become one; equal stretches get equal symbols except at their ends.  The levels
are a run-length grammar of logarithmic height.  A longest-common-extension query walks two places up
while their phrases are equal and down where they are not; all queries of a batch take their steps together.

Candidates are the harmonic grid: a run of period q has at least 3 q places x whose word equals the word at x + q, so
one of them is a multiple of 3 q.  These places, n/3 (1 + 1/2 + ... ) for n words, whose two words are equal, are extended
both ways by the grammar.  Of equal stretches the smallest period counts (others are its multiples).

Documents are independent: one pass, no shuffle.  A task holds about ``GROUP`` words at a time or one longer document,
and ``GRID`` candidates.

Defined results: null, empty or short texts have no run (start, length, period, exponent_milli null; digests of the empty
string and of the words); a null id is kept; equal rows give equal rows; other columns are not read.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.llm.text import map_arrow, mixed, values

LEAST_WORDS, LEAST_POWER = 6, 4
GROUP = 1 << 17    # words whose grammar is made together
GRID = 1 << 20     # candidates looked at together
LEVELS = 200       # a bound on the height that is never met: each round takes a quarter off on average


class Grammar:
    """Run-length grammar of a sequence whose first and last symbols occur once.

    The levels stand one after the other in flat arrays; an index names a symbol of some level.
    """

    def __init__(self, seq: np.ndarray):
        sym, size = [seq.astype(np.int64)], [np.ones(len(seq), np.int64)]
        up, first, last, ahead, behind, low, high = [], [], [], [], [], [], []
        base, blocks = 0, True
        low.append(np.full(len(seq), -1, np.int64))
        high.append(low[0])
        while True:
            s, n = sym[-1], len(sym[-1])
            heads = _block_heads(s) if blocks else _pair_heads(s, len(sym))
            if n <= 4 or len(sym) >= LEVELS:
                break
            m = len(heads)
            sizes = np.diff(heads, append=n)
            parent = np.repeat(np.arange(m), sizes)
            tail = heads + sizes - 1
            one = np.ones(n, np.int64)
            if blocks:  # a block can be crossed in one step
                here = np.arange(n)
                ahead.append(tail[parent] - here + 1)
                behind.append(here - heads[parent] + 1)
                name = _named(s[heads], sizes)
            else:
                ahead.append(one)
                behind.append(one)
                name = _named(s[heads], np.where(sizes > 1, s[tail], -1))
            f, t = np.zeros(n, bool), np.zeros(n, bool)
            f[heads], t[tail] = True, True
            first.append(f)
            last.append(t)
            up.append(parent + base + n)
            low.append(heads + base)
            high.append(tail + base)
            size.append(np.add.reduceat(size[-1], heads))
            sym.append(name)
            base += n
            blocks = not blocks
        n = len(sym[-1])
        up.append(np.full(n, -1, np.int64))
        for flags in (first, last):
            flags.append(np.zeros(n, bool))
        for steps in (ahead, behind):
            steps.append(np.ones(n, np.int64))
        self.sym, self.up = np.concatenate(sym), np.concatenate(up)
        start = np.concatenate([np.cumsum(x) - x for x in size])
        # by direction: border flags, steps, child to go down to, place in the sequence
        self.way = {1: (np.concatenate(first), np.concatenate(ahead), np.concatenate(low), start),
                    -1: (np.concatenate(last), np.concatenate(behind), np.concatenate(high), start + np.concatenate(size) - 1)}

    def extension(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        """How many symbols from places a and b on are equal, forwards (1) or backwards (-1)."""
        border, steps, child, place = self.way[way]
        sym, up = self.sym, self.up
        out = np.zeros(len(a), np.int64)
        todo, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        from_a = x.copy()
        while len(todo):
            ux, uy = up[x], up[y]
            same = sym[x] == sym[y]
            rise = same & border[x] & border[y] & (ux >= 0)
            rise &= sym[ux] == sym[uy]
            go = same & ~rise
            down = ~same
            cx = child[x]
            end = down & (cx < 0)
            if end.any():
                out[todo[end]] = (x[end] - from_a[end]) * way
            step = np.where(go, np.minimum(steps[x], steps[y]) * way, 0)
            nx = np.where(rise, ux, np.where(go, x + step, cx))
            ny = np.where(rise, uy, np.where(go, y + step, child[y]))
            left = ~end
            todo, x, y, from_a = todo[left], nx[left], ny[left], from_a[left]
        return out


def _block_heads(s: np.ndarray) -> np.ndarray:
    return np.nonzero(np.concatenate([[True], s[1:] != s[:-1]]))[0]


def _pair_heads(s: np.ndarray, level: int) -> np.ndarray:
    """First places of phrases, where a left symbol before a right one makes a pair."""
    right = (mixed(s.view(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) & np.uint64(1)).astype(bool)
    pair = ~right[:-1] & right[1:]
    other = right[:-1] & ~right[1:]
    if other.sum() > pair.sum():
        pair = other
    return np.nonzero(np.concatenate([[True], ~pair]))[0]


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each distinct (a, b)."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.concatenate([[False], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    out = np.empty(len(a), np.int64)
    out[order] = np.cumsum(new)
    return out


def _grid(w: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, q) of the harmonic grid over one document's words with equal words at x and x + q."""
    n = len(w)
    most = n // LEAST_POWER
    if n < LEAST_WORDS or not most:
        return
    q = np.arange(1, most + 1)
    count = (n - 1 - q) // (3 * q) + 1
    ends = np.cumsum(count)
    lo = 0
    while lo < most:
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + GRID, "right")))
        c = count[lo:hi]
        qs = np.repeat(q[lo:hi], c)
        x = (np.arange(len(qs)) - np.repeat(np.cumsum(c) - c, c)) * 3 * qs
        eq = w[x] == w[x + qs]
        yield x[eq], qs[eq]
        lo = hi


def runs(docs: list[np.ndarray]) -> list[np.ndarray]:
    """For each document (an array of word numbers >= 0) its runs: rows (start, length, period) by start, then period."""
    found = [list(_grid(w)) for w in docs]
    sizes = np.array([len(w) for w in docs])
    at = np.cumsum(sizes + 1) - sizes  # place of each document's first word
    none = np.zeros((0, 3), np.int64)
    hits = [(i, x, q) for i, parts in enumerate(found) for x, q in parts if len(x)]
    if not hits:
        return [none] * len(docs)
    seq = np.empty(int(sizes.sum()) + len(docs) + 1, np.int64)
    marks = np.concatenate([[0], np.cumsum(sizes + 1)])
    keep = np.ones(len(seq), bool)
    keep[marks] = False
    seq[keep] = np.concatenate(docs)
    seq[marks] = -1 - np.arange(len(marks))
    doc = np.concatenate([np.full(len(x), i) for i, x, _ in hits])
    x = np.concatenate([x for _, x, _ in hits]) + at[doc]
    q = np.concatenate([q for _, _, q in hits])
    g = Grammar(seq)
    after = g.extension(x, x + q, 1)
    before = g.extension(x - 1, x + q - 1, -1)
    start, length = x - before - at[doc], before + after + q
    ok = length >= np.maximum(LEAST_WORDS, LEAST_POWER * q)
    doc, start, length, q = doc[ok], start[ok], length[ok], q[ok]
    # the smallest period of each stretch
    order = np.lexsort((q, length, start, doc))
    doc, start, length, q = doc[order], start[order], length[order], q[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    doc, start, length, q = doc[new], start[new], length[new], q[new]
    order = np.lexsort((q, start, doc))
    rows = np.stack([start, length, q], axis=1)[order]
    ends = np.searchsorted(doc[order], np.arange(len(docs) + 1))
    return [rows[ends[i]:ends[i + 1]] for i in range(len(docs))]


def collapsed(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words stay: of each run the first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def _grouped(batches, prepare) -> Iterator[tuple[list, list[list[bytes]], list[np.ndarray]]]:
    """Ids, words and word numbers of about ``GROUP`` words at a time."""
    ids, words, numbers, known, held = [], [], [], {}, 0
    for b in batches:
        for i, v in zip(b.column(0).to_pylist(), values(b.column(1))):
            w = v.split() if v else []  # bytes.split: space and \t-\r
            if prepare is not None and w:
                w = prepare(i, w)
            ids.append(i)
            words.append(w)
            numbers.append(np.fromiter((known.setdefault(t, len(known)) for t in w), np.int64, len(w)))
            held += len(w)
            if held >= GROUP or len(ids) >= 1 << 13:
                yield ids, words, numbers
                ids, words, numbers, known, held = [], [], [], {}, 0
    if ids:
        yield ids, words, numbers


COLUMNS = {"n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(), "exponent_milli": pa.int64(),
           "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}


def _row(words: list[bytes], found: np.ndarray) -> tuple:
    """The digest columns of one document."""
    if not len(found):
        return 0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()
    listed = found.tolist()
    start, length, q = min(listed, key=lambda r: (-r[1], r[0], r[2]))
    kept = [w for w, k in zip(words, collapsed(len(words), found).tolist()) if k]
    told = "".join(f"{s},{n},{p}\n" for s, n, p in listed)
    return len(listed), start, length, q, 1000 * length // q, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()



def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs array<struct<start, length, period>>, collapsed string) for every row of ``docs``."""
    def run(batches):
        for ids, words, numbers in _grouped(batches, None):
            every = runs(numbers)
            kept = [b" ".join(w for w, k in zip(ws, collapsed(len(ws), f).tolist()) if k) if len(f) else b" ".join(ws) for ws, f in zip(words, every)]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in every])]).astype(np.int32)
            flat = np.concatenate(every)
            rows = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), rows), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(narrow, run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document: n_runs, the longest run and digests; ``prepare`` may change the words first."""
    def run(batches):
        for ids, words, numbers in _grouped(batches, prepare):
            cols = list(zip(*map(_row, words, runs(numbers))))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, k) for c, k in zip(cols, COLUMNS.values())]], names=["doc_id", *COLUMNS])
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(narrow, run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def made_periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contracted input: in a tenth of the documents the words from some place on repeat; null ids stay."""
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
