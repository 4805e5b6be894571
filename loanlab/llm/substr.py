"""Operator 8: exact substring dedup of 50-word windows behind a count-min prefilter.

Equal windows have equal minimisers (the least 8-word hash within the window).  Pass one counts
minimiser occurrences in a count-min sketch: each task emits its cells, sorted, and tasks merge
them by range of cells.  Only the bits "this cell counted two or more" travel back.  A window
whose minimiser has a bit clear in any row of the sketch starts in one document only; no
repeated window can be missed, since two documents give every cell of its minimiser at least
two.  Pass two groups the remaining windows exactly by a 128-bit hash of their words.

The sketch is sized to the number of minimisers (about one in 22 words) up to ``MAX_WIDTH``; past
that it lets more windows through to pass two, whose result does not depend on it.

Copies of a whole word sequence are settled by their class (smallest doc_id) before pass two, so a
group of thousands of copies costs a row for each copy, not for each window.

Defined results: null or empty text has no words; a document under 50 words loses nothing; windows
are judged on the input; rows that share a doc_id do not remove each other's words; a row with
a null doc_id loses nothing and removes nothing; words repeated inside one document stay.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.llm.text import BROADCAST_BYTES, WordHashes, broadcast_if_small, lists, map_arrow, reliable, run_hashes, values

WINDOW = 50
GRAM = 8
ROWS = 2                    # of the sketch
MIN_WIDTH, MAX_WIDTH = 1 << 20, 1 << 28   # cells in a row: at most 64 MB of bits in all
RANGES = 1 << 8             # the sketch is merged in so many parts
UNIT = 1 << 19              # windows that travel together


def minimisers(h: np.ndarray) -> np.ndarray:
    """For each window start, the least hash of the 8-word runs within the window."""
    g = run_hashes(h, GRAM, 0xA24BAED4963EE407)
    span = WINDOW - GRAM + 1
    n = len(h) - WINDOW + 1
    if n <= 0:
        return g[:0]
    pad = np.full(-len(g) % span + span, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([g, pad]).reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[span - 1:span - 1 + n])


def cells(m: np.ndarray, width: int) -> np.ndarray:
    """Cell of each minimiser in each row of the sketch (row by row)."""
    bits = np.uint64(width.bit_length() - 1)
    a = m >> (np.uint64(64) - bits)
    b = (m * np.uint64(0xD6E8FEB86659FD93)) >> (np.uint64(64) - bits)
    return np.concatenate([a, b + np.uint64(width)])


def _key(words: list[bytes]) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(b" ".join(words))
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _first(width: int):
    """Per document word count and sequence key; then the task's sketch cells by range."""
    part = ROWS * width // RANGES

    def run(batches):
        hashes, seen = WordHashes(), []
        for b in batches:
            n, k1, k2 = [], [], []
            for v in values(b.column(1)):
                words = v.split() if v else []
                n.append(len(words))
                x, y = _key(words)
                k1.append(x)
                k2.append(y)
                if len(words) >= WINDOW:
                    m = minimisers(hashes.of(words))
                    seen.append(cells(m[np.concatenate([[True], m[1:] != m[:-1]])], width).astype(np.uint32))
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())],
                                             names=["doc_id", "n", "k1", "k2", "part", "cells"])
        if seen:
            every = np.sort(np.concatenate(seen))
            ends = np.searchsorted(every, np.arange(RANGES + 1, dtype=np.uint64) * np.uint64(part))
            full = [r for r in range(RANGES) if ends[r] < ends[r + 1]]
            none = pa.nulls(len(full)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(full, pa.int32()), pa.array([every[ends[r]:ends[r + 1]].tobytes() for r in full], pa.binary())],
                                             names=["doc_id", "n", "k1", "k2", "part", "cells"])
    return run


def _merged(width: int):
    part = ROWS * width // RANGES

    def run(t: pa.Table) -> pa.Table:
        r = t.column("part")[0].as_py()
        counts = np.zeros(part, np.uint8)
        for v in values(t.column("cells")):
            cell, n = np.unique(np.frombuffer(v, np.uint32), return_counts=True)
            at = cell.astype(np.int64) - r * part
            counts[at] = np.minimum(counts[at] + np.minimum(n, 2), 2)
        return pa.table({"part": pa.array([r], pa.int32()), "bits": pa.array([np.packbits(counts >= 2, bitorder="little").tobytes()], pa.binary())})
    return run


def _windows(bits, width: int):
    """Windows estimated repeated, with 96-bit hashes, packed into units of about ``UNIT``."""
    def out(task, at, held):
        cols = [np.concatenate(x) for x in zip(*held)]
        return pa.RecordBatch.from_arrays([pa.array([task << 20 | at], pa.int64()), pa.array([len(cols[-1])], pa.int64()), *[pa.array([c.astype(k).tobytes()], pa.binary()) for c, k in zip(cols, _KINDS.values())]],
                                          names=["unit", "n", *_PACKED])

    def run(batches):
        hashes, task, at, held, size = WordHashes(), TaskContext.get().partitionId(), 0, [], 0
        flags = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            for doc, v in zip(b.column(0).to_numpy(), values(b.column(1))):
                words = v.split() if v else []
                if len(words) < WINDOW:
                    continue
                h = hashes.of(words)
                c = cells(minimisers(h), width)
                on = (flags[(c >> np.uint64(3)).astype(np.int64)] >> (c & np.uint64(7)).astype(np.uint8)) & 1
                s = np.nonzero(on.reshape(ROWS, -1).all(axis=0))[0]
                if not len(s):
                    continue
                k1, k2 = _key(words)
                held.append((np.array([doc]), np.array([k1]), np.array([k2]), np.array([len(s)]), s, run_hashes(h, WINDOW, 0x632BE59BD9B4E019)[s].view(np.int64),
                             (run_hashes(h, WINDOW, 0x9FB21C651E98DF25)[s] >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                size += len(s)
                if size >= UNIT:
                    at += 1
                    yield out(task, at, held)
                    held, size = [], 0
        if size:
            yield out(task, at + 1, held)
    return run


_PACKED = ("doc_id", "k1", "k2", "sizes", "starts", "ha", "hb")
_KINDS = dict(zip(_PACKED, (np.int64, np.int64, np.int64, np.int32, np.int32, np.int64, np.int32)))


def _unpacked(row: dict) -> dict:
    return {c: np.frombuffer(row[c], _KINDS[c]) for c in _PACKED}


def _heads(ha: np.ndarray, hb: np.ndarray) -> np.ndarray:
    """First position of each distinct (ha, hb) in sorted arrays."""
    return np.nonzero(np.concatenate([[True], (ha[1:] != ha[:-1]) | (hb[1:] != hb[:-1])]))[0]


def _spread(bits: int):
    """Each unit's distinct windows, with its smallest and largest doc_id, by range of the hash."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                u = _unpacked(row)
                doc = np.repeat(u["doc_id"], u["sizes"])
                order = np.lexsort((doc, u["hb"], u["ha"]))
                ha, hb, doc = u["ha"][order], u["hb"][order], doc[order]
                new = _heads(ha, hb)
                last = np.append(new[1:], len(ha)) - 1
                ha, hb, lo, hi = ha[new], hb[new], doc[new], doc[last]
                part = (ha >> np.int64(64 - bits)) + (1 << (bits - 1))
                ends = np.searchsorted(part, np.arange((1 << bits) + 1))
                full = [r for r in range(1 << bits) if ends[r] < ends[r + 1]]
                cut = lambda x: pa.array([x[ends[r]:ends[r + 1]].tobytes() for r in full], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([row["unit"]] * len(full), pa.int64()), cut(ha), cut(hb), cut(lo), cut(hi)], names=["part", "unit", "ha", "hb", "lo", "hi"])
    return run


def _firsts(t: pa.Table) -> pa.Table:
    """For each unit the windows of this range that start in a document smaller than one of its own."""
    cols = {c: [np.frombuffer(v, k) for v in values(t.column(c))] for c, k in (("ha", np.int64), ("hb", np.int32), ("lo", np.int64), ("hi", np.int64))}
    row = np.repeat(np.arange(t.num_rows), [len(x) for x in cols["ha"]])
    ha, hb, lo, hi = (np.concatenate(cols[c]) for c in ("ha", "hb", "lo", "hi"))
    order = np.lexsort((lo, hb, ha))
    ha, hb, lo, hi, row = ha[order], hb[order], lo[order], hi[order], row[order]
    new = _heads(ha, hb)
    first = np.repeat(lo[new], np.diff(new, append=len(ha)))
    tell = np.nonzero(first < hi)[0]
    tell = tell[np.argsort(row[tell], kind="stable")]
    ends = np.searchsorted(row[tell], np.arange(t.num_rows + 1))
    unit = t.column("unit").to_pylist()
    full = [r for r in range(t.num_rows) if ends[r] < ends[r + 1]]
    cut = lambda x: pa.array([x[tell[ends[r]:ends[r + 1]]].tobytes() for r in full], pa.binary())
    return pa.table({"unit": pa.array([unit[r] for r in full], pa.int64()), "ha": cut(ha), "hb": cut(hb), "first": cut(first)})


def _covered(units: pa.Table, firsts: pa.Table) -> pa.Table:
    """Starts of each document's windows that also start in a smaller document."""
    empty = {"doc_id": pa.int64(), "k1": pa.int64(), "k2": pa.int64(), "starts": pa.list_(pa.int32())}
    if not units.num_rows or not firsts.num_rows:
        return pa.table({c: pa.array([], k) for c, k in empty.items()})
    u = _unpacked(units.to_pylist()[0])
    ha, hb, first = (np.concatenate([np.frombuffer(v, k) for v in values(firsts.column(c))]) for c, k in (("ha", np.int64), ("hb", np.int32), ("first", np.int64)))
    # told windows and own windows in one order: each own window looks at the told one of its hash
    n = len(ha)
    every_a, every_b = np.concatenate([ha, u["ha"]]), np.concatenate([hb, u["hb"]])
    own = np.concatenate([np.zeros(n, np.int8), np.ones(len(u["ha"]), np.int8)])
    order = np.lexsort((own, every_b, every_a))
    new = _heads(every_a[order], every_b[order])
    head = np.repeat(order[new], np.diff(new, append=len(order)))
    least = np.full(len(order), np.iinfo(np.int64).max)
    told = head < n
    least[order[told]] = first[head[told]]
    doc = np.repeat(np.arange(len(u["doc_id"])), u["sizes"])
    gone = least[n:] < u["doc_id"][doc]
    at, where = u["starts"][gone].astype(np.int64), doc[gone]
    # of a run of consecutive windows every 50th and the last cover the same words
    if len(at):
        head = np.nonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (where[1:] != where[:-1])]))[0]
        size = np.diff(head, append=len(at))
        step = np.arange(len(at)) - np.repeat(head, size)
        need = (step % WINDOW == 0) | (step == np.repeat(size, size) - 1)
        at, where = at[need], where[need]
    full, ends = np.unique(where, return_index=True)
    ends = np.append(ends, len(where))
    return pa.table({"doc_id": pa.array(u["doc_id"][full]), "k1": pa.array(u["k1"][full]), "k2": pa.array(u["k2"][full]),
                     "starts": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))})


def _kept(batches):
    """What is left of each document after its covered windows; see ``substring_dedup``."""
    for b in batches:
        n, gone, text = [], [], []
        for v, copy, starts in zip(values(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
            words = v.split() if v else []
            n.append(len(words))
            if copy and len(words) >= WINDOW:
                words, out = [], len(words)
            elif starts:
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.unique(np.asarray(starts, np.int64))
                edge[at] += 1
                edge[at + WINDOW] -= 1
                keep = (np.cumsum(edge[:-1]) == 0).tolist()
                left = [w for w, k in zip(words, keep) if k]
                words, out = left, len(words) - len(left)
            else:
                out = 0
            gone.append(out)
            text.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(text, pa.binary()).cast(pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept"])


def _digested(batches):
    for b in _kept(batches):
        sha = pa.array([hashlib.sha256(v).hexdigest() for v in values(b.column(3))], pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns[:3], sha], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words (``kept``, or their SHA-256 if ``digest``)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # a word takes two bytes at least, and minimisers of 43 runs are about one in 22 words
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = min(MAX_WIDTH, max(MIN_WIDTH, 1 << (size // 32).bit_length()))
    first = reliable(map_arrow(docs, _first(width), "doc_id long, n long, k1 long, k2 long, part int, cells binary"))
    bits = bytearray(ROWS * width // 8)
    step = len(bits) // RANGES
    for r in first.where("part is not null").select("part", "cells").groupBy("part").applyInArrow(_merged(width), "part int, bits binary").toLocalIterator():
        bits[r.part * step:(r.part + 1) * step] = r.bits  # at most MAX_WIDTH * ROWS / 8 bytes in all
    flags = spark.sparkContext.broadcast(bytes(bits))

    # copies of whole word sequences: all but the smallest doc_id
    rows = first.where(f"part is null and doc_id is not null and n >= {WINDOW}").select("doc_id", "k1", "k2")
    same = reliable(rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where("rep < last").drop("last"))
    copies = reliable(rows.join(broadcast_if_small(same, 96), ["k1", "k2"]).where("doc_id > rep").select("doc_id", "k1", "k2").distinct())

    keyed = first.where("part is null").select("doc_id", "k1", "k2")
    twice = reliable(keyed.groupBy("doc_id").agg(F.countDistinct("k1", "k2").alias("c")).where("c > 1 and doc_id is not null").select("doc_id"))

    # a copy's words all go, and its windows are its first's: leaving copies out saves work and
    # changes nothing, so it is done where their ids are few enough to broadcast
    open_docs = docs.where("doc_id is not null")
    single = copies.join(twice, "doc_id", "left_anti").select("doc_id")
    if copies.count() * 32 <= BROADCAST_BYTES:
        open_docs = open_docs.join(F.broadcast(single), "doc_id", "left_anti")
    blobs = ", ".join(f"{c} binary" for c in _PACKED)
    units = reliable(map_arrow(open_docs, _windows(flags, width), f"unit long, n long, {blobs}"))
    total = units.agg(F.sum("n")).first()[0] or 0
    bits = min(16, max(8, (total >> 20).bit_length()))  # about a million windows in each range
    spread = map_arrow(units, _spread(bits), "part int, unit long, ha binary, hb binary, lo binary, hi binary")
    told = spread.groupBy("part").applyInArrow(_firsts, "unit long, ha binary, hb binary, first binary")
    covered = units.groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(_covered, "doc_id long, k1 long, k2 long, starts array<int>")
    # repeated rows give equal starts; copies lose all their words anyway
    covered = covered.groupBy("doc_id", "k1", "k2").agg(F.max("starts").alias("starts")).join(broadcast_if_small(copies, 64), ["doc_id", "k1", "k2"], "left_anti")
    out = reliable(covered.withColumn("copy", F.lit(False)).unionByName(copies.select("*", F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("copy"))))

    # texts meet their removals by id and sequence; rows without removals pass by
    if twice.take(1):  # rows that share a doc_id: the join needs the sequence too
        docs = map_arrow(docs, _with_key, "doc_id long, text string, k1 long, k2 long")
        joined = docs.join(_sized(out), ["doc_id", "k1", "k2"], "left")
    else:
        joined = docs.join(_sized(out.drop("k1", "k2")), "doc_id", "left")
    joined = joined.select("doc_id", "text", "copy", "starts")
    if digest:
        return map_arrow(joined, _digested, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return map_arrow(joined, _kept, "doc_id long, n_words long, n_removed long, kept string")


def _with_key(batches):
    for b in batches:
        keys = [_key(v.split() if v else []) for v in values(b.column(1))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())], names=["doc_id", "text", "k1", "k2"])


def _sized(out: DataFrame) -> DataFrame:
    """Broadcast the removals only if their measured size allows it."""
    size = out.agg(F.sum(F.lit(64) + F.coalesce(F.size("starts"), F.lit(0)) * 4)).first()[0] or 0
    return F.broadcast(out) if size <= BROADCAST_BYTES else out
