"""Operator 3: exact top-k inner products by block-at-a-time pruning.

Vectors become integers floor(1024 x).  Rows are ordered by their nearest pivot and then by id, and
cut into document-range blocks of ``BLOCK`` rows; a block keeps its forward index (the vectors) and the
largest and smallest value of each term (component).  For a query the sum of its terms' maxima
bounds every score in the block.  Queries travel in broadcast batches of at most ``BATCH``; each
task orders its blocks by that bound for each query and scores them until the bounds fall below
the k-th score so far.  The first k-th score comes from a bounded sample of rows, scored
beforehand; being real rows, they can only give too low a threshold, never a wrong one.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part, nor do rows
without an id; a query never meets rows of its own id; ties go to the smaller id; repeated rows
count as often as they occur; of several query rows with one id the least vector is the query;
vectors of unequal length count as padded with zeros; a score beyond a long is clipped to it.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlab.llm.text import map_arrow, reliable

BLOCK = 256
PART = 1 << 17        # rows of a partition at most, about: 32 MB of 64 integers
BATCH = 1 << 15       # queries of one broadcast (16 MB of 64 doubles)
PIVOTS = 64
SAMPLE = 2048
LONG = 2**63 - 1
HUGE = 1e150   # integers beyond count as this: a score of theirs is past a long anyway, unless they cancel out


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as integers in doubles, padded with zeros to ``dim``."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    flat = flat[ends[0]:ends[-1]]
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes] or [np.zeros(0, int)])] = flat
    return out


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products, clipped to int64."""
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)), np.int64)
    if np.abs(q).max() * np.abs(v).max() * q.shape[1] < 2**53:
        return (q @ v.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], dtype=object) @ np.array([[int(x) for x in r] for r in v], dtype=object).T
    return np.clip(exact, -LONG, LONG).astype(np.int64)


def _blocks(dim: int):
    def run(batches):
        ids, rows = np.zeros(0, np.int64), np.zeros((0, dim))

        def out(n):
            i, r = ids[:n], rows[:n]
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (i, r, r.max(axis=0), r.min(axis=0))], names=["ids", "rows", "hi", "lo"])

        for b in batches:
            ids, rows = np.concatenate([ids, b.column(0).to_numpy()]), np.concatenate([rows, matrix(b.column(1), dim)])
            while len(ids) >= BLOCK:
                yield out(BLOCK)
                ids, rows = ids[BLOCK:], rows[BLOCK:]
        if len(ids):
            yield out(len(ids))
    return run


def _near(pivots: np.ndarray, dim: int):
    def run(batches):
        for b in batches:
            m = matrix(b.column(1), dim)
            near = (m @ pivots.T).argmax(axis=1) if len(pivots) and dim else np.zeros(len(m), np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.astype(np.int32))], names=["vec_id", "v", "near"])
    return run


def _scored(shared, k: int, dim: int):
    """Each query's best rows of this task's blocks."""
    def run(batches):
        qid, q, floor = shared.value
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        for b in batches:
            col = [c.to_pylist() for c in b.columns]
            ids = [np.frombuffer(x, np.int64) for x in col[0]]
            rows = [np.frombuffer(x).reshape(len(i), dim) for x, i in zip(col[1], ids)]
            hi, lo = (np.array([np.frombuffer(x) for x in c]).reshape(len(ids), dim) for c in col[2:])
            for at in range(0, len(qid), 1024):
                part = slice(at, min(at + 1024, len(qid)))
                yield from _search(qid[part], q[part], floor[part], up[part] @ hi.T + down[part] @ lo.T, ids, rows, k)
    return run


def _search(qid, q, floor, bound, ids, rows, k):
    """Score blocks in order of bound until it falls below the k-th score."""
    # the bound is summed in another order than the scores: room for rounding of huge values
    bound = bound + np.abs(bound) * 1e-9
    order = np.argsort(-bound, axis=1, kind="stable")
    kth, best = floor.astype(np.float64), [[] for _ in qid]
    live = np.arange(len(qid))
    for r in range(len(ids)):
        block = order[live, r]
        go = bound[live, block] >= kth[live]
        live, block = live[go], block[go]
        if not len(live):
            break
        for j in np.unique(block):
            mine = live[block == j]
            score = products(q[mine], rows[j])
            x, y = np.nonzero((score >= kth[mine][:, None]) & (ids[j][None, :] != qid[mine][:, None]))
            for i in np.unique(x):
                m, c = mine[i], y[x == i]
                got = best[m] + list(zip((-score[i, c]).tolist(), ids[j][c].tolist()))
                got.sort()
                best[m] = got[:k]
                if len(best[m]) == k:
                    kth[m] = max(kth[m], -best[m][-1][0])
    found = [(i, v, -s) for i, got in zip(qid.tolist(), best) for s, v in got]
    if found:
        i, v, s = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64())], names=["query_id", "vec_id", "score"])


def _sample(v: DataFrame, n: int, total: int, dim: int):
    """Ids and vectors of about ``n`` rows, drawn by hash of the id (at most 4n)."""
    some = v.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < min(1.0, n / max(total, 1)) * (1 << 20)).limit(4 * n).toArrow()
    return some.column("vec_id").to_numpy(), matrix(some.column("v").combine_chunks() if some.num_rows else pa.array([], pa.list_(pa.float64())), dim)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows of ``vectors``, exactly.

    Both frames have vec_id and embedding.
    """
    spark = vectors.sparkSession

    def whole(df):
        ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null").where(ok).select(
            "vec_id", F.transform("embedding", lambda x: _floor(x * 1024)).alias("v"))

    v, qs = whole(vectors), whole(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    shape = v.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    dim = shape.d or 0
    parts = max(-(-shape.n // PART), min(32, -(-shape.n // (4 * BLOCK))), 1)
    near = _sample(v, PIVOTS, shape.n, dim)[1]
    near = near / np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-300) if len(near) else near
    placed = map_arrow(v, _near(near, dim), "vec_id long, v array<double>, near int")
    placed = placed.repartitionByRange(parts, "near", "vec_id").sortWithinPartitions("near", "vec_id").select("vec_id", "v")
    blocks = reliable(map_arrow(placed, _blocks(dim), "ids binary, rows binary, hi binary, lo binary"))

    sid, sample = _sample(v, SAMPLE, shape.n, dim)
    done, held = [], []

    def run():
        qid, q = np.array([r.vec_id for r in held], np.int64), np.zeros((len(held), dim))
        for i, r in enumerate(held):
            q[i, :len(r.v)] = r.v
        floor = np.full(len(held), -np.inf)
        for at in range(0, len(held), 4096):
            s = products(q[at:at + 4096], sample).astype(np.float64)
            s[sid[None, :] == qid[at:at + 4096, None]] = -np.inf
            if s.shape[1] >= k:
                floor[at:at + 4096] = np.partition(s, -k, axis=1)[:, -k]
        shared = spark.sparkContext.broadcast((qid, q, floor))
        best = map_arrow(blocks, _scored(shared, k, dim), "query_id long, vec_id long, score long")
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        done.append(reliable(best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)))
        shared.unpersist()
        held.clear()

    for r in qs.toLocalIterator():  # one bounded batch of queries at a time
        held.append(r)
        if len(held) == BATCH:
            run()
    run()
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out.select("query_id", "rank", "vec_id", "score")


def _floor(x: F.Column) -> F.Column:
    """Floor as a double (Spark's floor gives a long, which huge values leave)."""
    return F.when(F.abs(x) < 2.0**62, F.floor(F.when(F.abs(x) < 2.0**62, x).otherwise(0.0)).cast("double")).otherwise(F.greatest(F.lit(-HUGE), F.least(F.lit(HUGE), x)))
