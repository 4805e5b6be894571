"""Operator 9: n-gram Jaccard join by rare-first prefix filtering.

Documents are sets of distinct 5-word shingles (64-bit hashes).  Equal sets collapse first to
the smallest doc_id of their class.  Shingles are ordered by how common their hash bucket is
over all documents (a fixed-size count table, so any size of corpus has the same broadcast) and
then by hash: any fixed order gives right prefixes, a rare-first one gives short buckets.  Two
sets with similarity >= 0.8 share a shingle within the first ``n - ceil(0.8 n) + 1`` of the longer
and the first ``n - ceil(8 n / 9) + 1`` of the shorter; buckets of one shingle meet there, under the
length and positional filters; a pair must also share as many prefix shingles as its
lengths imply.  Pairs come in two rounds, so that a group of m near copies
costs m pairs and not m^2: first each bucket's member with the fewest rarer shingles against
the others; then, after components are formed from the verified links, only pairs that still
lie in different components.  A pair within one component cannot change the result, so no
link between components is lost.  Every pair is verified once, on whole sets, after the suffix
filter (a lower bound on the Hamming distance from counts between fixed pivots).

Defined results: null, empty or wordless text: no shingles, linked with nothing; fewer than
five words: one shingle, the whole sequence; rows that share a doc_id are one node; a null
doc_id takes no part (component_id null); repeated rows are returned as often as they occur.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.llm.graph import components
from loanlab.llm.text import WordHashes, broadcast_if_small, lists, map_arrow, reliable, run_hashes, values

WORDS = 5
BUCKETS = 1 << 20   # of the document-frequency table: 4 MB whatever the corpus
CHUNKS = 256
PIVOTS = np.arange(-32, 32, dtype=np.int64) << np.int64(58)


def shingle_set(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a document's words, as signed 64-bit."""
    if not words:
        return np.zeros(0, np.int64)
    k = min(WORDS, len(words))
    return np.unique(run_hashes(hashes.of(words), k, 0x51ED270B + k).view(np.int64))


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased (bytes.lower is ASCII only), split at space and \\t-\\r."""
    return text.lower().split() if text else []


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s.view(np.uint64) >> np.uint64(44)).astype(np.int64)


def _sizes(batches):
    """Per document id, set size and 128-bit set key; then this task's bucket counts in chunks."""
    hashes, counts = WordHashes(), np.zeros(BUCKETS, np.uint32)
    for b in batches:
        n, k1, k2 = [], [], []
        for v in values(b.column(1)):
            s = shingle_set(words_of(v), hashes)
            if len(s):
                np.add.at(counts, _bucket(s), 1)
            d = xxhash.xxh3_128_digest(s.tobytes())
            n.append(len(s))
            k1.append(int.from_bytes(d[:8], "little", signed=True))
            k2.append(int.from_bytes(d[8:], "little", signed=True))
        none = pa.nulls(len(n))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())],
                                         names=["doc_id", "n", "k1", "k2", "chunk", "cells"])
    parts = counts.reshape(CHUNKS, -1)
    full = [c for c in range(CHUNKS) if parts[c].any()]
    none = pa.nulls(len(full)).cast(pa.int64())
    yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(full, pa.int32()), pa.array([parts[c].astype("<u4").tobytes() for c in full], pa.binary())],
                                     names=["doc_id", "n", "k1", "k2", "chunk", "cells"])


def _summed(t: pa.Table) -> pa.Table:
    total = np.zeros(BUCKETS // CHUNKS, np.int64)
    for v in values(t.column("cells")):
        total += np.frombuffer(v, "<u4")
    return pa.table({"chunk": t.column("chunk")[:1].cast(pa.int32()), "cells": pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()], pa.binary())})


def _prefixes(table):
    """Per document the rarest shingles, in order: as many as the probing prefix has."""
    def run(batches):
        hashes = WordHashes()
        common = np.frombuffer(table.value, "<u4")
        for b in batches:
            n, k1, out = [], [], []
            for v in values(b.column(1)):
                s = shingle_set(words_of(v), hashes)
                m = len(s)
                n.append(m)
                k1.append(int.from_bytes(xxhash.xxh3_128_digest(s.tobytes())[:8], "little", signed=True))
                p = m - (4 * m + 4) // 5 + 1
                out.append(s[np.lexsort((s, common[_bucket(s)]))[:p]] if m >= 4 else s[:0])  # below 4 only equal sets link
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), lists(out, pa.int64())], names=["doc_id", "n", "k1", "prefix"])
    return run


def _sets(batches):
    hashes = WordHashes()
    for b in batches:
        out = [shingle_set(words_of(v), hashes) for v in values(b.column(1))]
        yield pa.RecordBatch.from_arrays([b.column(0), lists(out, pa.int64())], names=["doc_id", "items"])


def _verified(batches):
    """Pairs that link: suffix filter, then the exact intersection."""
    def rows(col):
        ends, flat = col.offsets.to_numpy(), col.values.to_numpy()
        return [flat[ends[i]:ends[i + 1]] for i in range(len(col))]

    for b in batches:
        keep = []
        for x, y in zip(rows(b.column(2)), rows(b.column(3))):
            need = (4 * (len(x) + len(y)) + 8) // 9
            apart = np.abs(np.diff(np.searchsorted(x, PIVOTS), append=len(x)) - np.diff(np.searchsorted(y, PIVOTS), append=len(y))).sum()
            keep.append(len(x) + len(y) - apart >= 2 * need and len(np.intersect1d(x, y, assume_unique=True)) >= need)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _keys(bits: int):
    """Prefix shingles of this task by range of their top bits, with two flags each: seen in
    several documents, and seen within an indexing prefix."""
    def out(held):
        s, index = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(s, kind="stable")
        s, index = s[order], index[order]
        new = np.nonzero(np.concatenate([[True], s[1:] != s[:-1]]))[0]
        keys = s[new]
        flags = (np.diff(new, append=len(s)) > 1).astype(np.uint8) | (np.add.reduceat(index, new) > 0).astype(np.uint8) << 1
        part = (keys >> np.int64(64 - bits)) + (1 << (bits - 1))
        ends = np.searchsorted(part, np.arange((1 << bits) + 1))
        full = [r for r in range(1 << bits) if ends[r] < ends[r + 1]]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([keys[ends[r]:ends[r + 1]].tobytes() for r in full], pa.binary()), pa.array([flags[ends[r]:ends[r + 1]].tobytes() for r in full], pa.binary())], names=["part", "keys", "flags"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            n, (ends, flat) = b.column(0).to_numpy(), (b.column(1).offsets.to_numpy(), b.column(1).values.to_numpy())
            sizes = np.diff(ends)
            pos = np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], sizes)
            held.append((flat[ends[0]:ends[-1]], (pos < np.repeat(n - (8 * n + 8) // 9 + 1, sizes)).astype(np.int32)))
            size += len(pos)
            if size > 1 << 20:
                yield out(held)
                held, size = [], 0
        if size:
            yield out(held)
    return run


def _shared(t: pa.Table) -> pa.Table:
    """Shingles of one range that are in several prefixes, one of them an indexing prefix."""
    s = np.concatenate([np.frombuffer(v, np.int64) for v in values(t.column("keys"))])
    flags = np.concatenate([np.frombuffer(v, np.uint8) for v in values(t.column("flags"))])
    order = np.argsort(s, kind="stable")
    s, flags = s[order], flags[order]
    new = np.nonzero(np.concatenate([[True], s[1:] != s[:-1]]))[0]
    any_flag = np.bitwise_or.reduceat(flags, new)
    ok = ((np.diff(new, append=len(s)) > 1) | (any_flag & 1 > 0)) & (any_flag & 2 > 0)
    return pa.table({"s": pa.array(s[new][ok], pa.int64())})


def _pairs(joined: DataFrame) -> DataFrame:
    """(a, b) of the joined members x, y of buckets that pass the length and positional filters.

    The first shingle that a linked pair shares, at positions i and j, leaves an overlap of at most
    min(nx - i, ny - j), so this bound holds in one bucket at least.
    """
    nx, ny, i, j = (F.col(c) for c in ("x.n", "y.n", "x.pos", "y.pos"))
    fits = (5 * F.least(nx, ny) >= 4 * F.greatest(nx, ny)) & (9 * F.least(nx - i, ny - j) >= 4 * (nx + ny))
    return joined.where(fits).select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()


def _likely(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Pairs that share as many prefix shingles as a link needs: with an overlap of ``need``,
    prefixes of n - ceil(0.8 n) + 1 share at least need - ceil(0.8 max n) + 1."""
    ids = reliable(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct())
    some = reliable(prefixes.join(broadcast_if_small(ids, 48), "doc_id", "left_semi"))
    x, y = (some.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("prefix").alias(f"p{c}")) for c in ("a", "b"))
    need = F.ceil(4 * (F.col("na") + F.col("nb")) / 9) - F.ceil(4 * F.greatest("na", "nb") / 5) + 1
    return pairs.join(x, "a").join(y, "b").where(F.size(F.array_intersect("pa", "pb")) >= need).select("a", "b")


def similarity_links(docs: DataFrame, sets_from: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets have similarity >= 0.8, each verified once."""
    ids = reliable(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct())
    some = sets_from.join(broadcast_if_small(ids, 48), "doc_id", "left_semi")
    sets = reliable(map_arrow(some, _sets, "doc_id long, items array<long>"))
    both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y"))
    return map_arrow(both, _verified, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (see the module)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    first = reliable(map_arrow(docs, _sizes, "doc_id long, n long, k1 long, k2 long, chunk int, cells binary"))
    rows = first.where("chunk is null").drop("chunk", "cells")
    counts = first.where("chunk is not null").select("chunk", "cells").groupBy("chunk").applyInArrow(_summed, "chunk int, cells binary")
    table = bytearray(4 * BUCKETS)
    for r in counts.collect():  # the count table: 4 MB in all
        table[r.chunk * 4 * BUCKETS // CHUNKS:(r.chunk + 1) * 4 * BUCKETS // CHUNKS] = r.cells
    common = spark.sparkContext.broadcast(bytes(table))

    # classes of equal sets; only those of several documents are kept
    some = rows.where("n > 0 and doc_id is not null")
    same = reliable(some.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where("rep < last").drop("last"))
    rows = rows.join(broadcast_if_small(same, 96), ["k1", "k2"], "left")
    rows = reliable(rows.select("doc_id", "n", "k1", F.when(F.col("n") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")).alias("rep")))
    others = reliable(rows.where("doc_id <> rep").select("doc_id", "k1").distinct())
    own = rows.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")

    prefixes = map_arrow(docs.where("doc_id is not null"), _prefixes(common), "doc_id long, n long, k1 long, prefix array<long>")
    prefixes = reliable(prefixes.where(F.size("prefix") > 0).join(broadcast_if_small(others, 64), ["doc_id", "k1"], "left_anti").select("doc_id", "n", "prefix"))
    total = prefixes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    bits = min(16, max(8, (total >> 20).bit_length()))  # about a million shingles in each range
    shared = reliable(map_arrow(prefixes.select("n", "prefix"), _keys(bits), "part int, keys binary, flags binary").groupBy("part").applyInArrow(_shared, "s long"))
    posted = prefixes.select("doc_id", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "s"))
    posted = reliable(posted.join(broadcast_if_small(shared, 48), "s", "left_semi"))

    hubs = reliable(posted.groupBy("s").agg(F.min(F.struct("pos", "n", "doc_id")).alias("h")).select("s", "h.pos", "h.n", "h.doc_id"))
    star = posted.alias("x").join(broadcast_if_small(hubs, 96).alias("y"), (F.col("x.s") == F.col("y.s")) & (F.col("x.doc_id") != F.col("y.doc_id")))
    tried = reliable(_likely(reliable(_pairs(star)), prefixes))
    links = reliable(similarity_links(docs, docs, tried).union(own))
    roots = reliable(components(links))

    # second round: members of one bucket that are still in different components
    member = posted.join(broadcast_if_small(roots.select(F.col("node").alias("doc_id"), "root"), 64), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    member = reliable(member)
    mixed = reliable(member.groupBy("s").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("s"))
    member = reliable(member.join(broadcast_if_small(mixed, 48), "s", "left_semi"))
    x, y = member.alias("x"), member.alias("y")
    rest = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.doc_id") < F.col("y.doc_id")) & (F.col("x.root") != F.col("y.root")))
    rest = reliable(_pairs(rest).join(tried, ["a", "b"], "left_anti"))
    rest = reliable(_likely(rest, prefixes)) if rest.take(1) else rest
    more = reliable(similarity_links(docs, docs, rest))
    roots = reliable(components(links.union(more))) if more.take(1) else roots

    roots = roots.select(F.col("node").alias("rep"), "root")
    return (rows.join(broadcast_if_small(roots, 64), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component_id")))
