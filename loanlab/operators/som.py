"""Self-organizing map, batch form, on Spark.

Training: the codebook (grid w x h, d weights per node; its size is set by the
grid, never by the data) goes to the tasks in their closure; each partition
finds every row's best-matching node with one matrix product per Arrow batch
and returns, per node, the row count and the sum of its rows (``mapInArrow``);
Spark adds the partial sums by (node, dim).  The driver then smooths the sums
with the neighbourhood kernel on the (periodic) grid, shrinks the radius and
goes again.  One job per pass, the input is persisted once, lineage does not
grow.  Projection and the node tables are DataFrame jobs.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlab.functions.columns import hash_u32
from loanlab.session import right_size, ship


def grid_coords(w: int, h: int, topology: str = "hex") -> np.ndarray:
    xs, ys = np.meshgrid(np.arange(w), np.arange(h))
    gx, gy = xs.ravel().astype(float), ys.ravel().astype(float)
    if topology == "hex":
        return np.stack([gx + 0.5 * (gy % 2), gy * math.sqrt(3) / 2], axis=1)
    return np.stack([gx, gy], axis=1)


def grid_dist2(w: int, h: int, periodic: bool = True, topology: str = "hex") -> np.ndarray:
    """Squared distances between all nodes on the grid (minimum image if periodic)."""
    p = grid_coords(w, h, topology)
    d = np.abs(p[:, None, :] - p[None, :, :])
    if periodic:
        span = np.array([w, h * (math.sqrt(3) / 2 if topology == "hex" else 1.0)])
        d = np.minimum(d, span - d)
    return (d ** 2).sum(-1)


def _bmu(x: np.ndarray, cb: np.ndarray):
    """Best-matching node per row: squared distance by direct differences, ties to the lowest node; memory capped by chunking rows.

    One matrix product finds the nodes that rounding leaves in question, for most rows one; only their distances are
    taken by differences."""
    n, k = x.shape[0], cb.shape[0]
    step = max(1, 1_000_000 // max(1, k))
    idx, dist = np.empty(n, dtype=np.int64), np.empty(n)
    c2 = (cb * cb).sum(-1)
    for s in range(0, n, step):
        part = x[s:s + step]
        x2 = (part * part).sum(-1)
        near = c2 - 2.0 * (part @ cb.T)               # less the row's own square, which is the same for all nodes
        slack = 1e-12 * max(1, cb.shape[1]) * (x2 + c2.max())
        row, node = np.nonzero(~(near > (near.min(axis=1) + slack)[:, None]))   # all nodes of a row that is not finite
        diff = part[row] - cb[node]
        d2 = (diff * diff).sum(-1)
        head = np.searchsorted(row, np.arange(len(part)))
        if len(row) > len(part):
            order = np.lexsort((node, d2, row))       # a row without a number has no distance: its first node
            row, node, d2 = row[order], node[order], d2[order]
        idx[s:s + step], dist[s:s + step] = node[head], d2[head]
    return idx, dist


def _stack(pdf: pd.DataFrame, col: str) -> np.ndarray:
    return np.stack(pdf[col].to_numpy()).astype(float) if len(pdf) else np.zeros((0, 0))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    """The lists of the first column as rows; a gap within is a NaN."""
    x = b.column(0)
    if x.null_count:
        raise ValueError("a row without features")
    return x.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(x), -1)


def _sums_fn(cb: np.ndarray):
    """Per partition, long rows (node, i, v): i >= 0 the coordinate sums of the
    node's rows, i = -1 their count; node -1 carries the summed BMU distance."""
    k, d = cb.shape

    def run(batches):
        n = np.zeros(k)
        s = np.zeros((k, d))
        qe = 0.0
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b)
            j, d2 = _bmu(x, cb)
            n += np.bincount(j, minlength=k)
            np.add.at(s, j, x)
            qe += np.sqrt(d2).sum()
        nz = np.nonzero(n)[0]
        node = np.concatenate([np.repeat(nz, d + 1), [-1]]).astype("int32")
        idx = np.concatenate([np.tile(np.arange(-1, d), len(nz)), [0]]).astype("int32")
        val = np.concatenate([np.column_stack([n[nz], s[nz]]).ravel(), [qe]])
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (node, idx, val)], names=["node", "i", "v"])
    return run


class SOMModel:
    def __init__(self, codebook: np.ndarray, w: int, h: int, periodic: bool, topology: str, history=None):
        self.codebook, self.w, self.h, self.periodic, self.topology = codebook, w, h, periodic, topology
        self.history = history or []

    def codebook_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, i % self.w, i // self.w, self.codebook[i].tolist()) for i in range(self.codebook.shape[0])]
        return spark.createDataFrame(rows, "node int, gx int, gy int, w array<double>")

    def project(self, df: DataFrame, col: str = "features", keep: Sequence[str] = ()) -> DataFrame:
        """Adds (node, gx, gy, dist2) per row: best-matching node, ties to the
        lowest node number; ``keep`` columns are carried."""
        return project(df, self.codebook, self.w, col, keep)


def project(df: DataFrame, codebook: np.ndarray, w: int, col: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    cb = np.asarray(codebook, dtype=float)
    keep = list(keep)

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            j, d2 = _bmu(_stack(pdf, col), cb)
            out = pdf[keep].copy()
            out["node"] = j.astype("int32")
            out["gx"] = (j % w).astype("int32")
            out["gy"] = (j // w).astype("int32")
            out["dist2"] = d2
            yield out
    fields = [f for f in df.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema = (schema + ", " if schema else "") + "node int, gx int, gy int, dist2 double"
    ship(df.sparkSession)
    return df.select(*keep, col).mapInPandas(run, schema)


class BatchSOM:
    """Batch SOM: ``passes`` full passes with a Gaussian neighbourhood whose
    radius shrinks geometrically from ``sigma0`` (default: half the grid) to
    ``sigma_end``.  Initial nodes: the ``w*h`` rows with the smallest key hash
    (a top-k, bounded by the grid size)."""

    def __init__(self, w: int = 20, h: int = 20, periodic: bool = True, topology: str = "hex", passes: int = 20,
                 sigma0: float | None = None, sigma_end: float = 0.5, seed: int = 111):
        self.w, self.h, self.periodic, self.topology, self.passes = w, h, periodic, topology, passes
        self.sigma0 = sigma0 if sigma0 is not None else max(w, h) / 2.0
        self.sigma_end, self.seed = sigma_end, seed

    def fit(self, df: DataFrame, col: str = "features", key: str | None = None) -> SOMModel:
        k = self.w * self.h
        dim = len(df.select(col).first()[col] or [])
        data = right_size(df.select(col, *([key] if key else [])), 8 * (dim + 2))
        order = hash_u32(key, self.seed, "som") if key else F.xxhash64(col)
        first = data.orderBy(order).limit(k).collect()
        x0 = np.array([r[col] for r in first], dtype=float)
        if len(x0) < k:
            reps = int(math.ceil(k / max(1, len(x0))))
            x0 = np.tile(x0, (reps, 1))[:k]
        cb = x0
        d2 = grid_dist2(self.w, self.h, self.periodic, self.topology)
        hist = []
        src = data.select(col)
        for t in range(self.passes):
            frac = t / max(1, self.passes - 1)
            sigma = self.sigma0 * (self.sigma_end / self.sigma0) ** frac
            rows = (src.mapInArrow(_sums_fn(cb), "node int, i int, v double")
                       .groupBy("node", "i").agg(F.sum("v").alias("v")).collect())
            n = np.zeros(k)
            s = np.zeros_like(cb)
            qe = 0.0
            for r in rows:
                if r["node"] < 0:
                    qe = r["v"]
                elif r["i"] < 0:
                    n[r["node"]] = r["v"]
                else:
                    s[r["node"], r["i"]] = r["v"]
            hk = np.exp(-d2 / (2.0 * sigma * sigma))
            num, den = hk @ s, hk @ n
            ok = den > 0
            cb = np.where(ok[:, None], num / np.where(ok, den, 1.0)[:, None], cb)
            hist.append((t, float(sigma), float(qe / max(1.0, n.sum()))))
        data.unpersist()
        return SOMModel(cb, self.w, self.h, self.periodic, self.topology, hist)


def fixed_codebook(spark: SparkSession, w: int = 4, h: int = 4, dim: int = 64) -> DataFrame:
    """Deterministic codebook used by the oracle checks:
    weight(node, d) = ((7*node + 3*d) mod 17 - 8) / 16, built JVM-side."""
    nodes = spark.range(w * h).select(F.col("id").cast("int").alias("node"))
    wexpr = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                        lambda d: (((F.col("node") * 7 + d * 3) % 17) - 8) / F.lit(16.0))
    return nodes.select("node", (F.col("node") % w).alias("gx"), (F.col("node") / w).cast("int").alias("gy"),
                        wexpr.alias("w"))


def codebook_of_rows(df: DataFrame, col: str, key: str, w: int, h: int, seed=111) -> DataFrame:
    """Codebook frame of the first w * h rows in (hash, key) order (a bounded sample)."""
    first = df.withColumn("_h", hash_u32(key, seed, "codebook")).orderBy("_h", key).limit(w * h)
    node = F.row_number().over(Window.orderBy("_h", key)) - 1
    return first.select(node.alias("node"), (node % w).alias("gx"), F.floor(node / w).cast("int").alias("gy"), F.col(col).alias("w"))


def codebook_array(cb: DataFrame) -> np.ndarray:
    """Codebook frame -> matrix (rows = nodes); bounded by the grid size."""
    rows = sorted(cb.select("node", "w").collect(), key=lambda r: r["node"])
    return np.array([r["w"] for r in rows], dtype=float)


def _long(cb: DataFrame) -> DataFrame:
    return cb.select("node", "gx", "gy", F.posexplode("w").alias("d", "v"))


def u_matrix(cb: DataFrame, w: int, h: int, periodic: bool = True, topology: str = "rect") -> DataFrame:
    """Mean distance of every node to its grid neighbours, wrapping when periodic: 4 on a
    rectangular grid, 6 on a hexagonal one (odd rows lie half a step to the right, as
    ``grid_coords`` places them): codebook self-join on neighbour coordinates."""
    offset = lambda pairs: F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in pairs])
    cross = [(1, 0), (-1, 0), (0, 1), (0, -1)]
    if topology == "hex":
        offs = F.when(F.col("gy") % 2 == 1, offset(cross + [(1, 1), (1, -1)])).otherwise(offset(cross + [(-1, 1), (-1, -1)]))
    else:
        offs = offset(cross)
    nb = cb.select("node", "gx", "gy", F.explode(offs).alias("o"))
    nx, ny = F.col("gx") + F.col("o.dx"), F.col("gy") + F.col("o.dy")
    if periodic:
        nb = nb.select("node", F.pmod(nx, F.lit(w)).alias("ngx"), F.pmod(ny, F.lit(h)).alias("ngy"))
    else:
        nb = nb.select("node", nx.alias("ngx"), ny.alias("ngy")).filter(
            (F.col("ngx") >= 0) & (F.col("ngx") < w) & (F.col("ngy") >= 0) & (F.col("ngy") < h))
    pos = cb.select(F.col("node").alias("nbr"), F.col("gx").alias("ngx"), F.col("gy").alias("ngy"))
    pairs = nb.join(pos, ["ngx", "ngy"]).select("node", "nbr")
    lw = _long(cb).select("node", "d", "v")
    rw = lw.select(F.col("node").alias("nbr"), "d", F.col("v").alias("u"))
    dist = (pairs.join(lw, "node").join(rw, ["nbr", "d"])
                 .groupBy("node", "nbr").agg(F.sqrt(F.sum((F.col("v") - F.col("u")) ** 2)).alias("dist")))
    out = dist.groupBy("node").agg(F.avg("dist").alias("u"))
    return cb.select("node", "gx", "gy").join(out, "node")


def component_plane(cb: DataFrame, projection: DataFrame, feature: int = 0) -> DataFrame:
    """Node value of one feature with the number of rows mapped to the node."""
    hits = projection.groupBy("node").agg(F.count(F.lit(1)).alias("hits"))
    return cb.select("node", "gx", "gy", F.element_at("w", feature + 1).alias("value")) \
             .join(hits, "node", "left").withColumn("hits", F.coalesce("hits", F.lit(0)).cast("long"))


def label_map(projection: DataFrame, label: str = "label") -> DataFrame:
    """Label mix per node."""
    return projection.groupBy("node", "gx", "gy", label).agg(F.count(F.lit(1)).alias("count"))
