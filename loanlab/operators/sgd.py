"""Linear classifier trained by distributed stochastic gradient descent (hinge or
modified Huber loss, L2 penalty) with early stopping on a hashed validation slice.

Rows fall into ``SLICES`` mini-batches by a hash of their key.  One step = one Spark job: the
weights (d + 1 numbers) travel in the task closure, every partition returns the gradient sum of its
rows in the step's slice (vectorised numpy) with the losses, and the driver adds up one small array a core and
takes an Adam step.  A step depends on which rows are in the slice and not on their order or
partitioning, so the fitted coefficients do not either (up to the rounding of sums).  The
input is packed once to blocks of one slice each, which stay as they are, in at most one partition a core; the weights are plain numbers, so lineage never grows.

The fitted model is a ``SQLTransformer`` (a linear expression over the input
columns): JVM-side scoring and a saveable ``PipelineModel`` stage.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.functions.columns import TWO_32, hash_u32
from loanlab.session import ship


def _losses(z: np.ndarray, loss: str):
    if loss == "hinge":
        return np.maximum(0.0, 1.0 - z), np.where(z < 1.0, -1.0, 0.0)
    l = np.where(z >= -1.0, np.maximum(0.0, 1.0 - z) ** 2, -4.0 * z)
    dz = np.where(z >= 1.0, 0.0, np.where(z >= -1.0, -2.0 * (1.0 - z), -4.0))
    return l, dz


SLICES = 2   # mini-batches of one pass over the data


BLOCK_BYTES = 8 << 20   # of rows that a task holds at once, and that are worth a task


def _packed(d: int):
    """Rows (d features, label, validation, slice) to blocks of one slice each."""
    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(d + 3)], axis=1))
            size += held[-1].nbytes
            if size >= BLOCK_BYTES:
                yield from cut(np.concatenate(held))
                held, size = [], 0
        if held:
            yield from cut(np.concatenate(held))

    def cut(rows):
        for p in range(SLICES):
            mine = rows[rows[:, d + 2] == p]
            if len(mine):
                parts = [np.ascontiguousarray(mine[:, :d]), np.where(mine[:, d] > 0, 1.0, -1.0), mine[:, d + 1] > 0]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([len(mine)], pa.int64()), *[pa.array([v.tobytes()], pa.binary()) for v in parts]], names=["piece", "n", "x", "y", "val"])
    return run


def _opened(r) -> dict:
    return {"piece": r["piece"], "x": np.frombuffer(r["x"]).reshape(r["n"], -1), "y": np.frombuffer(r["y"]), "val": np.frombuffer(r["val"], bool)}


def _step(block: dict, w: np.ndarray, b: float, loss: str, piece: int) -> np.ndarray:
    """Gradient sum (w then b), rows of the slice; losses at ``w`` and rows, of training and validation."""
    x, y, val = block["x"], block["y"], block["val"]
    l, dz = _losses(y * (x @ w + b), loss)
    out = np.zeros(len(w) + 6)
    if block["piece"] == piece:
        coef = np.where(val, 0.0, dz * y)
        out[:len(w)], out[len(w)], out[-5] = x.T @ coef, coef.sum(), (~val).sum()
    out[-4:] = l[~val].sum(), (~val).sum(), l[val].sum(), val.sum()
    return out


class LinearSGD:
    """``fit(df, cols, label, key) -> SQLTransformer`` producing ``margin``,
    ``p1`` (class-1 probability for modified Huber, else the margin) and
    ``prediction``."""

    def __init__(self, loss: str = "hinge", alpha: float = 1e-4, max_iter: int = 1000, tol: float = 1e-3,
                 n_iter_no_change: int = 5, validation_fraction: float = 0.1, eta0: float = 0.2,
                 early_stopping: bool = True, seed: int = 111):
        if loss not in ("hinge", "modified_huber"):
            raise ValueError("loss must be 'hinge' or 'modified_huber'")
        self.loss, self.alpha, self.max_iter, self.tol = loss, alpha, max_iter, tol
        self.n_iter_no_change, self.validation_fraction, self.eta0 = n_iter_no_change, validation_fraction, eta0
        self.early_stopping, self.seed = early_stopping, seed
        self.history: list[tuple[int, float, float]] = []

    def fit(self, df: DataFrame, cols: Sequence[str], label: str = "label", key: str = "loan_id") -> SQLTransformer:
        cols = list(cols)
        ship(df.sparkSession)
        vf = self.validation_fraction if self.early_stopping else 0.0
        data = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label).alias(label),
                         (hash_u32(key, self.seed, "sgdval") < F.lit(int(vf * TWO_32))).cast("int").alias("_val"),
                         F.pmod(hash_u32(key, self.seed, "sgdslice"), F.lit(SLICES)).cast("int").alias("_slice"))
        d = len(cols)
        packed = data.mapInArrow(_packed(d), "piece int, n long, x binary, y binary, val binary").persist()
        size = 8 * (d + 3) * (packed.agg(F.sum("n")).first()[0] or 0)
        most = min(data.sparkSession.sparkContext.defaultParallelism, max(1, -(-size // BLOCK_BYTES)))   # a step lasts as long as its tasks take to start
        pieces = []
        for p in range(SLICES):   # a step over one slice reads that one alone
            rdd = packed.where(F.col("piece") == p).rdd.map(_opened)
            pieces.append((rdd.coalesce(most) if rdd.getNumPartitions() > most else rdd).persist(StorageLevel.MEMORY_AND_DISK))
        everything = data.sparkSession.sparkContext.union(pieces)
        wb, mean, square, steps = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1), 0
        best, bad, best_wb = np.inf, 0, wb.copy()
        loss = self.loss
        try:
            for t in range(self.max_iter * SLICES):
                w, b, p = wb[:d], wb[d], t % SLICES
                # the losses are asked for once a pass, at its first step
                parts = (everything if p == 0 else pieces[p]).mapPartitions(lambda it: [sum((_step(x, w, b, loss, p) for x in it), np.zeros(d + 6))]).collect()
                if t == 0:
                    packed.unpersist()
                total = np.sum(parts, axis=0) if parts else np.zeros(d + 6)
                r = {"g": total[:d + 1], "n": total[d + 1], "lt": total[-4], "nt": total[-3], "lv": total[-2], "nv": total[-1]}
                if not r["nt"]:
                    break
                if t % SLICES == 0:   # once a pass: has it become better?
                    train_loss = r["lt"] / r["nt"] + 0.5 * self.alpha * float(wb[:d] @ wb[:d])
                    val_loss = r["lv"] / r["nv"] if r["nv"] else train_loss
                    self.history.append((t // SLICES, train_loss, val_loss))
                    score = val_loss if self.early_stopping and r["nv"] else train_loss
                    if score < best - self.tol:
                        best, bad, best_wb = score, 0, wb.copy()
                    else:
                        bad += 1
                        if bad >= self.n_iter_no_change:
                            break
                if r["n"]:
                    g = r["g"] / r["n"]
                    g[:d] += self.alpha * wb[:d]
                    steps += 1
                    mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
                    wb = wb - self.eta0 * (mean / (1 - 0.9 ** steps)) / (np.sqrt(square / (1 - 0.99 ** steps)) + 1e-8)
        finally:
            packed.unpersist()
            for rdd in pieces:
                rdd.unpersist()
        self.coef_, self.intercept_ = best_wb[:d], best_wb[d]
        return self.as_transformer(cols)

    def as_transformer(self, cols: Sequence[str]) -> SQLTransformer:
        terms = " + ".join(f"({repr(float(wi))}) * CAST(`{c}` AS DOUBLE)" for wi, c in zip(self.coef_, cols))
        margin = f"({repr(float(self.intercept_))} + {terms})"
        if self.loss == "modified_huber":
            p1 = f"((LEAST(GREATEST({margin}, -1.0D), 1.0D) + 1.0D) / 2.0D)"
        else:
            p1 = margin
        stmt = (f"SELECT *, {margin} AS margin, {p1} AS p1, "
                f"CAST(CASE WHEN {margin} > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction FROM __THIS__")
        return SQLTransformer(statement=stmt)
