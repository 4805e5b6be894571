"""Histogram trees: binned blocks, leaf-wise boosted trees, and their Spark ML form.

Features are binned once (at most 255 bins a feature; the cuts are the only thing the driver keeps of the data).  A
block holds some ten thousand rows as arrays, one for each feature.  Each wave is one Spark job: tasks send the rows down to the
leaves that are looked at, as lists of row numbers, and add gradients, hessians and counts by (leaf, feature, bin).  The tasks' sums
are added up on the executors; one array, of leaves x bins in use, reaches the driver and tells the best split of each new leaf.  Only the
smaller child of a split is counted, the other is its parent less that.  Gradients are whole multiples of 2^-26, so sums are exact: a tree depends neither on partitioning nor
on the order of rows.

Growth is best leaf first.  Best-first takes the splits with the largest *path gain* (the least gain from the root to the
split), so the leaves among the ``max_leaves - 1`` largest path gains known are split together: a tree of 31
leaves takes about as many waves as it has levels, and is the one that single splits would give.

The fitted trees are written in the form in which Spark ML saves its own models and loaded from there: scoring, saving,
importances and node tables are Spark's.
"""
from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlab.functions.columns import hash_u32
from loanlab.session import checkpoint_dir, right_size, scratch_path, ship

UNIT = 1 << 26            # gradients are whole multiples of 1 / UNIT
BLOCK_ROWS = 1 << 16
WIDTH = 256               # bins of a feature at most (cuts and one)
CHECKPOINT_EVERY = 20     # rounds between reliable checkpoints of the scores
FEW = 4                   # arrays that go to the driver as they are, without a second stage
TASKS_A_CORE = 1          # of a wave at most: starting a task costs as much as a block, and a task holds one block at a time


# ------------------------------------------------------------------ bins and blocks
def fit_cuts(df: DataFrame, cols: Sequence[str], max_bins: int = 255) -> list[np.ndarray]:
    """For each column the values at which bins end (a row lies in the first bin whose cut is not below it).

    The smallest value and the quantiles at 1/max_bins, ...; one aggregation with a mergeable sketch.
    """
    at = [i / max_bins for i in range(1, max_bins)]
    x = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    row = df.agg(*[F.struct(F.percentile_approx(x(c), at, 10_000).alias("q"), F.min(x(c)).alias("least"), F.max(x(c)).alias("most")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = []
    for s in row:
        cut = sorted({v for v in [s.least, *(s.q or [])] if v is not None})
        out.append(np.array([v for v in cut if v < s.most] if s.most is not None else [], np.float64))
    return out


def binned(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bin of each value; gaps lie in the last bin."""
    return np.where(np.isnan(x), len(cuts), np.searchsorted(cuts, x, "left")).astype(np.uint8)


def block_frame(df: DataFrame, cols: Sequence[str], cuts: list[np.ndarray], extra: dict[str, str]) -> DataFrame:
    """``df`` packed to blocks: n, bins (rows x features) and the ``extra`` columns (name -> numpy kind) as binary."""
    def pack(held):
        x = np.concatenate([h[0] for h in held])
        parts = [np.concatenate([h[1][name] for h in held]) for name in extra]
        return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([x.tobytes()], pa.binary()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=["n", "bins", *extra])

    def run(batches):
        held, n = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([binned(b.column(i).to_numpy(zero_copy_only=False).astype(np.float64), c) for i, c in enumerate(cuts)], axis=1)
            held.append((x, {name: b.column(len(cols) + i).to_numpy(zero_copy_only=False).astype(kind) for i, (name, kind) in enumerate(extra.items())}))
            n += len(x)
            if n >= BLOCK_ROWS:
                yield pack(held)
                held, n = [], 0
        if held:
            yield pack(held)

    ship(df.sparkSession)
    narrow = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], *extra)
    return narrow.mapInArrow(run, "n long, bins binary, " + ", ".join(f"{name} binary" for name in extra))


def block_of(row, extra: dict[str, str]) -> dict:
    """A block's arrays from its row."""
    out = {name: np.frombuffer(row[name], kind) for name, kind in extra.items()}
    out["bins"] = np.frombuffer(row["bins"], np.uint8).reshape(row["n"], -1)
    return out


# ------------------------------------------------------------------ trees
@dataclass
class Tree:
    """Arrays over nodes (the root is 0): split feature (-1 for a leaf), last bin that goes left, children, value, gain, rows."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    stats: np.ndarray | None = None

    def leaves(self, bins: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Leaf of each row; ``at``: nodes reached already (changed in place)."""
        at = np.zeros(len(bins), np.int32) if at is None else at
        todo = np.nonzero(self.feature[at] >= 0)[0]
        while len(todo):
            here = at[todo]
            f = self.feature[here]
            inner = f >= 0
            todo, here, f = todo[inner], here[inner], f[inner]
            go = bins[todo, f] <= self.bin[here]
            at[todo] = np.where(go, self.left[here], self.right[here])
        return at


def split_score(g, h, l1: float, l2: float):
    """Loss that a leaf of gradient sum g and hessian sum h takes off (twice)."""
    g = np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)
    return np.divide(g * g, h + l2, out=np.zeros(np.broadcast(g, h).shape), where=(h + l2) > 0)


def best_splits(hist: np.ndarray, spec: Boost) -> list[tuple | None]:
    """For histograms [3, features, leaves, bins] (whole units) each leaf's best (gain, feature, bin, left sums);
    the first feature and bin on ties; None if no split is allowed."""
    left = np.cumsum(hist, axis=3)
    total = left[:, :1, :, -1:]
    gl, hl, nl = left[0] / UNIT, left[1] / UNIT, left[2]
    g, h, n = total[0] / UNIT, total[1] / UNIT, total[2]
    ok = (nl >= spec.min_rows) & (n - nl >= spec.min_rows) & (hl >= spec.min_hessian) & (h - hl >= spec.min_hessian)
    gain = split_score(gl, hl, spec.l1, spec.l2) + split_score(g - gl, h - hl, spec.l1, spec.l2) - split_score(g, h, spec.l1, spec.l2)
    gain = np.where(ok, gain, -1.0).transpose(1, 0, 2)
    leaves, features, bins = gain.shape
    flat = gain.reshape(leaves, -1)
    at = np.argmax(flat, axis=1)
    out = []
    for s in range(leaves):
        f, b = divmod(int(at[s]), bins)
        out.append((float(flat[s, at[s]]), f, b, left[:, f, s, b].copy()) if flat[s, at[s]] > 1e-12 else None)
    return out


@dataclass
class Boost:
    """Parameters of one boosted model."""
    rounds: int = 100
    rate: float = 0.1
    max_leaves: int = 31
    max_depth: int | None = None
    l1: float = 0.0
    l2: float = 0.0
    min_rows: int = 20
    min_hessian: float = 1e-3
    mode: str = "gbdt"            # or goss (large gradients and a sample of the others), dart (dropped trees)
    stop_after: int | None = None  # rounds without a better validation loss; None: no early stopping
    tolerance: float = 1e-7
    seed: int = 0


def grow(total: Callable, start: np.ndarray, spec: Boost) -> Tree:
    """One tree.  ``total(nodes, slots)`` gives the summed histograms of the nodes in ``slots`` of a partial tree;
    ``start`` is the root's."""
    feature, bin_, left, right = [-1], [0], [-1], [-1]
    sums, depth, path, split, hists = [start[:, 0, 0].sum(axis=1)], [0], [np.inf], best_splits(start, spec), {0: start}
    if spec.max_depth is not None and spec.max_depth < 1:
        split[0] = None
    path = [split[0][0] if split[0] else -1.0]
    while True:
        ranked = sorted((v for v in range(len(feature)) if path[v] > 0), key=lambda v: (-path[v], v))[:spec.max_leaves - 1]
        todo = [v for v in ranked if left[v] < 0]
        if not todo:
            break
        counted = []
        for v in todo:
            _, f, b, low = split[v]
            kids = []
            for part in (low, sums[v] - low):
                kids.append(len(feature))
                for arr, x in ((feature, -1), (bin_, 0), (left, -1), (right, -1), (sums, part), (depth, depth[v] + 1), (path, -1.0), (split, None)):
                    arr.append(x)
            feature[v], bin_[v], (left[v], right[v]) = f, b, kids
            useful = [k for k in kids if sums[k][2] >= 2 * spec.min_rows and (spec.max_depth is None or depth[k] < spec.max_depth)]
            if useful:
                small = min(kids, key=lambda k: (sums[k][2], k))
                counted.append((v, small, sum(kids) - small, useful))
        if counted:
            tree = Tree(np.array(feature), np.array(bin_), np.array(left), np.array(right), *[np.zeros(0)] * 3)
            got = total(tree, [small for _, small, _, _ in counted])
            for s, (v, small, other, useful) in enumerate(counted):
                hists[small] = got[:, :, s:s + 1]
                hists[other] = hists[v] - hists[small]
                for k in useful:
                    split[k] = best_splits(hists[k], spec)[0]
                    path[k] = min(path[v], split[k][0]) if split[k] else -1.0
        for v in todo:
            hists.pop(v, None)
    taken = set(ranked)
    order, at = [0], 0  # the nodes of the tree itself, parents first
    while at < len(order):
        if order[at] in taken:
            order += [left[order[at]], right[order[at]]]
        at += 1
    new = {v: i for i, v in enumerate(order)}
    inner = [v in taken for v in order]
    s = np.array([sums[v] for v in order], np.float64)
    g, h = s[:, 0] / UNIT, s[:, 1] / UNIT
    g = np.sign(g) * np.maximum(np.abs(g) - spec.l1, 0.0)
    value = np.divide(-g, h + spec.l2, out=np.zeros(len(order)), where=(h + spec.l2) > 0)
    return Tree(np.array([feature[v] if i else -1 for v, i in zip(order, inner)]), np.array([bin_[v] for v in order]), np.array([new[left[v]] if i else -1 for v, i in zip(order, inner)]),
                np.array([new[right[v]] if i else -1 for v, i in zip(order, inner)]), value, np.array([split[v][0] if i else -1.0 for v, i in zip(order, inner)]), s[:, 2].astype(np.int64))


# ------------------------------------------------------------------ what tasks do with a block
def _prob(s: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-s))


def _uniform(key: np.ndarray, salt: int) -> np.ndarray:
    """A draw in [0, 1) for each row that depends on its key hash and ``salt`` alone."""
    x = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((salt * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


def _columns(block: dict) -> np.ndarray:
    """Bins of the block by feature."""
    if "columns" not in block:
        block["columns"] = np.ascontiguousarray(block["bins"].T)
    return block["columns"]


def _by_columns(block: dict) -> dict:
    """The block with its bins by feature alone."""
    return {**{k: v for k, v in block.items() if k != "bins"}, "columns": _columns(block)}


def _parted(columns: np.ndarray, tree: Tree, node: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``rows`` that go left and right at a node."""
    low = columns[tree.feature[node]].take(rows) <= int(tree.bin[node])
    return rows[low], rows[~low]


def _values(tree: Tree, block: dict) -> np.ndarray:
    """Value of the leaf of each row."""
    columns = _columns(block)
    out, todo = np.empty(columns.shape[1]), [(0, np.arange(columns.shape[1]))]
    while todo:
        v, rows = todo.pop()
        if tree.feature[v] < 0:
            out[rows] = tree.value[v]
        elif len(rows):
            todo += zip((int(tree.left[v]), int(tree.right[v])), _parted(columns, tree, v, rows))
    return out


def _gradients(block: dict, msg: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training rows of the block; gradients and hessians of all its rows in whole units."""
    rows = np.nonzero(block["part"] == 0)[0]
    s = block["score"]
    for tree, c in msg["minus"]:
        s = s - c * _values(tree, block)
    p = _prob(s)
    g, h = p - block["label"], p * (1 - p)
    if msg["top"] is not None:  # one-side sampling: all large gradients, a tenth of the others with eight times the weight
        large = np.abs(g) >= msg["top"]
        keep = large | (_uniform(block["key"], msg["round"] + 1) < GOSS_REST / (1 - GOSS_TOP))
        w = np.where(large, 1.0, (1 - GOSS_TOP) / GOSS_REST)
        rows, g, h = rows[keep[rows]], g * w, h * w
    return rows, np.rint(g * UNIT), np.rint(h * UNIT)


GOSS_TOP, GOSS_REST, GOSS_BINS = 0.2, 0.1, 4096


def _rows_at(columns: np.ndarray, tree: Tree, slots: Sequence[int], held: dict):
    """Training rows at each of the nodes ``slots``; ``held`` has those of the root, or of nodes reached already, and is kept up."""
    up = {int(kid): v for kids in (tree.left, tree.right) for v, kid in enumerate(kids) if kid >= 0}
    for node in slots:
        path, v = [], node
        while v not in held:
            v = up[v]
            path.append(v)
        for v in reversed(path):
            held[int(tree.left[v])], held[int(tree.right[v])] = _parted(columns, tree, v, held.pop(v))
        yield held[node]


def _histograms(block: dict, msg: dict) -> np.ndarray:
    """[3, features, leaves, bins] of the leaves in ``msg["slots"]``, exact whole units."""
    if block.get("made", (None,))[0] != msg["round"]:   # one task's own blocks stay from wave to wave
        rows, g, h = _gradients(block, msg)
        block["made"] = (msg["round"], g, h, {0: rows})
    _, g, h, held = block["made"]
    columns, width = _columns(block), msg["bins"]
    out = np.empty((3, len(columns), len(msg["slots"]), width), np.int64)
    for s, rows in enumerate(_rows_at(columns, msg["tree"], msg["slots"], held) if msg["tree"] is not None else [held[0]]):
        gs, hs = g.take(rows), h.take(rows)
        for f, bins in enumerate(columns):
            i = bins.take(rows).astype(np.intp)
            out[0, f, s] = np.bincount(i, gs, width)   # sums of whole numbers below 2^53
            out[1, f, s] = np.bincount(i, hs, width)
            out[2, f, s] = np.bincount(i, minlength=width)
    return out


def _large_gradients(block: dict, msg: dict) -> np.ndarray:
    """Counts of |gradient| in equal steps of [0, 1]."""
    rows, g, _ = _gradients(block, msg)
    return np.bincount(np.minimum((np.abs(g[rows]) / UNIT * GOSS_BINS).astype(np.int64), GOSS_BINS - 1), minlength=GOSS_BINS)


def _counted(block: dict, _) -> np.ndarray:
    """Training rows and those of class 1."""
    y = block["label"][block["part"] == 0]
    return np.array([len(y), y.sum()], np.float64)


def _tested(block: dict, part: int) -> np.ndarray:
    """Rows of one part: log loss in units of 2^-26, rows, rows predicted right."""
    v = block["part"] == part
    s, y = block["score"][v], block["label"][v]
    loss = np.rint(np.logaddexp(0, np.where(y > 0, -s, s)) * UNIT)
    return np.array([loss.sum(), len(y), np.sum((s > 0) == (y > 0))], np.float64)


def _moved(block: dict, add: list) -> dict:
    """The block with ``coefficient * tree`` added to its scores."""
    s = block["score"]
    for tree, c in add:
        s = s + (c if tree is None else c * _values(tree, block))
    return {**block, "score": s, "made": (None,)}


class Local:
    """Blocks that one task holds: one partition's, or a bounded set of rows (see ``selection``)."""

    def __init__(self, blocks: list[dict]):
        self.blocks = blocks

    def total(self, fn, msg=None):
        return sum(fn(b, msg) for b in self.blocks)

    def move(self, add):
        self.blocks = [_moved(b, add) for b in self.blocks]

    def close(self):
        self.blocks = []


class Distributed:
    """Blocks spread over the cluster.  The scores of a round are stored with the blocks and dropped when the next
    round's are there; reliable checkpoints cut the lineage.  ``sizes``: bins in use of each feature."""

    def __init__(self, blocks: RDD, sizes: Sequence[int]):
        most = TASKS_A_CORE * blocks.context.defaultParallelism
        if blocks.getNumPartitions() > most:
            blocks = blocks.coalesce(most)
        self.rdd, self.sizes, self.old, self.rounds = blocks.map(_by_columns).persist(StorageLevel.MEMORY_AND_DISK), list(sizes), [], 0
        checkpoint_dir(SparkSession.builder.getOrCreate())

    def summed(self, fn, msg=None) -> RDD:
        """The tasks' arrays added up to one on an executor, histograms without the bins that no feature uses: what reaches the
        driver grows neither with rows nor with partitions."""
        sizes = self.sizes

        def of_task(blocks):
            out = None
            for b in blocks:
                x = fn(b, msg)
                out = x if out is None else out + x
            if out is not None:
                yield 0, (np.concatenate([out[:, f, :, :n] for f, n in enumerate(sizes)], axis=2) if out.ndim == 4 else out)
        out = self.rdd.mapPartitions(of_task)
        return (out if out.getNumPartitions() <= FEW else out.reduceByKey(np.add, 1)).values()

    def total(self, fn, msg=None):
        out = sum(self.summed(fn, msg).collect())
        for r in self.old:
            r.unpersist()
        self.old = []
        if np.ndim(out) < 3:
            return out
        full = np.zeros((3, len(self.sizes), out.shape[1], msg["bins"]), np.int64)
        for f, (end, n) in enumerate(zip(np.cumsum(self.sizes), self.sizes)):
            full[:, f, :, :n] = out[:, :, end - n:end]
        return full

    def move(self, add):
        self.old.append(self.rdd)
        self.rdd = self.rdd.map(lambda b: _moved(b, add)).persist(StorageLevel.MEMORY_AND_DISK)
        self.rounds += 1
        if self.rounds % CHECKPOINT_EVERY == 0:
            self.rdd.checkpoint()

    def close(self):
        for r in [*self.old, self.rdd]:
            r.unpersist()


@dataclass
class Fitted:
    """Start score, trees and their coefficients; validation losses by round; (round, loss, accuracy) of tests."""
    start: float
    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    losses: list = field(default_factory=list)
    tests: list = field(default_factory=list)

    def test(self, at: int, rows: Local | Distributed):
        loss, n, right = rows.total(_tested, 2)
        self.tests.append((at, loss / UNIT / max(n, 1), right / max(n, 1)))


def boost(rows: Local | Distributed, spec: Boost, bins: int, test_at: Sequence[int] = ()) -> Fitted:
    """Boosted trees on the rows of part 0.  With early stopping the loss of the rows of part 1 decides; the rows of part 2 are
    tested after the rounds in ``test_at`` (or after the last, where it comes before)."""
    n, ones = rows.total(_counted)
    one_class = not 0 < ones < n
    out = Fitted(float(np.log((ones + 0.5) / (n - ones + 0.5)) if one_class else np.log(ones / (n - ones))))
    rows.move([(None, out.start)])
    rng = np.random.default_rng(spec.seed)
    best, since = np.inf, 0
    for t in range(0 if one_class else spec.rounds):
        minus = []
        if spec.mode == "dart" and out.trees and rng.random() >= 0.5:  # half of the rounds drop a tenth of the trees
            drop = np.nonzero(rng.random(len(out.trees)) < 0.1)[0].tolist()[:50]
            minus = [(out.trees[i], out.weights[i]) for i in drop]
        msg = {"minus": minus, "top": None, "round": t, "tree": None, "slots": [0], "bins": bins}
        if spec.mode == "goss" and t >= 1 / spec.rate:
            seen = np.cumsum(rows.total(_large_gradients, msg)[::-1])[::-1]
            msg["top"] = int(np.nonzero(seen >= GOSS_TOP * seen[0])[0][-1]) / GOSS_BINS
        start = rows.total(_histograms, msg)
        tree = grow(lambda part, slots, msg=msg: rows.total(_histograms, {**msg, "tree": part, "slots": slots}), start, spec)
        if len(tree.feature) == 1 and spec.mode == "gbdt":
            break  # nothing left to learn: later rounds would be the same
        add = [(tree, spec.rate / (1 + len(minus)))]
        if minus:
            shrink = len(minus) / (1 + len(minus))
            for i in drop:
                add.append((out.trees[i], out.weights[i] * (shrink - 1)))
                out.weights[i] *= shrink
        out.trees.append(tree)
        out.weights.append(add[0][1])
        rows.move(add)
        if t + 1 in test_at:
            out.test(t + 1, rows)
        if spec.stop_after is not None:
            loss, n_valid, _ = rows.total(_tested, 1)
            loss = loss / UNIT / max(n_valid, 1)
            out.losses.append(loss)
            best, since = (loss, 0) if loss < best - spec.tolerance else (best, since + 1)
            if since >= spec.stop_after:
                break
    for r in test_at:  # rounds that were not needed
        if r not in {x for x, _, _ in out.tests}:
            out.test(r, rows)
    return out


# ------------------------------------------------------------------ Spark ML form
_NODE = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
         "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def _metadata(kind: str, uid: str, spark: SparkSession, defaults: dict, params: dict | None = None, **more) -> str:
    return json.dumps({"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, "paramMap": params or {}, "defaultParamMap": defaults, **more})


def _node_rows(trees: list[Tree], cuts: list[np.ndarray], class_stats: bool):
    for t, tree in enumerate(trees):
        for i in range(len(tree.feature)):
            f = int(tree.feature[i])
            n = int(tree.rows[i])
            stats = tree.stats[i].tolist() if class_stats else [float(n), float(n * tree.value[i]), float(n * tree.value[i] ** 2)]
            split = (f, [float(cuts[f][tree.bin[i]])], -1) if f >= 0 else (-1, [], -1)
            total = sum(stats) if class_stats else 0.0
            impurity = 1.0 - sum((x / total) ** 2 for x in stats) if total else 0.0
            yield (t, (i, float(tree.value[i]), float(impurity), stats, n, float(tree.gain[i]), int(tree.left[i]), int(tree.right[i]), split))


def _load(spark: SparkSession, trees: list[Tree], weights: list[float], cuts: list[np.ndarray], n_features: int, boosted: bool):
    """Write trees as Spark ML saves an ensemble and load them as one."""
    path = scratch_path(spark, "trees")
    common = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction", "leafCol": "", "cacheNodeIds": False, "checkpointInterval": 10, "maxBins": 32, "maxDepth": 30,
              "maxMemoryInMB": 256, "minInfoGain": 0.0, "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0, "seed": 0}
    classes = {"probabilityCol": "probability", "rawPredictionCol": "rawPrediction"}
    if boosted:
        kind, part, own = "classification.GBTClassificationModel", "regression.DecisionTreeRegressionModel", {"impurity": "variance", "lossType": "logistic", "featureSubsetStrategy": "all",
                                                                                                             "maxIter": len(trees), "stepSize": 0.1, "subsamplingRate": 1.0, "validationTol": 0.01, **classes}
        more, tree_own = {}, {"impurity": "variance"}
    else:
        kind, part, own = "classification.RandomForestClassificationModel", "classification.DecisionTreeClassificationModel", {"impurity": "gini", "bootstrap": True, "featureSubsetStrategy": "auto", "numTrees": 20,
                                                                                                                           "subsamplingRate": 1.0, **classes}
        more, tree_own = {"numClasses": 2}, {"impurity": "gini", **classes}
    uid = f"histtree_{abs(hash(path)) % 16**12:012x}"
    spark.createDataFrame([(_metadata(f"org.apache.spark.ml.{kind}", uid, spark, {**common, **own}, {} if boosted else {"numTrees": len(trees)}, numFeatures=n_features, numTrees=len(trees), **more),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    meta = [(i, _metadata(f"org.apache.spark.ml.{part}", f"{uid}_{i}", spark, {**common, **tree_own}, **({"numFeatures": n_features, **more})), float(w)) for i, w in enumerate(weights)]
    spark.createDataFrame(meta, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    rows = _node_rows(trees, cuts, not boosted)
    slices = max(1, sum(len(t.feature) for t in trees) // 100_000)
    spark.createDataFrame(spark.sparkContext.parallelize(list(rows), slices), _NODE).write.parquet(f"{path}/data")
    return (GBTClassificationModel if boosted else RandomForestClassificationModel).load(path)


def boosted_model(spark: SparkSession, fit: Fitted, cuts: list[np.ndarray], n_features: int) -> GBTClassificationModel:
    """Spark's boosted classifier doubles its margin before the logistic function: trees and start are halved."""
    root = Tree(*[np.array([x]) for x in (-1, 0, -1, -1)], np.array([fit.start / 2]), np.array([-1.0]), np.array([0]))
    halves = [Tree(t.feature, t.bin, t.left, t.right, t.value / 2, t.gain, t.rows) for t in fit.trees]
    return _load(spark, [root, *halves], [1.0, *fit.weights], cuts, n_features, True)


class HistBoost:
    """Estimator for ``ResampledPipeline``: leaf-wise boosting with early stopping on a hashed tenth of the rows when
    there are more than ``STOP_FROM`` (the analysed scripts' default), L1 and L2 on leaves."""

    STOP_FROM, VALID = 10_000, 0.1

    def __init__(self, max_bins: int = 255, early_stopping: bool | str = "auto", seed: int = 111, **spec):
        self.max_bins, self.early_stopping, self.seed, self.spec = max_bins, early_stopping, seed, spec
        self.fit_: Fitted | None = None

    def fit(self, df: DataFrame, cols: Sequence[str], label: str, key: str) -> GBTClassificationModel:
        """Trees over the vector of ``cols`` (in this order, column ``features``)."""
        spark = df.sparkSession
        # partitions by their size in bins; as many blocks as fit in one are boosted in its task without a job for each wave
        df = right_size(df.select(*cols, F.col(label).cast("double").alias("label"), hash_u32(key, self.seed, "boost").alias("key")), len(cols) + 32)
        try:
            stop = df.count() > self.STOP_FROM if self.early_stopping == "auto" else bool(self.early_stopping)
            cuts = fit_cuts(df, cols, self.max_bins)
            part = F.when(F.col("key") < int(self.VALID * 2**32), 1).otherwise(0) if stop else F.lit(0)
            extra = {"label": "<f8", "key": "<i8", "part": "<i1"}
            frame = block_frame(df.withColumn("part", part), cols, cuts, extra)
            unused = {"key"} if self.spec.get("mode") != "goss" else set()   # every wave reads the blocks: nothing is in them that it does not need

            def opened(r):
                b = {k: v for k, v in block_of(r, extra).items() if k not in unused}
                return {**b, "label": b["label"].astype(np.float32), "score": np.zeros(r["n"])}
            blocks = frame.rdd.map(opened)
            spec = Boost(**{"stop_after": 10 if stop else None, "seed": self.seed, **self.spec})
            if blocks.getNumPartitions() == 1:
                self.fit_ = blocks.mapPartitions(lambda it: [boost(Local(list(it)), spec, WIDTH)]).collect()[0]
            else:
                run = Distributed(blocks, [len(c) + 1 for c in cuts])
                try:
                    self.fit_ = boost(run, spec, WIDTH)
                finally:
                    run.close()
        finally:
            df.unpersist()
        self.cuts_ = cuts
        return boosted_model(spark, self.fit_, cuts, len(cols)).setFeaturesCol("features")
