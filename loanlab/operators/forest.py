"""Forests whose trees all grow together, each on its own weighted draw of the rows.

Every row has a Lehmer stream seeded by its key hash; the t-th number of the stream is its draw for tree t, and the
weight of the row in that tree is the Poisson count at that draw.  The rate is ``max_samples`` (bootstrap) or, balanced,
that times the smallest class's share of the row's class, so each tree sees as many rows of every class.  No row is
copied: a block carries one byte for each (row, tree), and one number for the node where the row stands in that tree.

A level of large nodes is one job for all trees: tasks add class weights by (node, feature, bin) for the features that a node
may look at, the cells are dealt out by node, and the best split of each node comes back, not the cells.  A node whose features
give no split tries the next ones of its own order, until one does or all have been tried.  The number of cells is bounded
by rows x trees x features looked at, whatever the number of nodes; a part of the deal gets about ``CELLS`` from all tasks together.

A node of at most ``LOCAL`` rows (by weight; fewer where many features are looked at) is not split by jobs any more: its rows are dealt to one task, with those of other small
nodes up to ``PAIRS`` (row, tree) pairs, which grows the rest of the subtree by the same rules.  The subtrees stay a table; the
driver holds the nodes above them alone.  Rows are scored in the same way: down the upper nodes in place, then dealt to the
subtrees they reach, and their votes (whole multiples of 1 / ``VOTE``) added up.

Out-of-bag votes come from the same draws: a row is voted on by the trees in which its weight is 0.
"""
from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlab.functions.columns import hash_u32, sql_hash_u32
from loanlab.operators.histtree import Tree, _load, binned, block_frame, fit_cuts
from loanlab.operators.sampling import poisson_cdf
from loanlab.session import cut_lineage, ship

PRIME, STEP = (1 << 31) - 1, 48271   # of the Lehmer stream
CELLS = 1 << 20
ROWS_AT_ONCE = 1 << 13               # of a block, times the trees
CHECKPOINT_EVERY = 8                 # levels
LOOKS_AT_ONCE = 1 << 22              # (row, tree) pairs times features counted in one go
DENSE, SPARSE, ONES = 1 << 16, 4, 26   # cells that may always be counted densely, and for each value counted; bits of the weight in a cell
LOCAL = 1 << 18                      # rows (by weight) of a node whose subtree grows in one task, at most
LOCAL_LOOKS = 1 << 21                # the same, times the features looked at
PAIRS = 1 << 18                      # (row, tree) pairs dealt to a task
LOOKS = 1 << 21                      # pairs times features that a task looks at in one go
TASK_CELLS = 1 << 23                 # rows x trees x features of a partition of blocks
TASK_PAIRS = 1 << 21                 # rows x trees of a partition of blocks
FEW_TREES = 8                        # up to which the rows to score are dealt by their size
VOTE = 1 << 40
EXTRA = {"label": "<f8", "key": "<i8", "fold": "<i1"}


# ------------------------------------------------------------------ draws
def multipliers(trees: int) -> list[int]:
    """What the seed is multiplied by (modulo ``PRIME``) for the draw of each tree."""
    return [pow(STEP, t + 1, PRIME) for t in range(trees)]


def stream_seed(key: str, seed) -> Column:
    """Seed of a row's stream, 1 to PRIME - 1, from its key."""
    return F.pmod(hash_u32(key, seed, "forest"), F.lit(PRIME - 1)) + 1


def seed_sql(key: str, seed) -> str:
    """DuckDB text of ``stream_seed``."""
    return f"({sql_hash_u32(key, seed, 'forest')} % {PRIME - 1} + 1)"


def draws(seeds: np.ndarray, trees: int) -> np.ndarray:
    """[rows, trees] draws, 1 to PRIME - 1."""
    return seeds.astype(np.int64)[:, None] * np.array(multipliers(trees), np.int64)[None, :] % PRIME


def thresholds(rate: float) -> list[int]:
    """A weight of at least k + 1 starts at the k-th of these draws."""
    return [math.ceil(c * PRIME) for c in poisson_cdf(rate) if c < 1.0][:255]


def weights(seeds: np.ndarray, label: np.ndarray, rates: dict[int, float | None], trees: int, fold: np.ndarray | None = None, cv: int = 1) -> np.ndarray:
    """[rows, trees] Poisson weights (1 without a rate); with ``cv`` folds [rows, cv x trees], 0 in the trees of a row's own fold."""
    if cv > 1:
        out = np.tile(weights(seeds, label, rates, trees), (1, cv))
        own = fold[:, None] == np.repeat(np.arange(cv), trees)[None, :]
        out[own] = 0
        return out
    out = np.zeros((len(seeds), trees), np.uint8)
    for c, rate in rates.items():
        mine = label == c
        out[mine] = 1 if rate is None else np.searchsorted(np.array(thresholds(rate), np.int64), draws(seeds[mine], trees), "right")
    return out


# ------------------------------------------------------------------ one level
@dataclass
class Level:
    """The open nodes: their numbers (ascending) and the features each looks at now (-1: none left)."""
    nodes: np.ndarray
    features: np.ndarray


def _moved(at: np.ndarray, bins: np.ndarray, moves) -> np.ndarray:
    """Nodes after the splits of the last level: node (ascending), feature, last bin that goes left, left child (right is next)."""
    node, feature, cut, left = moves
    if not len(node):
        return at
    i = np.minimum(np.searchsorted(node, at), len(node) - 1)
    hit = node[i] == at
    r = np.broadcast_to(np.arange(len(at))[:, None], at.shape)[hit]
    i = i[hit]
    out = at.copy()
    out[hit] = left[i] + (bins[r, feature[i]] > cut[i])
    return out


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of the values."""
    order = np.argsort(key, kind="stable")
    return _runs(key[order], *[v[order] for v in values])


def _runs(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """``_summed`` of keys in order."""
    head = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else np.zeros(0, np.int64)
    return (key[head], *[np.add.reduceat(v, head) if len(head) else v[:0] for v in values])


def _counted(slot: np.ndarray, slots: int, look: np.ndarray, row: np.ndarray, bins: np.ndarray, weight: np.ndarray, one: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, rows, rows of class 1) by weight of the rows ``row`` of ``bins`` that stand at ``slot`` (below ``slots``); slot s looks at the features ``look[s]``.

    Counted in an array of all cells where that is not much larger than what is counted, else by a sort."""
    looked = look.shape[1]
    size = slots * looked * width
    if size <= min(SPARSE * len(slot) * looked, LOOKS_AT_ONCE) + DENSE:
        both = (weight + (one << ONES)).astype(float)   # whole numbers below 2^53: two sums in one
        total = np.zeros(size)
        for j in range(looked):
            f = look[slot, j]
            use = slice(None) if (f >= 0).all() else np.nonzero(f >= 0)[0]
            total += np.bincount((slot[use] * looked + j) * width + bins[row[use], f[use]], both[use], size)
        cell = np.nonzero(total)[0]
        total = total[cell].astype(np.int64)
        return cell, total & ((1 << ONES) - 1), total >> ONES
    f = look[slot]
    # weight and label ride in the low bits of the cell, so that one sort of numbers brings the cells together
    packed = (((slot[:, None] * looked + np.arange(looked)) * width + bins[row[:, None], np.maximum(f, 0)]) << 9 | (weight << 1 | (one > 0))[:, None])[f >= 0]
    packed.sort()
    weight = (packed >> 1) & 255
    return _runs(packed >> 9, weight, weight * (packed & 1))


def _cells(block: dict, level: Level, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, rows, rows of class 1) by weight; a cell is (open node, place among its features, bin)."""
    held = []
    looked, open_nodes = level.features.shape[1], len(level.nodes)
    span = looked * width
    step = max(1, LOOKS_AT_ONCE // (max(1, block["node"].shape[1]) * looked))
    for lo in range(0, len(block["label"]), step):
        part = slice(lo, lo + step)
        at, w, bins, y = block["node"][part], block["w"][part], block["bins"][part], block["label"][part] > 0
        row, tree = np.nonzero(w > 0)
        at = at[row, tree]
        slot = np.minimum(np.searchsorted(level.nodes, at), open_nodes - 1)
        mine = np.nonzero(level.nodes[slot] == at)[0]
        row, tree, slot = row[mine], tree[mine], slot[mine]
        weight = w[row, tree].astype(np.int64)
        there = np.zeros(open_nodes, bool)   # the nodes that rows of the block stand at
        there[slot] = True
        there = np.nonzero(there)[0]
        local = np.zeros(open_nodes, np.int64)
        local[there] = np.arange(len(there))
        cell, n, s = _counted(local[slot], len(there), level.features[there], row, bins, weight, weight * y[row], width)
        held.append((there[cell // span] * span + cell % span if len(cell) else cell, n, s))
    return held[0] if len(held) == 1 else _summed(*[np.concatenate(x) for x in zip(*held)]) if held else (np.zeros(0, np.int64),) * 3


def _best(cell: np.ndarray, rows: np.ndarray, total: np.ndarray, looked: int, width: int) -> tuple[np.ndarray, ...]:
    """Per node of the cells: (slot, gain, place of the feature, bin, rows and sum on the left, rows and sum of the node);
    gain -1 if no split.

    The gain is the fall of the squared error of the mean (for a 0/1 target half that of the summed Gini impurity); ties go to the
    feature looked at first, then the lowest bin."""
    return _best_of(*_summed(cell, rows, total), looked, width)


def _best_of(cell: np.ndarray, rows: np.ndarray, total: np.ndarray, looked: int, width: int, scale: tuple[float, float] = (1.0, 1.0)) -> tuple[np.ndarray, ...]:
    """``_best`` of distinct cells in order; ``scale``: weight of a row of class 0 and 1 in the gain."""
    group = cell // width                       # (slot, place)
    head = np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0]
    size = np.diff(head, append=len(cell))
    run_n, run_s = np.cumsum(rows), np.cumsum(total)
    ln, ls = run_n - np.repeat(run_n[head] - rows[head], size), run_s - np.repeat(run_s[head] - total[head], size)
    tn, ts = (np.repeat(x[head + size - 1], size) for x in (ln, ls))
    last = np.zeros(len(cell), bool)
    last[head + size - 1] = True
    def square(s, n):
        if scale != (1.0, 1.0):
            s, n = scale[1] * s, scale[0] * (n - s) + scale[1] * s
        return np.divide(s.astype(float) ** 2, n, out=np.zeros(len(n)), where=n > 0)
    whole = square(ts, tn)
    gain = np.where(last, -1.0, square(ls, ln) + square(ts - ls, tn - ln) - whole)
    gain = np.where(gain > 1e-9 * (1 + whole), gain, -1.0)
    slot = group // looked
    first = np.nonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))[0]
    top = np.maximum.reduceat(gain, first)
    at = np.nonzero(gain == np.repeat(top, np.diff(first, append=len(cell))))[0]
    at = at[np.unique(slot[at], return_index=True)[1]]   # the first of the best
    return slot[first], top, group[at] % looked, cell[at] % width, ln[at], ls[at], tn[at], ts[at]


_BEST = "slot long, gain double, place long, bin long, ln long, ls long, tn long, ts long"
_BEST_NAMES = [x.split()[0] for x in _BEST.split(", ")]


def _arrays(row: dict, trees: int) -> dict:
    n = row["n"]
    return {"bins": np.frombuffer(row["bins"], np.uint8).reshape(n, -1), "label": np.frombuffer(row["label"], "<f8"), "key": np.frombuffer(row["key"], "<i8"), "fold": np.frombuffer(row["fold"], "<i1"),
            "w": np.frombuffer(row["w"], np.uint8).reshape(n, trees), "node": np.frombuffer(row["node"], np.int32).reshape(n, trees)}


_STATE = "n long, bins binary, label binary, key binary, fold binary, w binary, node binary"


def _rows(batches):
    for b in batches:
        yield from b.to_pylist()


def _state(n, row, w, node):
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *[pa.array([x], pa.binary()) for x in (row["bins"], row["label"], row["key"], row["fold"], w, node)]], names=["n", "bins", "label", "key", "fold", "w", "node"])


def _started(rates: dict[int, float], trees: int, cv: int):
    """Blocks with weights and every row at the root of every tree (node t)."""
    def run(batches):
        for row in _rows(batches):
            w = weights(np.frombuffer(row["key"], "<i8"), np.frombuffer(row["label"], "<f8"), rates, trees, np.frombuffer(row["fold"], "<i1"), cv)
            yield _state(row["n"], row, w.tobytes(), np.broadcast_to(np.arange(trees * cv, dtype=np.int32), w.shape).tobytes())
    return run


def _advanced(moves, trees: int):
    def run(batches):
        for row in _rows(batches):
            b = _arrays(row, trees)
            yield _state(row["n"], row, row["w"], _moved(b["node"], b["bins"], moves).tobytes())
    return run


def _dealt(level: Level, trees: int, width: int, parts: int):
    """Cells by ranges of open nodes; those of a task's blocks are added up as far as they keep within ``CELLS``."""
    def run(batches):
        span = -(-len(level.nodes) // parts) * level.features.shape[1] * width

        def cut_up(cell, n, s):
            ends = np.searchsorted(cell, np.arange(parts + 1) * span)
            full = [p for p in range(parts) if ends[p] < ends[p + 1]]
            cut = lambda x: pa.array([x[ends[p]:ends[p + 1]].tobytes() for p in full], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), cut(cell), cut(n), cut(s)], names=["part", "cell", "n", "s"])
        held = None
        for row in _rows(batches):
            got = _cells(_arrays(row, trees), level, width)
            held = got if held is None else _summed(*[np.concatenate(x) for x in zip(held, got)])
            if len(held[0]) > CELLS:
                yield cut_up(*held)
                held = None
        if held is not None:
            yield cut_up(*held)
    return run


def _judged(looked: int, width: int, scale: tuple[float, float] = (1.0, 1.0)):
    def run(t: pa.Table) -> pa.Table:
        cell, n, s = (np.concatenate([np.frombuffer(v, np.int64) for v in t.column(c).to_pylist()]) for c in ("cell", "n", "s"))
        return pa.table(dict(zip(_BEST_NAMES, _best_of(*_summed(cell, n, s), looked, width, scale))))
    return run


# ------------------------------------------------------------------ growth
def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _order(node: np.ndarray, n_features: int, seed: int) -> np.ndarray:
    """For each node a random order of the features, from its number and the seed."""
    with np.errstate(over="ignore"):
        x = node.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(n_features, dtype=np.uint64)[None, :] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(seed)
    return np.argsort(_mixed(x), axis=1)


class Nodes:
    """Node arrays, the roots first; ``left`` is the left child (right is next), -1 for a leaf."""

    FILL = {"feature": -1, "bin": 0, "left": -1, "w0": 0.0, "w1": 0.0, "gain": 0.0}
    KIND = {"feature": "<i2", "bin": "<i2", "left": "<i4", "w0": "<f8", "w1": "<f8", "gain": "<f8"}   # as bytes of a table

    def __init__(self, roots: int):
        for name, fill in self.FILL.items():
            setattr(self, name, np.full(roots, fill))

    def add(self, n: int) -> int:
        at = len(self.feature)
        for name, fill in self.FILL.items():
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, np.full(n, fill, old.dtype)]))
        return at

    def weigh(self, scale: tuple[float, float]) -> None:
        """Class weights count in what leaves say."""
        self.w0, self.w1 = self.w0 * scale[0], self.w1 * scale[1]


class _Growth:
    """The open nodes of some trees: numbers (ascending), depths, path numbers, orders of the features and how many were tried."""

    def __init__(self, nodes: Nodes, path: np.ndarray, depth: np.ndarray, n_features: int, looked: int, max_depth: int, seed: int):
        self.f, self.n_features, self.looked, self.max_depth, self.seed = nodes, n_features, looked, max_depth, seed
        self.nodes, self.path, self.depth, self.tries = np.arange(len(path)), path.astype(np.uint64), depth, np.zeros(len(path), np.int64)
        self.order = _order(self.path, n_features, seed)

    def level(self) -> Level:
        place = self.tries[:, None] * self.looked + np.arange(self.looked)[None, :]
        return Level(self.nodes, np.where(place < self.n_features, np.take_along_axis(self.order, np.minimum(place, self.n_features - 1), axis=1), -1))

    def keep(self, mask: np.ndarray) -> None:
        for name in ("nodes", "path", "depth", "tries", "order"):
            setattr(self, name, getattr(self, name)[mask])

    def split(self, level: Level, g: dict) -> tuple:
        """Nodes split by the judgements of the level (``_BEST`` columns by slot); the moves of the rows."""
        f, slot = self.f, g["slot"]
        node = level.nodes[slot]
        f.w0[node], f.w1[node] = g["tn"] - g["ts"], g["ts"]
        cut = g["gain"] > 0
        left = f.add(2 * int(cut.sum())) + 2 * np.arange(int(cut.sum()))
        parent, feature = node[cut], level.features[slot[cut], g["place"][cut]]
        f.feature[parent], f.bin[parent], f.left[parent], f.gain[parent] = feature, g["bin"][cut], left, 2 * g["gain"][cut]
        ln, ls, tn, ts = (g[c][cut] for c in ("ln", "ls", "tn", "ts"))
        kids = np.stack([left, left + 1], axis=1).ravel()
        ones = np.stack([ls, ts - ls], axis=1).ravel()
        f.w0[kids], f.w1[kids] = np.stack([ln, tn - ln], axis=1).ravel() - ones, ones
        # impure children go on; so do impure nodes that have features left to try
        deep = np.repeat(self.depth[slot[cut]] + 1, 2)
        on = (f.w0[kids] > 0) & (f.w1[kids] > 0) & (deep < self.max_depth)
        again = ~cut & (g["ts"] > 0) & (g["ts"] < g["tn"]) & ((self.tries[slot] + 1) * self.looked < self.n_features)
        with np.errstate(over="ignore"):   # a node's path number is that of its parent and the side
            path = _mixed(np.repeat(self.path[slot[cut]], 2) * np.uint64(0xD1342543DE82EF95) + np.tile(np.array([1, 2], np.uint64), int(cut.sum())))[on]
        stay = slot[again]
        self.nodes, self.path, self.depth, self.tries, self.order = (np.concatenate(x) for x in (
            (node[again], kids[on]), (self.path[stay], path), (self.depth[stay], deep[on]), (self.tries[stay] + 1, np.zeros(int(on.sum()), np.int64)), (self.order[stay], _order(path, self.n_features, self.seed))))
        self.keep(np.argsort(self.nodes))
        return parent, feature, g["bin"][cut], left


def _subtrees(slot: np.ndarray, bins: np.ndarray, w: np.ndarray, one: np.ndarray, path: np.ndarray, depth: np.ndarray, looked: int, width: int, max_depth: int, seed: int, scale=(1.0, 1.0)) -> tuple[Nodes, np.ndarray]:
    """Subtrees of the roots 0, 1, ... grown on rows of weight ``w`` (label ``one``) that stand at root ``slot``; every row's leaf."""
    f = Nodes(len(path))
    g = _Growth(f, path, depth, bins.shape[1], looked, max_depth, seed)
    at = slot.astype(np.int64)
    weight = w.astype(np.int64)
    ones = weight * one
    live = np.nonzero(w > 0)[0]
    while len(g.nodes):
        level = g.level()
        number = np.full(len(f.feature), -1)
        number[level.nodes] = np.arange(len(level.nodes))
        mine = number[at[live]]
        live, mine = live[mine >= 0], mine[mine >= 0]
        cells = _counted(mine, len(level.nodes), level.features, live, bins, weight[live], ones[live], width)
        if not len(cells[0]):   # no row has weight
            break
        got = _best_of(*cells, looked, width, scale)
        parent, feature, cut, left = g.split(level, dict(zip(_BEST_NAMES, got)))
        chosen = np.full(len(level.nodes), -1)
        chosen[number[parent]] = np.arange(len(parent))
        i = chosen[mine]
        row, i = live[i >= 0], i[i >= 0]
        at[row] = left[i] + (bins[row, feature[i]] > cut[i])
    idle = np.nonzero(w == 0)[0]
    at[idle] = _walk(f, bins, idle, at[idle])
    f.weigh(scale)
    return f, at


def _walk(f, bins: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Leaves below the nodes ``at`` for the rows ``row`` of ``bins``."""
    at = at.astype(np.int64)
    todo = np.nonzero(f.left[at] >= 0)[0]
    while len(todo):
        v = at[todo]
        at[todo] = f.left[v] + (bins[row[todo], f.feature[v]] > f.bin[v])
        todo = todo[f.left[at[todo]] >= 0]
    return at


def _leaf_of(f, bins: np.ndarray, row: np.ndarray, tree: np.ndarray) -> np.ndarray:
    return _walk(f, bins, row, tree)


def _votes(f, leaf: np.ndarray) -> np.ndarray:
    """Shares of class 1 in units of 1 / VOTE: their sums do not depend on the order."""
    return np.rint(f.w1[leaf] / np.maximum(f.w0[leaf] + f.w1[leaf], 1) * VOTE).astype(np.int64)


# ------------------------------------------------------------------ pairs dealt to subtrees
_PAIR = {"slot": "<i4", "bins": "u1", "w": "u1", "one": "u1", "row": "<i4"}
_PAIRS = "part int, block long, " + ", ".join(f"{c} binary" for c in _PAIR)
_GROWN = "part int, root binary, " + ", ".join(f"{c} binary" for c in Nodes.FILL) + ", block long, row binary, vote binary"
_VOTES = "block long, row binary, vote binary"


def _dealt_pairs(block, slot: np.ndarray, row: np.ndarray, bins: np.ndarray, starts: np.ndarray, w: np.ndarray | None = None, one: np.ndarray | None = None):
    """Record batch of (row of a block, small node) pairs by part; ``starts``: first slot of every part."""
    by = np.argsort(slot, kind="stable")
    slot, row = slot[by], row[by]
    ends = np.searchsorted(slot, np.append(starts, np.iinfo(np.int64).max))
    full = [p for p in range(len(starts)) if ends[p] < ends[p + 1]]
    none = np.zeros(0, np.uint8)
    held = {"slot": slot.astype("<i4"), "bins": bins[row], "w": none if w is None else w[by], "one": none if one is None else one[row].astype(np.uint8), "row": row.astype("<i4")}
    cut = lambda x: pa.array([x[ends[p]:ends[p + 1]].tobytes() for p in full], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()), *[cut(held[c]) for c in _PAIR]], names=["part", "block", *_PAIR])


def _place(small: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places among the small nodes, whether they are small)."""
    i = np.minimum(np.searchsorted(small, at), max(0, len(small) - 1))
    return i, (small[i] == at) if len(small) else np.zeros(at.shape, bool)


def _pairs_of(small: np.ndarray, starts: np.ndarray, trees: int, moves, idle: bool):
    """The rows of the blocks at small nodes, with weight or (``idle``) also without."""
    def run(batches):
        for r in _rows(batches):
            b = _arrays(r, trees)
            for lo in range(0, r["n"], ROWS_AT_ONCE):
                cut = slice(lo, lo + ROWS_AT_ONCE)
                bins, w = b["bins"][cut], b["w"][cut]
                at = _moved(b["node"][cut], bins, moves) if moves is not None else b["node"][cut]
                slot, hit = _place(small, at)
                row, tree = np.nonzero(hit if idle else hit & (w > 0))
                batch = _dealt_pairs(r.get("block", 0), slot[row, tree], row, bins, starts, w[row, tree], b["label"][cut] > 0)
                if lo:
                    row = pa.array([(np.frombuffer(x, "<i4") + np.int32(lo)).astype("<i4").tobytes() for x in batch.column("row").to_pylist()], pa.binary())
                    batch = pa.RecordBatch.from_arrays([*batch.columns[:-1], row], names=batch.schema.names)
                yield batch
    return run


def _joined(t: pa.Table, c: str, kind: str) -> np.ndarray:
    parts = [np.frombuffer(v, kind) for v in t.column(c).to_pylist() if v is not None]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _grown_table(part, root, f, votes) -> pa.Table:
    """One row of a part's subtrees, and rows of votes (block, rows, votes)."""
    n = len(votes)
    cols = {"part": pa.array([part] * (n + 1), pa.int32()), "root": pa.array([root.astype("<i4").tobytes()] + [None] * n, pa.binary())}
    cols |= {c: pa.array([f[c].astype(k).tobytes()] + [None] * n, pa.binary()) for c, k in Nodes.KIND.items()}
    cols |= {"block": pa.array([None] + [v[0] for v in votes], pa.int64()), "row": pa.array([None] + [v[1].tobytes() for v in votes], pa.binary()), "vote": pa.array([None] + [v[2].tobytes() for v in votes], pa.binary())}
    return pa.table(cols)


def _grown_part(path: np.ndarray, depth: np.ndarray, starts: np.ndarray, n_features: int, looked: int, width: int, max_depth: int, seed: int, vote: bool, scale=(1.0, 1.0)):
    """All subtrees of one part; with ``vote`` the votes on its rows without weight."""
    def run(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        first, end = int(starts[part]), int(starts[part + 1]) if part + 1 < len(starts) else len(path)
        slot, w, one = (_joined(t, c, _PAIR[c]) for c in ("slot", "w", "one"))
        bins = _joined(t, "bins", "u1").reshape(-1, n_features)
        by = np.argsort(slot, kind="stable")
        edge = np.searchsorted(slot[by], np.arange(first, end + 1))
        held, roots, p, base = [], np.zeros(end - first, np.int64), np.zeros(len(slot) if vote else 0, np.int64), 0
        lo = first
        while lo < end:   # whole nodes, about LOOKS at a time
            hi = lo + 1
            while hi < end and (edge[hi + 1 - first] - edge[lo - first]) * looked <= LOOKS:
                hi += 1
            mine = by[edge[lo - first]:edge[hi - first]]
            f, leaf = _subtrees(slot[mine] - lo, bins[mine], w[mine], one[mine], path[lo:hi], depth[lo:hi], looked, width, max_depth, seed, scale)
            if vote:
                p[mine] = _votes(f, leaf)
            f.left = np.where(f.left >= 0, f.left + base, -1)
            roots[lo - first:hi - first] = base + np.arange(hi - lo)
            base += len(f.feature)
            held.append(f)
            lo = hi
        votes = []
        if vote:
            row, done = _joined(t, "row", "<i4"), 0
            for block, x in zip(t.column("block").to_pylist(), t.column("row").to_pylist()):
                n = len(x) // 4
                mine = done + np.nonzero(w[done:done + n] == 0)[0]
                votes.append((block, row[mine], p[mine]))
                done += n
        return _grown_table(part, roots, {c: np.concatenate([getattr(f, c) for f in held]) for c in Nodes.FILL}, votes)
    return run


def _part_nodes(row: dict) -> Nodes:
    f = Nodes(0)
    for c, k in Nodes.KIND.items():
        setattr(f, c, np.frombuffer(row[c], k).astype(np.int64 if k[1] == "i" else float))
    return f


class GrownForest:
    """Fitted trees: the upper nodes (``top``), the numbers of the small nodes among them, the parts these were dealt to and
    the table of their subtrees.  ``whole`` has all nodes as arrays on the driver, which only exports and tests need; so have ``feature``, ``bin``, ``left``, ``w0``, ``w1``, ``gain``."""

    def __init__(self, trees: int, rates: dict, cuts: list, width: int, top: Nodes, small=None, starts=None, table: DataFrame | None = None):
        self.trees, self.rates, self.cuts, self.width, self.top = trees, rates, cuts, width, top
        self.small, self.starts = (np.zeros(0, np.int64) if x is None else x for x in (small, starts))
        self.table, self._whole = table, None

    def whole(self) -> Nodes:
        if self._whole is None:
            f = Nodes(0)
            held = {c: [getattr(self.top, c).copy()] for c in Nodes.FILL}
            base = len(self.top.feature)
            for r in self.table.orderBy("part").toArrow().to_pylist() if self.table is not None else []:   # the model
                part, root = _part_nodes(r), np.frombuffer(r["root"], "<i4")
                mine = self.small[self.starts[r["part"]]:][:len(root)]
                # a subtree's root takes the place of the small node, the other nodes follow
                rest = np.setdiff1d(np.arange(len(part.feature)), root)
                new = np.zeros(len(part.feature), np.int64)
                new[root], new[rest] = mine, base + np.arange(len(rest))
                part.left = np.where(part.left >= 0, new[part.left], -1)
                for c in Nodes.FILL:
                    held[c][0][mine] = getattr(part, c)[root]
                    held[c].append(getattr(part, c)[rest])
                base += len(rest)
            for c in Nodes.FILL:
                setattr(f, c, np.concatenate(held[c]))
            self._whole = f
        return self._whole

    def __getattr__(self, name):
        if name in Nodes.FILL:
            return getattr(self.whole(), name)
        raise AttributeError(name)

    def _of_parts(self, fn, schema: str, parts: Sequence[int] | None = None) -> DataFrame:
        """Rows that ``fn(part's nodes, their roots, places of the roots among the small nodes)`` gives for the subtrees of each part."""
        starts = self.starts

        def run(batches):
            for r in _rows(batches):
                root = np.frombuffer(r["root"], "<i4").astype(np.int64)
                yield fn(_part_nodes(r), root, int(starts[r["part"]]) + np.arange(len(root)))
        table = self.table if parts is None else self.table.where(F.col("part").isin([int(p) for p in parts]))
        ship(table.sparkSession)
        return table.mapInArrow(run, schema)

    def tree_gains(self, n_features: int) -> np.ndarray:
        """[trees, features] summed gain of the splits.  The subtrees' are added up where they lie."""
        owner = _owners(self.top, np.arange(self.trees), np.arange(self.trees))
        out = np.zeros((self.trees, n_features))
        tree, feature, gain = _tree_gains(self.top, owner, n_features)
        out[tree, feature] = gain
        if self.table is not None:
            of_small = owner[self.small]

            def gains(f, root, place):
                got = _tree_gains(f, _owners(f, root, of_small[place]), n_features)
                return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(got, (pa.int32(), pa.int32(), pa.float64()))], names=["tree", "feature", "gain"])
            for r in self._of_parts(gains, "tree int, feature int, gain double").groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect():
                out[r.tree, r.feature] += r.gain
        return out

    def node_rows(self, spark: SparkSession, trees: Sequence[int]) -> DataFrame:
        """The nodes of some trees as rows (``_NODE_ROWS``), numbered as Spark ML numbers them; those of subtrees are made where they lie."""
        top, small, cuts = self.top, self.small, self.cuts
        wanted = np.zeros(self.trees, bool)
        wanted[list(trees)] = True
        roots = np.nonzero(wanted)[0]
        owner = _owners(top, roots, roots)
        mine = owner[small] >= 0 if len(small) else np.zeros(0, bool)
        parts = np.unique(np.searchsorted(self.starts, np.nonzero(mine)[0], "right") - 1) if mine.any() else []
        size = np.ones(len(top.feature), np.int64)
        if len(parts):
            def counted(f, root, place):
                return pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(_sizes(f, root, np.ones(len(f.feature)))[root], pa.int64())], names=["place", "size"])
            for r in self._of_parts(counted, "place long, size long", parts).collect():   # one row a small node
                size[small[r.place]] = r["size"]
        size = _sizes(top, roots, size)
        number = _numbers(top, roots, np.zeros(len(roots), np.int64), size)
        above = np.setdiff1d(np.nonzero(owner >= 0)[0], small) if len(parts) else np.nonzero(owner >= 0)[0]
        out = spark.createDataFrame(pa.Table.from_batches([_node_batch(top, above, owner, number, cuts)]), _NODE_ROWS)
        if len(parts):
            of_small, first = np.where(mine, owner[small], -1), number[small]

            def made(f, root, place):
                held = _owners(f, root, of_small[place])
                use = np.nonzero(held >= 0)[0]
                own = _numbers(f, root, first[place], _sizes(f, root, np.ones(len(f.feature))))
                return _node_batch(f, use, held, own, cuts)
            out = out.unionByName(self._of_parts(made, _NODE_ROWS, parts))
        return out

    def tree(self, t: int) -> Tree:
        """Tree ``t`` alone, parents before children."""
        order, at = [t], 0
        while at < len(order):
            if self.left[order[at]] >= 0:
                order += [int(self.left[order[at]]), int(self.left[order[at]]) + 1]
            at += 1
        new = {v: i for i, v in enumerate(order)}
        o = np.array(order)
        kids = lambda d: np.array([new[int(self.left[v]) + d] if self.left[v] >= 0 else -1 for v in order])
        stats = np.stack([self.w0[o], self.w1[o]], axis=1)
        total = stats.sum(axis=1)
        gain = np.where(self.left[o] >= 0, np.divide(self.gain[o], total, out=np.zeros(len(o)), where=total > 0), -1.0)
        return Tree(np.where(self.left[o] >= 0, self.feature[o], -1), self.bin[o], kids(0), kids(1), (stats[:, 1] > stats[:, 0]).astype(float), gain, total.astype(np.int64), stats)

    def model(self, spark: SparkSession, n_features: int, first: int | None = None) -> RandomForestClassificationModel:
        """All trees, or the ``first`` ones, in Spark ML's form, which the driver holds whole."""
        n = self.trees if first is None else first
        return _load(spark, [self.tree(t) for t in range(n)], [1.0] * n, self.cuts, n_features, False).setFeaturesCol("features")


def _levels(f, at: np.ndarray) -> list[np.ndarray]:
    """The nodes below and with ``at``, level by level."""
    out = []
    while len(at):
        out.append(at)
        left = f.left[at[f.left[at] >= 0]]
        at = np.stack([left, left + 1], axis=1).ravel()
    return out


def _owners(f, roots: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """Tree of each node: that of its root."""
    out = np.full(len(f.feature), -1)
    out[roots] = tree
    for at in _levels(f, roots):
        v = at[f.left[at] >= 0]
        out[f.left[v]] = out[f.left[v] + 1] = out[v]
    return out


def _sizes(f, roots: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Nodes of the tree below each node and itself; ``size``: those of the leaves."""
    out = size.astype(np.int64)
    for at in reversed(_levels(f, roots)):
        v = at[f.left[at] >= 0]
        out[v] = 1 + out[f.left[v]] + out[f.left[v] + 1]
    return out


def _numbers(f, roots: np.ndarray, number: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Number of each node in its tree: a node, then all below its left child, then all below its right one."""
    out = np.full(len(f.feature), -1)
    out[roots] = number
    for at in _levels(f, roots):
        v = at[f.left[at] >= 0]
        out[f.left[v]], out[f.left[v] + 1] = out[v] + 1, out[v] + 1 + size[f.left[v]]
    return out


def _tree_gains(f, tree: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tree, feature, summed gain) of the splits."""
    v = np.nonzero((f.left >= 0) & (tree >= 0))[0]
    key, gain = _summed(tree[v] * n_features + f.feature[v], f.gain[v])
    return key // n_features, key % n_features, gain


_NODE_ROWS = "tree int, id int, prediction double, impurity double, gain double, left int, right int, feature_index int, threshold double, count long"


def _node_batch(f, use: np.ndarray, tree: np.ndarray, number: np.ndarray, cuts: list) -> pa.RecordBatch:
    """Rows of ``_NODE_ROWS`` of the nodes ``use``."""
    inner, total = f.left[use] >= 0, f.w0[use] + f.w1[use]
    share = np.divide(f.w1[use], total, out=np.zeros(len(use)), where=total > 0)
    left = np.where(inner, f.left[use], 0)
    feature = np.where(inner, f.feature[use], -1)
    gain = np.where(inner, np.divide(f.gain[use], total, out=np.zeros(len(use)), where=total > 0), -1.0)
    at = [float(cuts[c][b]) if c >= 0 else None for c, b in zip(feature.tolist(), f.bin[use].tolist())]
    columns = [pa.array(tree[use], pa.int32()), pa.array(number[use], pa.int32()), pa.array((f.w1[use] > f.w0[use]).astype(float)), pa.array(np.where(total > 0, 2 * share * (1 - share), 0.0)), pa.array(gain),
               pa.array(np.where(inner, number[left], -1), pa.int32()), pa.array(np.where(inner, number[left + 1 if len(f.left) > 1 else left], -1), pa.int32()), pa.array(feature, pa.int32()), pa.array(at, pa.float64()), pa.array(total.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _NODE_ROWS.split(", ")])


def _voted(top: Nodes, small: np.ndarray, trees: int):
    """Per block, with the votes of the subtrees: rows with a vote, votes, rows whose mean vote is right, weight of classes 0 and 1 in the bags."""
    def run(state: pa.Table, votes: pa.Table) -> pa.Table:
        out = np.zeros((state.num_rows, 5), np.int64)
        for i, r in enumerate(state.to_pylist()):
            b = _arrays(r, trees)
            y = b["label"] > 0
            n, s = np.zeros(len(y), np.int64), np.zeros(len(y), np.int64)
            for rows, p in zip(votes.column("row").to_pylist(), votes.column("vote").to_pylist()):
                rows, p = np.frombuffer(rows, "<i4"), np.frombuffer(p, np.int64)
                np.add.at(n, rows, 1)
                np.add.at(s, rows, p)
            for lo in range(0, len(y), ROWS_AT_ONCE):
                part = slice(lo, lo + ROWS_AT_ONCE)
                row, tree = np.nonzero((b["w"][part] == 0) & ~_place(small, b["node"][part])[1])
                np.add.at(n, lo + row, 1)
                np.add.at(s, lo + row, _votes(top, b["node"][part][row, tree]))
            right = (n > 0) & ((2 * s > n * VOTE) == y)
            w = b["w"].sum(axis=1, dtype=np.int64)
            out[i] = (n > 0).sum(), n.sum(), right.sum(), w[~y].sum(), w[y].sum()
        return pa.table({c: pa.array(out[:, i]) for i, c in enumerate(_COUNTS)})
    return run


_COUNTS = ["oob_rows", "oob_votes", "oob_right", "in_bag_0", "in_bag_1"]


def grow_forest(df: DataFrame, cols: Sequence[str], n_trees: int = 100, features: str | int = "sqrt", balanced: bool = False, max_samples: float = 1.0, max_depth: int = 30, max_bins: int = 255,
                key: str = "loan_id", label: str = "label", seed: int = 111, oob: bool = False, fold: str | None = None, cv: int = 1, tests=None,
                class_weights: dict[int, float] | None = None, bootstrap: bool = True) -> tuple[GrownForest, dict]:
    """(forest, out-of-bag counts) of trees grown on ``df`` until their leaves are pure or at ``max_depth``.

    ``features``: ``sqrt``, ``log2`` or ``all`` or a number are looked at in a node.  Rows without a label are left out.  Rows without
    a key draw by their values.  ``class_weights`` weigh the classes in gains and leaves; the draws do not change.
    Without ``bootstrap`` every tree has every row once.
    With a column ``fold`` of numbers below ``cv`` there are ``cv`` forests of ``n_trees``, the k-th without the rows of fold k;
    ``tests`` is a (depths, counts) pair for the accuracy of cut-off forests on their own folds (see ``fold_accuracy``).
    """
    in_fold = (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold")
    df = df.where(F.col(label).isNotNull()).select(*cols, F.col(label).cast("double").alias("label"), F.coalesce(stream_seed(key, seed), F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(PRIME - 1)) + 1).alias("key"), in_fold).persist()
    counts = {int(r.label): r.n for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}
    least = min(counts.values())
    rates = {c: max_samples * (least / n if balanced else 1.0) if bootstrap else None for c, n in counts.items()}
    cuts = fit_cuts(df, cols, max_bins)
    width, n_features = max_bins + 1, len(cols)
    looked = {"sqrt": max(1, math.isqrt(n_features)), "log2": max(1, int(math.log2(n_features))), "all": n_features}.get(features, features)
    scale = tuple(float((class_weights or {}).get(c, 1.0)) for c in (0, 1))
    per_fold, n_trees = n_trees, n_trees * cv
    rows = sum((rates[c] if bootstrap else 1) * n for c, n in counts.items())   # expected weight of a tree
    all_rows = sum(counts.values())
    tasks = max(-(-all_rows * n_trees * looked // TASK_CELLS), -(-all_rows * n_trees // TASK_PAIRS))
    have, want = df.rdd.getNumPartitions(), max(tasks, df.sparkSession.sparkContext.defaultParallelism)
    dealt = df.repartition(tasks) if tasks > have else df.coalesce(want) if want < have else df   # every level starts a task for each
    state = block_frame(dealt, cols, cuts, EXTRA).mapInArrow(_started(rates, per_fold, cv), _STATE).persist()
    local = min(LOCAL, max(1, LOCAL_LOOKS // looked)) if tests is None else 0
    senders = max(tasks, min(have, want))   # tasks that send cells
    top = Nodes(n_trees)
    g = _Growth(top, np.arange(n_trees), np.zeros(n_trees, np.int64), n_features, looked, max_depth, seed)
    small = [[], [], [], []]   # numbers, path numbers, depths, weights

    def set_aside(weight: np.ndarray) -> None:
        mine = (weight <= local) & (g.tries == 0)
        for x, v in zip(small, (g.nodes, g.path, g.depth, weight)):
            x.append(v[mine])
        g.keep(~mine)
    set_aside(np.full(n_trees, rows))
    moves, old, level = None, [], 0
    while len(g.nodes):
        if moves is not None and len(moves[0]):
            old.append(state)
            state = state.mapInArrow(_advanced(moves, n_trees), _STATE)
            level += 1
            state = cut_lineage(state) if level % CHECKPOINT_EVERY == 0 else state.persist()
        now = g.level()
        cells = min(len(now.nodes) * looked * width * senders, int(rows * n_trees * looked))   # that the tasks send at most
        parts = int(min(len(now.nodes), max(1, -(-cells // CELLS))))
        got = state.mapInArrow(_dealt(now, n_trees, width, parts), "part int, cell binary, n binary, s binary").groupBy("part").applyInArrow(_judged(looked, width, scale), _BEST).toArrow()
        for s in old:
            s.unpersist()
        old = []
        best = {c: got.column(c).to_numpy() for c in _BEST_NAMES}
        by = np.argsort(best["slot"])
        moves = g.split(now, {c: v[by] for c, v in best.items()})
        set_aside(top.w0[g.nodes] + top.w1[g.nodes])
    top.weigh(scale)
    res, table, starts = {}, None, None
    small = [np.concatenate(x) for x in small]
    small = [x[np.argsort(small[0])] for x in small]
    if oob:   # votes meet their blocks again by the blocks' numbers, which a checkpoint fixes
        if moves is not None:
            old.append(state)
            state = state.mapInArrow(_advanced(moves, n_trees), _STATE)
            moves = None
        state = cut_lineage(state.withColumn("block", F.monotonically_increasing_id()))
    votes = None
    if len(small[0]):
        part = (np.cumsum(small[3]) - small[3]).astype(np.int64) // PAIRS
        starts = np.unique(part, return_index=True)[1]
        pairs = state.mapInArrow(_pairs_of(small[0], starts, n_trees, moves, oob), _PAIRS)
        grown = pairs.repartition(len(starts), "part").groupBy("part").applyInArrow(_grown_part(small[1], small[2], starts, n_features, looked, width, max_depth, seed, oob, scale), _GROWN)
        grown = cut_lineage(grown)
        table = grown.where(F.col("root").isNotNull()).drop("block", "row", "vote")
        votes = grown.where(F.col("root").isNull()).select("block", "row", "vote")
    if oob:
        votes = df.sparkSession.createDataFrame([], _VOTES) if votes is None else votes
        counted = state.groupBy("block").cogroup(votes.groupBy("block")).applyInArrow(_voted(top, small[0], n_trees), ", ".join(f"{c} long" for c in _COUNTS))
        res = {c: int(x or 0) for c, x in zip(_COUNTS, counted.agg(*[F.sum(c) for c in _COUNTS]).first())}
    if tests is not None:
        shape = "fold int, depth int, trees int, right long, n long"
        res = state.mapInArrow(_fold_tests(top, cv, per_fold, *tests), shape).groupBy("depth", "trees", "fold").agg((F.sum("right") / F.sum("n")).alias("accuracy"))
        res = {(r.depth, r.trees): r.accuracy for r in res.groupBy("depth", "trees").agg(F.avg("accuracy").alias("accuracy")).collect()}
    for s in old:
        s.unpersist()
    state.unpersist()
    df.unpersist()
    return GrownForest(n_trees, rates, cuts, width, top, small[0], starts, table), res


# ------------------------------------------------------------------ scoring
def _packed_bins(batches):
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b"".join(b.column(0).to_pylist())], pa.binary())], names=["n", "bins"])


def _every_pair(rows: int, trees: int):
    """(rows, trees) of all pairs, about ``PAIRS`` at a time."""
    step = max(1, PAIRS // trees)
    for lo in range(0, rows, step):
        row, tree = np.divmod(np.arange(lo * trees, min(rows, lo + step) * trees), trees)
        yield row, tree


def _reached(top: Nodes, small: np.ndarray, starts: np.ndarray, trees: int, n_features: int):
    """Pairs of the blocks' rows and the small nodes that they reach in each tree."""
    def run(batches):
        for r in _rows(batches):
            bins = np.frombuffer(r["bins"], np.uint8).reshape(-1, n_features)
            for row, tree in _every_pair(len(bins), trees):
                slot, hit = _place(small, _walk(top, bins, row, tree))
                yield _dealt_pairs(r["block"], slot[hit], row[hit], bins, starts)
    return run


def _scored_part(starts: np.ndarray, n_features: int):
    """Votes of a part's subtrees on the pairs dealt to it."""
    def run(pairs: pa.Table, table: pa.Table) -> pa.Table:
        out = ([], [], [])
        for grown in table.to_pylist():   # one row; none if no row of the part had weight: no votes for class 1
            f, root, first = _part_nodes(grown), np.frombuffer(grown["root"], "<i4"), int(starts[grown["part"]])
            for r in pairs.to_pylist():
                bins = np.frombuffer(r["bins"], np.uint8).reshape(-1, n_features)
                at = root[np.frombuffer(r["slot"], "<i4") - first]
                for x, v in zip(out, (r["block"], r["row"], _votes(f, _walk(f, bins, np.arange(len(bins)), at)).tobytes())):
                    x.append(v)
        return pa.table([pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.binary(), pa.binary()))], names=["block", "row", "vote"])
    return run


def _added_up(top: Nodes, small: np.ndarray, trees: int, n_features: int):
    """Mean vote of each row of the blocks: of the subtrees, and of the leaves above them."""
    def run(blocks: pa.Table, votes: pa.Table) -> pa.Table:
        keys, p = [], []
        for r in blocks.to_pylist():
            s, bins = np.zeros(r["n"], np.int64), np.frombuffer(r["bins"], np.uint8).reshape(-1, n_features)
            for row, tree in _every_pair(len(bins), trees):
                at = _walk(top, bins, row, tree)
                above = ~_place(small, at)[1]
                np.add.at(s, row[above], _votes(top, at[above]))
            for row, vote in zip(votes.column("row").to_pylist(), votes.column("vote").to_pylist()):
                np.add.at(s, np.frombuffer(row, "<i4"), np.frombuffer(vote, np.int64))
            keys += [r["bins"][i * n_features:(i + 1) * n_features] for i in range(r["n"])]
            p.append(s / (VOTE * trees))
        return pa.table([pa.array(keys, pa.binary()), pa.array(np.concatenate(p) if p else np.zeros(0))], names=["_bins", "p1"])
    return run


class ForestModel(Model, MLWritable, MLReadable):
    """The first ``trees`` trees of a grown forest as a stage of a pipeline: adds ``p1``, the mean share of class 1, and ``prediction``.

    Every distinct row of bins is scored once: dealt to the subtrees it reaches, the votes added up, and joined to the rows that have it."""

    def __init__(self, forest: GrownForest | None = None, cols: Sequence[str] = (), trees: int | None = None):
        super().__init__()
        self.forest, self.cols, self.getNumTrees = forest, list(cols), trees if trees or forest is None else forest.trees

    def spark_model(self) -> RandomForestClassificationModel:
        return self.forest.model(SparkSession.active(), len(self.cols), self.getNumTrees)

    @property
    def trees(self) -> list:
        return self.spark_model().trees

    @property
    def featureImportances(self) -> DenseVector:
        """As Spark ML has them: gains by feature, each tree's and then the forest's scaled to a sum of 1."""
        gains = self.forest.tree_gains(len(self.cols))[:self.getNumTrees]
        total = gains.sum(axis=1, keepdims=True)
        out = np.divide(gains, total, out=np.zeros(gains.shape), where=total > 0).sum(axis=0)
        return DenseVector(out / out.sum() if out.sum() > 0 else out)

    def node_table(self, spark: SparkSession, tree: int | None = None) -> DataFrame:
        """The nodes of all trees, or of one, as rows (see ``explain.node_table``)."""
        return self.forest.node_rows(spark, range(self.getNumTrees) if tree is None else [tree])

    def _transform(self, df: DataFrame) -> DataFrame:
        f, n = self.forest, len(self.cols)
        cuts, small, starts = f.cuts, f.small, f.starts
        ship(df.sparkSession)

        @F.pandas_udf("binary")
        def row_bins(x: pd.DataFrame) -> pd.Series:
            own = np.stack([binned(x[c].to_numpy(np.float64), k) for c, k in zip(x.columns, cuts)], axis=1)
            return pd.Series([v.tobytes() for v in own])
        keyed = df.withColumn("_bins", row_bins(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.cols)])))
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        own = keyed.select("_bins")
        own = own.repartition(tasks, "_bins") if self.getNumTrees > FEW_TREES else own   # many trees: bound by computing, not by size
        blocks = cut_lineage(own.distinct().mapInArrow(_packed_bins, "n long, bins binary").withColumn("block", F.monotonically_increasing_id()))
        pairs = blocks.mapInArrow(_reached(f.top, small, starts, self.getNumTrees, n), _PAIRS)
        table = f.table if f.table is not None else df.sparkSession.createDataFrame([], _GROWN).drop("block", "row", "vote")
        votes = pairs.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(_scored_part(starts, n), _VOTES)
        p = blocks.groupBy("block").cogroup(votes.groupBy("block")).applyInArrow(_added_up(f.top, small, self.getNumTrees, n), "_bins binary, p1 double")
        return keyed.join(cut_lineage(p), "_bins").drop("_bins").withColumn("prediction", F.when(F.col("p1") > 0.5, 1.0).otherwise(0.0))

    def write(self):
        return _ForestWriter(self)

    @classmethod
    def read(cls):
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, f, spark = self.model, self.model.forest, SparkSession.active()
        DefaultParamsWriter.saveMetadata(m, path, spark)
        facts = {"cols": m.cols, "trees": m.getNumTrees, "all": f.trees, "rates": {str(c): r for c, r in f.rates.items()}, "width": f.width, "cuts": [c.tolist() for c in f.cuts]}
        nodes = [[getattr(f.top, c).astype(k).tobytes() for c, k in Nodes.KIND.items()] + [x.astype("<i8").tobytes() for x in (f.small, f.starts)]]
        spark.createDataFrame([(json.dumps(facts), *[bytearray(x) for x in nodes[0]])], "facts string, " + ", ".join(f"{c} binary" for c in (*Nodes.KIND, "small", "starts"))).coalesce(1).write.parquet(f"{path}/top")
        if f.table is not None:
            f.table.write.parquet(f"{path}/subtrees")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.active()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        r = spark.read.parquet(f"{path}/top").first().asDict()
        facts = json.loads(r["facts"])
        small, starts = (np.frombuffer(r[c], "<i8") for c in ("small", "starts"))
        table = spark.read.parquet(f"{path}/subtrees") if len(small) else None
        f = GrownForest(facts["all"], {int(c): x for c, x in facts["rates"].items()}, [np.array(c, np.float64) for c in facts["cuts"]], facts["width"], _part_nodes(r), small, starts, table)
        out = ForestModel(f, facts["cols"], facts["trees"])
        out._resetUid(meta["uid"])
        return out


def _fold_tests(f: GrownForest, cv: int, trees: int, depths: Sequence[int], counts: Sequence[int]):
    """Right predictions for the rows of each fold by the first trees of its forest, cut off at each depth."""
    def run(batches):
        right, n = np.zeros((cv, len(depths), len(counts)), np.int64), np.zeros(cv, np.int64)
        for r in _rows(batches):
            b = _arrays(r, trees * cv)
            for k in range(cv):
                mine = np.nonzero(b["fold"] == k)[0]
                n[k] += len(mine)
                for lo in range(0, len(mine), ROWS_AT_ONCE):
                    rows = mine[lo:lo + ROWS_AT_ONCE]
                    at, y = np.broadcast_to(np.arange(k * trees, (k + 1) * trees), (len(rows), trees)).copy(), b["label"][rows] > 0
                    for d in range(max(depths) + 1):
                        if d in depths:
                            p = np.cumsum(f.w1[at] / np.maximum(f.w0[at] + f.w1[at], 1), axis=1)
                            for j, c in enumerate(counts):
                                right[k, list(depths).index(d), j] += int(((p[:, c - 1] > 0.5 * c) == y).sum())
                        i, t = np.nonzero(f.left[at] >= 0)
                        v = at[i, t]
                        at[i, t] = f.left[v] + (b["bins"][rows[i], f.feature[v]] > f.bin[v])
        out = [(k, d, c, int(right[k, i, j]), int(n[k])) for k in range(cv) for i, d in enumerate(depths) for j, c in enumerate(counts)]
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["fold", "depth", "trees", "right", "n"])
    return run


def fold_accuracy(df: DataFrame, cols: Sequence[str], fold: str, cv: int, trees: int, features: str, depths: Sequence[int], counts: Sequence[int], **kw) -> dict[tuple[int, int], float]:
    """{(depth, number of trees): mean accuracy over the folds} of forests grown on the other folds."""
    return grow_forest(df, cols, trees, features, max_depth=max(depths), fold=fold, cv=cv, tests=(list(depths), list(counts)), **kw)[1]
