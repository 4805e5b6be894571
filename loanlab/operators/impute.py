"""Chained (iterative) imputation with a regression tree per gappy column.

Start from column means; then, round after round, every gappy column is predicted from the other columns by one regression tree
fitted on the rows where it is observed, and only its gaps are replaced.  The trees of a round see the values that the
round before left, so they grow together: one job for each level serves all columns.  Stops after ``max_rounds`` or when the
largest change of an imputed cell is below ``tol`` times the largest observed magnitude.

A block carries its values, their bins (cut once, at most 255 a column) and which cells are gaps.  Tasks add rows and
target values by (node, feature, bin) for the features that a node may look at, in whole units, so sums are exact; the cells are
dealt out by node and only the best splits come back.  The blocks of a round replace those of the round before; every
``CHECKPOINT_EVERY`` rounds they are checkpointed.

Trees of more than ``SHALLOW`` levels grow so down to nodes of at most ``LOCAL`` rows; the pairs of a row and such a node are dealt to tasks, which
grow the rest of the subtrees by the same rules and send the values of the gaps back to their blocks.  The subtrees stay a table.

The fitted model keeps the means and the trees of every round; ``transform`` plays all rounds on each row, in one projection or, where trees
are tables, by dealing the gaps to them, so new rows (the test part) are imputed with what was learnt on the training part only.
"""
from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loanlab.operators.forest import CELLS, LOOKS, ROWS_AT_ONCE, _BEST, _BEST_NAMES, _best_of, _joined, _judged, _mixed, _order, _place, _rows, _runs, _summed
from loanlab.operators.histtree import BLOCK_ROWS, WIDTH, binned, fit_cuts
from loanlab.session import cut_lineage, right_size, ship

UNIT = 1 << 28            # targets are whole multiples of their spread / UNIT: sums of 2^35 rows are exact
CHECKPOINT_EVERY = 3      # rounds
SHALLOW = 8               # levels of trees that grow by jobs alone: at most 512 nodes a tree
LOCAL = 1 << 18           # rows of a node whose subtree grows in one task
PAIRS = 1 << 17           # (row, tree) pairs dealt to a task, or those of one node
_STATE = "n long, x binary, gap binary, bins binary, change double"
_NODES = {"feature": "<i2", "bin": "<i2", "left": "<i4", "value": "<f8"}   # as bytes of a table
_PAIR = {"slot": "<i4", "bins": "u1", "gap": "u1", "y": "<i8", "row": "<i4"}
_VALUE = {"row": "<i4", "tree": "<i4", "fill": "<f8"}
_PAIRS = "part int, block long, " + ", ".join(f"{c} binary" for c in _PAIR)
_VALUES = "block long, " + ", ".join(f"{c} binary" for c in _VALUE)
_GROWN = "part int, root binary, " + ", ".join(f"{c} binary" for c in _NODES) + ", " + _VALUES


@dataclass
class Round:
    """The trees of one round in common arrays, tree t's root at t: feature (-1: leaf), last bin that goes left, left child (right is
    next), value.  Below the nodes ``small`` (of the trees ``small_tree``) the nodes are in ``table``, by parts that start at the places ``starts``."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    small: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    small_tree: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    table: DataFrame | None = None

    def top(self) -> Round:
        """Without the table, for tasks."""
        return Round(self.feature, self.bin, self.left, self.value, self.small, self.small_tree, self.starts)

    def leaf(self, bins: np.ndarray, row: np.ndarray, tree: np.ndarray) -> np.ndarray:
        at = tree.astype(np.int64)
        todo = np.nonzero(self.left[at] >= 0)[0]
        while len(todo):
            v = at[todo]
            at[todo] = self.left[v] + (bins[row[todo], self.feature[v]] > self.bin[v])
            todo = todo[self.left[at[todo]] >= 0]
        return at


def _play(x: np.ndarray, gap: np.ndarray, bins: np.ndarray, r: Round, targets: np.ndarray, cuts: list) -> float:
    """Replace the gaps by the trees' values (in place), all from the values before; the largest change."""
    row, tree = np.nonzero(gap[:, targets])
    return _put(x, bins, row, targets[tree], r.value[r.leaf(bins, row, tree)], cuts)


def _put(x: np.ndarray, bins: np.ndarray, row: np.ndarray, col: np.ndarray, value: np.ndarray, cuts: list) -> float:
    if not len(row):
        return 0.0
    change = float(np.max(np.abs(value - x[row, col])))
    x[row, col] = value
    for t in np.unique(col):
        mine = col == t
        bins[row[mine], t] = binned(value[mine], cuts[t])
    return change


def _columns(b: pa.RecordBatch, at: Sequence[int]) -> np.ndarray:
    return np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in at], axis=1)


def _filled(x: np.ndarray, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gap = np.isnan(x)
    return np.where(gap, means, x), gap


def _packed(cuts: list, means: np.ndarray):
    """Blocks of the first round: gaps hold the mean."""
    def run(batches):
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(_columns(b, range(len(cuts))))
                n += b.num_rows
            if n >= BLOCK_ROWS:
                yield _block(*_filled(np.concatenate(held), means), cuts)
                held, n = [], 0
        if held:
            yield _block(*_filled(np.concatenate(held), means), cuts)
    return run


def _block(x, gap, cuts, bins=None, change=0.0):
    if bins is None:
        bins = np.stack([binned(x[:, i], c) for i, c in enumerate(cuts)], axis=1)
    return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), *[pa.array([v.tobytes()], pa.binary()) for v in (x, gap, bins)], pa.array([change], pa.float64())], names=["n", "x", "gap", "bins", "change"])


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = row["n"]
    return (np.frombuffer(row["x"], np.float64).reshape(n, -1), np.frombuffer(row["gap"], bool).reshape(n, -1), np.frombuffer(row["bins"], np.uint8).reshape(n, -1))


def _played(r: Round, targets: np.ndarray, cuts: list):
    def run(batches):
        for row in _rows(batches):
            x, gap, bins = (v.copy() for v in _open(row))
            change = _play(x, gap, bins, r, targets, cuts)
            yield _block(x, gap, cuts, bins, change)
    return run


def _dealt(r: Round, nodes: np.ndarray, features: np.ndarray, targets: np.ndarray, means: np.ndarray, spread: np.ndarray, parts: int):
    """Rows and summed targets by (open node, place among its features, bin), by ranges of open nodes."""
    looked = features.shape[1]

    def cells(x, gap, bins):
        held = []
        for lo in range(0, len(x), ROWS_AT_ONCE):
            part = slice(lo, lo + ROWS_AT_ONCE)
            row, tree = np.nonzero(~gap[part][:, targets])
            at = r.leaf(bins[part], row, tree)
            slot = np.minimum(np.searchsorted(nodes, at), len(nodes) - 1)
            here = nodes[slot] == at
            row, col, slot = row[here], targets[tree[here]], slot[here]
            y = np.rint((x[part][row, col] - means[col]) / spread[col] * UNIT).astype(np.int64)
            f = features[slot]
            key = ((slot[:, None] * looked + np.arange(looked)) * WIDTH + bins[part][row[:, None], np.maximum(f, 0)])[f >= 0]
            many = (f >= 0).sum(axis=1)
            held.append(_summed(key, np.repeat(np.ones(len(row), np.int64), many), np.repeat(y, many)))
        return _summed(*[np.concatenate(v) for v in zip(*held)]) if held else (np.zeros(0, np.int64),) * 3

    def run(batches):
        span = -(-len(nodes) // parts) * looked * WIDTH
        for row in _rows(batches):
            cell, n, s = cells(*_open(row))
            ends = np.searchsorted(cell, np.arange(parts + 1) * span)
            full = [p for p in range(parts) if ends[p] < ends[p + 1]]
            cut = lambda v: pa.array([v[ends[p]:ends[p + 1]].tobytes() for p in full], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), cut(cell), cut(n), cut(s)], names=["part", "cell", "n", "s"])
    return run


# ------------------------------------------------------------------ subtrees grown in tasks
def _numbered(state: DataFrame) -> DataFrame:
    """Blocks with numbers, which a checkpoint fixes."""
    return cut_lineage(state.withColumn("block", F.monotonically_increasing_id()))


def _pairs_of(r: Round, targets: np.ndarray, mean: np.ndarray, spread: np.ndarray, gaps_only: bool):
    """(row of a block, small node) pairs by part: its bins, and the target in whole units where it is observed."""
    def run(batches):
        for b in _rows(batches):
            x, gap, bins = _open(b)
            for lo in range(0, len(x), ROWS_AT_ONCE):
                part = slice(lo, lo + ROWS_AT_ONCE)
                row, tree = np.nonzero(gap[part][:, targets] if gaps_only else np.ones((len(x[part]), len(targets)), bool))
                slot, hit = _place(r.small, r.leaf(bins[part], row, tree))
                row, tree, slot = row[hit], tree[hit], slot[hit]
                by = np.argsort(slot, kind="stable")
                row, tree, slot = row[by], tree[by], slot[by]
                col = targets[tree]
                unknown = gap[part][row, col]
                y = np.where(unknown, 0, np.rint((x[part][row, col] - mean[col]) / spread[col] * UNIT)).astype(np.int64)
                ends = np.searchsorted(slot, np.append(r.starts, np.iinfo(np.int64).max))
                full = [p for p in range(len(r.starts)) if ends[p] < ends[p + 1]]
                held = {"slot": slot, "bins": bins[part][row], "gap": unknown, "y": y, "row": row + lo}
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([b["block"]] * len(full), pa.int64()), *[
                    pa.array([held[c][ends[p]:ends[p + 1]].astype(k).tobytes() for p in full], pa.binary()) for c, k in _PAIR.items()]], names=["part", "block", *_PAIR])
    return run


class _Growth:
    """The open nodes of some trees: numbers (ascending), path numbers, targets, depths, how many features were tried, and their orders."""

    def __init__(self, f: Round, path: np.ndarray, tree: np.ndarray, depth: np.ndarray, targets: np.ndarray, mean: np.ndarray, spread: np.ndarray, looked: int, max_depth: int, seed: int):
        self.f, self.targets, self.mean, self.spread, self.looked, self.max_depth, self.seed = f, targets, mean, spread, looked, max_depth, seed
        self.n_features = len(mean) - 1
        self.nodes, self.path, self.tree, self.depth, self.tries = np.arange(len(path)), path.astype(np.uint64), tree, depth, np.zeros(len(path), np.int64)
        self.order = self._others(self.path, tree)

    def _others(self, path: np.ndarray, tree: np.ndarray) -> np.ndarray:
        """The features of each node in its own order, without its target."""
        order = _order(path, self.n_features + 1, self.seed)
        return order[order != self.targets[tree][:, None]].reshape(len(path), self.n_features)

    def seen(self) -> np.ndarray:
        """The features that each node looks at now (-1: none left)."""
        place = self.tries[:, None] * self.looked + np.arange(self.looked)[None, :]
        return np.where(place < self.n_features, np.take_along_axis(self.order, np.minimum(place, self.n_features - 1), axis=1), -1)

    def keep(self, mask: np.ndarray) -> None:
        for name in ("nodes", "path", "tree", "depth", "tries", "order"):
            setattr(self, name, getattr(self, name)[mask])

    def split(self, seen: np.ndarray, g: dict) -> np.ndarray:
        """Nodes split by the judgements (``_BEST`` columns by slot); rows of the nodes that are open now."""
        f, slot = self.f, g["slot"]
        node, col = self.nodes[slot], self.targets[self.tree[slot]]
        f.value[node] = self.mean[col] + self.spread[col] * g["ts"] / g["tn"] / UNIT
        cut = g["gain"] > 0
        many, at = int(cut.sum()), len(f.feature)
        left = at + 2 * np.arange(many)
        ln, ls, tn, ts = (g[c][cut] for c in ("ln", "ls", "tn", "ts"))
        value = np.stack([ls / np.maximum(ln, 1), (ts - ls) / np.maximum(tn - ln, 1)], axis=1) / UNIT
        value = (self.mean[col[cut]][:, None] + self.spread[col[cut]][:, None] * value).ravel()
        parent = node[cut]
        for name, fill in (("feature", np.full(2 * many, -1)), ("bin", np.zeros(2 * many, np.int64)), ("left", np.full(2 * many, -1)), ("value", value)):
            setattr(f, name, np.concatenate([getattr(f, name), fill]))
        f.feature[parent], f.bin[parent], f.left[parent] = seen[slot[cut], g["place"][cut]], g["bin"][cut], left
        kids, tree = np.stack([left, left + 1], axis=1).ravel(), np.repeat(self.tree[slot[cut]], 2)
        deep, rows = np.repeat(self.depth[slot[cut]] + 1, 2), np.stack([ln, tn - ln], axis=1).ravel()
        on = (deep < self.max_depth) & (rows > 1)
        again = ~cut & ((self.tries[slot] + 1) * self.looked < self.n_features) & (g["tn"] > 1)
        with np.errstate(over="ignore"):   # a node's path number is that of its parent and the side
            path = _mixed(np.repeat(self.path[slot[cut]], 2) * np.uint64(0xD1342543DE82EF95) + np.tile(np.array([1, 2], np.uint64), many))[on]
        stay, tree = slot[again], tree[on]
        self.nodes, self.path, self.tree, self.depth, self.tries, self.order, rows = (np.concatenate(v) for v in (
            (node[again], kids[on]), (self.path[stay], path), (self.tree[stay], tree), (self.depth[stay], deep[on]), (self.tries[stay] + 1, np.zeros(int(on.sum()), np.int64)),
            (self.order[stay], self._others(path, tree)), (g["tn"][again], rows[on])))
        by = np.argsort(self.nodes)
        self.keep(by)
        return rows[by]


def _totals(key: np.ndarray, target: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cells, ascending, their rows and summed targets; sums of a node of at most ``LOCAL`` rows are exact in doubles."""
    if cells <= 4 * len(key):
        rows = np.bincount(key, minlength=cells)
        cell = np.nonzero(rows)[0]
        return cell, rows[cell], np.bincount(key, target, cells)[cell].astype(np.int64)
    by = np.argsort(key)
    return _runs(key[by], np.ones(len(by), np.int64), target[by])


def _subtrees(f: Round, g: _Growth, slot: np.ndarray, bins: np.ndarray, gap: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Subtrees of the roots 0, 1, ... grown on the observed pairs; every pair's leaf."""
    at, live = slot.astype(np.int64), np.nonzero(~gap)[0]
    while len(g.nodes):
        seen, number = g.seen(), np.full(len(f.feature), -1)
        number[g.nodes] = np.arange(len(g.nodes))
        mine = number[at[live]]
        live, mine = live[mine >= 0], mine[mine >= 0]
        look = seen[mine]
        key = (mine[:, None] * g.looked + np.arange(g.looked)) * WIDTH + bins[live[:, None], np.maximum(look, 0)]
        here = look >= 0
        key, target = key[here], np.repeat(y[live], here.sum(axis=1))
        if not len(key):
            break
        got = _best_of(*_totals(key, target, len(g.nodes) * g.looked * WIDTH), g.looked, WIDTH)
        g.split(seen, dict(zip(_BEST_NAMES, got)))
        down = f.left[at[live]] >= 0
        row = live[down]
        at[row] = f.left[at[row]] + (bins[row, f.feature[at[row]]] > f.bin[at[row]])
    idle = np.nonzero(gap)[0]
    at[idle] = f.leaf(bins, idle, at[idle])
    return at


def _grown_part(top: Round, path: np.ndarray, depth: np.ndarray, targets: np.ndarray, mean: np.ndarray, spread: np.ndarray, looked: int, max_depth: int, seed: int):
    """All subtrees of one part, and the values of the gaps that were dealt to it."""
    def run(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        first = int(top.starts[part])
        end = int(top.starts[part + 1]) if part + 1 < len(top.starts) else len(path)
        slot, gap, y = _joined(t, "slot", "<i4"), _joined(t, "gap", "u1") > 0, _joined(t, "y", "<i8")
        bins = _joined(t, "bins", "u1").reshape(-1, len(mean))
        by = np.argsort(slot, kind="stable")
        edge = np.searchsorted(slot[by], np.arange(first, end + 1))
        held, roots, fill, base, lo = [], np.zeros(end - first, np.int64), np.zeros(len(slot)), 0, first
        while lo < end:   # whole nodes, about LOOKS at a time
            hi = lo + 1
            while hi < end and (edge[hi + 1 - first] - edge[lo - first]) * looked <= LOOKS:
                hi += 1
            mine = by[edge[lo - first]:edge[hi - first]]
            tree = top.small_tree[lo:hi]
            f = Round(np.full(hi - lo, -1), np.zeros(hi - lo, np.int64), np.full(hi - lo, -1), mean[targets[tree]].copy())
            g = _Growth(f, path[lo:hi], tree, depth[lo:hi], targets, mean, spread, looked, max_depth, seed)
            leaf = _subtrees(f, g, slot[mine] - lo, bins[mine], gap[mine], y[mine])
            fill[mine] = f.value[leaf]
            f.left = np.where(f.left >= 0, f.left + base, -1)
            roots[lo - first:hi - first] = base + np.arange(hi - lo)
            base += len(f.feature)
            held.append(f)
            lo = hi
        values, done = [], 0
        for block, x in zip(t.column("block").to_pylist(), t.column("row").to_pylist()):
            row = np.frombuffer(x, "<i4")
            own = slice(done, done + len(row))
            values.append((block, row[gap[own]], top.small_tree[slot[own][gap[own]]], fill[own][gap[own]]))
            done += len(row)
        n = len(values)
        cols = {"part": pa.array([part] * (n + 1), pa.int32()), "root": pa.array([roots.astype("<i4").tobytes()] + [None] * n, pa.binary())}
        cols |= {c: pa.array([np.concatenate([getattr(f, c) for f in held]).astype(k).tobytes()] + [None] * n, pa.binary()) for c, k in _NODES.items()}
        cols |= {"block": pa.array([None] + [v[0] for v in values], pa.int64())}
        cols |= {c: pa.array([None] + [v[i + 1].astype(k).tobytes() for v in values], pa.binary()) for i, (c, k) in enumerate(_VALUE.items())}
        return pa.table(cols)
    return run


def _valued_part(top: Round):
    """Values of a part's subtrees for the gaps dealt to it."""
    def run(pairs: pa.Table, table: pa.Table) -> pa.Table:
        out = {c: [] for c in ("block", *_VALUE)}
        for r in table.to_pylist():   # one row
            f, root, first = Round(*[np.frombuffer(r[c], k) for c, k in _NODES.items()]), np.frombuffer(r["root"], "<i4"), int(top.starts[r["part"]])
            for p in pairs.to_pylist():
                slot = np.frombuffer(p["slot"], "<i4")
                bins = np.frombuffer(p["bins"], np.uint8).reshape(len(slot), -1)
                for c, v in (("block", p["block"]), ("row", p["row"]), ("tree", top.small_tree[slot].astype("<i4").tobytes()),
                             ("fill", f.value[f.leaf(bins, np.arange(len(slot)), root[slot - first])].astype("<f8").tobytes())):
                    out[c].append(v)
        return pa.table({c: pa.array(v, pa.int64() if c == "block" else pa.binary()) for c, v in out.items()})
    return run


def _filled_block(top: Round, targets: np.ndarray, cuts: list):
    """A block's gaps replaced: by the values of the subtrees, and of the leaves above them."""
    def run(state: pa.Table, values: pa.Table) -> pa.Table:
        got = [_joined(values, c, k) for c, k in _VALUE.items()]
        out = []
        for b in state.to_pylist():   # one row
            x, gap, bins = (v.copy() for v in _open(b))
            row, tree = np.nonzero(gap[:, targets])
            at = top.leaf(bins, row, tree)
            above = ~_place(top.small, at)[1]
            row, tree, value = (np.concatenate(v) for v in ((row[above], got[0]), (tree[above], got[1]), (top.value[at[above]], got[2])))
            change = _put(x, bins, row, targets[tree], value, cuts)
            out.append(_block(x, gap, cuts, bins, change).append_column("block", pa.array([b["block"]], pa.int64())))
        return pa.Table.from_batches(out)
    return run


def _replaced(state: DataFrame, r: Round, values: DataFrame, targets: np.ndarray, cuts: list, parts: int) -> DataFrame:
    """Blocks of the next round, in ``parts`` partitions at most: every level starts a task for each."""
    return state.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(_filled_block(r.top(), targets, cuts), _STATE + ", block long").coalesce(parts)


class IterativeTreeImputerModel:
    """Means, cuts and the trees of every round."""

    def __init__(self, cols, targets, means, cuts, rounds, history):
        self.cols, self.targets, self.means = list(cols), list(targets), dict(means)
        self.cuts, self.rounds, self.history = cuts, rounds, history
        self.rounds_run = len(rounds)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns as doubles and their gaps filled; other columns stay.  A column without any value
        when fitted keeps its gaps."""
        cols, cuts, rounds = self.cols, self.cuts, self.rounds
        means = np.array([np.nan if self.means[c] is None else self.means[c] for c in cols])
        targets = np.array([cols.index(c) for c in self.targets], np.int64)
        typed = df.withColumns({c: F.col(c).cast("double") for c in cols})
        place = [typed.columns.index(c) for c in cols]
        if any(r.table is not None for r in rounds):
            return self._dealt(typed, place, means, targets)

        def run(batches):
            for b in batches:
                x, gap = _filled(_columns(b, place), means)
                bins = np.stack([binned(x[:, i], c) for i, c in enumerate(cuts)], axis=1)
                for r in rounds:
                    _play(x, gap, bins, r, targets, cuts)
                out = list(b.columns)
                for i, p in enumerate(place):
                    out[p] = pa.array(x[:, i], mask=np.isnan(x[:, i]))
                yield pa.RecordBatch.from_arrays(out, names=b.schema.names)
        ship(df.sparkSession)
        return typed.mapInArrow(run, self._schema(typed))

    def _schema(self, typed: DataFrame) -> StructType:
        return StructType([StructField(f.name, DoubleType() if f.name in self.cols else f.dataType, True) for f in typed.schema])

    def _dealt(self, typed: DataFrame, place: list, means: np.ndarray, targets: np.ndarray) -> DataFrame:
        """``transform`` with trees that are tables: round after round, the gaps of each block are dealt to the subtrees that they
        reach; the rows themselves wait as they are and meet the values at the end."""
        cuts = self.cuts
        ship(typed.sparkSession)

        def pack(batches):
            for b in batches:
                if b.num_rows:
                    block = _block(*_filled(_columns(b, place), means), cuts)
                    rows = pa.Table.from_batches([b]).combine_chunks().to_batches()[0]
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rows.schema) as w:
                        w.write_batch(rows)
                    yield block.append_column("rows", pa.array([sink.getvalue().to_pybytes()], pa.binary()))

        def unpack(batches):
            for r in _rows(batches):
                b = pa.ipc.open_stream(r["rows"]).read_all().combine_chunks().to_batches()[0]
                x, out = np.frombuffer(r["x"], np.float64).reshape(r["n"], -1), list(b.columns)
                for i, p in enumerate(place):
                    out[p] = pa.array(x[:, i], mask=np.isnan(x[:, i]))
                yield pa.RecordBatch.from_arrays(out, names=b.schema.names)

        blocks = _numbered(typed.mapInArrow(pack, _STATE + ", rows binary"))
        parts = max(typed.sparkSession.sparkContext.defaultParallelism, blocks.count() // 8)
        state, held = blocks.drop("rows").coalesce(parts), []
        for i, r in enumerate(self.rounds):
            values = typed.sparkSession.createDataFrame([], _VALUES)
            if r.table is not None:
                pairs = state.mapInArrow(_pairs_of(r.top(), targets, means, np.ones(len(means)), True), _PAIRS)
                values = pairs.groupBy("part").cogroup(r.table.groupBy("part")).applyInArrow(_valued_part(r.top()), _VALUES)
            state = _replaced(state, r, values, targets, cuts, parts)
            if (i + 1) % CHECKPOINT_EVERY == 0 or i + 1 == len(self.rounds):
                state = cut_lineage(state)
                for s in held:
                    s.unpersist()
                held = []
            else:
                held.append(state.persist())
                state = held[-1]
        return blocks.select("block", "rows").join(state.select("block", "n", "x"), "block").select("n", "x", "rows").mapInArrow(unpack, self._schema(typed))


class IterativeTreeImputer:
    """``feature_subset``: how many features a node looks at (sqrt, log2, all); ``max_depth`` None: until nothing is gained
    (at most 30 levels)."""

    def __init__(self, cols: Sequence[str], max_depth: int | None = 3, feature_subset: str = "sqrt", max_rounds: int = 10, tol: float = 1e-3, seed: int = 111):
        self.cols, self.max_depth, self.feature_subset = list(cols), 30 if max_depth is None else max_depth, feature_subset
        self.max_rounds, self.tol, self.seed = max_rounds, tol, seed

    def fit(self, df: DataFrame) -> IterativeTreeImputerModel:
        cols = self.cols
        ship(df.sparkSession)
        df = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols])
        one = df.agg(*[F.struct(F.avg(c).alias("mean"), F.count_if(F.col(c).isNull()).alias("gaps"), F.min(c).alias("least"), F.max(c).alias("most")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        means = {c: one[i].mean for i, c in enumerate(cols)}
        targets = [c for i, c in enumerate(cols) if one[i].gaps and one[i].mean is not None]
        scale = max([0.0, *[max(abs(s.least), abs(s.most)) for s in one if s.mean is not None]])
        mean = np.array([np.nan if s.mean is None else s.mean for s in one])
        spread = np.array([1.0 if s.mean is None else max(s.most - s.mean, s.mean - s.least, 1e-300) for s in one])
        cuts = fit_cuts(df.fillna({c: m for c, m in means.items() if m is not None}), cols)
        t = np.array([cols.index(c) for c in targets], np.int64)
        cores = df.sparkSession.sparkContext.defaultParallelism
        held = right_size(df, 8 * len(cols), floor=cores)   # every level starts a task for each partition
        parts = max(cores, held.rdd.getNumPartitions())
        dealt = held.repartition(cores) if self.max_depth > SHALLOW and held.rdd.getNumPartitions() < cores else held
        state = dealt.mapInArrow(_packed(cuts, mean), _STATE)
        state = _numbered(state) if self.max_depth > SHALLOW else state.persist()
        observed = state.agg(F.sum("n")).first()[0] or 0
        held.unpersist()
        known = np.array([observed - one[int(i)].gaps for i in t], np.int64)
        rounds, history = [], []
        for r in range(self.max_rounds if targets else 0):
            got, values = self._trees(state, t, mean, spread, r, known)
            rounds.append(got)
            old, state = state, state.mapInArrow(_played(got, t, cuts), _STATE) if self.max_depth <= SHALLOW else _replaced(state, got, values, t, cuts, parts)
            state = cut_lineage(state) if (r + 1) % CHECKPOINT_EVERY == 0 else state.persist()
            change = state.agg(F.max("change")).first()[0] or 0.0
            old.unpersist()
            history.append((r, float(change)))
            if change < self.tol * scale:
                break
        state.unpersist()
        return IterativeTreeImputerModel(cols, targets, means, cuts, rounds, history)

    def _trees(self, state: DataFrame, t: np.ndarray, mean: np.ndarray, spread: np.ndarray, number: int, known: np.ndarray) -> tuple[Round, DataFrame | None]:
        """One tree for each target (of ``known`` observed rows), grown level by level together; deep trees: down to nodes of at most ``LOCAL``
        rows, whose subtrees grow in tasks.  With the values of the gaps below these."""
        n_features, seed = len(self.cols) - 1, self.seed * 1000 + number
        looked = {"sqrt": math.isqrt(n_features), "log2": int(math.log2(max(1, n_features))), "all": n_features}[self.feature_subset]
        looked = max(1, min(looked, n_features))
        trees = len(t)
        f = Round(np.full(trees, -1), np.zeros(trees, np.int64), np.full(trees, -1), mean[t].copy())
        values = None if self.max_depth <= SHALLOW else state.sparkSession.createDataFrame([], _VALUES)
        if not n_features or not self.max_depth:
            return f, values
        g = _Growth(f, np.arange(trees), np.arange(trees), np.zeros(trees, np.int64), t, mean, spread, looked, self.max_depth, seed)
        small = [[], [], [], [], []]   # numbers, trees, path numbers, depths, rows

        def set_aside(rows: np.ndarray) -> None:
            mine = (rows <= LOCAL) & (g.tries == 0) & (self.max_depth > SHALLOW)
            for x, v in zip(small, (g.nodes, g.tree, g.path, g.depth, rows)):
                x.append(v[mine])
            g.keep(~mine)
        set_aside(known)
        while len(g.nodes):
            seen = g.seen()
            cells = min(len(g.nodes) * looked * WIDTH, int(known.sum()) * looked)
            parts = int(min(len(g.nodes), max(1, -(-cells // CELLS))))
            got = state.mapInArrow(_dealt(f, g.nodes, seen, t, mean, spread, parts), "part int, cell binary, n binary, s binary").groupBy("part").applyInArrow(_judged(looked, WIDTH), _BEST).toArrow()
            best = {c: got.column(c).to_numpy() for c in _BEST_NAMES}
            by = np.argsort(best["slot"])
            set_aside(g.split(seen, {c: v[by] for c, v in best.items()}))
        small = [np.concatenate(x) for x in small]
        if len(small[0]):
            f.small, f.small_tree, path, depth, rows = (x[np.argsort(small[0])] for x in small)
            f.starts = np.unique((np.cumsum(rows) - rows).astype(np.int64) // PAIRS, return_index=True)[1]
            pairs = state.mapInArrow(_pairs_of(f.top(), t, mean, spread, False), _PAIRS)
            grown = cut_lineage(pairs.repartition(len(f.starts), "part").groupBy("part").applyInArrow(_grown_part(f.top(), path, depth, t, mean, spread, looked, self.max_depth, seed), _GROWN))
            f.table = grown.where(F.col("root").isNotNull()).select("part", "root", *_NODES)
            values = grown.where(F.col("root").isNull()).select("block", *_VALUE)
        return f, values
