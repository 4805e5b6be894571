"""Leaf-wise boosted trees: equal to a plain version, to themselves under any partitioning, and to their Spark ML form."""
import heapq

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from loanlab.operators import histtree as H


def sample(n=500, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.random(n).round(2), rng.integers(0, 2, n)])
    y = ((x[:, 0] + 0.5 * x[:, 1] * x[:, 3] - x[:, 2] + rng.normal(scale=0.5, size=n)) > 0.8).astype(float)
    return x, y


def block(x, y, bins=31, part=None):
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins), method="lower"))[:-1] for c in x.T]
    return {"bins": np.stack([H.binned(c, k) for c, k in zip(x.T, cuts)], axis=1), "label": y, "key": np.arange(len(y)) * 7919, "part": np.zeros(len(y), np.int8) if part is None else part,
            "score": np.zeros(len(y))}, cuts


def plain_tree(bins, g, h, spec):
    """Best-first growth, one split at a time, every split looked at from the rows themselves."""
    score = lambda a, b: (np.sign(a) * max(abs(a) - spec.l1, 0)) ** 2 / (b + spec.l2) if b + spec.l2 > 0 else 0.0

    def best(rows, depth):
        out = None
        if spec.max_depth is not None and depth >= spec.max_depth:
            return None
        for f in range(bins.shape[1]):
            for b in range(int(bins[:, f].max()) + 1):
                low = rows[bins[rows, f] <= b]
                if min(len(low), len(rows) - len(low)) < spec.min_rows:
                    continue
                gl, hl, ga, ha = g[low].sum() / H.UNIT, h[low].sum() / H.UNIT, g[rows].sum() / H.UNIT, h[rows].sum() / H.UNIT
                if min(hl, ha - hl) < spec.min_hessian:
                    continue
                gain = score(gl, hl) + score(ga - gl, ha - hl) - score(ga, ha)
                if gain > 1e-12 and (out is None or gain > out[0]):
                    out = (gain, f, b)
        return out
    leaves, heap, at = {0: np.arange(len(bins))}, [], 0

    def offer(name, rows, depth):
        got = best(rows, depth)
        if got:
            heapq.heappush(heap, (-got[0], name, depth, got))
    offer(0, leaves[0], 0)
    while heap and len(leaves) < spec.max_leaves:
        _, name, depth, (_, f, b) = heapq.heappop(heap)
        rows = leaves.pop(name)
        for part in (rows[bins[rows, f] <= b], rows[bins[rows, f] > b]):
            at += 1
            leaves[at] = part
            offer(at, part, depth + 1)
    out = np.zeros(len(bins))
    for rows in leaves.values():
        a, b = g[rows].sum() / H.UNIT, h[rows].sum() / H.UNIT
        out[rows] = -np.sign(a) * max(abs(a) - spec.l1, 0) / (b + spec.l2)
    return out, len(leaves)


@pytest.mark.parametrize("spec", [H.Boost(max_leaves=31), H.Boost(max_leaves=7, l1=1.0, l2=2.0), H.Boost(max_leaves=64, min_rows=1, min_hessian=0.0, max_depth=4), H.Boost(max_leaves=12, min_rows=3, l2=0.5)])
def test_trees_equal_plain_growth(spec):
    x, y = sample()
    b, _ = block(x, y)
    rows = H.Local([{k: v[i::3] for k, v in b.items()} for i in range(3)])
    spec.rounds = 4
    fit = H.boost(rows, spec, 32)
    score = np.full(len(y), np.log(y.sum() / (len(y) - y.sum())))
    assert len(fit.trees) == 4
    for tree in fit.trees:
        p = 1 / (1 + np.exp(-score))
        want, leaves = plain_tree(b["bins"], np.rint((p - y) * H.UNIT), np.rint(p * (1 - p) * H.UNIT), spec)
        got = tree.value[tree.leaves(b["bins"])]
        assert (tree.feature < 0).sum() == leaves and np.allclose(got, want, rtol=1e-12)
        score = score + spec.rate * got


@pytest.mark.parametrize("mode", ["gbdt", "goss", "dart"])
def test_partitioning_does_not_matter(mode):
    x, y = sample(3000, 1)
    b, _ = block(x, y)
    got = []
    for n in (1, 5):
        fit = H.boost(H.Local([{k: v[i::n] for k, v in b.items()} for i in range(n)]), H.Boost(rounds=25, mode=mode, rate=0.2), 32, test_at=(25,))
        assert [x[0] for x in fit.tests] == [25]
        got.append(sum(w * t.value[t.leaves(b["bins"])] for t, w in zip(fit.trees, fit.weights)))
    assert np.array_equal(got[0], got[1]) and np.mean((got[0] + fit.start > 0) == y) > 0.85


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "k long, a double, b double, c double, d double, label int")


def test_fit_on_spark(spark, monkeypatch):
    x, y = sample(4000, 2)
    df = frame(spark, x, y)
    cols = ["a", "b", "c", "d"]
    margins = []
    for n in (1, 6):
        monkeypatch.setattr(H, "right_size", lambda d, size: d.repartition(n).persist())   # one task, or a job for each wave
        est = H.HistBoost(rounds=12, early_stopping=False)
        model = PipelineModel([VectorAssembler(inputCols=cols, outputCol="features"), est.fit(df.repartition(n), cols, "label", "k")])
        out = model.transform(df).select("k", "label", vector_to_array("probability")[1].alias("p")).orderBy("k").collect()
        margins.append([r.p for r in out])
        bins = np.stack([H.binned(c, k) for c, k in zip(x.T, est.cuts_)], axis=1)
        score = est.fit_.start + sum(w * t.value[t.leaves(bins)] for t, w in zip(est.fit_.trees, est.fit_.weights))
        assert np.allclose(1 / (1 + np.exp(-score)), margins[-1], atol=1e-9)
    assert margins[0] == margins[1]
    assert np.mean((np.array(margins[0]) > 0.5) == y) > 0.85


def test_early_stopping_and_one_class(spark):
    x, y = sample(4000, 3)
    noise = (np.random.default_rng(4).random(4000) > 0.5).astype(float)
    est = H.HistBoost(early_stopping=True, rounds=100)
    est.fit(frame(spark, x, noise), ["a", "b", "c", "d"], "label", "k")
    losses = est.fit_.losses
    assert len(est.fit_.trees) < 60 and losses[-1] > min(losses)
    flat = H.HistBoost()
    model = flat.fit(frame(spark, x, y * 0), ["a", "b", "c", "d"], "label", "k")
    assert not flat.fit_.trees and model.getNumTrees == 1


def test_gaps_go_right():
    cuts = np.array([1.0, 2.0])
    assert H.binned(np.array([0.5, 1.0, 1.5, 2.0, 9.0, np.nan]), cuts).tolist() == [0, 0, 1, 1, 2, 2]


def test_cuts(spark):
    df = spark.createDataFrame([(float(i % 7), None if i % 2 else float(i), float("nan"), 3.0) for i in range(3000)], "a double, b double, c double, d double")
    a, b, c, d = H.fit_cuts(df, ["a", "b", "c", "d"])
    assert a.tolist() == [0, 1, 2, 3, 4, 5] and 200 < len(b) < 256 and len(c) == 0 and len(d) == 0


def test_one_array_reaches_the_driver(spark, monkeypatch):
    """Sums of any number of partitions are added up on the executors, and bins that no feature uses do not travel."""
    monkeypatch.setattr(H, "FEW", 1)
    x, y = sample(2000, 5)
    b, cuts = block(x, y)
    sizes = [len(c) + 1 for c in cuts]
    parts = [{k: v[i::9] for k, v in b.items()} for i in range(9)]
    tree = H.boost(H.Local([dict(p) for p in parts]), H.Boost(rounds=1), 32).trees[0]
    leaves = np.nonzero(tree.feature < 0)[0].tolist()
    run, local = H.Distributed(spark.sparkContext.parallelize(parts, 9), sizes), H.Local(parts)
    try:
        for msg in ({"minus": [], "top": None, "round": 0, "tree": None, "slots": [0], "bins": 32}, {"minus": [], "top": None, "round": 1, "tree": tree, "slots": leaves, "bins": 32}):
            sent = run.summed(H._histograms, msg).collect()
            assert len(sent) == 1 and sent[0].shape == (3, len(msg["slots"]), sum(sizes)) and sum(sizes) < 4 * 32
            assert np.array_equal(run.total(H._histograms, msg), local.total(H._histograms, msg))
    finally:
        run.close()


def test_rows_by_lists_reach_their_leaves():
    x, y = sample(3000, 6)
    b, _ = block(x, y)
    tree = H.boost(H.Local([dict(b)]), H.Boost(rounds=1), 32).trees[0]
    assert np.array_equal(H._values(tree, b), tree.value[tree.leaves(b["bins"])])
