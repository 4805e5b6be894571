"""Learners over packed blocks: equal to plain versions on the same rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlab.functions.columns import hash_u32
from loanlab.operators import ensembles, sgd, som


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=3000).round(2), rng.integers(0, 4, 3000)
    y = (a + 0.3 * b + rng.normal(scale=0.6, size=3000) > 1.2).astype(int)
    return spark.createDataFrame([(i, float(u), float(v), int(t)) for i, (u, v, t) in enumerate(zip(a, b, y))], "k long, a double, b double, y int").repartition(5)


def test_bags_of_easy_ensemble_equal_plain_boosting(spark, rows, monkeypatch):
    """Rows stay where they are: the bags come from the cuts, and every round is one array of the executors."""
    sent = []
    plain = ensembles._added
    monkeypatch.setattr(ensembles, "_added", lambda blocks, fn: sent.append(plain(blocks, fn)) or sent[-1])
    got = ensembles.EasyEnsemble(2, 5, key="k", label="y", checkpoint_every=2)
    model = got.fit(rows, ["a", "b"])
    binned = model.stages[0].transform(rows).orderBy("k").toPandas()
    bins, y = binned[["a__b", "b__b"]].to_numpy().astype(int), binned["y"].to_numpy()
    n_bins = sent[1].shape[-1]
    for bag in range(2):
        h = np.array([r.h for r in rows.select("k", hash_u32("k", 111, "bbag", F.lit(bag)).alias("h")).orderBy("k").collect()])
        mine = np.zeros(len(y), bool)
        for c in (0, 1):
            mine[sorted(np.nonzero(y == c)[0], key=lambda i: (h[i], i))[:min(y.sum(), (1 - y).sum())]] = True
        assert sent[0][bag] == mine.sum()
        w = mine / mine.sum()
        for t in range(5):
            hist = np.array([[np.bincount(bins[y == c, f], w[y == c], n_bins) for c in (0, 1)] for f in range(2)])
            assert np.allclose(sent[t + 1][bag], hist)
            _, f, s, lc, rc = ensembles._best_stump(hist)
            assert got.stumps_[bag][t][:4] == (f, s, lc, rc)
            miss = np.where(bins[:, f] <= s, lc, rc) != y
            err = w[miss].sum() / w.sum()
            w = w * np.where(miss, (1 - err) / err, 1.0)
            w /= w.sum()


def test_best_nodes_equal_direct_differences():
    rng = np.random.default_rng(1)
    cb = rng.normal(size=(40, 7)).round(1)
    cb[11], cb[30] = cb[3], cb[3]                      # ties go to the lowest node
    x = np.concatenate([rng.normal(size=(500, 7)).round(1), cb, (cb[:20] + cb[20:]) / 2, cb * 1e6, [[np.nan] * 7]])
    d2 = ((x[:, None, :] - cb[None]) ** 2).sum(-1)
    node, dist = som._bmu(x, cb)
    assert np.array_equal(node, d2.argmin(axis=1)) and np.array_equal(dist, d2[np.arange(len(x)), node], equal_nan=True)
    made = np.zeros(1)

    class Counted(np.ndarray):
        def __sub__(self, other):
            made[0] += max(self.size, np.size(other))
            return np.ndarray.__sub__(self, other)
    som._bmu(x[:500].view(Counted), cb)
    assert made[0] < 500 * 7 * 10                      # differences for the nodes in question, not for all


def test_steps_of_sgd_read_blocks_of_their_slice(rows, monkeypatch):
    cols = ["a", "b"]
    models = []
    for size in (sgd.BLOCK_BYTES, 2000):
        monkeypatch.setattr(sgd, "BLOCK_BYTES", size)
        m = sgd.LinearSGD(max_iter=30, tol=0.0, n_iter_no_change=30)
        m.fit(rows, cols, "y", "k")
        models.append(np.append(m.coef_, m.intercept_))
    assert np.allclose(*models, rtol=1e-6)
    x = np.random.default_rng(2).normal(size=(50, 2))
    y, val, w = np.where(x[:, 0] > 0, 1.0, -1.0), np.arange(50) % 5 == 0, np.array([0.3, -0.2])
    block = {"piece": 1, "x": x, "y": y, "val": val}
    g = sgd._step(block, w, 0.1, "hinge", 1)
    z = y * (x @ w + 0.1)
    coef = np.where((z < 1) & ~val, -y, 0.0)
    assert np.allclose(g[:3], [*(x.T @ coef), coef.sum()]) and g[3] == 40
    other = sgd._step(block, w, 0.1, "hinge", 0)
    assert not other[:4].any() and np.allclose(other[-4:], g[-4:]) and np.allclose(g[-2], np.maximum(0, 1 - z)[val].sum())
