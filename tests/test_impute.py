"""Chained imputation: equal to a plain version, whatever the partitioning; odd columns."""
import numpy as np
import pytest

from loanlab.operators import impute
from loanlab.operators.histtree import binned

COLS = ["a", "b", "c", "d"]


def sample(n=300, seed=0):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n).round(1)
    x = np.column_stack([a, (2 * a + rng.normal(scale=0.1, size=n)).round(1), rng.integers(0, 6, n).astype(float), a * 0])
    x[:, 3] = x[:, 2] * 3 + 1
    x[rng.random(n) < 0.2, 1] = np.nan
    x[rng.random(n) < 0.1, 3] = np.nan
    return x


def frame(spark, x):
    return spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r], "t") for i, r in enumerate(x)], "k long, a double, b double, c double, d double, other string")


def plain_tree(bins, y, depth):
    """Predictions for all rows of the tree over the rows with a target, all features looked at."""
    out = np.zeros(len(y))

    def split(rows, depth):
        used = rows[~np.isnan(y[rows])]
        out[rows] = y[used].mean()
        best = None
        for f in range(bins.shape[1]):
            for b in np.unique(bins[used, f])[:-1]:
                lo = used[bins[used, f] <= b]
                hi = used[bins[used, f] > b]
                gain = y[lo].sum() ** 2 / len(lo) + y[hi].sum() ** 2 / len(hi) - y[used].sum() ** 2 / len(used)
                if best is None or gain > best[0] + 1e-6:
                    best = (gain, f, b)
        if depth and best and best[0] > 1e-6:
            split(rows[bins[rows, best[1]] <= best[2]], depth - 1)
            split(rows[bins[rows, best[1]] > best[2]], depth - 1)
    split(np.arange(len(y)), depth)
    return out


def plain_impute(x, cuts, rounds, depth):
    gap = np.isnan(x)
    now = np.where(gap, np.nanmean(x, axis=0), x)
    for _ in range(rounds):
        bins = np.stack([binned(now[:, i], c) for i, c in enumerate(cuts)], axis=1)
        new = now.copy()
        for t in np.nonzero(gap.any(axis=0))[0]:
            others = [i for i in range(x.shape[1]) if i != t]
            p = plain_tree(bins[:, others], np.where(gap[:, t], np.nan, x[:, t]), depth)
            new[gap[:, t], t] = p[gap[:, t]]
        now = new
    return now


def test_equals_plain_version(spark):
    x = sample()
    model = impute.IterativeTreeImputer(COLS, max_depth=1, feature_subset="all", max_rounds=2, tol=0.0).fit(frame(spark, x))
    got = np.array([[r[c] for c in COLS] for r in model.transform(frame(spark, x)).orderBy("k").collect()])
    assert np.allclose(got, plain_impute(x, model.cuts, 2, 1), atol=1e-5)


@pytest.mark.parametrize("depth, subset", [(3, "sqrt"), (None, "log2")])
def test_partitioning_does_not_matter(spark, depth, subset, monkeypatch):
    x, out = sample(800, 1), []
    for parts, cells in ((1, 1 << 20), (5, 50)):
        monkeypatch.setattr(impute, "CELLS", cells)
        df = frame(spark, x).repartition(parts)
        model = impute.IterativeTreeImputer(COLS, max_depth=depth, feature_subset=subset, max_rounds=4).fit(df)
        rows = model.transform(df).orderBy("k").collect()
        out.append(rows)
        for r, v in zip(rows, x):
            assert all(np.isnan(o) and r[c] is not None or r[c] == o for c, o in zip(COLS, v)) and r.other == "t"
    values = [np.array([[r[c] for c in COLS] for r in rows]) for rows in out]
    assert np.allclose(*values, rtol=1e-9)   # the means are Spark's, sums in the order of rows
    d = np.array([r.d for r in out[0]])
    gone = np.isnan(x[:, 3])
    if depth is None:  # d is a function of c, but one random feature a node may reach a pure leaf without c
        assert np.mean(np.abs(d[gone] - (x[gone, 2] * 3 + 1)) < 1e-6) > 0.9 and len(model.history) <= 4


def test_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, None, 5), (None, None, 2.0, 5), (3.0, None, float("nan"), 5)], "a double, none double, z double, k int")
    model = impute.IterativeTreeImputer(["a", "none", "z"]).fit(df)
    rows = model.transform(df).collect()
    assert all(r.a is not None and r.none is None and r.z == 2.0 and r.k == 5 for r in rows)
    assert impute.IterativeTreeImputer(["a"]).fit(df).transform(df).count() == 3
    assert model.transform(df.limit(0)).count() == 0


@pytest.mark.parametrize("subset", ["sqrt", "all"])
def test_subtrees_grown_in_tasks(spark, subset, monkeypatch, tmp_path):
    """Deep trees whose small nodes grow in tasks are those that levels of jobs give; the driver holds the nodes above them; other columns and saved models stay."""
    from loanlab.operators import persist
    x = sample(700, 3)
    df, rows = frame(spark, x).repartition(3), []
    for local, pairs in ((0, 1), (1 << 15, 1 << 19), (60, 300)):
        monkeypatch.setattr(impute, "LOCAL", local)
        monkeypatch.setattr(impute, "PAIRS", pairs)
        model = impute.IterativeTreeImputer(COLS, max_depth=None, feature_subset=subset, max_rounds=3, tol=0.0).fit(df)
        assert all((r.table is None) == (local == 0) for r in model.rounds)
        assert local != 1 << 15 or all(len(r.feature) == 2 for r in model.rounds)
        assert local != 60 or all(len(r.starts) > 1 for r in model.rounds)
        rows.append((model.transform(df).orderBy("k").collect(), [h[1] for h in model.history]))
    assert rows[0][0] == rows[1][0] == rows[2][0] and rows[0][1] == rows[1][1] == rows[2][1]
    assert all(r.other == "t" and (np.isnan(v).any() or tuple(r)[1:5] == tuple(v)) for r, v in zip(rows[0][0], x)) and model.transform(df.limit(0)).count() == 0
    again = persist.load(spark, persist.save(model, str(tmp_path / "deep")))
    assert again.transform(df).orderBy("k").collect() == rows[0][0]
