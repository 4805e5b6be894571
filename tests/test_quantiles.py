"""Exact distributed quantiles equal the linear-interpolation definition."""
import numpy as np
import pytest

from loanlab.operators import profile, radix


def _np_q(x, q):
    return float(np.quantile(np.asarray(x, dtype=float), q))   # linear interpolation


@pytest.mark.parametrize("n", [1, 2, 5, 37, 5000])
def test_exact_against_numpy(spark, n):
    vals = [((i * 7919) % 1000) / 10.0 for i in range(n)]          # many ties
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(vals)], "x double, g int")
    got = profile.quantile_values(df, ["x"], [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0])
    for q in [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]:
        assert got[("x", q)] == pytest.approx(_np_q(vals, q), abs=1e-9)


def test_all_distinct_values(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=20000) * 10.0 ** rng.integers(-300, 300, 20000), [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(6)
    got = profile.quantile_values(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0])
    s = np.sort(vals)
    for q in [0.0, 0.25, 0.5, 0.75, 1.0]:
        at = q * (len(s) - 1)
        lo, hi = s[int(at)], s[min(int(at) + 1, len(s) - 1)]
        assert got[("x", q)] == (lo if lo == hi or at == int(at) else lo + (at - int(at)) * (hi - lo))


def test_images_keep_the_order():
    x = np.array([-np.inf, -1e308, -2.0, -5e-324, 0.0, 5e-324, 1.0, 1e308, np.inf, np.nan])
    img = radix.image(x).view(np.uint64)
    assert (img[1:] > img[:-1]).all() and radix.image(np.array([-0.0]))[0] == radix.image(np.array([0.0]))[0]
    assert np.array_equal(radix.number(radix.image(x)), x, equal_nan=True)


def test_many_groups(spark, monkeypatch):
    """More groups than targets that fit in an expression: cells are joined, by broadcast and by shuffle."""
    rows = [(float((i * 7919) % 1009), None if i % 5 == 0 else float(i % 13), None if i % 401 == 400 else i % 401) for i in range(6000)]
    df = spark.createDataFrame(rows, "x double, z double, g int")
    want = {}
    for g in [None, *range(400)]:
        for c, name in enumerate(["x", "z"]):
            v = [r[c] for r in rows if r[2] == g and r[c] is not None]
            for q in (0.1, 0.5):
                want[(g, name, q)] = _np_q(v, q)
    for limit in (1 << 26, 0):
        monkeypatch.setattr(radix, "BROADCAST_BYTES", limit)
        got = {(r.g, r.feature, r.prob): r.value for r in profile.quantile_table(df, ["x", "z"], [0.1, 0.5], by="g").collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_sequential_iqrs(spark):
    from loanlab.operators import clean
    rng = np.random.default_rng(2)
    a, b = rng.exponential(size=500) ** 3, rng.normal(size=500)
    df = spark.createDataFrame([(float(x), float(y) if i % 9 else None) for i, (x, y) in enumerate(zip(a, b))], "a double, b double")
    got = clean.remove_outliers(df, ["a", "b"], k=1.0).collect()
    rows = [(x, y if i % 9 else None) for i, (x, y) in enumerate(zip(a, b))]
    for c in (0, 1):
        v = [r[c] for r in rows if r[c] is not None]
        cut = _np_q(v, 0.75) - _np_q(v, 0.25)
        rows = [r for r in rows if r[c] is None or not r[c] > cut]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(float(x), None if y is None else float(y)) for x, y in rows]))


def test_grouped_and_gaps(spark):
    rows = [(float(i), i % 3) for i in range(100)] + [(None, 0), (None, 1)]
    df = spark.createDataFrame(rows, "x double, g int")
    got = {(r.g, r.prob): r.value for r in profile.quantile_table(df, ["x"], [0.5], by="g").collect()}
    for g in range(3):
        xs = [float(i) for i in range(100) if i % 3 == g]
        assert got[(g, 0.5)] == pytest.approx(_np_q(xs, 0.5))


def test_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert profile.quantile_values(df, ["x"], [0.5])[("x", 0.5)] is None


def test_describe_matches_pandas(spark):
    import pandas as pd
    vals = [((i * 31) % 101) - 20.5 for i in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = profile.describe(df, ["x"]).collect()[0]
    d = pd.Series(vals).describe()
    for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                         ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
        assert r[ours] == pytest.approx(d[theirs], abs=1e-9)


def test_boxes_of_many_classes(spark):
    rows = [(i % 300, float((i * 37) % 101)) for i in range(9000)]
    got = profile.boxplot_by_class(spark.createDataFrame(rows, "g int, x double"), ["x"], "g").collect()
    assert len(got) == 300
    for r in got[:20]:
        v = np.array([x for g, x in rows if g == r.g])
        q1, q3 = np.quantile(v, 0.25), np.quantile(v, 0.75)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert (r.q1, r.q3, r.whisker_lo, r.whisker_hi, r.n_outliers) == (q1, q3, v[v >= lo].min(), v[v <= hi].max(), ((v < lo) | (v > hi)).sum())
