"""Forests grown level by level: equal to a plain tree on the same draws, to themselves under any partitioning; out-of-bag counts."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from loanlab.operators import forest, sampling
from loanlab.operators.histtree import binned

COLS = ["a", "b", "c", "d"]


def sample(n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(1), rng.integers(0, 5, n), rng.random(n).round(2), rng.integers(0, 2, n)])
    return x, ((x[:, 0] + x[:, 1] * x[:, 3] + rng.normal(scale=0.7, size=n)) > 1.6).astype(int)


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "k long, a double, b double, c double, d double, y int")


def plain_leaves(bins, w, y, depth):
    """Class shares of the leaf of every row, by a recursive tree over all features."""
    out = np.full(len(y), np.nan)
    score = lambda m: (w[m & (y == 0)].sum() ** 2 + w[m & (y == 1)].sum() ** 2) / w[m].sum()

    def split(mask, depth):
        used = mask & (w > 0)
        one, all_ = w[used & (y == 1)].sum(), w[used].sum()
        out[mask] = one / all_
        if one in (0, all_) or not depth:
            return
        best = None
        for f in range(bins.shape[1]):
            for b in np.unique(bins[used, f])[:-1]:
                left, right = used & (bins[:, f] <= b), used & (bins[:, f] > b)
                gain = score(left) + score(right) - score(used)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, b)
        if best:
            _, f, b = best
            split(mask & (bins[:, f] <= b), depth - 1)
            split(mask & (bins[:, f] > b), depth - 1)
    split(np.ones(len(y), bool), depth)
    return out


@pytest.mark.parametrize("depth", [3, 30])
def test_trees_equal_plain_ones_in_quality(spark, depth):
    """All features looked at: leaves of the first split on, up to ties between features, which the plain tree breaks otherwise;
    so the weighted impurity of the leaves is compared, level by level of depth, not the leaves."""
    x, y = sample()
    df = frame(spark, x, y)
    f, _ = forest.grow_forest(df, COLS, 3, "all", max_depth=1 if depth == 3 else depth, key="k", label="y")
    bins = np.stack([binned(c, k) for c, k in zip(x.T, f.cuts)], axis=1)
    seeds = np.array([r.s for r in df.select(forest.stream_seed("k", 111).alias("s"), "k").orderBy("k").collect()])
    w = forest.weights(seeds, y, {0: 1.0, 1: 1.0}, 3)
    for t in range(3):
        leaf = forest._leaf_of(f, bins, np.arange(len(y)), np.full(len(y), t))
        got = f.w1[leaf] / (f.w0[leaf] + f.w1[leaf])
        used = w[:, t] > 0
        if depth == 30:  # pure, but for rows that no feature tells apart
            want = plain_leaves(bins, w[:, t].astype(float), y, 30)
            assert np.allclose(got[used], want[used])
        else:
            want = plain_leaves(bins, w[:, t].astype(float), y, 1)
            assert np.allclose(got, want)
        stats = np.stack([np.bincount(leaf, w[:, t] * (y == c), len(f.w0)) for c in (0, 1)])
        mine = np.unique(leaf)
        assert np.array_equal(stats[0][mine], f.w0[mine]) and np.array_equal(stats[1][mine], f.w1[mine])


@pytest.mark.parametrize("features", ["sqrt", "log2"])
def test_partitioning_does_not_matter(spark, features, monkeypatch):
    x, y = sample(900, 1)
    grown = []
    for parts, cells in ((1, 1 << 20), (6, 64)):
        monkeypatch.setattr(forest, "CELLS", cells)
        monkeypatch.setattr(forest, "ROWS_AT_ONCE", 1 << 13 if parts == 1 else 50)
        f, counts = forest.grow_forest(frame(spark, x, y).repartition(parts), COLS, 7, features, balanced=True, key="k", label="y", oob=True)
        grown.append((f.feature.tolist(), f.bin.tolist(), f.left.tolist(), f.w0.tolist(), f.w1.tolist(), counts))
    assert grown[0] == grown[1]


def test_spark_form_and_votes(spark):
    x, y = sample(700, 2)
    df = frame(spark, x, y)
    f, counts = forest.grow_forest(df, COLS, 9, "sqrt", key="k", label="y", oob=True)
    model = PipelineModel([VectorAssembler(inputCols=COLS, outputCol="features"), f.model(spark, 4)])
    got = [r.p for r in model.transform(df).select("k", vector_to_array("probability")[1].alias("p")).orderBy("k").collect()]
    bins = np.stack([binned(c, k) for c, k in zip(x.T, f.cuts)], axis=1)
    row, tree = np.divmod(np.arange(len(y) * 9), 9)
    leaf = forest._leaf_of(f, bins, row, tree)
    p = (f.w1[leaf] / (f.w0[leaf] + f.w1[leaf])).reshape(-1, 9)
    assert np.allclose(got, p.mean(axis=1))
    seeds = np.array([r.s for r in df.select(forest.stream_seed("k", 111).alias("s"), "k").orderBy("k").collect()])
    w = forest.weights(seeds, y, {0: 1.0, 1: 1.0}, 9)
    some = (w == 0).any(axis=1)
    mean = np.nan_to_num((p * (w == 0)).sum(axis=1) / np.maximum((w == 0).sum(axis=1), 1))
    assert counts == {"oob_rows": some.sum(), "oob_votes": (w == 0).sum(), "oob_right": ((mean > 0.5) == y)[some].sum(), "in_bag_0": w[y == 0].sum(), "in_bag_1": w[y == 1].sum()}
    assert 0.7 < counts["oob_right"] / counts["oob_rows"] < 1


def test_draws_are_poisson_and_balanced():
    rng = np.random.default_rng(3)
    seeds, y = rng.integers(1, forest.PRIME, 20_000), (rng.random(20_000) < 0.1).astype(int)
    n1 = int(y.sum())
    w = forest.weights(seeds, y, {0: n1 / (20_000 - n1), 1: 1.0}, 40)
    assert abs(w[y == 0].sum() / 40 / n1 - 1) < 0.03 and abs(w[y == 1].sum() / 40 / n1 - 1) < 0.03
    share = np.mean(w[y == 1] == 0)
    assert abs(share - sampling.poisson_cdf(1.0)[0]) < 0.01
    flat = w[y == 1].astype(float)
    assert np.abs(np.corrcoef(flat, rowvar=False) - np.eye(40)).max() < 0.12  # trees draw apart


def test_one_class_and_gaps(spark):
    df = spark.createDataFrame([(i, float(i % 3), None if i % 2 else 1.0, 1) for i in range(40)] + [(99, 1.0, 1.0, None)], "k long, a double, b double, y int")
    f, counts = forest.grow_forest(df, ["a", "b"], 3, key="k", label="y", oob=True)
    assert len(f.feature) == 3 and counts["in_bag_0"] == 0


@pytest.mark.parametrize("local, pairs", [(1 << 15, 1 << 19), (60, 500), (0, 1)])
def test_subtrees_grown_in_tasks_and_scored_by_joins(spark, local, pairs, monkeypatch):
    """Small nodes grown in tasks are those that levels of jobs give; the driver holds the nodes above them; scores are those of Spark ML's form."""
    x, y = sample(600, 4)
    df = frame(spark, x, y)
    want, counts = forest.grow_forest(df, COLS, 5, "sqrt", key="k", label="y", oob=True)
    monkeypatch.setattr(forest, "LOCAL", local)
    monkeypatch.setattr(forest, "PAIRS", pairs)
    f, got = forest.grow_forest(df, COLS, 5, "sqrt", key="k", label="y", oob=True)
    assert got == counts and (f.table is None) == (local == 0)
    if local:
        assert len(f.top.feature) < len(f.feature) and (local > 60 or len(f.starts) > 1)
    leaves = lambda g: forest._leaf_of(g, np.stack([binned(c, k) for c, k in zip(x.T, g.cuts)], axis=1), *np.divmod(np.arange(len(y) * 5), 5))
    assert len(f.feature) == len(want.feature) and all(np.array_equal(getattr(f, c)[leaves(f)], getattr(want, c)[leaves(want)]) for c in ("w0", "w1"))
    odd = df.union(df.limit(3)).union(spark.createDataFrame([(None, None, 1.0, float("nan"), 0.0, None)], df.schema))   # rows that come twice, gaps
    scored = forest.ForestModel(f, COLS, 3).transform(odd).select("k", "p1", "prediction")
    spark_form = PipelineModel([VectorAssembler(inputCols=COLS, outputCol="features"), want.model(spark, 4, 3)]).transform(df)
    p = {r.k: (r.p, r.prediction) for r in spark_form.select("k", vector_to_array("probability")[1].alias("p"), "prediction").collect()}
    rows = scored.collect()
    assert len(rows) == 604 and sum(r.k is None for r in rows) == 1
    assert all(np.isclose(r.p1, p[r.k][0]) and r.prediction == p[r.k][1] for r in rows if r.k is not None)


def test_class_weights_and_pipelines(spark, monkeypatch):
    """Weights of classes as copies of their rows would count; a pipeline's forest is not gathered on the driver."""
    from loanlab.operators import models
    x, y = sample(500, 5)
    df = frame(spark, x, y)
    monkeypatch.setattr(forest, "LOCAL", 100)
    f, _ = forest.grow_forest(df, COLS, 2, "all", max_depth=3, key="k", label="y", class_weights={0: 2.0, 1: 1.0})
    bins = np.stack([binned(c, k) for c, k in zip(x.T, f.cuts)], axis=1)
    seeds = np.array([r.s for r in df.select(forest.stream_seed("k", 111).alias("s"), "k").orderBy("k").collect()])
    w = forest.weights(seeds, y, {0: 1.0, 1: 1.0}, 2)
    for t in range(2):
        leaf = forest._leaf_of(f, bins, np.arange(len(y)), np.full(len(y), t))
        want = plain_leaves(bins, w[:, t] * np.where(y == 0, 2.0, 1.0), y, 3)
        used = w[:, t] > 0
        assert np.allclose((f.w1[leaf] / (f.w0[leaf] + f.w1[leaf]))[used], want[used])
    monkeypatch.setattr(forest.GrownForest, "whole", lambda self: 1 / 0)
    m = models.pipeline_of(COLS, "random_forest", sampler=None, label="y", key="k", weights={0: 1.2, 1: 1.0}, trees=7, grown=True)().fit(df)
    got = models.predict(m, df).select("k", "prediction", "score").collect()
    assert m.stages[-1].getNumTrees == 7 and len(got) == 500
    assert np.mean([r.prediction == y[r.k] for r in got]) > 0.85


def test_tree_of_a_pipeline_is_grown(spark, monkeypatch):
    """A pipeline's tree has every row once and looks at all features; neither Spark ML's fit nor the driver holds it whole."""
    from pyspark.ml.classification import DecisionTreeClassifier

    from loanlab.operators import models
    x, y = sample(500, 6)
    df = frame(spark, x, y)
    monkeypatch.setattr(forest, "LOCAL", 100)
    f, _ = forest.grow_forest(df, COLS, 1, "all", max_bins=32, bootstrap=False, key="k", label="y")
    bins = np.stack([binned(c, k) for c, k in zip(x.T, f.cuts)], axis=1)
    assert (f.w0[0], f.w1[0]) == ((y == 0).sum(), (y == 1).sum())
    stump, _ = forest.grow_forest(df, COLS, 1, "all", max_depth=1, max_bins=32, bootstrap=False, key="k", label="y")
    leaf = forest._leaf_of(stump, bins, np.arange(500), np.zeros(500, int))
    assert np.allclose(stump.w1[leaf] / (stump.w0[leaf] + stump.w1[leaf]), plain_leaves(bins, np.ones(500), y, 1))
    leaf = forest._leaf_of(f, bins, np.arange(500), np.zeros(500, int))
    want = f.w1[leaf] / (f.w0[leaf] + f.w1[leaf])
    monkeypatch.setattr(forest.GrownForest, "whole", lambda self: 1 / 0)
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda *a: 1 / 0)
    m = models.pipeline_of(COLS, "tree", sampler=None, label="y", key="k", grown=True)().fit(df)
    got = models.predict(m, df).select("k", "prediction", "score").orderBy("k").collect()
    assert np.allclose([r.score for r in got], want) and [r.prediction for r in got] == (want > 0.5).tolist()


def test_cells_by_arrays_and_by_sorting_are_plain_sums(monkeypatch):
    rng = np.random.default_rng(5)
    n, trees, width = 300, 4, 9
    block = {"node": rng.integers(0, 12, (n, trees)).astype(np.int32), "w": rng.integers(0, 4, (n, trees)).astype(np.uint8), "bins": rng.integers(0, width, (n, 5)).astype(np.uint8), "label": rng.integers(0, 2, n).astype(float)}
    nodes = np.array([1, 4, 7, 11])
    looks = np.array([[0, 3], [2, -1], [4, 1], [1, 0]])
    plain = {}
    for r in range(n):
        for t in range(trees):
            at = np.nonzero(nodes == block["node"][r, t])[0]
            w = int(block["w"][r, t])
            if len(at) and w:
                for j, f in enumerate(looks[at[0]]):
                    if f >= 0:
                        c = plain.setdefault(int((at[0] * 2 + j) * width + block["bins"][r, f]), [0, 0])
                        c[0] += w
                        c[1] += w * int(block["label"][r])
    want = [(c, *plain[c]) for c in sorted(plain)]
    for dense, at_once in ((1 << 16, 1 << 22), (1 << 16, 64), (-(1 << 40), 1 << 22), (-(1 << 40), 64)):
        monkeypatch.setattr(forest, "DENSE", dense)
        monkeypatch.setattr(forest, "LOOKS_AT_ONCE", at_once)
        got = forest._cells(block, forest.Level(nodes, looks), width)
        assert list(zip(*[v.tolist() for v in got])) == want


def test_tasks_send_the_cells_of_their_blocks_once():
    """A task with several blocks sends each cell once, not once a block."""
    import pyarrow as pa
    rng = np.random.default_rng(6)
    kinds = {"bins": np.uint8, "label": "<f8", "key": "<i8", "fold": "<i1", "w": np.uint8, "node": np.int32}

    def block():
        cols = {"bins": rng.integers(0, 3, (50, 2)), "label": rng.integers(0, 2, 50), "key": np.zeros(50), "fold": np.zeros(50), "w": np.ones((50, 1)), "node": np.zeros((50, 1))}
        return {"n": 50, **{c: v.astype(kinds[c]).tobytes() for c, v in cols.items()}}
    batch = pa.RecordBatch.from_pylist([block() for _ in range(20)])
    level = forest.Level(np.array([0]), np.array([[0, 1]]))
    out = list(forest._dealt(level, 1, 4, 1)([batch]))
    assert sum(len(x) for b in out for x in b.column("cell").to_pylist()) == 6 * 8
    assert sum(np.frombuffer(x, np.int64).sum() for b in out for x in b.column("n").to_pylist()) == 2 * 20 * 50


def test_importances_and_node_rows_are_those_of_spark(spark, monkeypatch):
    """Of upper nodes and subtrees alike, without the whole forest on the driver."""
    from loanlab.operators import explain
    x, y = sample(500, 8)
    monkeypatch.setattr(forest, "LOCAL", 60)
    monkeypatch.setattr(forest, "PAIRS", 150)
    f, _ = forest.grow_forest(frame(spark, x, y), COLS, n_trees=6, key="k", label="y")
    m = forest.ForestModel(f, COLS)
    assert len(f.starts) > 2 and (f.top.left >= 0).any()
    with monkeypatch.context() as p:
        p.setattr(forest.GrownForest, "whole", lambda self: pytest.fail("whole forest on the driver"))
        got = m.featureImportances.toArray()
        nodes = {(r.tree, r.id): r for r in explain.node_table(spark, m).collect()}
        top = explain.tree_nodes(spark, m, COLS, tree=2, max_depth=3).collect()
    spark_model = m.spark_model()
    assert np.allclose(got, spark_model.featureImportances.toArray(), atol=1e-9)
    want = {(r.tree, r.id): r for r in explain.node_table(spark, spark_model.setFeaturesCol("features")).collect()}
    assert nodes.keys() == want.keys()
    for at, r in want.items():
        mine = nodes[at]
        assert (mine.left, mine.right, mine.feature_index, mine["count"], mine.prediction, mine.threshold) == (r.left, r.right, r.feature_index, r["count"], r.prediction, r.threshold)
        assert abs(mine.impurity - r.impurity) < 1e-9 and abs(mine.gain - r.gain) < 1e-9
    assert [tuple(r)[:4] for r in top] == [tuple(r)[:4] for r in explain.tree_nodes(spark, spark_model, COLS, tree=2, max_depth=3).collect()]


def test_explained_forests_are_grown(monkeypatch):
    from loanlab.operators import models, selection
    from loanlab.plans import q_ml
    made = []
    monkeypatch.setattr(q_ml, "model_table", lambda *a: (None, COLS))
    monkeypatch.setattr(q_ml, "split_parts", lambda *a: (None, None))
    monkeypatch.setattr(models.ResampledPipeline, "fit", lambda self, df: made.append(self.grown))
    q_ml._forest(None, None)
    monkeypatch.setattr(selection, "compare_feature_sets", lambda train, test, sets, makers: made.append(makers["RF"](COLS).grown))
    q_ml.q_feature_set_comparison(None, None)
    assert made == [True, True]
