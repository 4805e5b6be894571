"""Registered fits have the recorded sizes; nothing is fitted here."""
import pytest

from loanlab.operators import ensembles, models, selection
from loanlab.plans import q_ml, q_som

FEATS = ["a", "b"]


class Stop(Exception):
    pass


@pytest.fixture
def made(spark, monkeypatch):
    """The estimators that a query makes, up to its first fit."""
    out, make = [], models.estimator
    monkeypatch.setattr(q_ml, "model_table", lambda *a: (None, FEATS))
    monkeypatch.setattr(q_ml, "split_parts", lambda *a: (None, None))
    monkeypatch.setattr(models, "estimator", lambda *a, **kw: out.append((a[0], make(*a, **kw))) or out[-1][1])

    def stop(self, *a, **kw):
        raise Stop
    monkeypatch.setattr(models.ResampledPipeline, "fit", stop)
    return out


def stopped(query):
    with pytest.raises(Stop):
        query(None, None)


def sizes(made):
    return [e.getNumTrees() if k == "random_forest" else e.spec["rounds"] for k, e in made if k in ("random_forest", "gbt")]


@pytest.mark.parametrize("query", [q_ml.forest_report, q_ml.q_tree_nodes])
def test_forests(made, query):
    stopped(query)
    assert sizes(made) == [100] and made[0][1].getMaxDepth() == models.MAX_TREE_DEPTH


def test_stacking(made, monkeypatch):
    def fit(bases, final, cv):
        for b in bases.values():
            b()
        raise Stop
    monkeypatch.setattr(ensembles, "Stacking", fit)
    stopped(q_ml.q_stacking)
    assert len(made) == 5 and sizes(made) == [100, 100]


def test_feature_sets(made, monkeypatch):
    def compare(train, test, sets, makers):
        for m in makers.values():
            m(FEATS)
        raise Stop
    monkeypatch.setattr(selection, "compare_feature_sets", compare)
    stopped(q_ml.q_feature_set_comparison)
    assert sizes(made) == [100]


def test_oob(made, monkeypatch):
    def grown(train, feats, n_trees):
        assert n_trees == 100
        raise Stop
    monkeypatch.setattr(ensembles, "oob_forest", grown)
    stopped(q_ml.q_oob_score)


def test_som_query_fits_all_classifiers(spark, monkeypatch):
    """All single models without and with under-sampling, both ensembles, the balanced ensembles and the vote, on the coordinates alone."""
    rows = spark.createDataFrame([(i, i % 2, i % 5, i % 3) for i in range(40)], "loan_id long, label int, gx int, gy int")
    asked = {}

    class Fitted:
        def transform(self, df):
            from pyspark.sql import functions as F
            return df.withColumn("prediction", (F.col("gx") > 2).cast("double")).withColumn("p1", F.col("gx") / 4)

    def fit_many(train, makers):
        for name, make in makers.items():
            m = make()
            asked[name] = (type(m.est).__name__, m.sampler, tuple(m.feature_cols), getattr(m.est, "getMaxDepth", lambda: None)())
        return {n: Fitted() for n in makers}, []
    monkeypatch.setattr(models, "fit_many", fit_many)
    for name in ("balanced_bagging", "balanced_random_forest"):
        monkeypatch.setattr(ensembles, name, lambda rows, cols, **kw: Fitted())
    monkeypatch.setattr(ensembles.EasyEnsemble, "fit", lambda self, rows, cols: Fitted())
    got = {r.model: r.accuracy for r in q_som.som_classifiers(rows, rows, ["gx", "gy"]).collect()}
    single, rest = ["LR", "DT", "ANN", "SVC", "SGDC"], ["HGBC", "RF"]
    assert set(asked) == {*single, *rest, *[f"{n}_unsampled" for n in single]}
    assert all(v[1] == (None if n.endswith("_unsampled") else "under") and v[2] == ("gx", "gy") for n, v in asked.items())
    assert asked["DT"][3] == asked["DT_unsampled"][3] == asked["RF"][3] == models.MAX_TREE_DEPTH
    assert set(got) == {f"{n}_on_SOM" for n in (*asked, "BalancedBagging", "BalancedRF", "EasyEnsemble", "HardVote")}
    right = sum((i % 5 > 2) == (i % 2 == 1) for i in range(40)) / 40
    assert all(abs(a - right) < 1e-9 for a in got.values())
