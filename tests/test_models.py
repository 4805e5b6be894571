"""Model gates on the planted-signal label, leakage checks, custom fitters."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_MID
from loanlab.operators import ensembles, explain, metrics, models, selection, som
from loanlab.operators.impute import IterativeTreeImputer
from loanlab.plans.flows import model_table, split_parts
from loanlab.sources.fixtures import vectors


@pytest.fixture(scope="module")
def data(spark):
    df, feats = model_table(spark, SF_MID)
    df = df.persist()
    train, test = split_parts(df)
    return train, test, feats


def _metric(m, test, name="auc"):
    p = models.predict(m, test)
    return metrics.score_many(p.withColumn("model", F.lit("m"))).collect()[0][name]


def test_logistic_quality_gate(data):
    train, test, feats = data
    m = models.fit_pipeline(train, feats, "logistic")
    assert _metric(m, test) > 0.85


def test_under_sampling_raises_recall(data):
    train, test, feats = data
    with_us = models.fit_pipeline(train, feats, "tree", max_depth=6)
    without = models.fit_pipeline(train, feats, "tree", sampler=None, max_depth=6)
    assert _metric(with_us, test, "recall") > _metric(without, test, "recall")


def test_scaler_is_fitted_on_training_rows_only(data, spark):
    train, test, feats = data
    m = models.fit_pipeline(train, feats, "logistic")
    stmt = m.stages[0].getStatement()
    # the fitted bounds are the training bounds: changing test rows changes nothing
    b = {c: v for c, v in __import__("loanlab.operators.encode", fromlist=["x"]).minmax_fit(train, feats[:1]).items()}
    assert repr(float(b[feats[0]][0])) in stmt
    assert "label" not in [c.replace("__s", "") for c in m.stages[1].getInputCols()]


def test_model_roundtrip(data, spark, tmp_path):
    from loanlab.sources import tables
    train, test, feats = data
    m = models.fit_pipeline(train, feats, "linear_svc")
    path = tables.save_model(m, str(tmp_path / "m"))
    a = models.predict(m, test).select("loan_id", "prediction")
    b = models.predict(tables.load_model(path), test).select("loan_id", "prediction")
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("kind", ["sgd_hinge", "sgd_modified_huber"])
def test_sgd_learns(data, kind):
    train, test, feats = data
    m = models.fit_pipeline(train, feats, kind, max_iter=15)
    assert _metric(m, test) > 0.85


def test_easy_ensemble_and_bagging(data):
    train, test, feats = data
    ee = ensembles.EasyEnsemble(n_bags=3, rounds=8).fit(train, feats)
    assert _metric(ee, test) > 0.8
    bb = ensembles.balanced_bagging(train, feats, n_estimators=3, max_depth=6)
    assert _metric(bb, test) > 0.8


def test_oob_and_importances(spark, data):
    train, test, feats = data
    _, res = ensembles.oob_forest(train, feats, n_trees=6, max_depth=6)
    assert 0.6 < res["oob_right"] / res["oob_rows"] <= 1.0
    m = models.fit_pipeline(train, feats, "random_forest", sampler=None, trees=10, max_depth=6)
    imp = explain.feature_importances(spark, m, feats).collect()
    assert imp[0].feature == "loan_amnt" and abs(sum(r.importance for r in imp) - 1) < 1e-9
    sc = explain.split_count_importances(spark, m, feats).collect()
    assert sum(r.split_count for r in sc) > 0
    nodes = explain.tree_nodes(spark, m, feats, 0, 3).collect()
    assert nodes[0].node_id == 0 and max(r.depth for r in nodes) <= 3


def test_halving_schedule_integer_math():
    s = selection.halving_schedule(100000, 243, 3, 5, 2)
    assert [c for _, c, _ in s] == [243, 81, 27, 9, 3, 1]
    assert [r for _, _, r in selection.halving_schedule(100000, 27)][:2] == [100000 // 27, 3 * (100000 // 27)]
    assert len(selection.halving_schedule(100000, 12)) == 3


def test_stacking_runs(data):
    train, test, feats = data
    bases = {"LR": models.pipeline_of(feats, "logistic"), "DT": models.pipeline_of(feats, "tree", max_depth=5)}
    final = lambda names: models.ResampledPipeline(names, models.estimator("logistic"))
    st = ensembles.Stacking(bases, final, cv=3).fit(train)
    p = st.transform(test)
    assert p.count() == test.count()
    assert metrics.score_many(p.withColumn("model", F.lit("s"))).collect()[0]["auc"] > 0.8


def test_som_error_falls_and_projection_is_exact(spark):
    v = vectors(spark, SF_MID)
    m = som.BatchSOM(5, 5, passes=6).fit(v, "features", "vec_id")
    qe = [h[2] for h in m.history]
    assert qe[-1] < qe[0]
    rows = v.collect()
    x = np.array([r.features for r in rows])
    d2 = ((x[:, None, :] - m.codebook[None, :, :]) ** 2).sum(-1)
    brute = {r.vec_id: int(np.argmin(d2[i])) for i, r in enumerate(rows)}
    got = {r.vec_id: r.node for r in m.project(v, "features", keep=["vec_id"]).collect()}
    assert got == brute


def test_imputer_keeps_observed_and_fills_all(spark):
    from loanlab.plans.flows import parsed_loans
    cols = ["loan_amnt", "revol_util", "employment_len", "age", "revol_bal"]
    df = parsed_loans(spark, "/root/testdata/sf0.001").select("loan_id", *cols).persist()
    model = IterativeTreeImputer(cols, max_rounds=2).fit(df.select(*cols))
    out = model.transform(df)
    assert out.filter(" OR ".join(f"{c} IS NULL" for c in cols)).count() == 0
    j = df.alias("a").join(out.alias("b"), "loan_id")
    for c in cols:
        assert j.filter(F.col(f"a.{c}").isNotNull() & (F.col(f"a.{c}") != F.col(f"b.{c}"))).count() == 0
