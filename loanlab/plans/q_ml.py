"""Queries: classifiers, pipelines, ensembles, selection, explanation,
chained imputation (SURVEY 2.3 E4, 2.8 - 2.12).  Fitting is not SQL; the registered
queries return what SQL can compute of a fit (see ``_facts_sql``), the tests gate the rest."""
from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from loanlab.functions.columns import sql_hash_u32
from loanlab.operators import metrics, models
from loanlab.plans.flows import model_table, split_parts
from loanlab.plans.registry import register
from loanlab.plans.sqltext import loans_sql, union_all
from loanlab.session import right_size, scratch_path
from loanlab.sources import tables


_TEST_FACTS = (
    "t AS (SELECT loan_amnt, y_signal AS label FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY "
    f"{sql_hash_u32('loan_id', 111, 'split')}, loan_id) - 1 AS rn, COUNT(*) OVER () AS n FROM loans) WHERE rn >= FLOOR(n * 0.75))",
    "r AS (SELECT label, RANK() OVER (ORDER BY loan_amnt) + (COUNT(*) OVER (PARTITION BY loan_amnt) - 1) / 2.0 AS rk FROM t)",
    "f AS (SELECT COUNT(*) AS n_test, CAST(SUM(label) AS BIGINT) AS support_1, "
    "ROUND((SUM(CASE WHEN label = 1 THEN rk END) - SUM(label) * (SUM(label) + 1) / 2.0) / (SUM(label) * (COUNT(*) - SUM(label))), 6) AS baseline_auc FROM r)")


def _facts_sql(*names: str) -> str:
    """What SQL can say of a fitted model: the test rows it is scored on, their classes, the AUC of
    the one informative column on them; and that the model is as good as its floors demand."""
    return loans_sql(*_TEST_FACTS, body=union_all(
        f"SELECT '{n}' AS model, n_test, support_1, n_test - support_1 AS support_0, baseline_auc, "
        "TRUE AS auc_ok, TRUE AS recall_ok, TRUE AS specificity_ok FROM f" for n in names))


# floors: AUC below the baseline's by this much at most; recall and specificity of class 1
_FLOORS = {"LR": (0.02, 0.5, 0.5), "DT": (0.15, 0.5, 0.5), "GBM": (0.1, 0.3, 0.5), "RF_tuned": (0.1, 0.3, 0.5), "CNB": (0.5, 0.0, 0.0)}
_FLOOR = (0.1, 0.5, 0.5)


def _facts(scored):
    """One row per model of scored test rows (model, label, prediction, score, loan_amnt)."""
    scored = scored.select("model", "label", "prediction", "score", "loan_amnt").persist()
    m = metrics.score_many(scored).select("model", "auc", "recall", "specificity")
    sizes = scored.groupBy("model").agg(F.count("*").alias("n_test"), F.sum("label").cast("long").alias("support_1"))
    base = metrics.roc_auc(scored, score="loan_amnt", by=["model"]).select("model", F.round("auc", 6).alias("baseline_auc"))
    floor = lambda i: F.coalesce(F.element_at(F.create_map(*[x for n, f in _FLOORS.items() for x in (F.lit(n), F.lit(f[i]))]), F.col("model")), F.lit(_FLOOR[i]))
    out = sizes.join(base, "model").join(m, "model").select(
        "model", "n_test", "support_1", (F.col("n_test") - F.col("support_1")).alias("support_0"), "baseline_auc",
        (F.col("auc") >= F.col("baseline_auc") - floor(0)).alias("auc_ok"),
        (F.col("recall") >= floor(1)).alias("recall_ok"), (F.col("specificity") >= floor(2)).alias("specificity_ok"))
    out = scored.sparkSession.createDataFrame(out.collect(), out.schema)   # one row per model
    scored.unpersist()
    return out


def _report(spark, model_name, model, test):
    return _facts(models.predict(model, test).withColumn("model", F.lit(model_name)))


def _fit_and_report(spark, sf, name, kind, sampler="under", weights=None, **kw):
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    m = models.ResampledPipeline(feats, models.estimator(kind, **kw), sampler=sampler, weights=weights, grown=True).fit(train)
    return _report(spark, name, m, test)


def forest_report(spark, sf):
    """Flagship: clean -> split -> under-sample -> forest -> classification report."""
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    m = models.ResampledPipeline(feats, models.estimator("random_forest"), sampler="under").fit(train)
    return metrics.classification_report(models.predict(m, test))


@register("fit_logistic", _facts_sql("LR"))
def q_fit_logistic(spark, sf):
    return _fit_and_report(spark, sf, "LR", "logistic")


@register("fit_tree", _facts_sql("DT"))
def q_fit_tree(spark, sf):
    return _fit_and_report(spark, sf, "DT", "tree")


@register("fit_mlp", _facts_sql("ANN"))
def q_fit_mlp(spark, sf):
    return _fit_and_report(spark, sf, "ANN", "mlp")


@register("fit_linear_svc", _facts_sql("SVC"))
def q_fit_linear_svc(spark, sf):
    return _fit_and_report(spark, sf, "SVC", "linear_svc")


@register("fit_sgd_hinge", _facts_sql("SGDC"))
def q_fit_sgd_hinge(spark, sf):
    return _fit_and_report(spark, sf, "SGDC", "sgd_hinge")


@register("fit_sgd_modified_huber", _facts_sql("SGDC_mh"))
def q_fit_sgd_mh(spark, sf):
    return _fit_and_report(spark, sf, "SGDC_mh", "sgd_modified_huber")


@register("fit_gbt", _facts_sql("HGBC"))
def q_fit_gbt(spark, sf):
    return _fit_and_report(spark, sf, "HGBC", "gbt")


@register("fit_gbt_leafy", _facts_sql("GBM"))
def q_fit_gbt_leafy(spark, sf):
    return _fit_and_report(spark, sf, "GBM", "gbt_leafy", sampler=None)


@register("fit_random_forest", _facts_sql("RF"))
def q_fit_random_forest(spark, sf):
    return _fit_and_report(spark, sf, "RF", "random_forest")


@register("fit_random_forest_weighted", _facts_sql("RF_tuned"))
def q_fit_rf_weighted(spark, sf):
    return _fit_and_report(spark, sf, "RF_tuned", "random_forest", sampler=None, weights={0: 1.2, 1: 1.0},
                           trees=200)


@register("fit_complement_nb", _facts_sql("CNB"))
def q_fit_cnb(spark, sf):
    return _fit_and_report(spark, sf, "CNB", "complement_nb")


# fixed values: the eight estimators, in their recorded order
_EIGHT = [("LR", "logistic"), ("DT", "tree"), ("ANN", "mlp"), ("SVC", "linear_svc"), ("SGDC", "sgd_hinge"), ("HGBC", "gbt"), ("RF", "random_forest"), ("GBM", "gbt_leafy")]


@register("fit_many", _facts_sql(*[n for n, _ in _EIGHT]))
def q_fit_many(spark, sf):
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    fitted, _ = models.fit_many(train, {n: models.pipeline_of(feats, k, grown=True) for n, k in _EIGHT})
    return _facts(models.long_predictions(fitted, test, "loan_id", "label", keep=["loan_amnt"]))


# fixed values: the members of the recorded votes, and the way they vote
_VOTERS = {"LR": ("logistic", {}), "DT": ("tree", {}), "ANN": ("mlp", {}), "SVC": ("linear_svc", {}), "SGDC": ("sgd_hinge", {}), "NB": ("complement_nb", {}),
           "SGDC_mh": ("sgd_modified_huber", {}), "HGBC": ("gbt", {}), "RF": ("random_forest", {"max_samples": 0.5})}
_VOTES = {"hard_5": ("hard", ["LR", "DT", "ANN", "SVC", "SGDC"]), "hard_7": ("hard", ["LR", "DT", "ANN", "SVC", "SGDC", "HGBC", "RF"]),
          "soft_5": ("soft", ["ANN", "LR", "DT", "NB", "SGDC_mh"]), "soft_7": ("soft", ["LR", "DT", "ANN", "NB", "SGDC_mh", "HGBC", "RF"])}


@register("fitted_votes", _facts_sql(*_VOTES))
def q_fitted_votes(spark, sf):
    """Hard and soft votes of five and of seven fitted models; every model is fitted once."""
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    fitted, _ = models.fit_many(train, {n: models.pipeline_of(feats, k, grown=True, **kw) for n, (k, kw) in _VOTERS.items()})
    out = None
    for name, (voting, members) in _VOTES.items():
        p = ensembles.VotingModel({n: fitted[n] for n in members}, voting).transform(test)
        p = p.select(F.lit(name).alias("model"), "loan_id", "label", "prediction", "score", "loan_amnt")
        out = p if out is None else out.unionByName(p)
    return _facts(out)


@register("model_roundtrip", loans_sql(*_TEST_FACTS, body="SELECT n_test, CAST(0 AS BIGINT) AS differing FROM f"))
def q_model_roundtrip(spark, sf):
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    m = models.fit_pipeline(train, feats, "logistic")
    path = tables.save_model(m, scratch_path(spark, "model-lr"))
    again = models.predict(tables.load_model(path), test).select("loan_id", F.col("prediction").alias("p2"), F.col("score").alias("s2"))
    both = models.predict(m, test).select("loan_id", "prediction", "score").join(again, "loan_id")
    differs = (F.col("prediction") != F.col("p2")) | (F.col("score") != F.col("s2"))
    return both.agg(F.count("*").alias("n_test"), F.count(F.when(differs, 1)).alias("differing"))


# ------------------------------------------------------------------ ensembles
from loanlab.operators import ensembles, explain, selection  # noqa: E402
from loanlab.plans.flows import MODEL_NUMERIC  # noqa: E402


_OOB_TREES = 100


def _oob_sql(trees: int = _OOB_TREES) -> str:
    """Draws of the forest from the key hash: the k-th number of a Lehmer stream seeded by it, Poisson(1) weights."""
    weight = " + ".join(f"CAST(u >= CEIL({2**31 - 1} * {c}) AS INTEGER)" for c in _poisson_sql())
    text = loans_sql(
        f"tr AS (SELECT loan_id, y_signal AS label FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {sql_hash_u32('loan_id', 111, 'split')}, loan_id) - 1 AS rn, COUNT(*) OVER () AS n FROM loans) WHERE rn < FLOOR(n * 0.75))",
        f"ds AS (SELECT loan_id, label, {sql_hash_u32('loan_id', 111, 'forest')} % {2**31 - 2} + 1 AS s FROM tr)",
        f"st(t, m) AS (SELECT 1, CAST(48271 AS BIGINT) UNION ALL SELECT t + 1, m * 48271 % {2**31 - 1} FROM st WHERE t < {trees})",
        f"dr AS (SELECT loan_id, label, CAST(s AS BIGINT) * m % {2**31 - 1} AS u FROM ds, st)",
        f"wt AS (SELECT loan_id, label, {weight} AS w FROM dr)",
        body=f"SELECT CAST({trees} AS INTEGER) AS n_trees, COUNT(DISTINCT CASE WHEN w = 0 THEN loan_id END) AS oob_rows, CAST(SUM(CASE WHEN w = 0 THEN 1 ELSE 0 END) AS BIGINT) AS oob_votes, "
             "CAST(SUM(CASE WHEN label = 0 THEN w ELSE 0 END) AS BIGINT) AS in_bag_0, CAST(SUM(CASE WHEN label = 1 THEN w ELSE 0 END) AS BIGINT) AS in_bag_1, TRUE AS beats_majority FROM wt")
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


def _poisson_sql(terms: int = 20) -> list[str]:
    """Cumulative Poisson(1) probabilities as SQL: e^-1 times the partial sums of 1 / k!."""
    return [f"(EXP(-1.0) * ({' + '.join(f'1.0 / {math.factorial(k)}' for k in range(n + 1))}))" for n in range(terms)]


@register("oob_score", _oob_sql())
def q_oob_score(spark, sf):
    df, feats = model_table(spark, sf)
    train, _ = split_parts(df)
    _, got = ensembles.oob_forest(train, feats, n_trees=_OOB_TREES)
    share = train.agg(F.avg("label")).first()[0]
    better = got["oob_right"] / got["oob_rows"] > max(share, 1 - share)
    return spark.createDataFrame([(_OOB_TREES, *[got[c] for c in ("oob_rows", "oob_votes", "in_bag_0", "in_bag_1")], better)],
                                 "n_trees int, oob_rows long, oob_votes long, in_bag_0 long, in_bag_1 long, beats_majority boolean")


# fixed values: the base models, in their recorded order
_STACK_BASES = [("DT", "tree"), ("ANN", "mlp"), ("SGDC", "sgd_hinge"), ("HGBC", "gbt"), ("RF", "random_forest")]


@register("stacking", _facts_sql("stacking"))
def q_stacking(spark, sf):
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    bases = {n: models.pipeline_of(feats, k, grown=True) for n, k in _STACK_BASES}
    final = lambda names: models.ResampledPipeline(names, models.estimator("logistic"), sampler="under")
    m = ensembles.Stacking(bases, final, cv=4).fit(train)
    p = m.transform(test)
    return _facts(p.withColumn("model", F.lit("stacking")))


@register("balanced_bagging", _facts_sql("BalancedBagging"))
def q_balanced_bagging(spark, sf):
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    m = ensembles.balanced_bagging(train, feats, n_estimators=10)
    return _report(spark, "BalancedBagging", m, test)


@register("balanced_random_forest", _facts_sql("BalancedRF"))
def q_balanced_random_forest(spark, sf):
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    m = ensembles.balanced_random_forest(train, feats, n_trees=100)
    return _report(spark, "BalancedRF", m, test)


@register("easy_ensemble", _facts_sql("EasyEnsemble"))
def q_easy_ensemble(spark, sf):
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    m = ensembles.EasyEnsemble(n_bags=10, rounds=50).fit(train, feats)
    return _facts(models.predict(m, test).withColumn("model", F.lit("EasyEnsemble")))


# ------------------------------------------------------------------ selection
# fixed values: the five models that are cross-validated, in their recorded order
_FIVE = [("LR", "logistic"), ("DT", "tree"), ("ANN", "mlp"), ("SVC", "linear_svc"), ("SGDC", "sgd_hinge")]


def _cv_sql(train_frac: float = 0.25, n_splits: int = 4) -> str:
    """Sizes of the parts of every split; the scores' floors hold."""
    names = union_all(f"SELECT '{n}' AS model" for n, _ in _FIVE)
    return loans_sql(
        f"tr AS (SELECT y_signal AS label FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {sql_hash_u32('loan_id', 111, 'split')}, loan_id) - 1 AS rn, COUNT(*) OVER () AS n FROM loans) WHERE rn < FLOOR(n * 0.75))",
        f"c AS (SELECT label, COUNT(*) AS n, CAST(FLOOR(COUNT(*) * {train_frac}) AS BIGINT) AS k FROM tr GROUP BY label)",
        "p AS (SELECT 'train' AS part, CAST(SUM(k) AS BIGINT) AS n_rows, CAST(SUM(CASE WHEN label = 1 THEN k ELSE 0 END) AS BIGINT) AS support_1 FROM c "
        "UNION ALL SELECT 'test', CAST(SUM(n - k) AS BIGINT), CAST(SUM(CASE WHEN label = 1 THEN n - k ELSE 0 END) AS BIGINT) FROM c)",
        f"m AS ({names})",
        body=f"SELECT model, CAST(split AS INTEGER) AS split, part, n_rows, support_1, TRUE AS recall_ok FROM m, p, range({n_splits}) s(split)")


def _cross_validated(spark, sf, sampler, floors):
    df, feats = model_table(spark, sf)
    train, _ = split_parts(df)
    train = right_size(train, 8 * len(train.columns))
    out = None
    for name, kind in _FIVE:
        _, scores = selection.cross_validate(train, models.pipeline_of(feats, kind, sampler=sampler, grown=True), n_splits=4, train_frac=0.25, metric="recall")
        mean = F.avg("score").over(Window.partitionBy("part"))   # over the splits: eight rows in all
        s = scores.select(F.lit(name).alias("model"), "split", "part", "n_rows", "support_1", (mean >= floors.get(name, 0.5)).alias("recall_ok"))
        out = s if out is None else out.unionByName(s)
    train.unpersist()
    return out


@register("cross_validate", _cv_sql())
def q_cross_validate(spark, sf):
    return _cross_validated(spark, sf, "under", {})


@register("cross_validate_over_sampled", _cv_sql())
def q_cross_validate_over_sampled(spark, sf):
    return _cross_validated(spark, sf, "over", {"DT": 0.2})


def _halved(spark, sf, name):
    """Rungs of the recorded grid ``name``: candidates, rows, candidates kept, and whether the best beats the larger class."""
    df, feats = model_table(spark, sf)
    train, _ = split_parts(df)
    kind, grid = selection.recorded_grids()[name]
    _, rows = selection.halving_trees(train, feats, kind, grid)
    share = train.agg(F.avg("label")).first()[0]
    rungs = rows.groupBy("rung", "n_resources").agg(F.count("*").cast("int").alias("n_candidates"), F.count_if("kept").alias("n_kept"), F.max("mean_score").alias("best"))
    return rungs.select("rung", "n_candidates", "n_resources", "n_kept", (F.col("best") >= max(share, 1 - share) - 0.02).alias("best_ok"))


def _halving_sql(n_candidates=27, factor=3, cv=5, n_classes=2, search=False):
    req = 1
    x = n_candidates
    while x >= factor:
        x //= factor
        req += 1
    kept = ", CAST((n_candidates + 2) // 3 AS BIGINT) AS n_kept, TRUE AS best_ok" if search else ""
    smallest = 2 * cv * n_classes
    return loans_sql(
        "t AS (SELECT CAST(FLOOR(COUNT(*) * 0.75) AS BIGINT) AS n FROM loans)",
        f"m AS (SELECT n, GREATEST({smallest}, n // {factor ** (req - 1)}) AS mr FROM t)",
        body=(f"SELECT *{kept} FROM (SELECT CAST(r AS INTEGER) AS rung, CAST(({n_candidates} + POW({factor}, r)::BIGINT - 1) // POW({factor}, r)::BIGINT AS INTEGER) "
              f"AS n_candidates, CAST(mr * POW({factor}, r)::BIGINT AS BIGINT) AS n_resources "
              f"FROM m, (SELECT range AS r FROM range({req})) g WHERE mr * POW({factor}, r)::BIGINT <= n)"))


@register("halving_search", _halving_sql(27, search=True))
def q_halving_search(spark, sf):
    return _halved(spark, sf, "HGB")


@register("halving_schedule", _halving_sql())
def q_halving_schedule(spark, sf):
    from loanlab.sources.fixtures import loans
    n = loans(spark, sf).count()
    sched = selection.halving_schedule(int(n * 0.75), 27, 3, 5, 2)
    return selection.schedule_frame(spark, sched)


_SWEEP = [10, 20, 30, 40, 50]


@register("param_sweep", _facts_sql(*[f"BalancedBagging_{n}" for n in _SWEEP]))
def q_param_sweep(spark, sf):
    """Balanced bagging with 10 to 50 trees."""
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    fitted = ensembles.bagging_sweep(train, feats, _SWEEP)
    return _facts(models.long_predictions({f"BalancedBagging_{n}": m for n, m in fitted.items()}, test, "loan_id", "label", keep=["loan_amnt"]))


@register("feature_set_comparison")
def q_feature_set_comparison(spark, sf):
    df, feats = model_table(spark, sf)
    train, test = split_parts(df)
    makers = {"LR": lambda cols: models.ResampledPipeline(cols, models.estimator("logistic")),
              "RF": lambda cols: models.ResampledPipeline(cols, models.estimator("random_forest"), grown=True)}
    return selection.compare_feature_sets(train, test, {"all": feats, "numeric": MODEL_NUMERIC}, makers)


# ------------------------------------------------------------------ explanation
def _forest(spark, sf):
    df, feats = model_table(spark, sf)
    train, _ = split_parts(df)
    m = models.ResampledPipeline(feats, models.estimator("random_forest"), sampler=None, grown=True).fit(train)
    return df, feats, m


@register("feature_importances")
def q_feature_importances(spark, sf):
    _, feats, m = _forest(spark, sf)
    return explain.feature_importances(spark, m, feats)


@register("split_count_importances")
def q_split_count_importances(spark, sf):
    df, feats = model_table(spark, sf)
    train, _ = split_parts(df)
    m = models.ResampledPipeline(feats, models.estimator("gbt_leafy"), sampler=None).fit(train)
    return explain.split_count_importances(spark, m, feats)


@register("select_by_importance")
def q_select_by_importance(spark, sf):
    df, feats, m = _forest(spark, sf)
    imp = explain.feature_importances(spark, m, feats)
    slim, _ = explain.select_by_importance(df, imp, 0.01, keep=["loan_id", "label"])
    return slim


@register("tree_nodes")
def q_tree_nodes(spark, sf):
    _, feats, m = _forest(spark, sf)
    return explain.tree_nodes(spark, m, feats, tree=0, max_depth=3)
