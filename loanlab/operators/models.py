"""Classifiers and the resampling pipeline.

``ResampledPipeline`` = min-max scaler (fitted on the training rows, BEFORE any
resampling) -> optional sampler (fit time only) -> estimator.  The fitted
result is an ordinary ``PipelineModel``:

    SQLTransformer (scaled copies ``<c>__s`` with the fitted bounds as literals;
                    a constant column maps to 0, optional clip at 0)
    VectorAssembler (``features``)
    fitted Spark ML model  (or the SQL form of :class:`LinearSGD`)

so scoring is JVM-side and the model can be saved and loaded.  The sampler
never runs at prediction time.
"""
from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
    NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.operators import encode, sampling
from loanlab.operators.forest import ForestModel, grow_forest
from loanlab.operators.histtree import HistBoost
from loanlab.operators.sgd import LinearSGD
from loanlab.session import right_size

SEED = 111
MAX_TREE_DEPTH = 30          # Spark's ceiling; stands in for "grow until pure"
# deep forests (many trees): keep each row's node id between levels and give the
# level histograms more room (fewer passes); checkpointing uses spark.checkpoint.dir.
# Single trees are faster without it (measured), so only forests use it.
TREE_SPEED = dict(cacheNodeIds=True, maxMemoryInMB=1024, checkpointInterval=10)


def _penalised(est, kw):
    """L2 penalty as 1 / (C n): a fixed ``reg``, else set from the training rows when fitted."""
    if "reg" in kw:
        return est.setRegParam(kw["reg"])
    est.inverse_penalty = kw.get("C", 1.0)
    return est


def estimator(kind: str, seed: int = SEED, **kw):
    """Estimators as the analysed scripts configure them (Spark equivalents)."""
    if kind == "logistic":
        return _penalised(LogisticRegression(maxIter=kw.get("max_iter", 100), standardization=False), kw)
    if kind == "tree":
        return DecisionTreeClassifier(maxDepth=kw.get("max_depth", MAX_TREE_DEPTH), seed=seed,
                                      impurity=kw.get("impurity", "gini"), maxBins=kw.get("max_bins", 32))
    if kind == "mlp":
        # no early stopping in Spark: a convergence tolerance and an iteration cap
        # play its part
        return MultilayerPerceptronClassifier(maxIter=kw.get("max_iter", 100), tol=kw.get("tol", 1e-4), seed=seed,
                                              blockSize=kw.get("block_size", 128))
    if kind == "linear_svc":
        return _penalised(LinearSVC(maxIter=kw.get("max_iter", 1000), standardization=False), kw)
    if kind in ("sgd_hinge", "sgd_modified_huber"):
        return LinearSGD(loss="hinge" if kind == "sgd_hinge" else "modified_huber", seed=seed,
                         max_iter=kw.get("max_iter", 1000))
    if kind == "gbt":
        # 31 leaves, best leaf first; stops early on large inputs
        return HistBoost(rounds=kw.get("rounds", 100), rate=kw.get("lr", 0.1), max_depth=kw.get("max_depth"), l2=kw.get("l2", 0.0), max_bins=kw.get("max_bins", 255),
                         early_stopping=kw.get("early_stopping", "auto"), seed=seed)
    if kind == "gbt_leafy":
        # L1 and L2 on the leaves, all rounds, and the modes of that library
        return HistBoost(rounds=kw.get("rounds", 100), rate=kw.get("lr", 0.1), max_depth=kw.get("max_depth"), l1=kw.get("l1", 1.0), l2=kw.get("l2", 1.0), mode=kw.get("mode", "gbdt"),
                         max_bins=kw.get("max_bins", 255), early_stopping=False, seed=seed)
    if kind == "random_forest":
        return RandomForestClassifier(numTrees=kw.get("trees", 100), featureSubsetStrategy=kw.get("features", "sqrt"),
                                      maxDepth=kw.get("max_depth", MAX_TREE_DEPTH), bootstrap=True, seed=seed,
                                      subsamplingRate=kw.get("max_samples", 1.0), **TREE_SPEED)
    if kind == "complement_nb":
        return NaiveBayes(modelType="complement")
    raise ValueError(f"unknown estimator {kind}")


def scaler_stage(bounds: Mapping[str, tuple], clip_low: bool = False, suffix: str = "__s") -> SQLTransformer:
    """The fitted min-max scaler as a SQL projection with literal bounds."""
    exprs = []
    for c, (mn, mx) in bounds.items():
        x = f"CAST(`{c}` AS DOUBLE)"
        if mn is None:
            e = x
        elif mx == mn:
            e = f"CASE WHEN `{c}` IS NULL THEN NULL ELSE 0.0D END"
        else:
            e = f"({x} - ({repr(float(mn))})) / ({repr(float(mx - mn))})"
        if clip_low:
            e = f"GREATEST({e}, 0.0D)"
        exprs.append(f"{e} AS `{c}{suffix}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def _sample(df: DataFrame, sampler: str | None, key: str, label: str, seed: int) -> DataFrame:
    if sampler is None:
        return df
    if sampler == "under":
        return sampling.under_sample(df, key, label, seed)
    if sampler == "over":
        return sampling.over_sample(df, key, label, seed).drop("draw")
    raise ValueError("sampler must be None, 'under' or 'over'")


class ResampledPipeline:
    """scaler -> (sampler) -> estimator, fitted on the given (training) rows.

    ``grown``: a random forest or a Gini tree (one tree, every row once, all features) is grown by ``forest.grow_forest``
    with the estimator's parameters and stays a table; else it is Spark ML's, which the driver holds whole."""

    def __init__(self, feature_cols: Sequence[str], est, sampler: str | None = "under", scale: bool = True,
                 label: str = "label", key: str = "loan_id", seed: int = SEED, weights: Mapping | None = None, grown: bool = False):
        self.grown = grown
        self.feature_cols, self.est, self.sampler, self.scale = list(feature_cols), est, sampler, scale
        self.label, self.key, self.seed, self.weights = label, key, seed, weights

    def fit(self, df: DataFrame) -> PipelineModel:
        encode.check_features(self.feature_cols, self.label)
        clip = isinstance(self.est, NaiveBayes)
        if self.scale:
            bounds = encode.minmax_fit(df, self.feature_cols)
            scaler = scaler_stage(bounds, clip_low=clip)
            in_cols = [f"{c}__s" for c in self.feature_cols]
        else:
            scaler = SQLTransformer(statement="SELECT * FROM __THIS__")
            in_cols = self.feature_cols
        assembler = VectorAssembler(inputCols=in_cols, outputCol="features", handleInvalid="keep")
        prepared = scaler.transform(df)
        prepared = _sample(prepared, self.sampler, self.key, self.label, self.seed)
        if isinstance(self.est, LinearSGD):
            return PipelineModel([scaler, self.est.fit(prepared, in_cols, self.label, self.key)])
        if isinstance(self.est, HistBoost):
            return PipelineModel([scaler, assembler, self.est.fit(prepared, in_cols, self.label, self.key)])
        common = dict(key=self.key, label=self.label, class_weights=self.weights)
        if self.grown and isinstance(self.est, RandomForestClassifier):
            est, n = self.est, len(in_cols)
            looked = {"sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))), "all": n}[est.getFeatureSubsetStrategy()]   # as Spark ML counts them
            f, _ = grow_forest(prepared, in_cols, est.getNumTrees(), looked, max_samples=est.getSubsamplingRate(), max_depth=est.getMaxDepth(), max_bins=est.getMaxBins(), seed=est.getSeed(), **common)
            return PipelineModel([scaler, ForestModel(f, in_cols)])
        if self.grown and isinstance(self.est, DecisionTreeClassifier) and self.est.getImpurity() == "gini":
            est = self.est
            f, _ = grow_forest(prepared, in_cols, 1, len(in_cols), bootstrap=False, max_depth=est.getMaxDepth(), max_bins=est.getMaxBins(), seed=est.getSeed(), **common)
            return PipelineModel([scaler, ForestModel(f, in_cols)])
        # iterative solvers read the training rows many times: materialise once,
        # in as many partitions as the size calls for
        prepared = assembler.transform(prepared).select(self.key, self.label, "features")
        if isinstance(self.est, (DecisionTreeClassifier, RandomForestClassifier)):
            prepared = prepared.persist()     # compute-bound: keep every partition busy
        else:
            prepared = right_size(prepared, 8 * (len(in_cols) + 3))   # latency-bound iterations
        stored = prepared
        est = self.est.copy()
        if getattr(self.est, "inverse_penalty", None) is not None:
            est.setRegParam(1.0 / (self.est.inverse_penalty * max(1, prepared.count())))
        est.setLabelCol(self.label).setFeaturesCol("features")
        if isinstance(est, MultilayerPerceptronClassifier):
            est.setLayers([len(in_cols), 100, 2])
        if self.weights is not None:
            w = F.lit(None).cast("double")
            for k, v in self.weights.items():
                w = F.when(F.col(self.label) == k, F.lit(float(v))).otherwise(w)
            prepared = prepared.withColumn("_w", w)
            est.setWeightCol("_w")
        try:
            return PipelineModel([scaler, assembler, est.fit(prepared)])
        finally:
            stored.unpersist()


OUTPUT_COLS = ["features", "rawPrediction", "probability", "prediction", "margin", "p1"]


def score_columns(scored: DataFrame, name: str | None = None) -> DataFrame:
    """Uniform outputs: ``prediction`` (int) and ``score`` (class-1 probability,
    else the margin), intermediate columns dropped."""
    cols = set(scored.columns)
    if "probability" in cols:
        s = vector_to_array("probability")[1]
    elif "p1" in cols:
        s = F.col("p1")
    elif "rawPrediction" in cols:
        s = vector_to_array("rawPrediction")[1]
    else:
        s = F.col("prediction").cast("double")
    out = scored.withColumn("_score", s).withColumn("_pred", F.col("prediction").cast("int"))
    drop = [c for c in OUTPUT_COLS if c in cols] + [c for c in scored.columns if c.endswith("__s")]
    out = out.drop(*drop)
    pn, sn = ("prediction", "score") if name is None else (f"{name}_prediction", f"{name}_score")
    return out.withColumnRenamed("_pred", pn).withColumnRenamed("_score", sn)


def predict(model: PipelineModel, df: DataFrame, name: str | None = None) -> DataFrame:
    return score_columns(model.transform(df), name)


def fit_many(train: DataFrame, estimators: Mapping[str, Callable[[], ResampledPipeline]],
             parallelism: int = 4) -> tuple[dict, list[tuple[str, float]]]:
    """Fit several pipelines on one persisted training frame from a small driver
    thread pool (Spark schedules their jobs side by side).  Returns the models
    and (name, fit seconds)."""
    train = train.persist()

    def one(item):
        name, make = item
        t0 = time.time()
        m = make().fit(train)
        return name, m, time.time() - t0

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            res = list(ex.map(one, estimators.items()))
    finally:
        train.unpersist()
    return {n: m for n, m, _ in res}, [(n, s) for n, _, s in res]


def long_predictions(models: Mapping[str, PipelineModel], test: DataFrame, key: str, label: str,
                     keep: Sequence[str] = ()) -> DataFrame:
    """(model, key, label, prediction, score) for every model, one union."""
    out = None
    for name, m in models.items():
        p = predict(m, test).select(F.lit(name).alias("model"), key, F.col(label).alias("label"),
                                    "prediction", "score", *keep)
        out = p if out is None else out.unionByName(p)
    return out


def fit_pipeline(train: DataFrame, feature_cols: Sequence[str], kind: str, sampler: str | None = "under",
                 label: str = "label", key: str = "loan_id", **kw) -> PipelineModel:
    return ResampledPipeline(feature_cols, estimator(kind, **kw), sampler=sampler, label=label, key=key).fit(train)


def pipeline_of(feature_cols: Sequence[str], kind: str, sampler: str | None = "under", label: str = "label",
                key: str = "loan_id", weights: Mapping | None = None, grown: bool = False, **kw) -> Callable[[], ResampledPipeline]:
    return lambda: ResampledPipeline(feature_cols, estimator(kind, **kw), sampler=sampler, label=label, key=key,
                                     weights=weights, grown=grown)


__all__ = ["estimator", "ResampledPipeline", "Pipeline", "fit_many", "predict", "score_columns",
           "long_predictions", "fit_pipeline", "pipeline_of", "scaler_stage"]
