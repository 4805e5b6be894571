"""Saving and loading fitted models of several parts: votes, stacks, and the chained imputer.

Pipelines are saved by Spark ML, each in a folder of its own; what is left is a Parquet table.
"""
from __future__ import annotations

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from loanlab.operators.ensembles import StackingModel, VotingModel
from loanlab.operators.impute import IterativeTreeImputerModel, Round

_META = "kind string, names array<string>, facts string"


def _save_meta(spark: SparkSession, path: str, kind: str, names: list[str], facts: dict) -> None:
    spark.createDataFrame([(kind, names, json.dumps(facts))], _META).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def save(model, path: str) -> str:
    """Save a pipeline, vote, stack or imputer under ``path`` (replacing what is there)."""
    spark = SparkSession.builder.getOrCreate()
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(f"{path}/pipeline")
        _save_meta(spark, path, "pipeline", [], {})
    elif isinstance(model, VotingModel):
        for n, m in model.models.items():
            m.write().overwrite().save(f"{path}/part-{n}")
        _save_meta(spark, path, "vote", list(model.models), {"voting": model.voting})
    elif isinstance(model, StackingModel):
        for n, m in model.bases.items():
            m.write().overwrite().save(f"{path}/part-{n}")
        model.final.write().overwrite().save(f"{path}/final")
        _save_meta(spark, path, "stack", list(model.bases), {})
    elif isinstance(model, IterativeTreeImputerModel):
        rows = [(i, *[x.tolist() for x in (r.feature, r.bin, r.left, r.value, r.small, r.small_tree, r.starts)]) for i, r in enumerate(model.rounds)]
        kind = "round int, feature array<long>, bin array<long>, left array<long>, value array<double>, small array<long>, small_tree array<long>, starts array<long>"
        for i, r in enumerate(model.rounds):
            if r.table is not None:
                r.table.write.mode("overwrite").parquet(f"{path}/subtrees-{i}")
        spark.createDataFrame(rows, kind).write.mode("overwrite").parquet(f"{path}/rounds")
        cuts = [(i, c.tolist()) for i, c in enumerate(model.cuts)]
        spark.createDataFrame(cuts, "col int, cuts array<double>").write.mode("overwrite").parquet(f"{path}/cuts")
        _save_meta(spark, path, "imputer", model.cols, {"targets": model.targets, "means": model.means, "history": model.history})
    else:
        raise TypeError(f"cannot save {type(model).__name__}")
    return path


def load(spark: SparkSession, path: str):
    """What ``save`` wrote."""
    meta = spark.read.parquet(f"{path}/meta").first()
    facts = json.loads(meta.facts)
    if meta.kind == "pipeline":
        return PipelineModel.load(f"{path}/pipeline")
    if meta.kind == "imputer":
        rounds = [Round(*[np.array(x) for x in (r.feature, r.bin, r.left, r.value)], *[np.array(x, np.int64) for x in (r.small, r.small_tree, r.starts)],
                        spark.read.parquet(f"{path}/subtrees-{r.round}") if r.small else None) for r in spark.read.parquet(f"{path}/rounds").orderBy("round").collect()]   # the model
        cuts = [np.array(r.cuts, np.float64) for r in spark.read.parquet(f"{path}/cuts").orderBy("col").collect()]   # one row a column
        return IterativeTreeImputerModel(meta.names, facts["targets"], facts["means"], cuts, rounds, [tuple(h) for h in facts["history"]])
    parts = {n: PipelineModel.load(f"{path}/part-{n}") for n in meta.names}
    if meta.kind == "vote":
        return VotingModel(parts, facts["voting"])
    return StackingModel(parts, PipelineModel.load(f"{path}/final"))
