"""Queries: self-organizing map, codebook persistence (A8) and
chained imputation (E4)."""
from __future__ import annotations

import functools

from pyspark.sql import functions as F

from loanlab.functions.columns import sql_hash_u32
from loanlab.operators import encode, ensembles, metrics, models, som
from loanlab.operators.impute import IterativeTreeImputer
from loanlab.plans.flows import parsed_loans
from loanlab.plans.registry import register, rounded
from loanlab.plans.sqltext import parsed_sql
from loanlab.session import cut_lineage, scratch_path
from loanlab.sources.fixtures import vectors

W, H, DIM = 4, 4, 64

_PROJ_CTES = [
    "v AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, "
    "generate_subscripts(embedding, 1) - 1 AS d FROM embeddings)",
    f"cb AS (SELECT CAST(n.range AS INTEGER) AS node, CAST(dd.range AS INTEGER) AS d, "
    f"((n.range * 7 + dd.range * 3) % 17 - 8) / 16.0 AS w FROM range({W * H}) n, range({DIM}) dd)",
    "dist AS (SELECT vec_id, label, node, SUM((x - w) * (x - w)) AS d2 FROM v JOIN cb USING (d) GROUP BY vec_id, label, node)",
    f"proj AS (SELECT vec_id, label, node, CAST(node % {W} AS INTEGER) AS gx, CAST(node // {W} AS INTEGER) AS gy FROM "
    "(SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY d2, node) AS rn FROM dist) WHERE rn = 1)",
]


def _sql(*extra, body):
    return "WITH " + ",\n".join(_PROJ_CTES + list(extra)) + "\n" + body


def _projection(spark, sf):
    cb = som.codebook_array(som.fixed_codebook(spark, W, H, DIM))
    return som.project(vectors(spark, sf), cb, W, "features", keep=["vec_id", "label"])


@register("som_project", _sql(body="SELECT vec_id, node, gx, gy FROM proj"))
def q_som_project(spark, sf):
    return _projection(spark, sf).select("vec_id", "node", "gx", "gy")


@register("som_label_map", _sql(body="SELECT node, gx, gy, label, COUNT(*) AS count FROM proj GROUP BY node, gx, gy, label"))
def q_som_label_map(spark, sf):
    return som.label_map(_projection(spark, sf), "label")


@register("som_component_plane", _sql(
    "hits AS (SELECT node, COUNT(*) AS hits FROM proj GROUP BY node)",
    body=(f"SELECT c.node, CAST(c.node % {W} AS INTEGER) AS gx, CAST(c.node // {W} AS INTEGER) AS gy, "
          "ROUND(c.w, 6) AS value, COALESCE(h.hits, 0) AS hits FROM cb c LEFT JOIN hits h ON c.node = h.node WHERE c.d = 0")))
def q_som_component_plane(spark, sf):
    cb = som.fixed_codebook(spark, W, H, DIM)
    return rounded(som.component_plane(cb, _projection(spark, sf), 0))


_CB_ROWS = ["cb AS (SELECT CAST(rn AS INTEGER) AS node, d, x AS w FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, "
            "generate_subscripts(embedding, 1) - 1 AS d FROM embeddings) JOIN (SELECT vec_id, rn FROM (SELECT vec_id, ROW_NUMBER() OVER (ORDER BY "
            f"{sql_hash_u32('vec_id', 111, 'codebook')}, vec_id) - 1 AS rn FROM embeddings) WHERE rn < {W * H}) USING (vec_id))"]


def _um_sql(offsets: str) -> str:
    return "WITH " + ",\n".join(_CB_ROWS) + f"""
SELECT a.node, CAST(a.node % {W} AS INTEGER) AS gx, CAST(a.node // {W} AS INTEGER) AS gy, ROUND(AVG(dist), 6) AS u FROM (
  SELECT p.node, p.nbr, SQRT(SUM((ca.w - cb2.w) * (ca.w - cb2.w))) AS dist FROM (
    SELECT DISTINCT node, ((node % {W} + o.dx + {W}) % {W}) + {W} * ((node // {W} + o.dy + {H}) % {H}) AS nbr
    FROM (SELECT DISTINCT node FROM cb), (VALUES {offsets}) o(odd, dx, dy) WHERE o.odd IS NULL OR o.odd = (node // {W}) % 2) p
  JOIN cb ca ON ca.node = p.node JOIN cb cb2 ON cb2.node = p.nbr AND cb2.d = ca.d
  GROUP BY p.node, p.nbr) a
GROUP BY a.node"""


_CROSS = "(NULL, 1, 0), (NULL, -1, 0), (NULL, 0, 1), (NULL, 0, -1)"


def _rows_codebook(spark, sf):
    return som.codebook_of_rows(vectors(spark, sf), "features", "vec_id", W, H)


@register("som_u_matrix", _um_sql(_CROSS))
def q_som_u_matrix(spark, sf):
    return rounded(som.u_matrix(_rows_codebook(spark, sf), W, H, periodic=True))


@register("som_u_matrix_hex", _um_sql(_CROSS + ", (1, 1, 1), (1, 1, -1), (0, -1, 1), (0, -1, -1)"))
def q_som_u_matrix_hex(spark, sf):
    return rounded(som.u_matrix(_rows_codebook(spark, sf), W, H, periodic=True, topology="hex"))


@register("som_train")
def q_som_train(spark, sf):
    m = som.BatchSOM(20, 20, periodic=True, topology="hex", passes=20).fit(vectors(spark, sf), "features", "vec_id")
    return m.codebook_frame(spark)


@register("som_codebook_roundtrip")
def q_som_codebook_roundtrip(spark, sf):
    m = som.BatchSOM(20, 20, passes=20).fit(vectors(spark, sf), "features", "vec_id")
    path = scratch_path(spark, "som-codebook")
    m.codebook_frame(spark).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# fixed values: the five single models and the ensembles that are fitted on the map's coordinates, in their recorded order
_SOM_FIVE = [("LR", "logistic"), ("DT", "tree"), ("ANN", "mlp"), ("SVC", "linear_svc"), ("SGDC", "sgd_hinge")]
_SOM_ENSEMBLES = [("HGBC", "gbt"), ("RF", "random_forest")]
_SOM_BALANCED = {"BalancedBagging": lambda rows, cols: ensembles.balanced_bagging(rows, cols, n_estimators=10),
                 "BalancedRF": lambda rows, cols: ensembles.balanced_random_forest(rows, cols, n_trees=100),
                 "EasyEnsemble": lambda rows, cols: ensembles.EasyEnsemble(n_bags=10, rounds=50).fit(rows, cols)}


def som_classifiers(train, test, cols):
    """Scores on ``test`` of all classifiers fitted on ``cols`` alone: the five single models without and with under-sampling,
    boosting and a forest, the balanced ensembles, and the hard vote of the five; one row a model."""
    makers = {f"{n}_unsampled": models.pipeline_of(cols, kind, sampler=None, grown=True) for n, kind in _SOM_FIVE}
    makers |= {n: models.pipeline_of(cols, kind, grown=True) for n, kind in _SOM_FIVE + _SOM_ENSEMBLES}
    fitted, _ = models.fit_many(train, makers)
    fitted |= {n: fit(train, cols) for n, fit in _SOM_BALANCED.items()}
    vote = ensembles.VotingModel({n: fitted[n] for n, _ in _SOM_FIVE}, "hard").transform(test)
    columns = ["model", "loan_id", "label", "prediction", "score"]
    long = models.long_predictions(fitted, test, "loan_id", "label").select(*columns)
    long = long.unionByName(vote.withColumn("model", F.lit("HardVote")).select(*columns))
    return metrics.score_many(long.withColumn("model", F.concat("model", F.lit("_on_SOM"))))


@register("som_features_fit")
def q_som_features_fit(spark, sf):
    from loanlab.plans.flows import model_table, split_parts
    df, feats = model_table(spark, sf)
    train, _ = split_parts(df)
    bounds = encode.minmax_fit(train, feats)
    scaled = encode.minmax_apply(df, bounds).withColumn("features", F.array(*[F.col(c) for c in feats]))
    m = som.BatchSOM(20, 20, passes=20).fit(scaled.filter(F.col("is_train") == 1), "features", "loan_id")
    proj = m.project(scaled, "features", keep=["loan_id", "label", "is_train"])
    proj = cut_lineage(proj)   # five narrow columns; every fit reads them several times, without all that made them in its plan
    scores = som_classifiers(*split_parts(proj), ["gx", "gy"])
    return spark.createDataFrame(scores.collect(), scores.schema)   # one row per model


# ------------------------------------------------------------------ chained imputation
_IMP_COLS = ["loan_amnt", "dti", "int_rate", "revol_util", "fico_score", "employment_len", "age", "open_acc",
             "total_acc", "revol_bal"]
_GAPPY = ["revol_util", "employment_len", "open_acc", "total_acc", "revol_bal"]


# what SQL can say of the imputed table: observed cells as they were, no gap left, and imputed cells within the range of observed ones
_IMPUTED_SQL = parsed_sql(body=(
    "SELECT loan_id, CAST(rn < FLOOR(n * 0.75) AS INTEGER) AS is_train, " + ", ".join(f"ROUND(CAST({c} AS DOUBLE), 6) AS {c}" for c in _IMP_COLS)
    + ", CAST(0 AS BIGINT) AS gaps_left, TRUE AS in_range FROM (SELECT *, "
    f"ROW_NUMBER() OVER (ORDER BY {sql_hash_u32('loan_id', 111, 'split')}, loan_id) - 1 AS rn, COUNT(*) OVER () AS n FROM parsed)"))


def _imputed(spark, sf, max_depth, feature_subset):
    from loanlab.operators.sampling import split_flag
    df = split_flag(parsed_loans(spark, sf).select("loan_id", *_IMP_COLS), "loan_id", 0.75, 111).persist()
    train = df.filter(F.col("is_train") == 1).select(*_IMP_COLS)
    model = IterativeTreeImputer(_IMP_COLS, max_depth=max_depth, feature_subset=feature_subset, max_rounds=10).fit(train)
    out = model.transform(df.withColumns({f"_gap_{c}": F.col(c).isNull() for c in _IMP_COLS}))
    ends = train.agg(*[F.min(c).alias(f"lo_{c}") for c in _IMP_COLS], *[F.max(c).alias(f"hi_{c}") for c in _IMP_COLS]).first()
    inside = [~F.col(f"_gap_{c}") | F.col(c).between(float(ends[f"lo_{c}"]) - 1e-6, float(ends[f"hi_{c}"]) + 1e-6) for c in _IMP_COLS]
    left = sum((F.col(c).isNull().cast("long") for c in _IMP_COLS), F.lit(0).cast("long"))
    return rounded(out.select("loan_id", "is_train", *[F.when(~F.col(f"_gap_{c}"), F.col(c)).alias(c) for c in _IMP_COLS], left.alias("gaps_left"),
                              functools.reduce(lambda a, b: a & b, inside).alias("in_range")))


@register("iterative_impute", _IMPUTED_SQL)
def q_iterative_impute(spark, sf):
    return _imputed(spark, sf, 3, "sqrt")


@register("iterative_impute_unbounded", _IMPUTED_SQL)
def q_iterative_impute_unbounded(spark, sf):
    return _imputed(spark, sf, None, "log2")


@register("iterative_impute_mean_start", parsed_sql(body="SELECT loan_id, " + ", ".join(
    f"ROUND(CAST(COALESCE({c}, AVG({c}) OVER ()) AS DOUBLE), 6) AS {c}" for c in _GAPPY) + " FROM parsed"))
def q_iterative_impute_mean_start(spark, sf):
    df = parsed_loans(spark, sf).select("loan_id", *_IMP_COLS)
    model = IterativeTreeImputer(_IMP_COLS, max_rounds=0).fit(df.drop("loan_id"))
    return rounded(model.transform(df).select("loan_id", *_GAPPY))
