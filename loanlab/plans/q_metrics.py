"""Queries: evaluation metrics on the ``scored`` and ``votes``
fixtures, and vote combiners (L1, L2)."""
from __future__ import annotations

from pyspark.sql import functions as F

from loanlab.operators import ensembles, metrics
from loanlab.operators.metrics import (
    ACCURACY, BALANCED_ACCURACY, F1_0, F1_1, F1_WEIGHTED, KAPPA, MCC, N, PREC0, PREC1, REC0, REC1, SPEC0,
    SPEC1, SUP0, SUP1, THRESHOLD_METRICS, _geo, _iba, _safe,
)
from loanlab.plans.registry import register, rounded
from loanlab.plans.sqltext import scored_sql, votes_sql
from loanlab.sources.fixtures import scored, votes

COUNTS = ("c AS (SELECT CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp, "
          "CAST(SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp, "
          "CAST(SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn, "
          "CAST(SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn FROM scored)")


def _r(e, name):
    return f"ROUND({e}, 6) AS {name}"


@register("confusion_matrix", scored_sql(body=(
    "SELECT v.label, v.prediction, COUNT(s.label) AS count "
    "FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(label, prediction) "
    "LEFT JOIN scored s ON s.label = v.label AND s.prediction = v.prediction GROUP BY 1, 2")))
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(scored(spark, sf))


def _report_sql():
    rows = [("'0'", PREC0, REC0, F1_0, SUP0), ("'1'", PREC1, REC1, F1_1, SUP1),
            ("'accuracy'", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", ACCURACY, N),
            ("'macro avg'", f"(({PREC0}) + ({PREC1})) / 2", f"(({REC0}) + ({REC1})) / 2", f"(({F1_0}) + ({F1_1})) / 2", N),
            ("'weighted avg'", _safe(f"({PREC0}) * ({SUP0}) + ({PREC1}) * ({SUP1})", N),
             _safe(f"({REC0}) * ({SUP0}) + ({REC1}) * ({SUP1})", N), F1_WEIGHTED, N)]
    parts = [f"SELECT {c} AS class, {_r(p, 'precision')}, {_r(r, 'recall')}, {_r(f, 'f1')}, CAST({s} AS BIGINT) AS support FROM c"
             for c, p, r, f, s in rows]
    return scored_sql(COUNTS, body=" UNION ALL ".join(parts))


@register("classification_report", _report_sql())
def q_classification_report(spark, sf):
    return rounded(metrics.classification_report(scored(spark, sf)))


def _imb_sql():
    cls = {"0": (PREC0, REC0, SPEC0, F1_0, SUP0), "1": (PREC1, REC1, SPEC1, F1_1, SUP1)}
    parts = []
    vals = {}
    for k, (p, r, s, f, sup) in cls.items():
        vals[k] = dict(pre=p, rec=r, spe=s, f1=f, geo=_geo(r, s), iba=_iba(r, s))
        parts.append(f"SELECT '{k}' AS class, " + ", ".join(_r(e, n) for n, e in vals[k].items())
                     + f", CAST({sup} AS BIGINT) AS sup FROM c")
    avg = {n: _safe(f"({vals['0'][n]}) * ({SUP0}) + ({vals['1'][n]}) * ({SUP1})", N) for n in vals["0"]}
    parts.append("SELECT 'avg / total' AS class, " + ", ".join(_r(e, n) for n, e in avg.items())
                 + f", CAST({N} AS BIGINT) AS sup FROM c")
    return scored_sql(COUNTS, body=" UNION ALL ".join(parts))


@register("imbalanced_report", _imb_sql())
def q_imbalanced_report(spark, sf):
    return rounded(metrics.imbalanced_report(scored(spark, sf)))


@register("recall_score", scored_sql(COUNTS, body=f"SELECT {_r(REC1, 'recall')} FROM c"))
def q_recall_score(spark, sf):
    return rounded(metrics.recall_score(scored(spark, sf)))


@register("mcc_kappa", scored_sql(COUNTS, body=(
    f"SELECT {_r(ACCURACY, 'accuracy')}, {_r(MCC, 'mcc')}, {_r(KAPPA, 'kappa')}, {_r(F1_WEIGHTED, 'f1_weighted')}, "
    f"{_r(BALANCED_ACCURACY, 'balanced_accuracy')} FROM c")))
def q_mcc_kappa(spark, sf):
    return rounded(metrics.mcc_kappa(scored(spark, sf)))


AUC_SQL = ("d AS (SELECT {by}score AS s, CAST(SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos, "
           "CAST(SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg FROM {src} WHERE score IS NOT NULL GROUP BY {by}score), "
           "r AS (SELECT *, SUM(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM d)")


@register("roc_auc", scored_sql(AUC_SQL.format(by="", src="scored", part=""), body=(
    "SELECT ROUND(SUM(pos * (cum_neg - neg + neg / 2)) / (SUM(pos) * SUM(neg)), 6) AS auc FROM r")))
def q_roc_auc(spark, sf):
    return rounded(metrics.roc_auc(scored(spark, sf)))


_CURVE = ("d AS (SELECT score AS s, CAST(SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos, "
          "CAST(SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg FROM scored WHERE score IS NOT NULL GROUP BY score), "
          "r AS (SELECT s, SUM(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos, "
          "SUM(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg, "
          "SUM(pos) OVER () AS P, SUM(neg) OVER () AS Nn FROM d)")


@register("roc_curve", scored_sql(_CURVE, body=(
    "SELECT ROUND(s, 6) AS threshold, ROUND(cum_neg / Nn, 6) AS fpr, ROUND(cum_pos / P, 6) AS tpr, "
    "CAST(cum_pos AS BIGINT) AS tp, CAST(cum_neg AS BIGINT) AS fp FROM r")))
def q_roc_curve(spark, sf):
    return rounded(metrics.roc_curve(scored(spark, sf)))


@register("pr_curve", scored_sql(_CURVE, body=(
    "SELECT ROUND(s, 6) AS threshold, ROUND(cum_pos / (cum_pos + cum_neg), 6) AS precision, "
    "ROUND(cum_pos / P, 6) AS recall FROM r")))
def q_pr_curve(spark, sf):
    return rounded(metrics.pr_curve(scored(spark, sf)))


# ------------------------------------------------------------------ many models at once
def _votes_long(spark, sf):
    v = votes(spark, sf)
    parts = [v.select(F.lit(f"rule{i}").alias("model"), "loan_id", "label",
                      F.col(f"v{i}").alias("prediction"), F.col(f"s{i}").alias("score")) for i in range(1, 6)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _score_many_sql():
    longp = " UNION ALL ".join(f"SELECT 'rule{i}' AS model, loan_id, label, v{i} AS prediction, s{i} AS score FROM votes"
                               for i in range(1, 6))
    cnt = ("cm AS (SELECT model, CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp, "
           "CAST(SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp, "
           "CAST(SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn, "
           "CAST(SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn FROM lv GROUP BY model)")
    auc = AUC_SQL.format(by="model, ", src="lv", part="PARTITION BY model ")
    a = ("au AS (SELECT model, SUM(pos * (cum_neg - neg + neg / 2)) / (SUM(pos) * SUM(neg)) AS auc FROM r GROUP BY model)")
    mets = ", ".join(_r(e, k) for k, e in THRESHOLD_METRICS.items())
    return votes_sql(f"lv AS ({longp})", cnt, auc, a, body=(
        "SELECT cm.model, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, "
        f"CAST(fn AS BIGINT) AS fn, {mets}, ROUND(au.auc, 6) AS auc FROM cm LEFT JOIN au ON cm.model = au.model"))


@register("score_many", _score_many_sql())
def q_score_many(spark, sf):
    return rounded(metrics.score_many(_votes_long(spark, sf)))


@register("hard_vote", votes_sql(body=(
    "SELECT loan_id, label, CASE WHEN v1 + v2 + v3 + v4 + v5 > 2.5 THEN 1 ELSE 0 END AS prediction FROM votes")))
def q_hard_vote(spark, sf):
    v = votes(spark, sf)
    return ensembles.hard_vote(v, [f"v{i}" for i in range(1, 6)]).select("loan_id", "label", "prediction")


@register("soft_vote", votes_sql(body=(
    "SELECT loan_id, label, ROUND((s1 + s2 + s3 + s4 + s5) / 5, 6) AS score, "
    "CASE WHEN (s1 + s2 + s3 + s4 + s5) / 5 > 0.5 THEN 1 ELSE 0 END AS prediction FROM votes")))
def q_soft_vote(spark, sf):
    v = votes(spark, sf)
    return rounded(ensembles.soft_vote(v, [f"s{i}" for i in range(1, 6)]).select("loan_id", "label", "score", "prediction"))
