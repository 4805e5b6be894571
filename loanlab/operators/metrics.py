"""Evaluation: confusion counts and every metric derived from them, ranking
metrics (ROC AUC, ROC and precision-recall curves) and many-model scoring.

All threshold metrics are arithmetic on four counts from ONE aggregation
(``tp, fp, tn, fn``).  The formulas below are plain SQL expressions over those
counts, used as they are by Spark (``F.expr``) and by the DuckDB oracle.

Ranking metrics need running totals over distinct scores.  Scores are first
aggregated per distinct value (partial aggregation), then range-partitioned;
running totals are the totals of earlier partitions plus a window inside each
partition, so no single task ever sees all distinct scores.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlab.session import cut_lineage

from loanlab.functions.constants import IMBALANCED_REPORT_ALPHA


def _safe(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE ({num}) / ({den}) END"


def _f1(p: str, r: str) -> str:
    return f"CASE WHEN ({p}) + ({r}) = 0 THEN 0.0 ELSE 2 * ({p}) * ({r}) / (({p}) + ({r})) END"


# per-class metrics over counts (tp, fp, tn, fn as doubles); class 0 swaps roles
PREC1, REC1 = _safe("tp", "tp + fp"), _safe("tp", "tp + fn")
PREC0, REC0 = _safe("tn", "tn + fn"), _safe("tn", "tn + fp")
SPEC1, SPEC0 = REC0, REC1
SUP1, SUP0 = "tp + fn", "tn + fp"
N = "tp + fp + tn + fn"
ACCURACY = _safe("tp + tn", N)
MCC = _safe("tp * tn - fp * fn", "SQRT((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))")
PE = f"((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (({N}) * ({N}))"
KAPPA = _safe(f"{ACCURACY} - {PE}", f"1 - {PE}")
F1_1, F1_0 = _f1(PREC1, REC1), _f1(PREC0, REC0)
F1_WEIGHTED = _safe(f"({F1_0}) * ({SUP0}) + ({F1_1}) * ({SUP1})", N)
BALANCED_ACCURACY = f"(({REC0}) + ({REC1})) / 2"

THRESHOLD_METRICS = {
    "accuracy": ACCURACY, "precision": PREC1, "recall": REC1, "specificity": SPEC1, "f1": F1_1,
    "f1_weighted": F1_WEIGHTED, "balanced_accuracy": BALANCED_ACCURACY, "mcc": MCC, "kappa": KAPPA,
}


def _geo(rec: str, spe: str) -> str:
    return f"SQRT(({rec}) * ({spe}))"


def _iba(rec: str, spe: str, alpha: float = IMBALANCED_REPORT_ALPHA) -> str:
    return f"(1 + {alpha} * (({rec}) - ({spe}))) * ({rec}) * ({spe})"


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn, fn (doubles) for a 0/1 label and prediction, per ``by`` group."""
    y, p = F.col(label), F.col(prediction)
    aggs = [F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("double").alias("tp"),
            F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("double").alias("fp"),
            F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("double").alias("tn"),
            F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("double").alias("fn")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All four cells, zero cells included: (label, prediction, count)."""
    c = confusion_counts(df, label, prediction)
    return c.selectExpr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (label, prediction, count)") \
            .select(F.col("label").cast("int"), F.col("prediction").cast("int"), F.col("count").cast("long"))


def metrics_from_counts(counts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return counts.select(*keep, *[F.col(c).cast("long").alias(c) for c in ["tp", "fp", "tn", "fn"]],
                         *[F.expr(e).alias(k) for k, e in THRESHOLD_METRICS.items()])


def threshold_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: counts, accuracy, precision, recall, specificity, F1, weighted F1,
    balanced accuracy, Matthews correlation, Cohen's kappa."""
    return metrics_from_counts(confusion_counts(df, label, prediction))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows '0', '1', 'accuracy', 'macro avg', 'weighted avg' with precision,
    recall, f1, support (0/0 gives 0; accuracy sits in the f1 column)."""
    c = confusion_counts(df, label, prediction)
    rows = [
        ("'0'", PREC0, REC0, F1_0, SUP0),
        ("'1'", PREC1, REC1, F1_1, SUP1),
        ("'accuracy'", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", ACCURACY, N),
        ("'macro avg'", f"(({PREC0}) + ({PREC1})) / 2", f"(({REC0}) + ({REC1})) / 2", f"(({F1_0}) + ({F1_1})) / 2", N),
        ("'weighted avg'", _safe(f"({PREC0}) * ({SUP0}) + ({PREC1}) * ({SUP1})", N),
         _safe(f"({REC0}) * ({SUP0}) + ({REC1}) * ({SUP1})", N), F1_WEIGHTED, N),
    ]
    stack = ", ".join(", ".join(r) for r in rows)
    return c.selectExpr(f"stack(5, {stack}) AS (class, precision, recall, f1, support)") \
            .withColumn("support", F.col("support").cast("long"))


def imbalanced_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows '0', '1', 'avg / total': pre, rec, spe, f1, geo, iba, sup; the last row
    is support-weighted."""
    c = confusion_counts(df, label, prediction)
    cls = {
        "0": dict(pre=PREC0, rec=REC0, spe=SPEC0, f1=F1_0, geo=_geo(REC0, SPEC0), iba=_iba(REC0, SPEC0), sup=SUP0),
        "1": dict(pre=PREC1, rec=REC1, spe=SPEC1, f1=F1_1, geo=_geo(REC1, SPEC1), iba=_iba(REC1, SPEC1), sup=SUP1),
    }
    keys = ["pre", "rec", "spe", "f1", "geo", "iba"]
    avg = {k: _safe(f"({cls['0'][k]}) * ({SUP0}) + ({cls['1'][k]}) * ({SUP1})", N) for k in keys}
    rows = [("'0'", *[cls["0"][k] for k in keys], SUP0), ("'1'", *[cls["1"][k] for k in keys], SUP1),
            ("'avg / total'", *[avg[k] for k in keys], N)]
    stack = ", ".join(", ".join(r) for r in rows)
    return c.selectExpr(f"stack(3, {stack}) AS (class, pre, rec, spe, f1, geo, iba, sup)") \
            .withColumn("sup", F.col("sup").cast("long"))


def recall_score(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return confusion_counts(df, label, prediction).select(F.expr(REC1).alias("recall"))


def mcc_kappa(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return confusion_counts(df, label, prediction).select(
        F.expr(ACCURACY).alias("accuracy"), F.expr(MCC).alias("mcc"), F.expr(KAPPA).alias("kappa"),
        F.expr(F1_WEIGHTED).alias("f1_weighted"), F.expr(BALANCED_ACCURACY).alias("balanced_accuracy"))


# ------------------------------------------------------------------ ranking metrics
def _score_counts(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    y = F.col(label)
    return (df.filter(F.col(score).isNotNull())
              .groupBy(*by, F.col(score).cast("double").alias("s"))
              .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("double").alias("pos"),
                   F.sum(F.when(y == 1, 0).otherwise(1)).cast("double").alias("neg")))


def running_totals(d: DataFrame, order: str, cols: Sequence[str], by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Inclusive running sums ``cum_<c>`` of ``cols`` in ``order`` (unique within ``by``).

    The rows are range-partitioned by group and order; a group's total before a partition is the sum over its earlier
    partitions (one row for each group and partition), to which a window within the partition adds.
    """
    by = list(by)
    o = F.col(order).desc() if descending else F.col(order).asc()
    dealt = cut_lineage(d.repartitionByRange(*by, o).withColumn("_part", F.spark_partition_id()))
    total = dealt.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_at"), *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0.0)).alias(f"_o_{c}") for c in cols])
    same = F.col("_part") == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    within = Window.partitionBy(*by, "_part").orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.join(total, same).select(*d.columns, *[(F.col(f"_o_{c}") + F.sum(c).over(within)).alias(f"cum_{c}") for c in cols])


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with ties counted half (Mann-Whitney); one row
    per ``by`` group."""
    by = list(by)
    d = _score_counts(df, label, score, by).persist()   # distinct scores, read twice
    r = running_totals(d, "s", ["neg"], by)
    part = r.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2)).alias("_a"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_a") / (F.col("_p") * F.col("_n")))
    res = part.select(*by, auc.alias("auc"))
    out = df.sparkSession.createDataFrame(res.collect(), res.schema)   # one row per group
    d.unpersist()
    return out


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score, thresholds descending: (threshold, fpr, tpr,
    tp, fp); a point means "predict 1 when score >= threshold"."""
    d = _score_counts(df, label, score, [])
    r = running_totals(d, "s", ["pos", "neg"], descending=True)
    t = d.agg(F.sum("pos").alias("P"), F.sum("neg").alias("Nn")).collect()[0]   # two numbers
    P, Nn = t["P"] or 0.0, t["Nn"] or 0.0
    return r.select(F.col("s").alias("threshold"),
                    (F.col("cum_neg") / F.lit(Nn) if Nn else F.lit(None).cast("double")).alias("fpr"),
                    (F.col("cum_pos") / F.lit(P) if P else F.lit(None).cast("double")).alias("tpr"),
                    F.col("cum_pos").cast("long").alias("tp"), F.col("cum_neg").cast("long").alias("fp"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score, thresholds descending: (threshold, precision,
    recall)."""
    d = _score_counts(df, label, score, [])
    r = running_totals(d, "s", ["pos", "neg"], descending=True)
    P = d.agg(F.sum("pos").alias("P")).collect()[0]["P"] or 0.0   # one number
    return r.select(F.col("s").alias("threshold"),
                    (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    (F.col("cum_pos") / F.lit(P) if P else F.lit(None).cast("double")).alias("recall"))


def score_many(long: DataFrame, model: str = "model", label: str = "label", prediction: str = "prediction",
               score: str | None = "score") -> DataFrame:
    """All threshold metrics (+ AUC when ``score`` is given) per model from one
    long frame (model, key, label, prediction, score): one aggregation by model."""
    cols = [model, label, prediction] + ([score] if score else [])
    long = long.select(*cols).persist()          # read by two aggregations
    m = metrics_from_counts(confusion_counts(long, label, prediction, by=[model]), keep=[model])
    if score:
        m = m.join(roc_auc(long, label, score, by=[model]), model, "left")
    out = long.sparkSession.createDataFrame(m.collect(), m.schema)   # one row per model
    long.unpersist()
    return out
