"""Threshold metrics from the nine recorded confusion matrices ([[tn, fp], [fn, tp]]),
against accuracy / MCC / kappa recomputed to four decimals."""
import pytest
from pyspark.sql import functions as F

from loanlab.operators import metrics

# fixed values: recorded matrices and their recomputed accuracy, MCC, kappa
GOLDEN = [
    ((293692, 3389, 67749, 4231), (0.8072, 0.1320, 0.0716)),
    ((239923, 131330, 28751, 61322), (0.6530, 0.2629, 0.2285)),
    ((293771, 77482, 49144, 40929), (0.7255, 0.2230, 0.2195)),
    ((242935, 128318, 32182, 57891), (0.6521, 0.2400, 0.2116)),
    ((235479, 135774, 29776, 60297), (0.6411, 0.2435, 0.2101)),
    ((214504, 156749, 35684, 54389), (0.5829, 0.1445, 0.1204)),
    ((211599, 159654, 38973, 51100), (0.5694, 0.1092, 0.0911)),
    ((254099, 117154, 42728, 47345), (0.6534, 0.1738, 0.1600)),
    ((244589, 126664, 32902, 57171), (0.6541, 0.2377, 0.2105)),
]


@pytest.mark.parametrize("cm,expected", GOLDEN)
def test_golden_matrix(spark, cm, expected):
    tn, fp, fn, tp = cm
    counts = spark.createDataFrame([(float(tp), float(fp), float(tn), float(fn))], "tp double, fp double, tn double, fn double")
    r = metrics.metrics_from_counts(counts).collect()[0]
    assert round(r["accuracy"], 4) == pytest.approx(expected[0], abs=1e-4)
    assert round(r["mcc"], 4) == pytest.approx(expected[1], abs=1e-4)
    assert round(r["kappa"], 4) == pytest.approx(expected[2], abs=1e-4)


def test_report_rows_and_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    rep = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0  # 0/0 -> 0
    assert rep["accuracy"]["f1"] == pytest.approx(2 / 3)
    cm = {(r["label"], r["prediction"]): r["count"] for r in metrics.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from paths import SF_MID
    from loanlab.sources.fixtures import scored
    s = scored(spark, SF_MID)
    ours = metrics.roc_auc(s).collect()[0]["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    theirs = ev.evaluate(s.withColumn("label", F.col("label").cast("double")))
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_imbalanced_report_formulas(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 4 + [(0, 1)] * 2, "label int, prediction int")
    r = {x["class"]: x for x in metrics.imbalanced_report(df).collect()}
    rec, spe = 3 / 4, 4 / 6
    assert r["1"]["geo"] == pytest.approx((rec * spe) ** 0.5)
    assert r["1"]["iba"] == pytest.approx((1 + 0.1 * (rec - spe)) * rec * spe)
    assert r["avg / total"]["sup"] == 10


def test_ranking_of_all_distinct_scores(spark):
    """Running totals over range partitions, with groups, against a plain count."""
    import numpy as np
    rng = np.random.default_rng(4)
    s, y, g = rng.normal(size=4000), (rng.random(4000) < 0.3).astype(int), rng.integers(0, 3, 4000)
    df = spark.createDataFrame([(float(a), int(b), int(c) if c else None) for a, b, c in zip(s, y, g)], "score double, label int, model int").repartition(5)
    for r in metrics.roc_auc(df, by=["model"]).collect():
        m = g == (r.model or 0)
        pos, neg = s[m & (y == 1)], np.sort(s[m & (y == 0)])
        assert r.auc == pytest.approx(np.searchsorted(neg, pos).sum() / (len(pos) * len(neg)), abs=1e-12)
    order = np.argsort(-s)
    curve = metrics.roc_curve(df).orderBy(F.col("threshold").desc()).collect()
    assert [r.tp for r in curve] == np.cumsum(y[order]).tolist() and [r.fp for r in curve] == np.cumsum(1 - y[order]).tolist()
