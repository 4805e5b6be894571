"""Queries: sampling and splitting and fold score summaries (G10)."""
from __future__ import annotations

from pyspark.sql import functions as F

from loanlab.functions.columns import TWO_32, sql_hash_u32
from loanlab.operators import profile, sampling
from loanlab.plans.registry import register, rounded
from loanlab.plans.sqltext import loans_sql, purchases_sql, scored_sql
from loanlab.sources.fixtures import loans, purchases, scored

SEED = 111


@register("hash_sample", purchases_sql(body=(
    f"SELECT event_id, label FROM purchases WHERE {sql_hash_u32('event_id', SEED)} < {int(0.1 * TWO_32)}")))
def q_hash_sample(spark, sf):
    return sampling.hash_sample(purchases(spark, sf), "event_id", 0.1, SEED).select("event_id", "label")


@register("train_test_split", loans_sql(body=(
    f"SELECT loan_id, CAST(rn < FLOOR(n * 0.75) AS INTEGER) AS is_train FROM ("
    f"SELECT loan_id, ROW_NUMBER() OVER (ORDER BY {sql_hash_u32('loan_id', SEED, 'split')}, loan_id) - 1 AS rn, "
    f"COUNT(*) OVER () AS n FROM loans)")))
def q_train_test_split(spark, sf):
    return sampling.split_flag(loans(spark, sf).select("loan_id"), "loan_id", 0.75, SEED)


@register("train_test_split_threshold", loans_sql(body=(
    f"SELECT loan_id, CAST({sql_hash_u32('loan_id', SEED, 'split')} < {int(0.75 * TWO_32)} AS INTEGER) AS is_train FROM loans")))
def q_train_test_split_threshold(spark, sf):
    return sampling.split_flag(loans(spark, sf).select("loan_id"), "loan_id", 0.75, SEED, exact=False)


@register("stratified_shuffle_split", purchases_sql(body=(
    "SELECT split, event_id, label, CAST(rn < FLOOR(n * 0.25) AS INTEGER) AS is_train FROM ("
    "SELECT split, event_id, label, ROW_NUMBER() OVER (PARTITION BY split, label ORDER BY "
    f"{sql_hash_u32('event_id', SEED, 'sss', 'split')}, event_id) - 1 AS rn, "
    "COUNT(*) OVER (PARTITION BY split, label) AS n "
    "FROM purchases, (SELECT CAST(range AS INTEGER) AS split FROM range(4)) s)")))
def q_stratified_shuffle_split(spark, sf):
    df = purchases(spark, sf).select("event_id", "label")
    return sampling.stratified_shuffle_split(df, "event_id", "label", n_splits=4, train_frac=0.25, seed=SEED)


@register("kfold_assign", loans_sql(body=(
    f"SELECT loan_id, CAST((ROW_NUMBER() OVER (ORDER BY {sql_hash_u32('loan_id', SEED, 'kfold')}, loan_id) - 1) * 3 // COUNT(*) OVER () AS INTEGER) "
    "AS fold FROM loans")))
def q_kfold_assign(spark, sf):
    return sampling.kfold_assign(loans(spark, sf).select("loan_id"), "loan_id", 3, SEED)


@register("stratified_kfold", purchases_sql(body=(
    "SELECT event_id, label, CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY "
    f"{sql_hash_u32('event_id', SEED, 'skfold')}, event_id) - 1) * 5 // COUNT(*) OVER (PARTITION BY label) AS INTEGER) AS fold FROM purchases")))
def q_stratified_kfold(spark, sf):
    return sampling.stratified_kfold(purchases(spark, sf).select("event_id", "label"), "event_id", "label", 5, SEED)


@register("under_sample", purchases_sql(body=(
    "SELECT event_id, label FROM (SELECT event_id, label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY "
    f"{sql_hash_u32('event_id', SEED, 'rus')}, event_id) - 1 AS rn FROM purchases) "
    "WHERE rn < (SELECT MIN(c) FROM (SELECT COUNT(*) AS c FROM purchases GROUP BY label))")))
def q_under_sample(spark, sf):
    return sampling.under_sample(purchases(spark, sf).select("event_id", "label"), "event_id", "label", SEED)


def _over_sql():
    """Poisson draws a minority row; the deficit to the first rows, or the surplus from the first draws, in hash order.
    The Poisson cumulative is summed in SQL."""
    cdf = "list_transform(range(0, 60), lambda k: list_sum(list_transform(range(0, k + 1), lambda j: exp(j * ln(rate) - rate - lgamma(j + 1)))))"
    return purchases_sql(
        "m AS (SELECT COUNT(*) FILTER (WHERE label = 1) AS nmin, COUNT(*) FILTER (WHERE label = 0) - COUNT(*) FILTER (WHERE label = 1) AS nd FROM purchases)",
        "c AS (SELECT nmin, nd, list_filter(" + cdf + ", lambda p: p < 1 - power(2, -40)) AS cdf FROM (SELECT nmin, nd, nd / CAST(nmin AS DOUBLE) AS rate FROM m))",
        f"u AS (SELECT event_id, label, {sql_hash_u32('event_id', SEED, 'ros', '0')} / {TWO_32} AS u FROM purchases WHERE label = 1)",
        "k AS (SELECT event_id, label, len(list_filter(cdf, lambda p: u >= p)) AS k FROM u, c)",
        "s AS (SELECT SUM(k) AS drawn FROM k)",
        f"a AS (SELECT event_id, label, k, ROW_NUMBER() OVER (ORDER BY {sql_hash_u32('event_id', SEED, 'ros-more')}, event_id) - 1 AS rn FROM k)",
        "b AS (SELECT event_id, label, k + greatest(nd - drawn, 0) // nmin + CASE WHEN rn < greatest(nd - drawn, 0) % nmin THEN 1 ELSE 0 END AS k FROM a, m, s)",
        "x AS (SELECT event_id, label, unnest(range(0, CAST(k AS BIGINT))) AS draw FROM b)",
        "n AS (SELECT *, event_id || ':' || draw AS name FROM x)",
        f"o AS (SELECT event_id, label, draw, ROW_NUMBER() OVER (ORDER BY {sql_hash_u32('name', SEED, 'ros-less')}, name) - 1 AS rn FROM n)",
        body=("SELECT event_id, label, CAST(NULL AS BIGINT) AS draw FROM purchases UNION ALL "
              "SELECT event_id, label, draw FROM o, m, s WHERE rn >= greatest(drawn - nd, 0)"))


@register("over_sample", _over_sql())
def q_over_sample(spark, sf):
    return sampling.over_sample(purchases(spark, sf).select("event_id", "label"), "event_id", "label", SEED)


def _bags_sql():
    w = sampling.bag_weight_sql("loan_id", SEED, "bag", 1.0)
    return loans_sql(body=(
        f"SELECT bag, loan_id, weight FROM (SELECT bag, loan_id, {w} AS weight FROM loans, "
        "(SELECT CAST(range AS INTEGER) AS bag FROM range(10)) b) WHERE weight > 0"))


@register("bootstrap_bags", _bags_sql())
def q_bootstrap_bags(spark, sf):
    return sampling.bootstrap_bags(loans(spark, sf), "loan_id", n_bags=10, fraction=1.0, seed=SEED)


def _fold_scores(spark, sf):
    s = sampling.kfold_assign(scored(spark, sf), "loan_id", 5, SEED)
    rules = {"amount_gt_0_5": F.col("score") > 0.5, "amount_gt_0_3": F.col("score") > 0.3}
    parts = None
    for name, rule in rules.items():
        p = s.groupBy("fold").agg(
            (F.sum(F.when(rule & (F.col("label") == 1), 1).otherwise(0))
             / F.sum(F.when(F.col("label") == 1, 1).otherwise(0))).alias("score")) \
            .withColumn("model", F.lit(name))
        parts = p if parts is None else parts.unionByName(p)
    return parts


def _fold_sql():
    parts = []
    for name, thr in [("amount_gt_0_5", 0.5), ("amount_gt_0_3", 0.3)]:
        parts.append(f"SELECT '{name}' AS model, fold, SUM(CASE WHEN score > {thr} AND label = 1 THEN 1 ELSE 0 END) / "
                     "SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS score FROM f GROUP BY fold")
    return scored_sql(
        f"f AS (SELECT *, CAST((ROW_NUMBER() OVER (ORDER BY {sql_hash_u32('loan_id', SEED, 'kfold')}, loan_id) - 1) * 5 // COUNT(*) OVER () AS INTEGER) AS fold FROM scored)",
        f"fs AS ({' UNION ALL '.join(parts)})",
        body=("SELECT model, ROUND(AVG(score), 6) AS mean_score, ROUND(STDDEV_POP(score), 6) AS std_score, COUNT(*) AS n_folds, "
              "CAST(arg_max(fold, score * 1000 - fold) AS INTEGER) AS best_fold, ROUND(MAX(score), 6) AS best_score FROM fs GROUP BY model"))


@register("fold_score_summary", _fold_sql())
def q_fold_score_summary(spark, sf):
    return rounded(profile.fold_score_summary(_fold_scores(spark, sf)))
