"""Queries: aggregation and profiling, joins, sort and top-k."""
from __future__ import annotations

from loanlab.operators import profile
from loanlab.plans.flows import parsed_loans
from loanlab.plans.registry import register, rounded
from loanlab.plans.sqltext import loans_sql, parsed_sql, union_all
from loanlab.sources import tables
from loanlab.sources.fixtures import loans

_DESC = ["loan_amnt", "dti", "int_rate", "revol_util", "age", "revol_bal"]


def _describe_sql():
    parts = [f"SELECT '{c}' AS feature, COUNT({c}) AS count, AVG({c}) AS mean, STDDEV_SAMP({c}) AS std, "
             f"CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
             f"quantile_cont({c}, 0.75) AS q75, CAST(MAX({c}) AS DOUBLE) AS max FROM parsed" for c in _DESC]
    r = ", ".join(f"ROUND({c}, 6) AS {c}" for c in ["mean", "std", "min", "q25", "q50", "q75", "max"])
    return parsed_sql(body=f"SELECT feature, count, {r} FROM ({union_all(parts)})")


@register("describe", _describe_sql())
def q_describe(spark, sf):
    return rounded(profile.describe(parsed_loans(spark, sf), _DESC))


_QCOLS = ["l_extendedprice", "l_quantity", "l_discount"]
_PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]


@register("quantiles", "SELECT feature, prob, ROUND(value, 6) AS value FROM (" + union_all(
    [f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS prob, quantile_cont({c}, {p}) AS value FROM lineitem"
     for c in _QCOLS for p in _PROBS]) + ")")
def q_quantiles(spark, sf):
    li = tables.table(spark, sf, "lineitem")
    return rounded(profile.quantile_table(li, _QCOLS, _PROBS))


_CATS = ["emp_length", "home_ownership", "purpose", "segment", "loan_status", "earliest_cr_line"]


@register("category_cardinality", loans_sql(body=union_all(
    [f"SELECT '{c}' AS feature, CAST(COUNT(DISTINCT {c}) + MAX(CAST({c} IS NULL AS INTEGER)) AS BIGINT) AS n_levels FROM loans"
     for c in _CATS])))
def q_category_cardinality(spark, sf):
    return profile.category_cardinality(loans(spark, sf), _CATS)


@register("value_counts", loans_sql(body="SELECT home_ownership, COUNT(*) AS count FROM loans "
                                         "WHERE home_ownership IS NOT NULL GROUP BY 1"))
def q_value_counts(spark, sf):
    return profile.value_counts(loans(spark, sf), "home_ownership")


_CORR = ["loan_amnt", "dti", "int_rate", "revol_util", "fico_score", "age", "open_acc", "total_acc",
         "revol_bal", "y_signal"]


def _corr_sql(where=""):
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM parsed"
             for i, a in enumerate(_CORR) for b in _CORR[i + 1:]]
    return parsed_sql(body=f"SELECT col_a, col_b, ROUND(r, 6) AS r FROM ({union_all(parts)}) {where}")


@register("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf):
    return rounded(profile.correlation_matrix(parsed_loans(spark, sf), _CORR, method="comoments"))


@register("correlation_pairs_direct", parsed_sql(body="SELECT col_a, col_b, ROUND(r, 6) AS r FROM (" + union_all(
    [f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM parsed"
     for i, a in enumerate(_CORR[:6]) for b in _CORR[i + 1:6]]) + ")"))
def q_correlation_direct(spark, sf):
    return rounded(profile.correlation_matrix(parsed_loans(spark, sf), _CORR[:6], method="pairs"))


@register("correlated_pairs", _corr_sql("WHERE r > 0.5 AND r < 1"))
def q_correlated_pairs(spark, sf):
    c = profile.correlation_matrix(parsed_loans(spark, sf), _CORR, method="comoments")
    return rounded(profile.correlated_pairs(c, 0.5, 1.0))


_HIST = ["loan_amnt", "revol_bal", "age"]


def _hist_sql():
    parts = []
    for c in _HIST:
        parts.append(
            f"SELECT '{c}' AS feature, bin, mn, mx, y_signal FROM (SELECT y_signal, mn, mx, "
            f"CAST(CASE WHEN mx = mn THEN 0 ELSE LEAST(FLOOR((CAST({c} AS DOUBLE) - mn) / (mx - mn) * 10), 9) END AS INTEGER) AS bin "
            f"FROM loans, (SELECT CAST(MIN({c}) AS DOUBLE) AS mn, CAST(MAX({c}) AS DOUBLE) AS mx FROM loans) WHERE {c} IS NOT NULL)")
    return loans_sql(body=(
        "SELECT feature, bin, ROUND(mn + (mx - mn) * bin / 10, 6) AS bin_lo, ROUND(mn + (mx - mn) * (bin + 1) / 10, 6) AS bin_hi, "
        f"y_signal, COUNT(*) AS count FROM ({union_all(parts)}) GROUP BY feature, bin, mn, mx, y_signal"))


@register("histogram_by_class", _hist_sql())
def q_histogram_by_class(spark, sf):
    return rounded(profile.histogram_by_class(loans(spark, sf), _HIST, "y_signal", bins=10))


def _box_sql():
    parts = []
    for c in _HIST:
        parts.append(f"""
SELECT y_signal, '{c}' AS feature, q1, median, q3, q3 - q1 AS iqr,
  (SELECT CAST(MIN({c}) AS DOUBLE) FROM loans l WHERE l.y_signal = s.y_signal AND {c} >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
  (SELECT CAST(MAX({c}) AS DOUBLE) FROM loans l WHERE l.y_signal = s.y_signal AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  (SELECT COUNT(*) FROM loans l WHERE l.y_signal = s.y_signal AND ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM (SELECT y_signal, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
             quantile_cont({c}, 0.75) AS q3 FROM loans GROUP BY y_signal) s""")
    r = ", ".join(f"ROUND({c}, 6) AS {c}" for c in ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"])
    return loans_sql(body=f"SELECT y_signal, feature, {r}, n_outliers FROM ({union_all(parts)})")


@register("boxplot_by_class", _box_sql())
def q_boxplot_by_class(spark, sf):
    return rounded(profile.boxplot_by_class(loans(spark, sf), _HIST, "y_signal"))


@register("top_k", loans_sql(body="SELECT loan_id, revol_bal, loan_amnt FROM loans "
                                  "ORDER BY revol_bal DESC NULLS LAST, loan_id LIMIT 20"))
def q_top_k(spark, sf):
    return profile.top_k(loans(spark, sf).select("loan_id", "revol_bal", "loan_amnt"), "revol_bal", 20, "loan_id")
