"""Queries: sources/sinks, projections, parsing, filters, outliers, missing data,
encoding (SURVEY 2.1 - 2.4)."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlab.functions.constants import (
    FEATURE_SET_1, FEATURE_SET_2, FEATURE_SET_3, FEATURE_SET_4, FEATURE_SETS_REMOVED,
)
from loanlab.operators import clean, encode, missing
from loanlab.plans.flows import parsed_loans
from loanlab.plans.registry import register, rounded
from loanlab.plans.sqltext import loans_sql, parsed_sql, union_all
from loanlab.session import scratch_path
from loanlab.sources import tables
from loanlab.sources.fixtures import LOAN_COLUMNS, loans
from loanlab.functions.columns import sql_hash_u32, hash_u32

LOAN_SCHEMA = ("loan_id bigint, loan_amnt double, dti double, int_rate string, revol_util string, "
               "fico_range_low bigint, fico_range_high bigint, emp_length string, home_ownership string, "
               "earliest_cr_line string, purpose string, segment string, age bigint, open_acc bigint, "
               "total_acc double, revol_bal double, loan_status string, y_signal int")

_ALL_LOANS = loans_sql(body=f"SELECT {', '.join(LOAN_COLUMNS)} FROM loans")


# ------------------------------------------------------------------ A: sources / sinks
@register("csv_roundtrip", _ALL_LOANS)
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "loans-csv")
    tables.write_table(loans(spark, sf), path, fmt="csv")
    return tables.read_table(spark, path, schema=LOAN_SCHEMA, fmt="csv")


@register("csv_gzip_roundtrip", _ALL_LOANS)
def q_csv_gzip_roundtrip(spark, sf):
    path = scratch_path(spark, "loans-csv-gz")
    tables.write_table(loans(spark, sf), path, fmt="csv", gzip=True)
    return tables.read_table(spark, path + "/*.csv.gz", schema=LOAN_SCHEMA, fmt="csv",
                             min_partitions=spark.sparkContext.defaultParallelism)


@register("aligned_files", loans_sql(body="SELECT loan_id, ROUND(loan_amnt, 6) AS loan_amnt, age, y_signal FROM loans"))
def q_aligned_files(spark, sf):
    """Features and label written to two CSV folders and read back side by side, by position alone."""
    x, y = scratch_path(spark, "aligned-x-csv"), scratch_path(spark, "aligned-y-csv")
    df = loans(spark, sf)
    tables.write_aligned(df, ["loan_id", "loan_amnt", "age"], "y_signal", "loan_id", x, y)
    kinds = {f.name: f for f in df.schema}
    kind = lambda *names: T.StructType([kinds[n] for n in names])
    return rounded(tables.read_aligned(spark, x, y, kind("loan_id", "loan_amnt", "age"), kind("y_signal")))


@register("column_subset", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def q_column_subset(spark, sf):
    return tables.read_table(spark, f"{sf}/lineitem.parquet", columns=["l_orderkey", "l_quantity", "l_returnflag"])


# ------------------------------------------------------------------ B: projections
_SETS_COLS = [c for c in LOAN_COLUMNS
              if c in (FEATURE_SET_1 | FEATURE_SET_2 | FEATURE_SET_3 | FEATURE_SET_4) - FEATURE_SETS_REMOVED]


@register("feature_sets", loans_sql(body=f"SELECT {', '.join(_SETS_COLS)} FROM loans"))
def q_feature_sets(spark, sf):
    return clean.resolve_columns(loans(spark, sf), [FEATURE_SET_1, FEATURE_SET_2, FEATURE_SET_3, FEATURE_SET_4],
                                 FEATURE_SETS_REMOVED, missing="ignore")


_DROPPED = ["fico_range_low", "fico_range_high", "emp_length"]


@register("drop_columns", loans_sql(body=f"SELECT {', '.join(c for c in LOAN_COLUMNS if c not in _DROPPED)} FROM loans"))
def q_drop_columns(spark, sf):
    return clean.drop_columns(loans(spark, sf), _DROPPED)


@register("numeric_columns", loans_sql(body="SELECT loan_id, loan_amnt, dti, fico_range_low, fico_range_high, age, "
                                            "open_acc, total_acc, revol_bal, y_signal FROM loans"))
def q_numeric_columns(spark, sf):
    return clean.select_numeric(loans(spark, sf), keep=["loan_id"])


@register("range_midpoint", loans_sql(body="SELECT loan_id, CAST((fico_range_low + fico_range_high) / 2 AS DOUBLE) AS fico_score, "
                                           "CAST(fico_range_low + FLOOR(fico_range_high / 2) AS DOUBLE) AS fico_score_compat FROM loans"))
def q_range_midpoint(spark, sf):
    df = clean.range_midpoint(loans(spark, sf), "fico_range_low", "fico_range_high", "fico_score", drop=False)
    df = clean.range_midpoint(df, "fico_range_low", "fico_range_high", "fico_score_compat", compat=True)
    return df.select("loan_id", "fico_score", "fico_score_compat")


@register("parse_percent", parsed_sql(body="SELECT loan_id, int_rate, revol_util FROM parsed"))
def q_parse_percent(spark, sf):
    return clean.parse_percent_columns(loans(spark, sf), ["int_rate", "revol_util"]).select("loan_id", "int_rate", "revol_util")


@register("parse_year", parsed_sql(body="SELECT loan_id, earliest_cr_line FROM parsed"))
def q_parse_year(spark, sf):
    return clean.parse_year_column(loans(spark, sf), "earliest_cr_line").select("loan_id", "earliest_cr_line")


@register("ordinal_map", parsed_sql(body="SELECT loan_id, employment_len FROM parsed"))
def q_ordinal_map(spark, sf):
    return clean.employment_length(loans(spark, sf)).select("loan_id", "employment_len")


@register("consolidate_categories", parsed_sql(body="SELECT loan_id, home_status FROM parsed"))
def q_consolidate(spark, sf):
    return clean.consolidate_home(loans(spark, sf)).select("loan_id", "home_status")


@register("binary_label", loans_sql(body="SELECT loan_id, y FROM (SELECT loan_id, CASE loan_status WHEN 'Fully Paid' THEN 0 "
                                         "WHEN 'Charged Off' THEN 1 END AS y FROM loans) WHERE y IS NOT NULL"))
def q_binary_label(spark, sf):
    return clean.binary_label(loans(spark, sf)).select("loan_id", "y")


@register("date_span_days", """
SELECT l.l_orderkey, l.l_linenumber,
       CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS ship_days
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_date_span_days(spark, sf):
    li = tables.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = tables.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return clean.date_span_days(j, "o_orderdate", "l_shipdate", "ship_days").select("l_orderkey", "l_linenumber", "ship_days")


# ------------------------------------------------------------------ C: filters, outliers
@register("drop_where", parsed_sql(body="SELECT loan_id, dti, revol_util FROM parsed "
                                        "WHERE NOT COALESCE(dti < 0, false) AND NOT COALESCE(revol_util > 90, false)"))
def q_drop_where(spark, sf):
    df = clean.parse_percent_columns(loans(spark, sf), ["revol_util"])
    df = clean.drop_where(df, F.col("dti") < 0)
    df = clean.drop_where(df, F.col("revol_util") > 90)
    return df.select("loan_id", "dti", "revol_util")


_OUT_COLS = ["loan_amnt", "dti", "int_rate", "revol_util", "age", "open_acc", "total_acc", "revol_bal"]


def _outlier_sql(rule: str = "median <> 0 AND max > 5 * q3 - q1"):
    parts = [f"SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, "
             f"quantile_cont({c}, 0.75) AS q3, CAST(MAX({c}) AS DOUBLE) AS max FROM parsed" for c in _OUT_COLS]
    return parsed_sql(body="SELECT feature, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3, "
                           f"ROUND(max, 6) AS max, CAST({rule} AS INTEGER) AS is_outlier "
                           f"FROM ({union_all(parts)})")


@register("outlier_columns", _outlier_sql())
def q_outlier_columns(spark, sf):
    out = clean.outlier_columns(parsed_loans(spark, sf), _OUT_COLS)
    return rounded(out.withColumn("is_outlier", F.col("is_outlier").cast("int")))


# at this factor both values of the flag occur
@register("outlier_columns_bracketed", _outlier_sql("median <> 0 AND max > 2.5 * (q3 - q1)"))
def q_outlier_columns_bracketed(spark, sf):
    out = clean.outlier_columns(parsed_loans(spark, sf), _OUT_COLS, factor=2.5, bracketed=True)
    return rounded(out.withColumn("is_outlier", F.col("is_outlier").cast("int")))


@register("outlier_columns_narrow", _outlier_sql("median <> 0 AND max > 2.5 * q3 - q1"))
def q_outlier_columns_narrow(spark, sf):
    out = clean.outlier_columns(parsed_loans(spark, sf), _OUT_COLS, factor=2.5)
    return rounded(out.withColumn("is_outlier", F.col("is_outlier").cast("int")))


_SEQ_COLS = ["revol_bal", "loan_amnt", "total_acc"]


def _seq_sql(k, cols, one_pass):
    ctes, prev = [], "parsed"
    for i, c in enumerate(cols):
        src = "parsed" if one_pass else prev
        thr = (f"{k} * ((SELECT quantile_cont({c}, 0.75) FROM {src}) - (SELECT quantile_cont({c}, 0.25) FROM {src}))")
        ctes.append(f"f{i} AS (SELECT * FROM {prev} WHERE NOT COALESCE({c} > {thr}, false))")
        prev = f"f{i}"
    return parsed_sql(*ctes, body=f"SELECT loan_id, {', '.join(cols)} FROM {prev}")


@register("iqr_filter_sequential", _seq_sql(10.0, _SEQ_COLS, False))
def q_iqr_sequential(spark, sf):
    return clean.remove_outliers(parsed_loans(spark, sf), _SEQ_COLS, k=10.0, mode="sequential") \
        .select("loan_id", *_SEQ_COLS)


# at this factor a third of the rows go, and which ones depends on the order of the columns
@register("iqr_filter_sequential_tight", _seq_sql(2.0, _SEQ_COLS, False))
def q_iqr_sequential_tight(spark, sf):
    return clean.remove_outliers(parsed_loans(spark, sf), _SEQ_COLS, k=2.0, mode="sequential") \
        .select("loan_id", *_SEQ_COLS)


@register("iqr_filter_one_pass", _seq_sql(3.0, _SEQ_COLS, True))
def q_iqr_one_pass(spark, sf):
    return clean.remove_outliers(parsed_loans(spark, sf), _SEQ_COLS, k=3.0, mode="one_pass") \
        .select("loan_id", *_SEQ_COLS)


# ------------------------------------------------------------------ E: missing data
_FILLS = {"purpose": "Not_specified", "home_ownership": "Other", "emp_length": "Other"}


@register("fill_constants", loans_sql(body="SELECT loan_id, " + ", ".join(
    f"COALESCE({c}, '{v}') AS {c}" for c, v in _FILLS.items()) + " FROM loans"))
def q_fill_constants(spark, sf):
    return missing.fill_constants(loans(spark, sf), _FILLS).select("loan_id", *_FILLS)


def _share_sql():
    parts = [f"SELECT '{c}' AS feature, AVG(CAST({c} IS NULL AS INTEGER)) * 100 AS share FROM loans" for c in LOAN_COLUMNS]
    return loans_sql(body=f"SELECT feature, ROUND(share, 6) AS share FROM ({union_all(parts)}) WHERE share > 0")


@register("missing_share", _share_sql())
def q_missing_share(spark, sf):
    return rounded(missing.missing_share(loans(spark, sf), scale=100.0))


_GAPPY = ["revol_util", "emp_length", "home_ownership", "purpose", "open_acc", "total_acc", "revol_bal"]


@register("missing_indicators", loans_sql(body="SELECT loan_id, " + ", ".join(
    f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in _GAPPY) + " FROM loans"))
def q_missing_indicators(spark, sf):
    df = loans(spark, sf)
    return missing.missing_indicators(df, exclude=["loan_id"]).select("loan_id", *[f"{c}_missing" for c in _GAPPY])


_IMPUTE_COLS = ["revol_util", "employment_len", "open_acc", "total_acc", "revol_bal"]


@register("mean_impute", parsed_sql(body="SELECT loan_id, " + ", ".join(
    f"ROUND(CAST(COALESCE({c}, AVG({c}) OVER ()) AS DOUBLE), 6) AS {c}" for c in _IMPUTE_COLS) + " FROM parsed"))
def q_mean_impute(spark, sf):
    df = parsed_loans(spark, sf)
    model = missing.mean_impute_fit(df, _IMPUTE_COLS)
    return rounded(missing.mean_impute_apply(df, model).select("loan_id", *_IMPUTE_COLS))


# ------------------------------------------------------------------ F: encoding
_OH = {"home_status": ["MORTGAGE", "OTHER", "OWN", "RENT"],
       "purpose": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
       "segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]}


@register("one_hot", parsed_sql(body="SELECT loan_id, " + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in _OH.items() for v in vs) + " FROM parsed"))
def q_one_hot(spark, sf):
    df = parsed_loans(spark, sf).select("loan_id", *_OH)
    return encode.one_hot(df, list(_OH))


_MM = ["loan_amnt", "dti", "age", "revol_bal"]


def _minmax_sql():
    h = sql_hash_u32("loan_id", 111, "split")
    stats = ", ".join(f"MIN({c}) AS mn_{c}, MAX({c}) AS mx_{c}" for c in _MM)
    sel = ", ".join(f"ROUND(CASE WHEN mx_{c} = mn_{c} THEN 0.0 ELSE ({c} - mn_{c}) / (mx_{c} - mn_{c}) END, 6) AS {c}"
                    for c in _MM)
    return parsed_sql(
        f"hp AS (SELECT *, {h} < 3221225472 AS is_train FROM parsed)",
        f"st AS (SELECT {stats} FROM hp WHERE is_train)",
        body=f"SELECT loan_id, {sel} FROM hp, st WHERE NOT is_train")


@register("minmax_scale", _minmax_sql())
def q_minmax_scale(spark, sf):
    df = parsed_loans(spark, sf).withColumn("_h", hash_u32("loan_id", 111, "split"))
    train, test = df.filter(F.col("_h") < 3221225472), df.filter(F.col("_h") >= 3221225472)
    bounds = encode.minmax_fit(train, _MM)
    return rounded(encode.minmax_apply(test, bounds).select("loan_id", *_MM))


@register("feature_join", loans_sql(body="SELECT loan_id, loan_amnt, dti, CAST(revol_util IS NULL AS INTEGER) AS revol_util_missing, "
                                         "CAST(purpose IS NULL AS INTEGER) AS purpose_missing FROM loans"))
def q_feature_join(spark, sf):
    df = loans(spark, sf)
    num = df.select("loan_id", "loan_amnt", "dti")
    ind = missing.missing_indicators(df.select("loan_id", "revol_util", "purpose"), exclude=["loan_id"], keep_source=False)
    return encode.feature_join(num, ind, "loan_id")


# ------------------------------------------------------------------ G9 (the first slice)
@register("category_by_class", loans_sql(body=(
    "SELECT COALESCE(purpose, 'Not_specified') AS purpose, y, COUNT(*) AS count FROM "
    "(SELECT *, CASE loan_status WHEN 'Fully Paid' THEN 0 WHEN 'Charged Off' THEN 1 END AS y FROM loans) "
    "WHERE y IS NOT NULL AND NOT COALESCE(dti < 0, false) GROUP BY 1, 2")))
def q_category_by_class(spark, sf):
    from loanlab.operators.profile import category_by_class
    df = clean.binary_label(loans(spark, sf))
    df = clean.drop_where(df, F.col("dti") < 0)
    df = missing.fill_constants(df, {"purpose": "Not_specified"})
    return category_by_class(df, "purpose", "y")
