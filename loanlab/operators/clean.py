"""Cleaning: column-name algebra, type selection, parsing, value maps, row filters,
outlier detection and removal.

Filters keep the pandas rule "a comparison with a gap is false, so the row
survives": ``drop_where`` removes a row only where the predicate is *true*.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlab.functions import columns as C
from loanlab.functions.constants import EMPLOYMENT_LENGTH, HOME_OWNERSHIP, LOAN_STATUS_LABEL

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------- column selection
def resolve_columns(df: DataFrame, include_sets: Iterable[Iterable[str]],
                    remove: Iterable[str] = (), missing: str = "error") -> DataFrame:
    """Union of name sets minus ``remove``, selected in the frame's column order.
    ``missing='ignore'`` skips names the frame lacks (default raises)."""
    wanted = set().union(*[set(s) for s in include_sets]) - set(remove)
    absent = sorted(wanted - set(df.columns))
    if absent and missing == "error":
        raise ValueError(f"columns not in frame: {absent}")
    return df.select(*[c for c in df.columns if c in wanted])


def numeric_columns(df: DataFrame, exclude: Iterable[str] = (), only_double: bool = False) -> list[str]:
    """Names of numeric columns (``only_double`` mimics a float64-only rule)."""
    ex = set(exclude)
    kinds = (T.DoubleType,) if only_double else NUMERIC_TYPES
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in ex]


def select_numeric(df: DataFrame, keep: Sequence[str] = (), only_double: bool = False) -> DataFrame:
    nums = numeric_columns(df, exclude=keep, only_double=only_double)
    return df.select(*keep, *nums)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


# ---------------------------------------------------------------- parsing and maps
def parse_percent_columns(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    return df.withColumns({c: C.parse_percent(c, strict) for c in cols})


def parse_year_column(df: DataFrame, col: str, out: str | None = None, strict: bool = False) -> DataFrame:
    return df.withColumn(out or col, C.parse_year(col, strict))


def map_column(df: DataFrame, col: str, mapping: Mapping, out: str, drop: bool = True) -> DataFrame:
    df = df.withColumn(out, C.map_values(col, mapping))
    return df.drop(col) if drop and out != col else df


def employment_length(df: DataFrame, col: str = "emp_length", out: str = "employment_len") -> DataFrame:
    return map_column(df, col, EMPLOYMENT_LENGTH, out)


def consolidate_home(df: DataFrame, col: str = "home_ownership", out: str = "home_status") -> DataFrame:
    return map_column(df, col, HOME_OWNERSHIP, out)


def binary_label(df: DataFrame, col: str = "loan_status", out: str = "y",
                 mapping: Mapping = LOAN_STATUS_LABEL) -> DataFrame:
    """Map to 0/1, drop the rows whose value is not listed, drop the source column."""
    return map_column(df, col, mapping, out).dropna(subset=[out])


def range_midpoint(df: DataFrame, lo: str, hi: str, out: str, compat: bool = False,
                   drop: bool = True) -> DataFrame:
    df = df.withColumn(out, C.range_midpoint(lo, hi, compat))
    return df.drop(lo, hi) if drop else df


def date_span_days(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    return df.withColumn(out, C.date_span_days(start, end))


# ---------------------------------------------------------------- row filters
def drop_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Remove rows where ``predicate`` is true; rows where it is NULL survive."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


# ---------------------------------------------------------------- outliers
def outlier_columns(df: DataFrame, cols: Sequence[str], factor: float = 5.0,
                    bracketed: bool = False) -> DataFrame:
    """Columns whose maximum is extreme against the quartiles.

    As coded in the analysed script: median != 0 and ``max > factor*Q3 - Q1``;
    ``bracketed=True`` uses ``max > factor*(Q3 - Q1)``.  Returns one row per column
    (feature, q1, median, q3, max, is_outlier).
    """
    from loanlab.operators.radix import quantile_table
    q = quantile_table(df, cols, [0.25, 0.5, 0.75])
    wide = (q.groupBy("feature")
             .agg(F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
                  F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("median"),
                  F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3")))
    mx = _unpivot(df.agg(*[F.max(F.col(c).cast("double")).alias(c) for c in cols]), cols, "max")
    out = wide.join(mx, "feature")
    lim = F.col("q3") - F.col("q1") if bracketed else None
    rule = (F.col("max") > factor * lim) if bracketed else (F.col("max") > factor * F.col("q3") - F.col("q1"))
    return out.select("feature", "q1", "median", "q3", "max",
                      ((F.col("median") != 0) & rule).alias("is_outlier"))


def _unpivot(one_row: DataFrame, cols: Sequence[str], value_name: str) -> DataFrame:
    return one_row.unpivot([], list(cols), "feature", value_name)


def remove_outliers(df: DataFrame, cols: Sequence[str], k: float = 10.0, mode: str = "sequential",
                    compat: bool = True) -> DataFrame:
    """Drop rows with ``x > k * (Q3 - Q1)`` (as coded: no Q3 added).

    ``sequential`` recomputes the quartiles after each column (the coded behaviour,
    order-dependent: four counting passes per column); ``one_pass`` computes every
    threshold from the same input in one aggregation.  With IQR 0 the coded rule
    removes every positive value; ``compat=False`` skips such a column instead.
    Gaps never remove a row.
    """
    from loanlab.operators.radix import quantile_values, sequential_iqrs
    cols = list(cols)
    if mode == "one_pass":
        qs = quantile_values(df, cols, [0.25, 0.75])
        for c in cols:
            iqr = qs[(c, 0.75)] - qs[(c, 0.25)] if qs[(c, 0.75)] is not None else None
            if iqr is None or (iqr == 0 and not compat):
                continue
            df = drop_where(df, F.col(c) > F.lit(k * iqr))
        return df
    if mode != "sequential":
        raise ValueError("mode must be 'sequential' or 'one_pass'")
    for c, at in zip(cols, sequential_iqrs(df, cols, lambda iqr: None if iqr == 0 and not compat else k * iqr)):
        if at is not None:
            df = drop_where(df, F.col(c) > F.lit(at))
    return df
