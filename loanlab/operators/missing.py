"""Missing data: constant fills, gap shares, indicators, mean imputation.

The chained tree imputation lives in :mod:`loanlab.operators.impute`.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Imputer, ImputerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_constants(df: DataFrame, mapping: Mapping) -> DataFrame:
    return df.fillna(dict(mapping))


def missing_share(df: DataFrame, scale: float = 1.0, only_positive: bool = True,
                  cols: Sequence[str] | None = None) -> DataFrame:
    """(feature, share) of gaps per column, one aggregation for all columns, sorted
    by share descending then name."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(f"s{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', `s{i}`" for i, c in enumerate(cols))
    long = one.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, share)") \
              .withColumn("share", F.col("share") * F.lit(float(scale)))
    if only_positive:
        long = long.filter(F.col("share") > 0)
    return long.orderBy(F.col("share").desc(), F.col("feature"))


def gappy_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Columns with at least one gap (one aggregation job)."""
    cols = list(cols or df.columns)
    r = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(f"g{i}") for i, c in enumerate(cols)]).collect()[0]
    return [c for i, c in enumerate(cols) if r[f"g{i}"]]


def missing_indicators(df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
                       suffix: str = "_missing", keep_source: bool = True) -> DataFrame:
    """Add ``<col>_missing`` (0/1) for every column that has gaps."""
    cand = [c for c in (cols or df.columns) if c not in set(exclude)]
    gaps = gappy_columns(df, cand)
    new = {f"{c}{suffix}": F.col(c).isNull().cast("int") for c in gaps}
    if keep_source:
        return df.withColumns(new)
    return df.select(*exclude, *[e.alias(n) for n, e in new.items()])


def _as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    # Imputer casts the surrogate to the input type; a mean must stay a double
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def mean_impute_fit(df: DataFrame, cols: Sequence[str]) -> ImputerModel:
    """Spark ML ``Imputer`` (mean); fit on training rows only, apply anywhere."""
    imp = Imputer(strategy="mean", inputCols=list(cols), outputCols=[f"{c}__imp" for c in cols])
    return imp.fit(_as_double(df, cols))


def mean_impute_apply(df: DataFrame, model: ImputerModel) -> DataFrame:
    cols = model.getInputCols()
    out = model.transform(_as_double(df, cols))
    return out.withColumns({c: F.col(f"{c}__imp") for c in cols}).drop(*[f"{c}__imp" for c in cols])
