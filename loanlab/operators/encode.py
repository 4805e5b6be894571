"""Encoding and scaling: one-hot to named columns, min-max fitted on train,
key joins of feature blocks, vector assembly that refuses the label."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_levels(df: DataFrame, cols: Sequence[str], max_levels: int = 1000) -> dict[str, list[str]]:
    """Sorted distinct non-null levels per column (one job; at most
    ``max_levels`` per column reach the driver, more raises)."""
    arr = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])
    d = (df.select(F.explode(arr).alias("e")).select("e.c", "e.v").filter(F.col("v").isNotNull())
           .distinct())
    cap = max_levels * len(cols) + 1
    rows = d.limit(cap).collect()
    out = {c: [] for c in cols}
    for r in rows:
        out[r["c"]].append(r["v"])
    for c, vs in out.items():
        if len(vs) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels")
        vs.sort()
    return out


def one_hot(df: DataFrame, cols: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None,
            max_levels: int = 1000, sep: str = "_", drop: bool = True) -> DataFrame:
    """``<col><sep><level>`` 0/1 columns in sorted level order; a gap gives all
    zeros.  Pass ``levels`` (e.g. from the training part) to skip the level job."""
    lv = dict(levels) if levels is not None else category_levels(df, cols, max_levels)
    new = {f"{c}{sep}{v}": F.when(F.col(c) == F.lit(v), 1).otherwise(0) for c in cols for v in lv[c]}
    out = df.withColumns(new)
    return out.drop(*cols) if drop else out


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Per-column (min, max) in one aggregation."""
    r = df.agg(*[F.min(F.col(c).cast("double")).alias(f"mn{i}") for i, c in enumerate(cols)],
               *[F.max(F.col(c).cast("double")).alias(f"mx{i}") for i, c in enumerate(cols)]).collect()[0]
    return {c: (r[f"mn{i}"], r[f"mx{i}"]) for i, c in enumerate(cols)}


def minmax_apply(df: DataFrame, bounds: Mapping[str, tuple[float, float]], clip_low: bool = False) -> DataFrame:
    """(x - min) / (max - min); a constant column maps to 0.  Values outside the
    fitted range are not clipped (``clip_low`` clips below 0, for models that
    refuse negatives)."""
    new = {}
    for c, (mn, mx) in bounds.items():
        if mn is None:
            e = F.col(c).cast("double")
        elif mx == mn:
            e = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            e = (F.col(c).cast("double") - F.lit(mn)) / F.lit(mx - mn)
        new[c] = F.greatest(e, F.lit(0.0)) if clip_low else e
    return df.withColumns(new)


def feature_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join two feature blocks on the carried row key (never on row position).
    Cheaper still: build both blocks as columns of one frame."""
    return left.join(right, key, how)


def check_features(feature_cols: Sequence[str], label: str | None) -> None:
    if label is not None and label in feature_cols:
        raise ValueError("the label cannot be a feature")


def assemble(df: DataFrame, feature_cols: Sequence[str], label: str | None = None,
             out: str = "features") -> DataFrame:
    """VectorAssembler; the label (and any ``*_id`` key) must not be a feature."""
    check_features(feature_cols, label)
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid="keep").transform(df)
