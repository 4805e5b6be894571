"""Profiling: summaries, exact distributed quantiles, cardinality, value counts,
correlation (pairwise-complete), histograms, box-plot statistics, class counts.

Scale notes
-----------
* Per-column statistics are computed in one wide aggregation (partial aggregation on
  the map side), never one job per column.
* Exact quantiles come from radix selection (``radix.py``): four counting passes, no
  sort, no sketch, and no column or group gathered in one task.
* Correlation over many columns uses co-moments: every partition adds its pairwise
  sums with one matrix product (``mapInPandas``), partials are summed by pair.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.operators.radix import BROADCAST_BYTES, quantile_table, quantile_values
from loanlab.session import cut_lineage

__all__ = ["quantile_table", "quantile_values", "describe", "category_cardinality", "value_counts", "category_by_class", "correlation_matrix",
           "correlated_pairs", "histogram_by_class", "boxplot_by_class", "fold_score_summary", "top_k"]

def _dbl(c: str):
    return F.col(c).cast("double")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per column (long form)."""
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.struct(F.lit(c).alias("feature"), F.count(c).alias("count"), F.avg(_dbl(c)).alias("mean"), F.stddev_samp(_dbl(c)).alias("std"),
                          F.min(_dbl(c)).alias("min"), F.max(_dbl(c)).alias("max")).alias(f"s{i}")]
    plain = df.agg(*aggs).select(F.inline(F.array(*[f"s{i}" for i in range(len(cols))])))
    q = quantile_table(df, cols, [0.25, 0.5, 0.75])  # one row for each column and quartile
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{int(100 * p)}")
    return plain.join(F.broadcast(q.groupBy("feature").agg(at(0.25), at(0.5), at(0.75))), "feature") \
        .select("feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def category_cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Number of categories per column, a gap counting as one more category."""
    cd = F.approx_count_distinct if approx else F.count_distinct
    aggs = []
    for c in cols:
        aggs += [cd(c).alias(f"{c}__d"), F.max(F.col(c).isNull().cast("int")).alias(f"{c}__g")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', CAST(`{c}__d` + `{c}__g` AS BIGINT)" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, n_levels)")


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Counts per value, descending (ties by value); partial aggregation first."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    return (src.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
               .orderBy(F.col("count").desc(), F.col(col).asc_nulls_first()))


def category_by_class(df: DataFrame, col: str, label: str, dropna: bool = True) -> DataFrame:
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(col, label).agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------------ correlation
def _comoment_partials(cols: list[str], means: list[float]):
    k = len(cols)
    iu, ju = np.triu_indices(k, 1)
    mu = np.asarray(means, dtype=float)

    def run(batches):
        acc = None
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float, na_value=np.nan) - mu
            m = (~np.isnan(x)).astype(float)
            x0 = np.nan_to_num(x)
            part = (m.T @ m, x0.T @ m, (x0 * x0).T @ m, x0.T @ x0)
            acc = part if acc is None else tuple(a + p for a, p in zip(acc, part))
        if acc is None:
            return
        n, sx, sxx, sxy = acc
        yield pd.DataFrame({"i": iu.astype("int32"), "j": ju.astype("int32"), "n": n[iu, ju],
                            "sx": sx[iu, ju], "sy": sx[ju, iu], "sxx": sxx[iu, ju], "syy": sxx[ju, iu],
                            "sxy": sxy[iu, ju]})
    return run


def correlation_matrix(df: DataFrame, cols: Sequence[str], method: str = "auto") -> DataFrame:
    """Pearson r over pairwise-complete rows for every unordered pair (col_a, col_b, r).

    ``pairs`` runs one ``corr`` per pair in a single aggregation (fine up to ~30
    pairs); ``comoments`` adds per-partition co-moment matrices (one BLAS product per
    Arrow batch) and sums them by pair.  ``auto`` picks by the number of pairs.
    """
    cols = list(cols)
    spark = df.sparkSession
    k = len(cols)
    names = spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "i int, name string")
    if method == "auto":
        method = "pairs" if k * (k - 1) // 2 <= 30 else "comoments"
    if method == "pairs":
        aggs = [F.corr(_dbl(cols[i]), _dbl(cols[j])).alias(f"r_{i}_{j}")
                for i in range(k) for j in range(i + 1, k)]
        one = df.agg(*aggs)
        stack = ", ".join(f"'{cols[i]}', '{cols[j]}', `r_{i}_{j}`" for i in range(k) for j in range(i + 1, k))
        out = one.selectExpr(f"stack({len(aggs)}, {stack}) AS (col_a, col_b, r)")
        return out.withColumn("r", F.when(F.isnan("r"), F.lit(None)).otherwise(F.col("r")))
    means_row = df.agg(*[F.avg(_dbl(c)).alias(f"m{i}") for i, c in enumerate(cols)]).collect()[0]
    means = [means_row[f"m{i}"] or 0.0 for i in range(k)]
    src = df.select(*[_dbl(c).alias(c) for c in cols])
    parts = src.mapInPandas(_comoment_partials(cols, means),
                            "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double")
    s = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ["n", "sx", "sy", "sxx", "syy", "sxy"]])
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    r = F.when((F.col("n") >= 2) & (vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))
    a = names.withColumnRenamed("name", "col_a")
    b = names.withColumnRenamed("i", "j").withColumnRenamed("name", "col_b")
    return (s.select("i", "j", r.alias("r"))
             .join(F.broadcast(a), "i").join(F.broadcast(b), "j")
             .select("col_a", "col_b", "r"))


def correlated_pairs(corr: DataFrame, low: float = 0.5, high: float = 1.0,
                     absolute: bool = False, both_orders: bool = False) -> DataFrame:
    """Pairs with ``high > r > low`` (``absolute`` uses |r|)."""
    v = F.abs("r") if absolute else F.col("r")
    out = corr.filter((v > low) & (v < high))
    if both_orders:
        out = out.unionByName(out.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "r"))
    return out


# ------------------------------------------------------------------ histograms / boxes
def _unpivot_cols(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), _dbl(c).alias("x")) for c in cols])
    return df.select(*keep, F.explode(arr).alias("_e")).select(*keep, "_e.feature", "_e.x")


def histogram_by_class(df: DataFrame, cols: Sequence[str], label: str | None, bins: int = 10) -> DataFrame:
    """Equal-width bins between each column's min and max, counts per (bin, class).

    Returns (feature, bin, bin_lo, bin_hi, label?, count); gaps are not counted.
    """
    cols = list(cols)
    mm = df.agg(*[F.min(_dbl(c)).alias(f"mn{i}") for i, c in enumerate(cols)],
                *[F.max(_dbl(c)).alias(f"mx{i}") for i, c in enumerate(cols)]).collect()[0]
    keep = [label] if label else []
    entries = []
    for i, c in enumerate(cols):
        mn, mx = mm[f"mn{i}"], mm[f"mx{i}"]
        if mn is None:
            continue
        x = _dbl(c)
        if mx == mn:
            b = F.when(x.isNotNull(), F.lit(0))
        else:
            # least() skips NULLs, so keep gaps out explicitly
            b = F.when(x.isNotNull(),
                       F.least(F.floor((x - F.lit(mn)) / F.lit(mx - mn) * bins), F.lit(bins - 1)).cast("int"))
        entries.append(F.struct(F.lit(c).alias("feature"), b.alias("bin"), F.lit(mn).alias("mn"),
                                F.lit(mx).alias("mx")))
    long = df.select(*keep, F.explode(F.array(*entries)).alias("_e")) \
             .select(*keep, "_e.feature", "_e.bin", "_e.mn", "_e.mx").filter(F.col("bin").isNotNull())
    g = long.groupBy("feature", "bin", *keep).agg(F.count(F.lit(1)).alias("count"),
                                                  F.first("mn").alias("mn"), F.first("mx").alias("mx"))
    lo = F.col("mn") + (F.col("mx") - F.col("mn")) * F.col("bin") / bins
    hi = F.col("mn") + (F.col("mx") - F.col("mn")) * (F.col("bin") + 1) / bins
    return g.select("feature", "bin", lo.alias("bin_lo"), hi.alias("bin_hi"), *keep, "count")


def boxplot_by_class(df: DataFrame, cols: Sequence[str], label: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles, fences at ``whisker``·IQR, whisker ends inside the fences and the
    number of points outside, per (class, column); any number of classes."""
    cols = list(cols)
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], by=label)
    at = lambda c, p: F.max(F.when((F.col("feature") == c) & (F.col("prob") == p), F.col("value")))
    boxes = []
    for i, c in enumerate(cols):
        iqr = at(c, 0.75) - at(c, 0.25)
        boxes.append(F.struct(at(c, 0.25).alias("q1"), at(c, 0.5).alias("median"), at(c, 0.75).alias("q3"), iqr.alias("iqr"),
                              (at(c, 0.25) - whisker * iqr).alias("lo"), (at(c, 0.75) + whisker * iqr).alias("hi")).alias(f"b{i}"))
    fences = cut_lineage(q.groupBy(F.col(label).alias("_class")).agg(*boxes))
    small = fences.count() * (32 + 64 * len(cols)) <= BROADCAST_BYTES  # fixed-width rows
    rows = df.select(label, *[_dbl(c).alias(f"x{i}") for i, c in enumerate(cols)])
    rows = rows.join(F.broadcast(fences) if small else fences, F.col(label).eqNullSafe(F.col("_class")))
    out = []
    for i, c in enumerate(cols):
        x, b = F.col(f"x{i}"), F.col(f"b{i}")
        out.append(F.struct(F.lit(c).alias("feature"), *[F.first(b[k]).alias(k) for k in ("q1", "median", "q3", "iqr")],
                            F.min(F.when(x >= b["lo"], x)).alias("whisker_lo"), F.max(F.when(x <= b["hi"], x)).alias("whisker_hi"),
                            F.count_if((x < b["lo"]) | (x > b["hi"])).alias("n_outliers")).alias(f"s{i}"))
    return rows.groupBy(label).agg(*out).select(label, F.inline(F.array(*[f"s{i}" for i in range(len(cols))])))


def fold_score_summary(scores: DataFrame, group: str = "model", fold: str = "fold",
                       score: str = "score") -> DataFrame:
    """Mean, population std, best fold (highest score, lowest fold on ties)."""
    best = F.max_by(F.struct(F.col(score), (-F.col(fold)).alias("nf")),
                    F.struct(F.col(score), (-F.col(fold)).alias("nf")))
    return scores.groupBy(group).agg(
        F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"),
        F.count(F.lit(1)).alias("n_folds"), best.alias("_b")) \
        .select(group, "mean_score", "std_score", "n_folds",
                (-F.col("_b.nf")).cast("int").alias("best_fold"), F.col(f"_b.{score}").alias("best_score"))


def top_k(df: DataFrame, order: str, k: int = 20, tiebreak: str | None = None,
          ascending: bool = False) -> DataFrame:
    """Top ``k`` rows by ``order`` (distributed TakeOrdered: each task keeps k)."""
    o = F.col(order).asc() if ascending else F.col(order).desc()
    keys = [o] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return df.orderBy(*keys).limit(k)
