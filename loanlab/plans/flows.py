"""End-to-end flows built from the operators (used by queries and ``entry``)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanlab.operators import clean
from loanlab.sources.fixtures import loans


def parsed_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loans -> typed columns: percents, score, ordinal length, grouped home
    status, credit-line year.  One narrow projection (no shuffle beyond the fixture)."""
    df = loans(spark, sf_dir)
    df = clean.parse_percent_columns(df, ["int_rate", "revol_util"])
    df = clean.range_midpoint(df, "fico_range_low", "fico_range_high", "fico_score")
    df = clean.employment_length(df)
    df = clean.consolidate_home(df)
    df = clean.parse_year_column(df, "earliest_cr_line")
    return df.select("loan_id", "loan_amnt", "dti", "int_rate", "revol_util", "fico_score",
                     "employment_len", "home_status", "earliest_cr_line", "purpose", "segment", "age",
                     "open_acc", "total_acc", "revol_bal", "loan_status", "y_signal")


def flagship_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanlab.plans.q_ml import forest_report
    return forest_report(spark, sf_dir)


MODEL_NUMERIC = ["loan_amnt", "dti", "int_rate", "revol_util", "fico_score", "employment_len",
                 "earliest_cr_line", "age", "open_acc", "total_acc", "revol_bal"]
MODEL_CATEGORICAL = ["home_status", "purpose", "segment"]


def model_table(spark: SparkSession, sf_dir: str, label: str = "y_signal", seed: int = 111):
    """Cleaned, encoded loan table ready for fitting, with an exact 75/25 split.

    Everything learnt from data (gap columns, means, category levels) is learnt
    on the training part only; the loan key is carried but never a feature.
    Returns (frame with loan_id, label, is_train, features..., feature names).
    """
    from pyspark.sql import functions as F

    from loanlab.operators import encode, missing, sampling
    df = parsed_loans(spark, sf_dir).withColumn("label", F.col(label).cast("int"))
    rows = df.persist()   # the split reads them three times
    df = sampling.split_flag(rows, "loan_id", 0.75, seed).persist()
    train = df.filter(F.col("is_train") == 1)
    gaps = missing.gappy_columns(train, MODEL_NUMERIC + MODEL_CATEGORICAL)   # the first pass, after which the split rows are there
    rows.unpersist()
    df = df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in gaps})
    num_gaps = [c for c in gaps if c in MODEL_NUMERIC]
    if num_gaps:
        df = missing.mean_impute_apply(df, missing.mean_impute_fit(train, num_gaps))
    df = df.withColumns({c: F.col(c).cast("double") for c in MODEL_NUMERIC})
    levels = encode.category_levels(train, MODEL_CATEGORICAL)
    df = encode.one_hot(df, MODEL_CATEGORICAL, levels)
    feats = MODEL_NUMERIC + [f"{c}_{v}" for c in MODEL_CATEGORICAL for v in levels[c]] + [f"{c}_missing" for c in gaps]
    return df.select("loan_id", "label", "is_train", *feats), feats


def split_parts(df: DataFrame):
    from pyspark.sql import functions as F
    return df.filter(F.col("is_train") == 1).drop("is_train"), df.filter(F.col("is_train") == 0).drop("is_train")
