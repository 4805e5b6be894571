"""Registry of named queries and their DuckDB oracle text.

Every query reads the driver's tables (or fixtures Spark derives from them) at
``sf_dir`` in full.  Double columns are rounded to 6 places in both the Spark
result and the oracle SQL, since summation order changes the last bits.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (the oracle rounds the same columns)."""
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round(F.col(c), digits) for c in dbl}) if dbl else df


def _load_all():
    # importing the query modules fills QUERIES / ORACLE
    from loanlab.plans import (  # noqa: F401
        q_clean, q_ml, q_metrics, q_profile, q_sampling, q_som,
    )
