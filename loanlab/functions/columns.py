"""Column expressions: parsing, value maps, the partition-independent hash.

Everything here returns a ``Column`` built from JVM-side functions, so it stays in
whole-stage codegen; no Python runs per row.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlab.functions.constants import PERCENT_PATTERN, YEAR_PATTERN

TWO_32 = 4294967296.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in floating columns (Spark orders NaN above +inf and
    ``NaN > t`` is true, unlike pandas; NULL keeps the pandas semantics)."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    todo = [c for c in (cols if cols is not None else df.columns) if c in fl]
    if not todo:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in todo})


def parse_percent(col, strict: bool = False) -> Column:
    """'13.56%' -> 13.56.  Unmatched text stays as is and then fails the cast:
    ``strict`` raises (ANSI cast), otherwise NULL."""
    s = F.regexp_replace(_c(col).cast("string"), PERCENT_PATTERN, "$1")
    return s.cast("double") if strict else s.try_cast("double")


def parse_year(col, strict: bool = False) -> Column:
    """'Aug-2003' -> 2003.0"""
    s = F.regexp_replace(_c(col), YEAR_PATTERN, "$1")
    return s.cast("double") if strict else s.try_cast("double")


def map_values(col, mapping: Mapping) -> Column:
    """Dictionary map; a value not listed (and NULL) becomes NULL."""
    c = _c(col)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out if out is not None else F.lit(None)


def range_midpoint(lo, hi, compat: bool = False) -> Column:
    """Score from a range pair.  Default is the average; ``compat`` reproduces the
    unbracketed form ``lo + floor(hi / 2)``."""
    lo, hi = _c(lo), _c(hi)
    if compat:
        return (lo + F.floor(hi / 2)).cast("double")
    return ((lo + hi) / 2).cast("double")


def date_span_days(start, end) -> Column:
    """Whole days from ``start`` to ``end``; negative spans are kept."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def hash_u32(key, seed, salt: str = "", salt_col=None) -> Column:
    """Unsigned 32-bit hash of ``seed:[salt:][salt_col:]key`` from the first 8 hex
    digits of MD5.

    Depends only on the key (never on partitioning or row order), so every
    sample/split below is reproducible on any cluster and by a SQL engine:
    ``('0x' || substr(md5(seed || ':' || key), 1, 8))::BIGINT`` in DuckDB.
    """
    return _hash_hex(key, seed, salt, salt_col, 8)


def hash_u60(key, seed, salt: str = "", salt_col=None) -> Column:
    """The same hash from the first 15 hex digits: 60 bits, for choices among many rows."""
    return _hash_hex(key, seed, salt, salt_col, 15)


def _hash_hex(key, seed, salt, salt_col, digits: int) -> Column:
    parts = [F.lit(f"{seed}:{salt}:" if salt else f"{seed}:")]
    if salt_col is not None:
        parts += [_c(salt_col).cast("string"), F.lit(":")]
    parts.append(_c(key).cast("string"))
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, digits), 16, 10).cast("bigint")


def unit_hash(key, seed, salt: str = "") -> Column:
    """``hash_u32`` scaled into [0, 1)."""
    return hash_u32(key, seed, salt) / F.lit(TWO_32)


def sql_hash_u32(key_sql: str, seed, salt: str = "", salt_sql: str | None = None, digits: int = 8) -> str:
    """The DuckDB text of :func:`hash_u32` (used by the oracle queries)."""
    prefix = f"{seed}:{salt}:" if salt else f"{seed}:"
    txt = f"'{prefix}'"
    if salt_sql is not None:
        txt += f" || CAST({salt_sql} AS VARCHAR) || ':'"
    return f"CAST(('0x' || substr(md5({txt} || CAST({key_sql} AS VARCHAR)), 1, {digits})) AS BIGINT)"
