"""Sources and sinks: CSV (plain or gzip), Parquet, fitted models.

Parquet is the preferred format (column pruning and filter pushdown reach the
scan).  gzip CSV is not splittable, so it is repartitioned right after the read;
``.csv.gz`` parts are what ``write_table(..., gzip=True)`` produces.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlab.functions.columns import nan_to_null
from loanlab.session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fmt(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    p = path.rstrip("/").lower()
    if p.endswith(".parquet"):
        return "parquet"
    if p.endswith(".csv") or p.endswith(".csv.gz") or p.endswith(".gz"):
        return "csv"
    if p.endswith(".gzip"):
        # a true gzip file named *.gzip is inflated by the codec lookup only when
        # it ends in .gz; ask for an explicit name instead of guessing
        raise ValueError("name gzip CSV files *.csv.gz (a '.gzip' suffix is not recognised)")
    return "parquet"


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               columns: Sequence[str] | None = None, fmt: str | None = None,
               min_partitions: int | None = None) -> DataFrame:
    """Read CSV (header row) or Parquet.  ``columns`` prunes at the scan; NaN in
    floating columns becomes NULL.  Without ``schema`` CSV types are inferred
    (one extra pass; pass a schema at scale)."""
    f = _fmt(path, fmt)
    r = spark.read
    if f == "csv":
        r = r.option("header", True).option("ignoreLeadingWhiteSpace", False) \
             .option("ignoreTrailingWhiteSpace", False).option("nanValue", "NaN")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        df = r.csv(path)
        if path.rstrip("/").lower().endswith(".gz") and min_partitions:
            df = df.repartition(min_partitions)
    else:
        if schema is not None:
            r = r.schema(schema)
        df = r.format(f).load(path)
    if columns is not None:
        df = df.select(*columns)
    return nan_to_null(df)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", gzip: bool = False,
                mode: str = "overwrite") -> str:
    """Write without an index column.  CSV keeps blanks as they are."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True).option("ignoreLeadingWhiteSpace", False) \
             .option("ignoreTrailingWhiteSpace", False)
        if gzip:
            w = w.option("compression", "gzip")
        w.csv(path)
    else:
        w.format(fmt).save(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ------------------------------------------------------------------ files aligned by position
def with_position(df: DataFrame, out: str = "_position") -> DataFrame:
    """Rows of a file source with their place in the files, from 0: files in the order of their part numbers (then names), rows in
    file order.

    A split's rows are numbered within the task that reads it; the rows of earlier splits are added as prefix sums over
    the table of splits, whose size is that of the file list, not of the data.
    """
    read = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    read = cut_lineage(read.withColumn("_n", F.monotonically_increasing_id()))
    number = F.regexp_extract("_file", r"part-(\d{1,18})[^/]*$", 1).try_cast("bigint")
    splits = read.groupBy("_file", "_block").agg(F.min("_n").alias("_least"), F.count("*").alias("_rows"))
    order = Window.orderBy(number.asc_nulls_last(), "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = cut_lineage(splits.select("_file", "_block", (F.coalesce(F.sum("_rows").over(order), F.lit(0)) - F.col("_least")).alias("_shift")))
    small = splits.count() * 512 <= 64 << 20
    placed = read.join(F.broadcast(splits) if small else splits, ["_file", "_block"])
    return placed.withColumn(out, F.col("_n") + F.col("_shift")).drop("_file", "_block", "_n", "_shift")


def write_aligned(df: DataFrame, features: Sequence[str], label: str, order: str, x_path: str, y_path: str, gzip: bool = False) -> None:
    """Two CSV folders, features and label apart, whose rows correspond by position (in the order of ``order``)."""
    ordered = cut_lineage(df.orderBy(order).select(*features, label))
    write_table(ordered.select(*features), x_path, "csv", gzip)
    write_table(ordered.select(label), y_path, "csv", gzip)


def read_aligned(spark: SparkSession, x_path: str, y_path: str, x_schema, y_schema) -> DataFrame:
    """Features and label of two CSV folders side by side, row by row; unequal row counts are an error."""
    x, y = (with_position(spark.read.schema(s).option("header", True).csv(p)) for p, s in ((x_path, x_schema), (y_path, y_schema)))
    n, m = x.count(), y.count()
    if n != m:
        raise ValueError(f"{n} rows of features, {m} labels")
    return nan_to_null(x.join(y, "_position").drop("_position"))
