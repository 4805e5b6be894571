"""Derived fixtures built from the driver's tables (never synthetic rows).

``loans`` stands in for the raw loan table: every column the cleaning operators
need, with gaps planted by key rules (the source tables have no NULLs).  The
same logic is kept as DuckDB text in ``LOANS_CTE`` for the oracle queries; the
two must stay in step.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlab.functions.columns import TWO_32, hash_u32, sql_hash_u32
from loanlab.sources.tables import table

# revol_bal is summed from whole cents so that it is exact in every engine.
LOANS_CTE = """
li AS (
  SELECT l_orderkey, COUNT(*) AS open_acc, SUM(l_quantity) AS total_acc,
         CAST(SUM(FLOOR(l_extendedprice * (1 - l_discount) * 100 + 0.5)) AS DOUBLE) / 100 AS revol_bal
  FROM lineitem GROUP BY l_orderkey),
loans AS (
SELECT o.o_orderkey AS loan_id,
  o.o_totalprice AS loan_amnt,
  c.c_acctbal AS dti,
  CONCAT(' ', CAST(5 + o.o_orderkey % 20 AS VARCHAR), '.', CAST(o.o_orderkey % 10 AS VARCHAR), '%') AS int_rate,
  CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE CONCAT(CAST((o.o_orderkey * 37) % 101 AS VARCHAR), '%') END AS revol_util,
  600 + 5 * (o.o_orderkey % 40) AS fico_range_low,
  604 + 5 * (o.o_orderkey % 40) AS fico_range_high,
  CASE o.o_orderkey % 12 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years' WHEN 11 THEN NULL
       ELSE CONCAT(CAST(o.o_orderkey % 12 AS VARCHAR), ' years') END AS emp_length,
  CASE o.o_orderkey % 7 WHEN 0 THEN 'MORTGAGE' WHEN 1 THEN 'RENT' WHEN 2 THEN 'OWN' WHEN 3 THEN 'OTHER'
       WHEN 4 THEN 'ANY' WHEN 5 THEN 'NONE' ELSE NULL END AS home_ownership,
  CONCAT('Aug-', CAST(YEAR(o.o_orderdate) AS VARCHAR)) AS earliest_cr_line,
  CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderpriority END AS purpose,
  c.c_mktsegment AS segment,
  15 + o.o_custkey % 60 AS age,
  CAST(li.open_acc AS BIGINT) AS open_acc, li.total_acc, li.revol_bal,
  CASE WHEN o.o_orderstatus = 'F' THEN 'Fully Paid'
       WHEN o.o_orderstatus = 'O' AND o.o_orderkey % 2 = 0 THEN 'Charged Off'
       ELSE 'Current' END AS loan_status,
  CASE WHEN o.o_totalprice / 500000 + ((o.o_orderkey * 7919) % 1000) / 2000.0 > 1.1 THEN 1 ELSE 0 END AS y_signal
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN li ON o.o_orderkey = li.l_orderkey)
"""

LOAN_COLUMNS = ["loan_id", "loan_amnt", "dti", "int_rate", "revol_util", "fico_range_low",
                "fico_range_high", "emp_length", "home_ownership", "earliest_cr_line", "purpose",
                "segment", "age", "open_acc", "total_acc", "revol_bal", "loan_status", "y_signal"]


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders JOIN customer LEFT JOIN (lineitem per order).

    Plan: lineitem is pre-aggregated per order (map-side partial aggregation, so a
    hot order never reaches one reducer whole) and its hash partitioning on the
    order key is reused by the left join; customer is joined on its key (broadcast
    only when Spark's size statistics allow it; skewed customers are split by AQE).
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    li = (table(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
          .groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("open_acc"),
               F.sum("l_quantity").alias("total_acc"),
               (F.sum(F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100 + 0.5))
                .cast("double") / 100).alias("revol_bal")))
    k = F.col("o_orderkey")
    m12 = k % 12
    m7 = k % 7
    j = o.join(c, o.o_custkey == c.c_custkey, "inner").join(li, k == li.l_orderkey, "left")
    return j.select(
        k.alias("loan_id"),
        F.col("o_totalprice").alias("loan_amnt"),
        F.col("c_acctbal").alias("dti"),
        F.concat(F.lit(" "), (5 + k % 20).cast("string"), F.lit("."), (k % 10).cast("string"),
                 F.lit("%")).alias("int_rate"),
        F.when(k % 9 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(((k * 37) % 101).cast("string"), F.lit("%"))).alias("revol_util"),
        (600 + 5 * (k % 40)).alias("fico_range_low"),
        (604 + 5 * (k % 40)).alias("fico_range_high"),
        F.when(m12 == 0, "< 1 year").when(m12 == 1, "1 year").when(m12 == 10, "10+ years")
         .when(m12 == 11, F.lit(None).cast("string"))
         .otherwise(F.concat(m12.cast("string"), F.lit(" years"))).alias("emp_length"),
        F.when(m7 == 0, "MORTGAGE").when(m7 == 1, "RENT").when(m7 == 2, "OWN").when(m7 == 3, "OTHER")
         .when(m7 == 4, "ANY").when(m7 == 5, "NONE").otherwise(F.lit(None).cast("string"))
         .alias("home_ownership"),
        F.concat(F.lit("Aug-"), F.year("o_orderdate").cast("string")).alias("earliest_cr_line"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("purpose"),
        F.col("c_mktsegment").alias("segment"),
        (15 + F.col("o_custkey") % 60).alias("age"),
        F.col("open_acc").cast("bigint").alias("open_acc"),
        F.col("total_acc"),
        F.col("revol_bal"),
        F.when(F.col("o_orderstatus") == "F", "Fully Paid")
         .when((F.col("o_orderstatus") == "O") & (k % 2 == 0), "Charged Off")
         .otherwise("Current").alias("loan_status"),
        F.when(F.col("o_totalprice") / 500000 + ((k * 7919) % 1000) / F.lit(2000.0) > 1.1, 1)
         .otherwise(0).alias("y_signal"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with a 0/1 label (purchase = 1, about 20 %), key ``event_id``."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value",
        (F.col("event_type") == "purchase").cast("int").alias("label"))


PURCHASES_CTE = """
purchases AS (SELECT event_id, user_id, value, CAST(event_type = 'purchase' AS INTEGER) AS label FROM events)
"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled scores for metric tests: score has ties, label is ``y_signal``."""
    l = loans(spark, sf_dir)
    score = F.floor(F.col("loan_amnt") / 500000 * 100 + 0.5) / 100
    return l.select("loan_id", F.col("y_signal").alias("label"), score.alias("score")) \
            .withColumn("prediction", (F.col("score") > 0.5).cast("int"))


SCORED_CTE = """
scored AS (
  SELECT loan_id, y_signal AS label, FLOOR(loan_amnt / 500000 * 100 + 0.5) / 100 AS score,
         CAST(FLOOR(loan_amnt / 500000 * 100 + 0.5) / 100 > 0.5 AS INTEGER) AS prediction
  FROM loans)
"""


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rule-based scores in [0, 1] and their 0/1 votes per loan."""
    l = loans(spark, sf_dir)
    s = {
        "s1": F.least(F.col("loan_amnt") / 500000, F.lit(1.0)),
        "s2": (F.col("fico_range_low") - 600) / F.lit(200.0),
        "s3": hash_u32("loan_id", 7) / F.lit(TWO_32),
        "s4": (F.col("age") - 15) / F.lit(60.0),
        "s5": (F.col("revol_bal") / 600000).cast("double"),
    }
    out = l.select("loan_id", F.col("y_signal").alias("label"),
                   *[e.alias(k) for k, e in s.items()])
    out = out.fillna({"s5": 0.0})
    return out.withColumns({f"v{k[1:]}": (F.col(k) > 0.5).cast("int") for k in s})


def votes_cte() -> str:
    h = sql_hash_u32("loan_id", 7)
    return f"""
votes0 AS (
  SELECT loan_id, y_signal AS label,
         LEAST(loan_amnt / 500000, 1.0) AS s1,
         (fico_range_low - 600) / 200.0 AS s2,
         {h} / {TWO_32} AS s3,
         (age - 15) / 60.0 AS s4,
         COALESCE(CAST(revol_bal / 600000 AS DOUBLE), 0.0) AS s5
  FROM loans),
votes AS (
  SELECT *, CAST(s1 > 0.5 AS INTEGER) AS v1, CAST(s2 > 0.5 AS INTEGER) AS v2,
         CAST(s3 > 0.5 AS INTEGER) AS v3, CAST(s4 > 0.5 AS INTEGER) AS v4,
         CAST(s5 > 0.5 AS INTEGER) AS v5
  FROM votes0)
"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as (vec_id, label, features array<double>)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label",
                    F.transform("embedding", lambda x: x.cast("double")).alias("features"))
