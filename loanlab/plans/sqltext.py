"""Helpers to write the DuckDB oracle text next to each query."""
from __future__ import annotations

from loanlab.sources.fixtures import LOANS_CTE, PURCHASES_CTE, SCORED_CTE, votes_cte


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def loans_sql(*extra: str, body: str) -> str:
    return with_ctes(LOANS_CTE, *extra, body=body)


def scored_sql(*extra: str, body: str) -> str:
    return with_ctes(LOANS_CTE, SCORED_CTE, *extra, body=body)


def votes_sql(*extra: str, body: str) -> str:
    return with_ctes(LOANS_CTE, votes_cte(), *extra, body=body)


def purchases_sql(*extra: str, body: str) -> str:
    return with_ctes(PURCHASES_CTE, *extra, body=body)


PARSED_LOANS_CTE = r"""
parsed AS (
  SELECT loan_id, loan_amnt, dti,
    TRY_CAST(regexp_replace(int_rate, '\s{0,}(\d{1,}\.?\d{0,})\%', '\1', 'g') AS DOUBLE) AS int_rate,
    TRY_CAST(regexp_replace(revol_util, '\s{0,}(\d{1,}\.?\d{0,})\%', '\1', 'g') AS DOUBLE) AS revol_util,
    CAST((fico_range_low + fico_range_high) / 2 AS DOUBLE) AS fico_score,
    CASE emp_length WHEN '< 1 year' THEN 0 WHEN '1 year' THEN 1 WHEN '2 years' THEN 2 WHEN '3 years' THEN 3
      WHEN '4 years' THEN 4 WHEN '5 years' THEN 5 WHEN '6 years' THEN 6 WHEN '7 years' THEN 7
      WHEN '8 years' THEN 8 WHEN '9 years' THEN 9 WHEN '10+ years' THEN 10 END AS employment_len,
    CASE home_ownership WHEN 'MORTGAGE' THEN 'MORTGAGE' WHEN 'RENT' THEN 'RENT' WHEN 'OWN' THEN 'OWN'
      WHEN 'OTHER' THEN 'OTHER' WHEN 'ANY' THEN 'OTHER' WHEN 'NONE' THEN 'OTHER' END AS home_status,
    TRY_CAST(regexp_replace(earliest_cr_line, '\w+\-(\d{4})', '\1', 'g') AS DOUBLE) AS earliest_cr_line,
    purpose, segment, age, open_acc, total_acc, revol_bal, loan_status, y_signal
  FROM loans)
"""


def parsed_sql(*extra: str, body: str) -> str:
    return with_ctes(LOANS_CTE, PARSED_LOANS_CTE, *extra, body=body)


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)
