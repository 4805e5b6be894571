"""Every query with an oracle matches DuckDB on the smallest scale
(row count, column names, order-insensitive value hash; doubles at 6 places)."""
import os
import sys

import duckdb
import pytest

from paths import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import oracle_check  # noqa: E402

import __spark_entry__ as E  # noqa: E402

def _own():
    from loanlab.plans import registry
    registry._load_all()
    return registry.ORACLE


ORACLE = _own()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in oracle_check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


# fits of a minute or more: run them with LOANLAB_SLOW=1 or scripts/oracle_check.py
SLOW = {"stacking", "fit_gbt", "fit_gbt_leafy", "fit_random_forest", "fit_random_forest_weighted", "balanced_bagging",
        "balanced_random_forest", "easy_ensemble", "fit_mlp", "fit_many", "fit_sgd_hinge", "fit_sgd_modified_huber",
        "fitted_votes", "cross_validate", "cross_validate_over_sampled", "halving_search", "oob_score", "param_sweep", "iterative_impute_unbounded"}
NAMES = sorted(n for n in ORACLE if n not in SLOW or os.environ.get("LOANLAB_SLOW"))


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toArrow()
    want = con.sql(ORACLE[name]).arrow()
    if hasattr(want, "read_all"):
        want = want.read_all()
    a, b = oracle_check.digest(got), oracle_check.digest(want)
    assert a[0] == b[0], f"columns {a[0]} != {b[0]}"
    assert a[1] == b[1], f"rows {a[1]} != {b[1]}"
    assert a[2] == b[2], f"values differ: {sorted(set(a[3]) - set(b[3]))[:3]} vs {sorted(set(b[3]) - set(a[3]))[:3]}"
