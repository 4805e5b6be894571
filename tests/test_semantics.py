"""Null/NaN semantics and the documented choices."""
import math

import pytest
from pyspark.sql import functions as F

from loanlab.functions import columns as C
from loanlab.operators import clean, encode, missing, profile


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(1, 1.0, "13.5%", 5.0, "Aug-2003", "1 year", "ANY"),
            (2, float("nan"), " 7%", 5.0, "Jan-1999", "10+ years", None),
            (3, None, None, 5.0, None, "weird", "RENT"),
            (4, 40000.0, "x%", 5.0, "Dec-2010", None, "NONE"),
            (5, -3.0, "0.5%", 5.0, "Feb-2001", "< 1 year", "OWN")]
    df = spark.createDataFrame(rows, "id int, x double, pct string, const double, line string, emp string, home string")
    return C.nan_to_null(df)


def test_nan_becomes_null(edge):
    assert edge.filter(F.col("x").isNull()).count() == 2


def test_drop_where_keeps_gaps(edge):
    kept = clean.drop_where(edge, F.col("x") > 30000).select("id").collect()
    assert sorted(r.id for r in kept) == [1, 2, 3, 5]


def test_parse_percent_strict_and_lenient(spark, edge):
    got = {r.id: r.pct for r in clean.parse_percent_columns(edge, ["pct"]).collect()}
    assert got == {1: 13.5, 2: 7.0, 3: None, 4: None, 5: 0.5}
    with pytest.raises(Exception):
        clean.parse_percent_columns(edge, ["pct"], strict=True).collect()


def test_maps_send_unlisted_to_null(edge):
    e = {r.id: r.employment_len for r in clean.employment_length(edge, "emp").collect()}
    assert e == {1: 1, 2: 10, 3: None, 4: None, 5: 0}
    h = {r.id: r.home_status for r in clean.consolidate_home(edge, "home").collect()}
    assert h == {1: "OTHER", 2: None, 3: "RENT", 4: "OTHER", 5: "OWN"}


def test_parse_year(edge):
    y = {r.id: r.line for r in clean.parse_year_column(edge, "line").collect()}
    assert y == {1: 2003.0, 2: 1999.0, 3: None, 4: 2010.0, 5: 2001.0}


def test_range_midpoint_both_forms(spark):
    df = spark.createDataFrame([(660, 664)], "lo int, hi int")
    r = clean.range_midpoint(clean.range_midpoint(df, "lo", "hi", "avg", drop=False), "lo", "hi", "compat",
                             compat=True).collect()[0]
    assert r.avg == 662.0 and r.compat == 660 + 332


def test_minmax_constant_column_is_zero(edge):
    b = encode.minmax_fit(edge, ["const", "x"])
    out = encode.minmax_apply(edge, b).collect()
    assert all(r.const == 0.0 for r in out)
    xs = [r.x for r in out if r.x is not None]
    assert min(xs) == 0.0 and max(xs) == 1.0


def test_one_hot_gap_gives_zeros(edge):
    oh = encode.one_hot(edge.select("id", "home"), ["home"])
    r = {x.id: x for x in oh.collect()}[2]
    assert sum(v for k, v in r.asDict().items() if k.startswith("home_")) == 0
    assert [c for c in oh.columns if c.startswith("home_")] == ["home_ANY", "home_NONE", "home_OWN", "home_RENT"]


def test_cardinality_counts_gap_as_level(edge):
    r = {x.feature: x.n_levels for x in profile.category_cardinality(edge, ["home", "emp"]).collect()}
    assert r == {"home": 5, "emp": 5}


def test_missing_share_and_indicators(edge):
    s = {r.feature: r.share for r in missing.missing_share(edge, scale=100).collect()}
    assert s["x"] == pytest.approx(40.0) and "id" not in s
    ind = missing.missing_indicators(edge, exclude=["id"])
    assert "x_missing" in ind.columns and "const_missing" not in ind.columns


def test_outlier_rule_as_coded_and_bracketed(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "v double")
    coded = clean.outlier_columns(df, ["v"]).collect()[0]
    assert coded.q1 == 2.0 and coded.q3 == 4.0 and coded.is_outlier  # 100 > 5*4 - 2
    br = clean.outlier_columns(df, ["v"], bracketed=True).collect()[0]
    assert br.is_outlier  # 100 > 5*(4-2)


def test_iqr_zero_compat_drops_positive(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 0, 0, 0, 3, -1]], "v double")
    assert clean.remove_outliers(df, ["v"], k=10, compat=True).count() == 6
    assert clean.remove_outliers(df, ["v"], k=10, compat=False).count() == 7


def test_correlated_pairs_options(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + (i % 3), -float(i)) for i in range(30)], "a double, b double, c double")
    c = profile.correlation_matrix(df, ["a", "b", "c"], method="comoments")
    p = profile.correlation_matrix(df, ["a", "b", "c"], method="pairs")
    cm = {(r.col_a, r.col_b): r.r for r in c.collect()}
    pm = {(r.col_a, r.col_b): r.r for r in p.collect()}
    for k in cm:
        assert cm[k] == pytest.approx(pm[k], abs=1e-12)
    assert {(r.col_a, r.col_b) for r in profile.correlated_pairs(c).collect()} == {("a", "b")}
    both = profile.correlated_pairs(c, both_orders=True).collect()
    assert len(both) == 2
    absr = profile.correlated_pairs(c, absolute=True).collect()
    assert ("a", "c") not in {(r.col_a, r.col_b) for r in absr}  # |r| = 1 is excluded (strict < 1)
    assert not math.isnan(cm[("b", "c")])
