"""Properties of the hash-based samplers: exactness, disjointness, balance,
and independence from partitioning."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paths import SF_MID
from loanlab.functions.columns import hash_u32
from loanlab.operators import sampling
from loanlab.sources.fixtures import purchases


@pytest.fixture(scope="module")
def events(spark):
    return purchases(spark, SF_MID).select("event_id", "label").persist()


def _set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_hash_rank_equals_brute_force(events):
    r = sampling.hash_rank(events, "event_id", 5, by="label", salt="x")
    w = Window.partitionBy("label").orderBy(hash_u32("event_id", 5, "x"), "event_id")
    brute = events.withColumn("_rank", F.row_number().over(w) - 1)
    assert _set(r, "event_id", "_rank") == _set(brute, "event_id", "_rank")


def test_split_is_exact_disjoint_complete(events):
    train, test = sampling.train_test_split(events, "event_id", 0.75, 111)
    n = events.count()
    tr, te = _set(train, "event_id"), _set(test, "event_id")
    assert len(tr) == int(n * 0.75) and not (tr & te) and len(tr | te) == n


def test_partitioning_does_not_matter(events):
    base = _set(sampling.under_sample(events, "event_id", "label", 3), "event_id")
    for p in (1, 7, 64):
        again = _set(sampling.under_sample(events.repartition(p), "event_id", "label", 3), "event_id")
        assert again == base


def test_under_sample_balances_classes(events):
    c = {r.label: r["count"] for r in sampling.under_sample(events, "event_id", "label").groupBy("label").count().collect()}
    assert c[0] == c[1] == events.filter("label = 1").count()


def test_over_sample_balances_classes(events):
    o = sampling.over_sample(events, "event_id", "label")
    c = {r.label: r["count"] for r in o.groupBy("label").count().collect()}
    assert c[0] == c[1] == events.filter("label = 0").count()
    # every original row is kept once
    assert o.filter(F.col("draw").isNull()).count() == events.count()


def test_kfold_disjoint_and_balanced(events):
    f = sampling.stratified_kfold(events, "event_id", "label", 5)
    sizes = [r["count"] for r in f.groupBy("fold", "label").count().collect()]
    per_class = {r.label: r["count"] for r in events.groupBy("label").count().collect()}
    assert sum(sizes) == events.count()
    for lab, n in per_class.items():
        got = [r["count"] for r in f.filter(F.col("label") == lab).groupBy("fold").count().collect()]
        assert max(got) - min(got) <= 1 and sum(got) == n


def test_stratified_shuffle_split_shares(events):
    s = sampling.stratified_shuffle_split(events, "event_id", "label", n_splits=3, train_frac=0.25)
    for i in range(3):
        part = s.filter(F.col("split") == i)
        assert part.count() == events.count()
        n1 = events.filter("label = 1").count()
        assert part.filter("label = 1 AND is_train = 1").count() == int(n1 * 0.25)


def test_bootstrap_weights_mean_close_to_fraction(events):
    b = sampling.bootstrap_bags(events, "event_id", n_bags=4, fraction=1.0)
    tot = b.agg(F.sum("weight")).collect()[0][0]
    assert abs(tot / (4 * events.count()) - 1.0) < 0.03


def test_poisson_cdf_tail():
    c = sampling.poisson_cdf(1.0)
    assert c[0] == pytest.approx(0.36787944117144233) and 1 - c[-1] < 2 ** -40


def test_hash_rank_without_broadcast(events, monkeypatch):
    """Above the row bound the offsets are shuffle-joined; the ranks do not change."""
    monkeypatch.setattr(sampling, "BROADCAST_BYTES", 0)
    a = _set(sampling.hash_rank(events, "event_id", 9, by="label"), "event_id", "_rank")
    monkeypatch.undo()
    b = _set(sampling.hash_rank(events, "event_id", 9, by="label"), "event_id", "_rank")
    assert a == b


def test_over_sample_large_minority_path(events, monkeypatch):
    monkeypatch.setattr(sampling, "BROADCAST_BYTES", 0)
    a = _set(sampling.over_sample(events, "event_id", "label"), "event_id", "draw")
    monkeypatch.undo()
    assert a == _set(sampling.over_sample(events, "event_id", "label"), "event_id", "draw")


@pytest.mark.parametrize("share", [0.0, 0.0001, 0.37, 0.9999, 1.0])
def test_hash_cut_equals_rank(events, share):
    got = sampling.hash_cut(events, "event_id", 5, lambda n, _: F.floor(n * share), by="label", salt="x")
    r = sampling.hash_rank(events, "event_id", 5, by="label", salt="x", with_counts=True)
    want = r.withColumn("_in", F.col("_rank") < F.floor(F.col("_n") * share))
    assert _set(got, "event_id", "_in") == _set(want, "event_id", "_in")


def test_hash_cut_of_nothing(events):
    assert sampling.split_flag(events.limit(0), "event_id").count() == 0
    assert sampling.under_sample(events.limit(0), "event_id", "label").count() == 0


@pytest.mark.parametrize("sampler", [lambda d: sampling.under_sample(d, "event_id", "label"), lambda d: sampling.over_sample(d, "event_id", "label"),
                                     lambda d: sampling.kfold_assign(d, "event_id", 3), lambda d: sampling.stratified_kfold(d, "event_id", "label", 4)])
def test_samplers_move_no_feature(events, sampler):
    wide = events.withColumn("feature", F.col("event_id") * 2.0)
    plan = sampler(wide)._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and "feature" in line and "Broadcast" not in line for line in plan.splitlines())
    assert "feature" in plan


@pytest.mark.parametrize("n, k", [(1, 5), (2, 5), (7, 3), (100, 7), (3000, 4)])
def test_pieces_equal_ranks(events, n, k):
    some = events.orderBy("event_id").limit(n)
    for by in (None, "label"):
        got = sampling.hash_pieces(some, "event_id", 8, k, by=by, salt="p")
        w = Window.partitionBy(*([by] if by else [F.lit(1)]))
        want = some.withColumn("h", hash_u32("event_id", 8, "p")).withColumn("r", F.row_number().over(w.orderBy("h", "event_id")) - 1) \
            .withColumn("fold", F.floor(F.col("r") * k / F.count("*").over(w)).cast("int"))
        assert _set(got, "event_id", "fold") == _set(want, "event_id", "fold")


def test_over_sample_draws_like_with_replacement(spark):
    df = spark.range(2200).select("id", (F.col("id") < 200).cast("int").alias("y"))
    for seed in (1, 2, 3, 4):   # surplus and deficit both occur
        o = sampling.over_sample(df, "id", "y", seed)
        draws = [r["count"] for r in o.filter("draw IS NOT NULL").groupBy("id").count().collect()]
        assert sum(draws) == 1800 and o.filter("draw IS NOT NULL AND y = 0").count() == 0
        spread = sum((d - 9) ** 2 for d in draws) / 200
        assert 6 < spread < 13   # a draw with replacement has 9 (1 - 1/200)
    even = sampling.over_sample(df.filter("id < 400"), "id", "y", 1)
    assert even.count() == 400


def test_over_sample_of_a_rare_class(spark):
    df = spark.range(3000).select("id", (F.col("id") < 20).cast("int").alias("y"))   # 148 draws a row: sums of several Poisson numbers
    o = sampling.over_sample(df, "id", "y")
    assert o.filter("y = 1").count() == 2980


@pytest.mark.parametrize("rate", [0.5, 1.0, 300.0, 800.0])
def test_poisson_cdf_reaches_one(rate):
    cdf = sampling.poisson_cdf(rate)
    assert cdf[-1] == pytest.approx(1.0, abs=1e-11) and all(a <= b for a, b in zip(cdf, cdf[1:]))
    mean = sum(1 - c for c in cdf)
    assert mean == pytest.approx(rate, rel=1e-6)


def test_the_label_is_no_feature(events):
    from loanlab.operators import models
    with pytest.raises(ValueError, match="label"):
        models.ResampledPipeline(["x", "label"], models.estimator("tree")).fit(events)
