"""Files aligned by position, and saved models of several parts."""
import pytest
from pyspark.sql import functions as F

from loanlab.operators import ensembles, impute, models, persist
from loanlab.sources import tables


def test_positions_over_many_splits(spark, tmp_path):
    """Rows of several files, cut into many splits, keep the order in which they were written."""
    x, y = str(tmp_path / "x"), str(tmp_path / "y")
    df = spark.range(5000).select("id", F.concat(F.lit("row "), F.col("id")).alias("t"), (F.col("id") * 7 % 11).alias("label")).repartition(6)
    tables.write_aligned(df, ["id", "t"], "label", "id", x, y)
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = tables.read_aligned(spark, x, y, "id long, t string", "label long")
            assert got.count() == 5000 and got.where("label <> id * 7 % 11 OR t <> concat('row ', id)").count() == 0
            placed = tables.with_position(spark.read.schema("id long, t string").option("header", True).csv(x))
            assert placed.where("id <> _position").count() == 0
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_unequal_files_raise(spark, tmp_path):
    x, y = str(tmp_path / "x"), str(tmp_path / "y")
    tables.write_aligned(spark.range(10).withColumn("label", F.lit(1)), ["id"], "label", "id", x, y)
    spark.range(9).select(F.lit(1).alias("label")).write.mode("overwrite").option("header", True).csv(y)
    with pytest.raises(ValueError, match="10 rows of features, 9 labels"):
        tables.read_aligned(spark, x, y, "id long", "label int")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).select("id", (F.col("id") * 37 % 101).cast("double").alias("a"), (F.col("id") * 53 % 89).cast("double").alias("b"), (F.col("id") * 37 % 101 > 60).cast("int").alias("y")).persist()


def makers(*kinds):
    return {k: (lambda k=k: models.ResampledPipeline(["a", "b"], models.estimator(k, **({"max_depth": 4} if k in ("tree", "gbt") else {}), **({"rounds": 5} if k == "gbt" else {})), label="y", key="id")) for k in kinds}


def same(a, b):
    return a.select("id", "prediction", F.round("score", 9)).exceptAll(b.select("id", "prediction", F.round("score", 9))).count() == 0


def test_votes_of_fitted_models(spark, rows, tmp_path):
    fitted = {n: m().fit(rows) for n, m in makers("logistic", "tree", "gbt", "sgd_modified_huber").items()}
    for voting in ("hard", "soft"):
        vote = ensembles.VotingModel(fitted, voting)
        out = vote.transform(rows)
        alone = [models.predict(m, rows, n) for n, m in fitted.items()]
        joined = alone[0].select("id", f"{list(fitted)[0]}_prediction", f"{list(fitted)[0]}_score")
        for n, p in list(zip(fitted, alone))[1:]:
            joined = joined.join(p.select("id", f"{n}_prediction", f"{n}_score"), "id")
        suffix = "prediction" if voting == "hard" else "score"
        mean = sum(F.col(f"{n}_{suffix}") for n in fitted) / 4
        differ = out.join(joined, "id").where((mean > 0.5).cast("int") != F.col("prediction"))
        assert differ.count() == 0 and set(out.columns) == {"id", "a", "b", "y", "prediction", "score"}
        path = persist.save(vote, str(tmp_path / voting))
        assert same(persist.load(spark, path).transform(rows), out)
    with pytest.raises(ValueError):
        ensembles.VotingModel(fitted, "loud")


def test_saved_stack_and_pipelines(spark, rows, tmp_path):
    final = lambda names: models.ResampledPipeline(names, models.estimator("logistic"), label="y", key="id")
    stack = ensembles.Stacking(makers("logistic", "tree"), final, cv=2, key="id", label="y").fit(rows)
    assert same(persist.load(spark, persist.save(stack, str(tmp_path / "stack"))).transform(rows), stack.transform(rows))
    for name, m in (("bag", ensembles.balanced_bagging(rows, ["a", "b"], 3, key="id", label="y")), ("easy", ensembles.EasyEnsemble(2, 3, key="id", label="y").fit(rows, ["a", "b"]))):
        assert same(models.predict(persist.load(spark, persist.save(m, str(tmp_path / name))), rows), models.predict(m, rows))
    with pytest.raises(TypeError):
        persist.save(object(), str(tmp_path / "no"))


def test_saved_imputer(spark, rows, tmp_path):
    gappy = rows.select("id", F.when(F.col("id") % 5 > 0, F.col("a")).alias("a"), F.when(F.col("id") % 7 > 0, F.col("b")).alias("b"))
    model = impute.IterativeTreeImputer(["a", "b"], max_rounds=3).fit(gappy)
    again = persist.load(spark, persist.save(model, str(tmp_path / "imputer")))
    assert again.transform(gappy).exceptAll(model.transform(gappy)).count() == 0 and again.history == model.history


def test_bagging_sweep_is_nested(spark, rows):
    got = ensembles.bagging_sweep(rows, ["a", "b"], [2, 5], key="id", label="y")
    assert [m.stages[-1].getNumTrees for m in got.values()] == [2, 5]
    assert got[5].stages[-1].trees[0].toDebugString.split("\n")[1:] == got[2].stages[-1].trees[0].toDebugString.split("\n")[1:]
