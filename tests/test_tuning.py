"""Staged grid search: prefixes of one fit against separate fits."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from sparkprep.operators import train as T
from sparkprep.operators import tuning as U
from sparkprep.operators.attribution import spark_ensemble
from sparkprep.operators.boosting import NewtonParams, fit_newton


@pytest.fixture(scope="module")
def data(spark):
    u = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000
    df = spark.range(600).select("id", u(1).alias("a"), u(2).alias("b"), u(3).alias("c"))
    return df.withColumn("label", ((F.col("a") + F.col("b") + 0.4 * F.col("c")) > 1.2).cast("double")).cache()


X = ["a", "b", "c"]


def _counts(pred):
    y, p = F.col("label") == 1, F.col("prediction") == 1
    return tuple(pred.agg(F.count_if(y & p), F.count_if(~y & p), F.count_if(~y & ~p), F.count_if(y & ~p)).first())


def test_prefixes_of_boosting_are_separate_fits(data):
    staged = U.staged_counts(data, X, "label", spark_ensemble(T.retrain("gradient_boosting", data, X, "label", {"maxIter": 5, "maxDepth": 2})), [1, 3, 5, 9], False)
    got = {r["size"]: (r.tp, r.fp, r.tn, r.fn) for r in staged.collect()}
    for k in (1, 3, 5):
        assert got[k] == _counts(T.retrain("gradient_boosting", data, X, "label", {"maxIter": k, "maxDepth": 2}).transform(data))
    assert got[9] == got[5]


def test_whole_forest_votes_as_the_model(data):
    model = T.retrain("random_forest", data, X, "label", {"numTrees": 7, "maxDepth": 4})
    r = U.staged_counts(data, X, "label", spark_ensemble(model), [7, 2], True).filter("size = 7").first()
    assert (r.tp, r.fp, r.tn, r.fn) == _counts(model.transform(data))
    assert U.staged_counts(data.limit(0), X, "label", spark_ensemble(model), [7], True).agg(F.sum("tp")).first()[0] in (0, None)
    odd = data.withColumn("label", F.when(F.col("id") % 2 == 0, 7.0))
    assert U.staged_counts(odd, X, "label", spark_ensemble(model), [7], True).agg(F.sum(F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))).first()[0] == 0


def test_search_agrees_with_cross_validator(data):
    points = [{"maxDepth": 2, "stepSize": s, "maxIter": n} for s in (0.1, 0.5) for n in (1, 2, 4)]
    got = U.staged_search("gradient_boosting", data, X, "label", points, ["id"])
    clf = T.make_classifier("gradient_boosting", maxDepth=2)
    grid = ParamGridBuilder().addGrid(clf.stepSize, [0.1, 0.5]).addGrid(clf.maxIter, [1, 2, 4]).build()
    cv = CrossValidator(estimator=Pipeline(stages=[T.assembler(X), clf]), estimatorParamMaps=grid, evaluator=T.f1_evaluator(), numFolds=3, foldCol="fold")
    want = cv.fit(T.with_folds(data, ["id"], 3).coalesce(1)).avgMetrics
    by = {(m[clf.stepSize], m[clf.maxIter]): f for m, f in zip(grid, want)}
    for r in got:
        assert len(r.f1) == 3 and r.mean_f1 == pytest.approx(by[r.params["stepSize"], r.params["maxIter"]], abs=1e-9)


def test_newton_prefixes(data):
    data = data.withColumn("b", F.when(F.col("id") % 11 > 0, F.col("b")))
    model = fit_newton(data, X, "label", NewtonParams(rounds=4, depth=2))
    staged = U.staged_counts(data, X, "label", U.newton_ensemble(model), [2, 4], False)
    got = {r["size"]: (r.tp, r.fp, r.tn, r.fn) for r in staged.collect()}
    short = U.newton_ensemble(fit_newton(data, X, "label", NewtonParams(rounds=2, depth=2)))
    r = U.staged_counts(data, X, "label", short, [2], False).first()
    assert got[2] == (r.tp, r.fp, r.tn, r.fn)


@pytest.mark.parametrize("kind", sorted(U.SIZE))
def test_cloud_grids_have_27_points_in_9_fits(kind):
    points = U.grid_points(kind, "cloud")
    assert len(points) == 27 and len({tuple(sorted((k, v) for k, v in p.items() if k != U.SIZE[kind])) for p in points}) == 9
    assert {p[U.SIZE[kind]] for p in points} == {100, 200, 300}


def test_refit_on_the_best_point(data):
    model, best, means = U.cross_validate_staged("random_forest", data, X, grid="local", folds=2, key_cols=["id"], numTrees=3, maxDepth=2)
    assert len(means) == 1 and best["numTrees"] == len(model.stages[-1].trees)
