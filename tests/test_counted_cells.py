"""Fits on counted cells, and queries that do their whole job."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sparkprep.operators import attribution as A
from sparkprep.operators import boosting as B
from sparkprep.operators import counted as K
from sparkprep.operators import split as S
from sparkprep.operators import train as T
from sparkprep.operators import tuning as U
from sparkprep.plans import q_boost, q_train

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    u = lambda k, n: (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))).cast("double")
    df = spark.range(2000).select("id", u(1, 7).alias("a"), u(2, 5).alias("b"), (u(3, 900) / 40).alias("c"), F.pmod("id", F.lit(3)).cast("int").alias("fold"))
    return df.withColumn("label", ((F.col("a") + F.col("b") + F.col("c") / 5 + u(4, 3)) > 8).cast("double")).cache()


def _counts(pred):
    y, p = F.col("label") == 1, F.col("prediction") == 1
    return tuple(pred.agg(F.count_if(y & p), F.count_if(~y & p), F.count_if(~y & ~p), F.count_if(y & ~p)).first())


def test_cells_count_all_rows_by_fold(data):
    found = K.count_cells(data, COLS, "label", 8, 3)
    rows = data.select(*COLS, "label", "fold").collect()
    for s, c in enumerate(found):
        want = {}
        for r in rows:
            key = tuple(int(np.searchsorted(p, r[x])) for p, x in zip(c.points, COLS))
            at = want.setdefault(key, [0] * 4)
            at[int(r.label) + 2 * (r.fold == s - 1)] += 1
        got = {tuple(k): [int(v) for v in n] for k, n in zip(c.bins.T.tolist(), np.stack([c.n0, c.n1, c.h0, c.h1]).T)}
        assert got == want and [len(p) for p in c.points] == [6, 4, 7]
    assert (found[0].h0 + found[0].h1).sum() == 0 and (found[0].n0 + found[0].n1).sum() == 2000


def test_sketches_keep_ranks(monkeypatch):
    monkeypatch.setattr(K, "POINTS", 500)
    v = np.random.default_rng(3).normal(size=20_000)
    parts = [K._compressed(p, None, 500) for p in np.array_split(v, 4)]
    assert all(len(p[0]) <= 500 and p[1].sum() == 5000 for p in parts)
    for k, t in enumerate(K._thresholds(*[np.concatenate(p) for p in zip(*parts)], 32), 1):
        assert abs((v <= t).mean() - k / 32) < 0.005


@pytest.mark.parametrize("odd", [None, math.nan, math.inf])
def test_what_cannot_be_counted_is_left(data, odd):
    assert K.count_cells(data.withColumn("b", F.when(F.col("id") != 5, F.col("b")).otherwise(odd)), COLS, "label", 32) is None
    assert K.count_cells(data.withColumn("label", F.when(F.col("id") != 5, F.col("label")).otherwise(odd)), COLS, "label", 32) is None


def test_a_split_has_the_most_gain():
    rng = np.random.default_rng(5)
    bins, n = rng.integers(0, 6, (3, 80)).astype(np.int16), rng.poisson(2, (2, 80))
    tree, (leaf,) = K.grow(bins, [6] * 3, n, K.gini, 2, 4, held=bins, marks=(2,))
    impurity = lambda s: 1 - sum(x * x for x in s) / sum(s) ** 2
    whole, best = n.sum(axis=1), 0
    for f in range(3):
        for t in range(5):
            left = n[:, bins[f] <= t].sum(axis=1)
            if min(left.sum(), (whole - left).sum()) >= 4:
                best = max(best, impurity(whole) - (left.sum() * impurity(left) + (whole - left).sum() * impurity(whole - left)) / whole.sum())
    assert tree.gain[0] == pytest.approx(best)
    for k in np.unique(leaf):
        assert tree.left[k] < 0 and tree.sums[:, k].tolist() == n[:, leaf == k].sum(axis=1).tolist()


def test_forests_of_a_grid_are_separate_fits(data):
    cells, spark = K.count_cells(data, COLS, "label", 32, 3), data.sparkSession
    points = [{"numTrees": n, "maxDepth": d, "minInstancesPerNode": m} for n in (2, 5, 25) for d in (3, 9) for m in (1, 4)]
    got = {(r.fold, r.point): (r.tp, r.fp, r.tn, r.fn) for r in K.search(K.RandomForestClassifier, cells[1:], [K._settings(T.make_classifier("random_forest", **p)) for p in points], spark).collect()}
    assert len(got) == 36
    for i in (0, 3, 6, 9):
        model = PipelineModel([T.assembler(COLS), K.fit(T.make_classifier("random_forest", **points[i]), cells[2], spark)])
        assert got[1, i] == _counts(model.transform(data.filter("fold = 1")))


def test_boosted_grid_equals_staged_fits(data, monkeypatch):
    points = [{"maxDepth": 2, "stepSize": s, "maxIter": n} for s in (0.1, 0.5) for n in (2, 4)]
    few = data.withColumn("c", F.floor("c"))
    want = U.staged_search("gradient_boosting", few, COLS, "label", points, ["id"])
    monkeypatch.setattr(T, "COUNT_FROM", 1)
    assert [r.f1 for r in U.staged_search("gradient_boosting", few, COLS, "label", points, ["id"])] == [r.f1 for r in want]


def test_counted_forest_is_a_model_of_sparks(data, tmp_path):
    model = T.retrain("random_forest", data, COLS, "label", {"numTrees": 30, "maxDepth": 6}, count_from=0)
    clf = model.stages[-1]
    assert clf.getNumTrees == 30 and clf.getMaxDepth() == 6 and clf.featureImportances.toArray().sum() == pytest.approx(1)
    root = A.spark_ensemble(model).trees
    assert len({t[0].cover for t in root}) > 1 and all(abs(t[0].cover - 2000) < 250 for t in root)  # bags
    model.save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    assert _counts(back.transform(data)) == _counts(model.transform(data))
    plain = T.retrain("random_forest", data, COLS, "label", {"numTrees": 30, "maxDepth": 6}, count_from=10**9)
    hit = [sum(_counts(m.transform(data))[::2]) / 2000 for m in (model, plain)]
    assert abs(hit[0] - hit[1]) < 0.02 and hit[0] > 0.85


def test_newton_trees_of_one_task_are_those_of_many(data, monkeypatch):
    holes = data.withColumn("b", F.when(F.col("id") % 13 > 0, F.col("b")))
    p = B.NewtonParams(rounds=3, depth=4)
    with monkeypatch.context() as m:
        m.setattr(B, "level_splits", None)  # no job a level
        one = B.fit_newton(holes, COLS, "label", p)
    monkeypatch.setattr(B, "LOCAL_CELLS", -1)
    assert B.fit_newton(holes, COLS, "label", p) == one and len(one.trees) == 3


def test_newton_sums_of_many_rows():
    rng = np.random.default_rng(7)
    bins, n = rng.integers(-1, 9, (2, 200)).astype(np.int16), rng.integers(0, 9, (2, 200))
    p = B.NewtonParams(rounds=2, depth=3, l2=0.0)
    few, many = (list(B._local_trees(bins, *(n * k), B.NewtonParams(rounds=2, depth=3, l2=0.0), 0.0)) for k in (1, 1 << 16))
    for a, b in zip(few, many):  # without a penalty, values don't depend on how often rows repeat
        assert a.keys() == b.keys() and all(a[k].left_value == pytest.approx(b[k].left_value, abs=1e-6) for k in a)
    assert p.rounds == len(many)


def test_written_split_is_the_same(data):
    odd = data.withColumn("label", F.when(F.col("id") % 10 > 0, F.col("label"))).unionByName(data.filter("id < 40"))
    a, b = (sorted(map(str, S.stratified_split(odd, "label", ["id"], 0.3, 1, digits=1, write=w).collect())) for w in (False, True))
    assert a == b and len(a) == 2040


def test_attributions_by_cells(data):
    ens = A.spark_ensemble(T.retrain("gradient_boosting", data, COLS, "label", {"maxIter": 5, "maxDepth": 3}, count_from=0))
    x = np.random.default_rng(2).choice([*range(-1, 9), 2.5, math.inf, math.nan], (500, 3))
    work = A.Attributor(ens, 3)
    want = work.values(x)
    work.seen = work.cells
    assert np.array_equal(work.values(x), want) and work.table is not None


def test_grid_selection_and_attributions_are_whole(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(U, "staged_search", lambda kind, train, cols, label, points, *a, **k: seen.update(points=points) or [])
    q_train.cv_grid(spark, "/root/testdata/sf0.001")
    assert seen["points"] == U.grid_points("random_forest", "cloud") and len(seen["points"]) == 27
    real = T.evaluate_candidates

    def few(train, test, cols, candidates, folds, **more):
        seen.update(candidates=candidates, folds=folds)
        return real(train, test, cols, candidates={"random_forest": {"numTrees": 2, "maxDepth": 2}}, folds=folds, **more)

    monkeypatch.setattr(T, "evaluate_candidates", few)
    assert q_train.model_select(spark, "/root/testdata/sf0.001").count() > 0
    assert seen["folds"] == 3 and seen["candidates"] == {"random_forest": {}, "gradient_boosting": {}, "boosting_depth6": {}, "not_a_model": {}}
    monkeypatch.setattr(T, "retrain", lambda kind, data, cols, *a, f=T.retrain, **k: f(kind, data, cols, "label", {"maxIter": 2, "maxDepth": 2}))
    monkeypatch.setattr(A, "attribution_summary", lambda rows, cols: rows)
    assert q_boost.tree_attribution_summary(spark, "/root/testdata/sf0.001").count() == q_train._lineitem(spark, "/root/testdata/sf0.001").count()
