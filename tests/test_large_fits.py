"""Fits and explanations that don't grow with rows: counted bins, sums by arrays, variants by tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import attribution as A
from sparkprep.operators import boosting as B
from sparkprep.operators import evaluate as V
from sparkprep.operators import explain as X
from sparkprep.operators import train as T

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    u = lambda k, n: (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))).cast("double")
    df = spark.range(3000).select("id", u(1, 7).alias("a"), u(2, 5).alias("b"), (u(3, 20) / 4).alias("c"))
    return df.withColumn("label", ((F.col("a") + F.col("b") + F.col("c") + u(4, 3)) > 8).cast("double")).cache()


@pytest.mark.parametrize("kind", ["gradient_boosting", "boosting_depth6"])
def test_counted_bins_give_the_same_boosted_trees(data, kind):
    params = {"maxIter": 4, "maxDepth": 3}
    plain, counted = (T.retrain(kind, data, COLS, "label", params, count_from=n) for n in (10**9, 0))
    p = [{r.id: r.p1 for r in V.positive_probability(m.transform(data)).select("id", "p1").collect()} for m in (plain, counted)]
    assert all(math.isclose(p[0][k], p[1][k], abs_tol=1e-9) for k in p[0])
    holes = data.filter("id < 50").withColumn("b", F.when(F.col("id") % 2 == 0, float("nan")))
    assert [r.prediction for r in plain.transform(holes).orderBy("id").collect()] == [r.prediction for r in counted.transform(holes).orderBy("id").collect()]
    for bad in (None, float("nan"), float("inf")):  # no fit takes them
        with pytest.raises(Exception, match="NaN or Infinity"):
            T.retrain(kind, data.withColumn("b", F.when(F.col("id") != 5, F.col("b")).otherwise(bad)), COLS, "label", params, count_from=0)
    ens = A.spark_ensemble(counted)
    assert ens.trees[0][0].cover == 3000
    rows = A.tree_attributions(data, ens, ["id"], COLS).selectExpr("id", "base + a + b + c as s").collect()
    assert all(math.isclose(1 / (1 + math.exp(-2 * r.s)), p[0][r.id], abs_tol=1e-9) for r in rows)


def test_level_splits_equal_the_table_of_gains(data):
    data = data.withColumn("b", F.when(F.col("id") % 13 > 0, F.col("b")))
    p, edges = B.NewtonParams(), B.bin_edges(data, COLS)
    binned = B.to_bins(data, COLS, edges, ["label", F.lit(0.0).alias("margin")])
    tree = {}
    for level in range(2):
        want = {r["node"]: r.asDict() for r in B.best_splits(B.split_gains(B.histograms(binned, 3, [], tree, level), p)).collect()}
        found = B.level_splits(binned.groupBy(*binned.columns).agg(F.count("*").alias("n")), 3, [], tree, level, p).collect()
        got = {k: max((r for r in found if r["node"] == k), key=lambda r: (r["gain"], -r["feature"])).asDict() for k in {r["node"] for r in found}}
        assert got == want and want
        tree |= {k: B.Split(r["feature"], r["bin"], r["missing_left"], r["gain"], 0.0, 0.0) for k, r in got.items()}


def test_sums_of_many_rows_are_exact():
    x = np.array([(1 << 52) + 1, (1 << 52) + 3, -5], np.int64)
    assert B._sums(np.array([1, 1, 0]), x, 3).tolist() == [-5, (1 << 53) + 4, 0]


def test_shapley_by_tables_equals_scoring_every_variant(data, monkeypatch):
    df = data.filter("id < 60").withColumn("id", F.when(F.col("id") != 7, F.col("id")))
    for kind, params, n in (("gradient_boosting", {"maxIter": 3, "maxDepth": 3}, 0), ("gradient_boosting", {"maxIter": 2, "maxDepth": 5}, 10**9), ("random_forest", {"numTrees": 3, "maxDepth": 3}, 0)):
        model = T.retrain(kind, data, COLS, "label", params, count_from=n)
        ask = lambda: {(r.id, r.feature): r.contribution for r in X.sampled_shapley(model, df.unionByName(df), "id", COLS, data.limit(9), permutations=3).collect()}  # noqa: B023, E731
        assert X._tree_ensemble(model, COLS) is not None
        got = ask()
        with monkeypatch.context() as m:
            m.setattr(X, "_tree_ensemble", lambda *_: None)
            want = ask()
        assert got.keys() == want.keys() and len(got) == 240
        assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)


def test_shapley_aggregates_without_a_window(data):
    model = T.retrain("gradient_boosting", data, COLS, "label", {"maxIter": 2, "maxDepth": 2})
    got = X.sampled_shapley(model, data, "id", COLS, data.limit(9), permutations=2)
    assert "Window" not in got._jdf.queryExecution().toString()
