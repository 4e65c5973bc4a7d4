import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sparkprep.operators import attribution as A
from sparkprep.operators import bind
from sparkprep.operators import boosting as B
from sparkprep.operators import explain as X
from sparkprep.operators import train as T


def _table(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = (float(x) for x in rng.integers(0, 6, 3))
        y = int((a > 2) != (b > 3)) if rng.random() < 0.95 else int(rng.random() < 0.5)
        rows.append((i, None if rng.random() < 0.1 else a, float("nan") if rng.random() < 0.1 else b, c, y))
    return rows, spark.createDataFrame(rows, "id long, a double, b double, c double, label int")


def _brute_margins(x, y, p):
    """Level-wise second-order boosting with every value as an edge."""
    margin = np.zeros(len(y))
    for _ in range(p.rounds):
        prob = 1 / (1 + np.exp(-margin))
        g, h = np.rint((prob - y) * 2 ** 30), np.rint(prob * (1 - prob) * 2 ** 30)

        def grow(rows, level):
            score = lambda r: (g[r].sum() / 2 ** 30) ** 2 / (h[r].sum() / 2 ** 30 + p.l2)  # noqa: B023, E731
            best = None
            if level < p.depth:
                for f in range(x.shape[1]):
                    v = x[rows, f]
                    for k, t in enumerate(np.unique(v[~np.isnan(v)])):
                        for missing_left in (True, False) if np.isnan(v).any() else (True,):
                            left = np.where(np.isnan(v), missing_left, v <= t)
                            lr, rr = rows[left], rows[~left]
                            if len(lr) and len(rr) and min(h[lr].sum(), h[rr].sum()) >= p.min_child_hessian * 2 ** 30:  # noqa: B023
                                gain = 0.5 * (score(lr) + score(rr) - score(rows)) - p.min_gain
                                order = (gain, -f, -t, missing_left)
                                if gain > 0 and (best is None or order > best[0]):
                                    best = (order, lr, rr)
            if best is None:
                if level:
                    margin[rows] -= p.step * (g[rows].sum() / 2 ** 30) / (h[rows].sum() / 2 ** 30 + p.l2)  # noqa: B023
                return
            grow(best[1], level + 1)
            grow(best[2], level + 1)

        grow(np.arange(len(y)), 0)
    return margin


@pytest.fixture(scope="module")
def fitted(spark):
    rows, df = _table(spark)
    p = B.NewtonParams(rounds=5, step=0.3, depth=3)
    return rows, df, p, B.fit_newton(df.repartition(5), ["a", "b", "c"], "label", p, refresh=2)


def test_newton_boosting_equals_brute_force(fitted):
    rows, df, p, model = fitted
    x = np.array([[math.nan if v is None else v for v in r[1:4]] for r in rows])
    want = _brute_margins(x, np.array([r[4] for r in rows], float), p)
    got = {r.id: r.margin for r in model.margins(df, [F.col("id")]).collect()}
    assert np.allclose([got[r[0]] for r in rows], want, atol=1e-9)


def test_newton_boosting_learns_and_does_not_depend_on_partitions(fitted):
    _, df, p, model = fitted
    again = B.fit_newton(df.coalesce(1), ["a", "b", "c"], "label", p)
    assert again.trees == model.trees
    hit = model.transform(df).filter("a is not null and not isnan(b)").select(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert hit > 0.9


def test_newton_save_load_and_empty(fitted, spark, tmp_path):
    _, df, _, model = fitted
    model.save(spark, str(tmp_path / "m"))
    back = B.NewtonModel.load(spark, str(tmp_path / "m"))
    assert back == model
    assert back.transform(df).columns == [*df.columns, "p1", "prediction"]
    none = B.fit_newton(df.limit(0), ["a", "b", "c"])
    assert none.trees == [] and none.transform(df).filter("p1 <> 0.5").count() == 0


def _subset_value(nodes, x, known):
    def walk(k):
        n = nodes[k]
        if n.feature < 0:
            return n.value
        if n.feature in known:
            v = x[n.feature]
            return walk(n.left if (n.missing_left if math.isnan(v) else v <= n.threshold) else n.right)
        return (nodes[n.left].cover * walk(n.left) + nodes[n.right].cover * walk(n.right)) / n.cover
    return walk(0)


def _random_tree(rng, n_features, depth):
    nodes = []

    def add(level, cover):
        at = len(nodes)
        nodes.append(None)
        if level == depth or cover < 2 or rng.random() < 0.15:
            nodes[at] = A.Node(-1, 0.0, -1, -1, float(rng.normal()), cover)
            return at
        left = float(rng.integers(1, int(cover)))
        f, t, m = int(rng.integers(n_features)), float(rng.integers(0, 5)), bool(rng.random() < 0.5)
        a, b = add(level + 1, left), add(level + 1, cover - left)
        nodes[at] = A.Node(f, t, a, b, 0.0, cover, m)
        return at

    add(0, 200.0)
    return nodes


def test_attributions_equal_all_subsets():
    rng = np.random.default_rng(4)
    n = 6
    ens = A.Ensemble([_random_tree(rng, n, 5) for _ in range(8)], list(rng.normal(size=8)), 0.25)
    x = rng.integers(0, 6, (30, n)).astype(float)
    x[rng.random(x.shape) < 0.1] = math.nan
    work = A.Attributor(ens, n)
    got = work.values(x)
    for row, own in zip(x, got):
        value = {s: 0.25 + sum(w * _subset_value(t, row, set(s)) for t, w in zip(ens.trees, ens.weights)) for k in range(n + 1) for s in itertools.combinations(range(n), k)}
        assert math.isclose(work.base, value[()], abs_tol=1e-9)
        for i in range(n):
            phi = sum(math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (value[tuple(sorted((*s, i)))] - value[s])
                      for s in value if i not in s)
            assert math.isclose(own[i], phi, abs_tol=1e-9)


def test_attributions_add_up_to_the_models(fitted, spark):
    _, df, _, model = fitted
    feats = ["a", "b", "c"]
    got = A.tree_attributions(df, A.newton_ensemble(model), ["id"], feats).selectExpr("id", "base + a + b + c as s")
    assert got.join(model.margins(df, [F.col("id")]), "id").filter("abs(s - margin) > 1e-9").count() == 0
    full = df.filter("a is not null and not isnan(b)")
    for kind, params in (("random_forest", {"numTrees": 6, "maxDepth": 4}), ("gradient_boosting", {"maxIter": 5, "maxDepth": 2})):
        clf = T.make_classifier(kind, **params)
        fit = Pipeline(stages=[T.assembler(feats), clf]).fit(full.withColumn("label", F.col("label").cast("double")))
        rows = A.tree_attributions(full, A.spark_ensemble(fit), ["id"], feats).selectExpr("id", "base + a + b + c as s")
        p = fit.transform(full).select("id", _probability()).collect()
        want = {r.id: r.p for r in p}
        for r in rows.collect():
            out = r.s if kind == "random_forest" else 1 / (1 + math.exp(-2 * r.s))
            assert math.isclose(out, want[r.id], abs_tol=1e-6)


def _probability():
    from pyspark.ml.functions import vector_to_array

    return vector_to_array("probability")[1].alias("p")


def test_attribution_summary_ranks(spark):
    df = spark.createDataFrame([(1, 0.5, -1.0), (2, -0.5, 3.0)], "id long, u double, v double")
    got = [tuple(r) for r in A.attribution_summary(df, ["u", "v"]).orderBy("rank").collect()]
    assert got == [("v", 2.0, 1.0, 1), ("u", 0.5, 0.0, 2)]


def test_attributions_of_an_empty_frame_and_null_keys(fitted, spark):
    _, df, _, model = fitted
    ens = A.newton_ensemble(model)
    assert A.tree_attributions(df.limit(0), ens, ["id"], ["a", "b", "c"]).count() == 0
    odd = df.limit(2).withColumn("id", F.lit(None).cast("long"))
    assert A.tree_attributions(odd, ens, ["id"], ["a", "b", "c"]).filter("id is null and base is not null").count() == 2


def test_permutation_importance(spark):
    df = spark.range(2000).select("id", (F.col("id") % 10).cast("double").alias("u"), (F.col("id") % 7).cast("double").alias("v"), (F.col("id") % 10 > 4).cast("int").alias("label"))
    rule = lambda d: d.withColumn("prediction", (F.col("u") > 4).cast("int"))
    for metric in ("accuracy", "f1"):
        got = {r.feature: r for r in X.permutation_importance(df.repartition(3), rule, ["id"], ["u", "v"], metric=metric).collect()}
        assert got["u"].base == 1.0 and 0.4 < got["u"].importance < 0.6 and got["u"]["rank"] == 1
        assert got["v"].importance == 0.0 and got["v"]["rank"] == 2
    assert [r.importance for r in X.permutation_importance(df.limit(0), rule, ["id"], ["u", "v"]).collect()] == [None, None]


def test_binding_by_position(spark):
    a = spark.range(0, 1000, 1, 7).select(F.col("id").alias("x"), F.lit("l").alias("part"))
    b = spark.range(0, 1000, 1, 3).select((F.col("id") * 2).alias("y"), F.lit("r").alias("at"))
    got = bind.bind_columns(a, b)
    assert got.count() == 1000 and got.filter("y <> 2 * x").count() == 0 and got.columns == ["x", "part", "y", "at"]
    assert bind.bind_columns(a, b, None, [F.col("y").desc()]).filter("y <> 2 * (999 - x)").count() == 0
    with pytest.raises(ValueError, match="1000 rows can't be bound to 999"):
        bind.bind_columns(a, b.limit(999))
    with pytest.raises(ValueError, match="both sides"):
        bind.bind_columns(a, b.withColumn("x", F.lit(1)))
    assert bind.bind_columns(a.limit(0), b.limit(0)).count() == 0
