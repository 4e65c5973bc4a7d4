"""Tail probabilities against numerical integration, exact quantiles against
numpy, and the traps of splits, loads, CSV and joins."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.functions.exprs import chi2_sf, kolmogorov_sf
from sparkprep.functions.joins import lookup_join
from sparkprep.functions.ordered import exact_quantiles
from sparkprep.operators import clean as C
from sparkprep.operators import drift as D
from sparkprep.operators import profile as P
from sparkprep.operators import split as S
from sparkprep.sources.sinks import conform
from sparkprep.sources.tables import read_csv


def _chi2_tail(x, dof):
    """Upper tail by Simpson's rule on the density, 60 standard deviations to the right."""
    a = dof / 2
    hi = x + 60 * math.sqrt(2 * dof) + 200
    t = np.linspace(x, hi, 400_001)
    with np.errstate(divide="ignore"):
        y = np.exp((a - 1) * np.log(t / 2) - t / 2 - math.lgamma(a)) / 2
    w = np.ones_like(t)
    w[1:-1:2], w[2:-1:2] = 4, 2
    return float((y * w).sum() * (t[1] - t[0]) / 3)


@pytest.mark.parametrize("dof", [1, 2, 3, 7, 50, 801, 900, 1000, 3000, 10000])
def test_chi2_tail(spark, dof):
    for x in (0.5 * dof + 0.1, 0.97 * dof, float(dof), 1.05 * dof, dof + 4 * math.sqrt(2 * dof)):
        got = spark.range(1).select(chi2_sf(F.lit(x), F.lit(dof))).first()[0]
        want = math.erfc(math.sqrt(x / 2)) if dof == 1 else _chi2_tail(x, dof)
        assert got == pytest.approx(want, rel=1e-6, abs=1e-10), (dof, x)


def test_kolmogorov_tail(spark):
    want = {0.002: 1.0, 0.01: 1.0, 0.2: 1.0, 0.5: 0.9639452436, 0.8276: 0.5, 1.0: 0.2699996717, 1.3581: 0.05, 1.6276: 0.01, 2.0: 0.0006709253}
    for lam, p in want.items():
        got = spark.range(1).select(kolmogorov_sf(F.lit(lam))).first()[0]
        assert got == pytest.approx(p, abs=2e-4 if p in (0.5, 0.05, 0.01) else 1e-9), lam


def test_exact_quantiles(spark):
    rng = np.random.default_rng(0)
    cols = {"a": rng.normal(size=3001), "b": rng.lognormal(0, 6, size=3001), "c": rng.integers(0, 3, 3001).astype(float), "d": np.full(3001, 7.5),
            "e": np.concatenate([[1e300, -1e300], rng.normal(size=2999) * 1e-9])}
    rows = [tuple(float(v[i]) for v in cols.values()) for i in range(3001)] + [(None,) * 5, (float("nan"),) * 5]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, {c: F.col(c) for c in cols}, probs, bins=16)
    for c, v in cols.items():
        assert got[c] == pytest.approx(np.quantile(v, probs).tolist(), rel=1e-12), c
    assert exact_quantiles(df.limit(0), {"a": F.col("a")}, [0.5]) == {"a": [None]}
    assert "percentile" not in P.describe(df)._jdf.queryExecution().toString()
    assert C.medians(df, []) == {}


def test_split_keeps_null_labels_and_quotas(spark):
    df = spark.range(1000).selectExpr("id as k", "case when id % 3 = 0 then null when id % 3 = 1 then 'a' else 'b' end as y")
    for digits in (1, 2, 4):
        got = S.stratified_split(df, "y", ["k"], 0.2, digits=digits)
        assert {(r.y, r.is_test): r.n for r in got.groupBy("y", "is_test").agg(F.count("*").alias("n")).collect()} == {
            (None, True): 67, (None, False): 267, ("a", True): 67, ("a", False): 266, ("b", True): 67, ("b", False): 266}
    everything = S.stratified_split(df, "y", ["k"], 1.0)
    assert everything.filter("is_test").count() == 1000
    keys = spark.createDataFrame([("a", None), ("a", "")], "p string, q string")
    assert keys.select(S.key_hash(["p", "q"])).distinct().count() == 2


def test_strict_load_refuses_bad_values(spark):
    df = spark.createDataFrame([("abc",), (None,)], "x string")
    with pytest.raises(Exception, match="does not fit"):
        conform(df, "x bigint").collect()
    with pytest.raises(Exception, match="does not fit"):
        conform(spark.createDataFrame([(3_000_000_000,)], "x long"), "x int").collect()
    assert [r.x for r in conform(df, "x bigint", strict=False).collect()] == [None, None]


def test_csv_like_pandas(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b,c,d\n1,"he said ""hi""",1.5,True\nNA,"two\nlines",nan,false\n3,,2e3,\n')
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert df.dtypes == [("a", "bigint"), ("b", "string"), ("c", "double"), ("d", "boolean")]
    assert [tuple(r) for r in df.collect()] == [(1, 'he said "hi"', 1.5, True), (None, "two\nlines", None, False), (3, None, 2000.0, None)]


def test_group_contrast_drops_null_groups(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 3.0), (None, 100.0)], "g string, v double")
    r = P.group_contrast(df, "g").first()
    assert (r.mean_0, r.mean_1) == (1.0, 3.0)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    got = {(r.col_a, r.col_b): r["corr"] for r in P.corr_matrix(df).collect()}
    assert math.isnan(got[("a", "a")]) and got[("b", "b")] == 1.0


def test_equal_hot_rows_are_salted(spark):
    big = spark.range(2000).selectExpr("'hot' as lvl", "1 as x")
    small = spark.createDataFrame([("hot", 5.0)], "lvl string, e double")
    j = lookup_join(big, small, "lvl", "left", salts=8)
    assert j.filter("e = 5.0").count() == 2000 and j.columns == ["lvl", "x", "e"]


def test_named_drift_tests_and_unmatched_columns(spark):
    a = spark.range(200).selectExpr("cast(id as double) v", "id % 7 as w", "1 as gone")
    b = spark.range(200).selectExpr("cast(id as double) v", "id % 7 as w", "1 as new")
    assert set(D.unmatched_columns(a, b)) == {("gone", "reference"), ("new", "current")}
    got = {r.column_name: r.test for r in D.column_drift(a, b, ["v", "w"], tests={"v": "wasserstein"}).collect()}
    assert got["v"] == "wasserstein" and got["w"] == "ks"


def _pair(spark):
    a = spark.range(400).selectExpr("cast(id % 97 as double) v", "id % 7 as w", "case when id % 3 = 0 then 'a' else 'b' end as b2", "cast(id % 40 as string) s")
    b = spark.range(300).selectExpr("cast((id * 3) % 120 as double) v", "id % 9 as w", "case when id % 5 = 0 then 'a' else 'b' end as b2", "cast((id * 2) % 40 as string) s")
    return a, b


@pytest.mark.parametrize("small", [1000, 10])
def test_one_pass_drift_equals_single_tests(spark, small):
    a, b = _pair(spark)
    one = ((D.ks_test, "v"), (D.ks_test, "w"), (D.proportion_z, "b2"), (D.chi_square, "s")) if small == 1000 else (
        (D.wasserstein, "v"), (D.wasserstein, "w"), (D.jensen_shannon, "b2"), (D.jensen_shannon, "s"))
    got = {r.column_name: r for r in D.column_drift(a, b, small_reference=small).collect()}
    for test, c in one:
        want = test(a, b, c).first()
        for name in ("test", "statistic", "p_value", "threshold", "drifted", "n_ref", "n_cur"):
            x, y = getattr(got[c], name), getattr(want, name)
            assert x == pytest.approx(y, rel=1e-9) if isinstance(y, float) else x == y, (c, name)


def test_drift_jobs_do_not_grow_with_columns(spark):
    a, b = _pair(spark)
    wide = lambda df, n: df.select(*[F.col(c).alias(f"{c}{i}") for i in range(n) for c in df.columns])
    sc, counts = spark.sparkContext, []
    for n in (1, 3):
        sc.setJobGroup(f"drift{n}", "")
        D.column_drift(wide(a, n), wide(b, n)).collect()
        counts.append(len(sc.statusTracker().getJobIdsForGroup(f"drift{n}")))
    sc.setJobGroup("", "")
    assert counts[0] == counts[1]


def test_scored_stream_replay_adds_no_rows(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    from sparkprep.streaming.incremental import file_stream, stream_score

    rows = spark.range(60).selectExpr("id", "cast(id as double) x", "cast(id > 30 as double) label")
    rows.write.parquet(str(tmp_path / "src"))
    features = Pipeline(stages=[SQLTransformer(statement="SELECT id, x FROM __THIS__")]).fit(rows)
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression()]).fit(rows)
    for checkpoint in ("c1", "c2"):  # the second run starts from nothing, as after a lost checkpoint
        stream_score(file_stream(spark, str(tmp_path / "src"), rows.schema), features, model, "id", str(tmp_path / "out"), str(tmp_path / checkpoint))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60


def test_model_path_falls_back_to_the_registry(spark, tmp_path):
    from sparkprep.plans.workflow import JobConfig, load_scoring_model

    with pytest.raises(FileNotFoundError):
        load_scoring_model(spark, str(tmp_path / "registry"), str(tmp_path / "none"))
    cfg = JobConfig.of({"label": "y", "folds": "4", "test_fraction": "0.25"})
    assert (cfg.label, cfg.folds, cfg.test_fraction, cfg.seed) == ("y", 4, 0.25, 42)
    with pytest.raises(ValueError):
        JobConfig.of({"unknown": "1"})


def test_exact_quantiles_with_infinities_and_denormals(spark):
    from pyspark.sql import functions as F

    from sparkprep.functions.ordered import exact_quantiles

    inf = float("inf")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for values, want in (([1.0, 2.0, inf, inf, inf], [1.0, 2.0, inf, inf, inf]), ([0.0, 5e-324], [0.0, 0.0, 0.0, 5e-324, 5e-324]), ([-inf, -inf, 3.0, 4.0, inf], [-inf, -inf, 3.0, 4.0, inf]),
                         ([inf], [inf] * 5), ([-inf, 7.0], [-inf, -inf, -inf, -inf, 7.0]), ([None, float("nan")], [None] * 5)):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = exact_quantiles(df, {"v": F.col("v")}, probs)["v"]
        assert got[0] == want[0] and got[-1] == want[-1]
        assert [g for g, w in zip(got, want) if values != [0.0, 5e-324]] == [w for w in want if values != [0.0, 5e-324]]
