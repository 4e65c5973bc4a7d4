"""Encoders, the feature estimator, persistence and pipeline composition."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sparkprep.operators import encode as E
from sparkprep.plans.features import FeatureEngineer, FeatureModel, FeatureSpec, lead_preset

ROWS = [
    (1, "a", "x", 1, 10.0), (2, "a", "y", 0, None), (3, "a", "x", 1, 30.0), (4, "b", "x", 0, 40.0),
    (5, "b", None, 1, 50.0), (6, "c", "y", 0, 60.0), (7, "Select", "z", 1, 70.0),
]
SCHEMA = "id long, cat string, oh string, y int, num double"


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_smoothed_encoding_formula(frame):
    enc = E.target_encoding_fit(frame, ["cat"], "y")
    prior = 4 / 7
    got = {r.level: r.encoded for r in enc.stats.collect()}
    w = 1 / (1 + math.exp(-(3 - 20) / 10))
    assert abs(got["a"] - (prior * (1 - w) + (2 / 3) * w)) < 1e-12
    assert got["c"] == pytest.approx(prior)  # a level seen once gets the prior


def test_unseen_and_null_levels_get_prior(spark, frame):
    enc = E.target_encoding_fit(frame.filter("cat <> 'c'"), ["cat"], "y")
    out = E.target_encoding_transform(spark.createDataFrame([("c",), (None,)], "cat string"), enc)
    assert all(r.cat == pytest.approx(enc.prior) for r in out.collect())
    out2 = E.apply_level_values(spark.createDataFrame([("c",), ("a",)], "cat string"), enc.cols, enc.stats, "encoded",
                                enc.prior)
    ref = E.target_encoding_transform(spark.createDataFrame([("c",), ("a",)], "cat string"), enc)
    assert sorted(r.cat for r in out2.collect()) == sorted(r.cat for r in ref.collect())


def test_one_hot_fitted_rows_sum_at_most_one(frame):
    oh = E.one_hot_fit(frame, ["oh"])
    assert oh.levels["oh"] == ["y", "z", None]  # 'x' dropped, null last
    out = E.one_hot_transform(frame, oh)
    cols = [c for c in out.columns if c.startswith("oh_")]
    assert out.select(sum(F.col(c) for c in cols).alias("s")).agg(F.max("s")).first()[0] <= 1


def test_one_hot_indexed_drops_rarest_and_passthrough(spark, frame):
    one_level = frame.withColumn("one", F.lit("k"))
    oh = E.one_hot_indexed_fit(one_level, ["oh", "one"])
    assert oh.levels["oh"] == ["x", "y"] and oh.passthrough == ["one"]


def _spec():
    return FeatureSpec(target="y", te_cols=["cat"], ohe_cols=["oh"], numeric_cols=["num"], drop_cols=["id"],
                       fills={"oh": "none"}, rare_col="cat", rare_min_count=2)


def test_feature_model_roundtrip(spark, frame, tmp_dir):
    model = FeatureEngineer(_spec()).fit(frame)
    out = model.transform(frame)
    assert out.filter(F.col("num").isNull()).count() == 0
    path = tmp_dir + "/fm"
    model.write().overwrite().save(path)
    back = FeatureModel.load(path)
    a = sorted(map(tuple, out.collect()))
    b = sorted(map(tuple, back.transform(frame).collect()))
    assert a == b and back.transform(frame).columns == out.columns


def test_transform_of_fit_data_is_stable(spark, frame):
    model = FeatureEngineer(_spec()).fit(frame)
    out = model.transform(frame)
    assert out.count() == frame.count()
    # rare 'b','c' grouped to 'Others' and encoded
    assert out.select("cat").distinct().count() <= 3


def test_pipeline_composition(spark, frame, tmp_dir):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    spec = _spec()
    spec.drop_cols = ["id"]
    spec.keep_target = True
    fe = FeatureEngineer(spec)
    va = VectorAssembler(inputCols=["cat", "num"], outputCol="features", handleInvalid="keep")
    lr = LogisticRegression(labelCol="y", maxIter=5)
    pm = Pipeline(stages=[fe, va, lr]).fit(frame.withColumn("y", F.col("y").cast("double")))
    assert pm.transform(frame.withColumn("y", F.col("y").cast("double"))).count() == 7
    pm.write().overwrite().save(tmp_dir + "/pm")
    from pyspark.ml import PipelineModel
    assert PipelineModel.load(tmp_dir + "/pm").transform(frame.withColumn("y", F.col("y").cast("double"))).count() == 7


def test_presets_build():
    for k in ("canonical", "full_preprocess", "table_job", "minimal"):
        assert lead_preset(k).target
    assert len(lead_preset("canonical").drop_cols) == 20


def test_table_job_fit_ignores_repeated_rows(spark, frame):
    spec = _spec()
    spec.dedupe = True
    a = FeatureEngineer(spec).fit(frame)
    b = FeatureEngineer(spec).fit(frame.unionByName(frame.filter("id % 2 = 1")))
    assert a.state.rare_levels == b.state.rare_levels and a.state.medians == b.state.medians and a.state.prior == b.state.prior
    assert sorted(map(tuple, a.transform(frame).collect())) == sorted(map(tuple, b.transform(frame).collect()))
