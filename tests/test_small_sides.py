"""Tables with a row a column or a row a file are broadcast: dealt by that
key, one task would get all values of a column, or all rows of a file."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from sparkprep.operators import drift as D
from sparkprep.streaming import key_index


@pytest.fixture()
def no_broadcast_by_size(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_values_of_a_column_are_not_dealt_by_its_name(spark, no_broadcast_by_size):
    df = spark.range(3000).select((F.col("id") / 7).alias("x"), (F.col("id") % 4).cast("string").alias("v"))
    out = D.column_drift(df, df.filter("x > 100"), ["x", "v"], exact=False)
    assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin [column_name") >= 2
    assert {r.column_name: r.test for r in out.collect()} == {"x": "wasserstein", "v": "jensenshannon"}


def test_rows_of_a_file_are_not_dealt_by_its_name(spark, no_broadcast_by_size, tmp_path, monkeypatch):
    target, plans = str(tmp_path / "t"), {}
    spark.range(100).write.parquet(target)
    write = DataFrameWriter.parquet

    def kept(self, path, *a, **k):
        plans[path.rsplit("/", 1)[1]] = self._df._jdf.queryExecution().executedPlan().toString()
        return write(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", kept)
    key_index._index_new(spark, target, str(tmp_path / "i"), ["id"])
    assert "BroadcastHashJoin [file" in plans["words"] and "SortMergeJoin [file" not in plans["words"]
