"""State over batches and loads: segments, drift, dedupe, key index, sketches, level dictionaries."""

import math

import pytest
from pyspark.sql import functions as F

from sparkprep.operators import drift as D
from sparkprep.operators import encode as E
from sparkprep.operators import sketches as K
from sparkprep.sources.segments import add_segment, last_batch, read_state, tiles
from sparkprep.streaming import key_index
from sparkprep.streaming.drift_state import DriftState
from sparkprep.streaming.incremental import append_stream, dedupe_stream, file_stream, incremental_load, stream_drift, stream_score


def _sum(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


def test_tiles_are_few_and_cover_every_batch_once():
    for count in range(1, 300):
        held = []
        for k in tiles(count):
            held += range((k + 1) & k, k + 1)
        assert sorted(held) == list(range(count)) and len(tiles(count)) <= math.log2(count) + 1


def test_segments_merge_and_replay(spark, tmp_path):
    path = str(tmp_path / "s")
    assert last_batch(spark, path) is None and read_state(spark, path, _sum) is None
    for n in [0, 1, 2, 3, 4, 3, 4]:  # batches 3 and 4 are run again
        add_segment(spark, path, n, spark.createDataFrame([("a", 1), (f"b{n}", n)], "k string, n long"), _sum)
    got = {r.k: r.n for r in read_state(spark, path, _sum).collect()}
    assert got == {"a": 5, **{f"b{n}": n for n in range(5)}} and last_batch(spark, path) == 4
    assert {r.k: r.n for r in read_state(spark, path, _sum, 2).collect()} == {"a": 3, "b0": 0, "b1": 1, "b2": 2}


def _frames(spark):
    a = spark.range(400).selectExpr("case when id % 11 > 0 then cast(id % 97 as double) end v", "id % 4 as w", "case when id % 3 = 0 then 'a' else 'b' end as b2", "cast(id % 40 as string) s", "cast(null as string) e")
    b = spark.range(300).selectExpr("cast((id * 3) % 120 as double) v", "id % 3 as w", "case when id % 5 = 0 then 'a' else 'b' end as b2", "case when id % 7 > 0 then cast((id * 2) % 50 as string) end s", "cast(null as string) e")
    return a, b


@pytest.mark.parametrize("small", [1000, 10])
def test_stream_drift_equals_batch_drift_and_replay_adds_nothing(spark, tmp_path, small):
    a, b = _frames(spark)
    b.repartition(3).write.parquet(str(tmp_path / "src"))
    state = DriftState(spark, str(tmp_path / "state"), a)
    assert state.last() is None and state.drift().filter("n_cur > 0").count() == 0
    want = {r.column_name: r.asDict() for r in D.column_drift(a, b, small_reference=small).collect()}
    for run in ("c1", "c1", "c2"):  # nothing new, then all again from a lost checkpoint
        stream_drift(file_stream(spark, str(tmp_path / "src"), b.schema, max_files_per_trigger=1), state, str(tmp_path / run))
        got = {r.column_name: r.asDict() for r in DriftState(spark, str(tmp_path / "state"), a).drift(small_reference=small).collect()}
        assert got.keys() == want.keys()
        for c in want:
            assert got[c] == {k: pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for k, v in want[c].items()}
    assert state.rows_added() == 300 and state.last() == 2


def test_scores_and_drift_in_one_run(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    rows = spark.range(60).selectExpr("id", "cast(id as double) x", "cast(id > 30 as double) label")
    rows.repartition(2).write.parquet(str(tmp_path / "src"))
    features = Pipeline(stages=[SQLTransformer(statement="SELECT id, x FROM __THIS__")]).fit(rows)
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression()]).fit(rows)
    state = DriftState(spark, str(tmp_path / "state"), rows, ["x"])
    stream_score(file_stream(spark, str(tmp_path / "src"), rows.schema, max_files_per_trigger=1), features, model, "id", str(tmp_path / "out"), str(tmp_path / "c"), state)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60
    after = {r.batch_id: r for r in spark.read.parquet(str(tmp_path / "out_drift")).collect()}
    assert after[1].n_cur == 60 and after[1].statistic == 0.0 and after[0].n_cur < 60


def test_stream_dedupe_with_late_rows_and_null_keys(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "k string, ts timestamp, v long"
    day = lambda d: f"timestamp'2024-01-{d:02d}'"
    for rows in ([("a", 5, 1), ("b", 6, 1), (None, 6, 1)], [("a", 5, 1), ("c", 9, 1)], [("b", 2, 1), (None, 3, 1), ("d", 1, 1)]):
        q = " union all ".join(f"select {'null' if k is None else repr(k)} k, {day(d)} ts, {v}L v" for k, d, v in rows)
        spark.sql(q).coalesce(1).write.mode("append").parquet(src)
    stream = file_stream(spark, src, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
    for _ in range(2):
        append_stream(dedupe_stream(stream, ["k"], "ts", "20 days"), out, str(tmp_path / "c"))
    assert sorted(r.k or "" for r in spark.read.parquet(out).collect()) == ["", "a", "b", "c", "d"]


def test_key_index_rules_files_out_and_loses_no_key(spark, tmp_path):
    target, index = str(tmp_path / "t"), str(tmp_path / "i")
    for lo in (0, 1000, 5000):
        spark.range(lo, lo + 1000).selectExpr("id * 2 as id", "id as v").coalesce(1).write.mode("append").parquet(target)
    match = lambda rows: key_index.matching_files(spark, target, index, spark.createDataFrame([(r,) for r in rows], "id long"), ["id"])
    assert len(spark.read.parquet(target).inputFiles()) == 3
    assert match([]) == [] and match([None]) == [] and match([4500, 9999, 99_999]) == []  # between and beyond all ranges
    assert len(match([10, 10_500])) == 2
    odd = sum(len(match([k])) for k in range(1, 200, 40))  # in a range, but not in the file
    assert odd <= 1
    for k in range(0, 2000, 700):
        assert len(match([k])) == 1
    assert len(match(range(0, 4000, 2))) == 2  # more keys than a filter is asked for
    spark.range(1).selectExpr("id * 2 + 77777 as id", "id as v").write.mode("append").parquet(target)  # a load that wasn't indexed
    assert len(match([77777])) == 1


@pytest.mark.parametrize("keys", [["id"], ["name", "id"]])
def test_indexed_load_equals_the_plain_one(spark, tmp_path, keys):
    src = str(tmp_path / "src")
    rows = spark.range(900).selectExpr("case when id % 50 > 0 then id % 600 end as id", "concat('n', id % 600) as name")
    rows.repartition(4).write.parquet(src)
    found = []
    for i, index in enumerate((None, str(tmp_path / "index"))):
        out = str(tmp_path / f"out{i}")
        incremental_load(spark, file_stream(spark, src, rows.schema, max_files_per_trigger=1), out, str(tmp_path / f"c{i}"), keys, index_path=index)
        found.append(sorted((r.id is None, r.id, r.name) if keys == ["name", "id"] else (r.id is None, r.id or 0) for r in spark.read.parquet(out).filter("id is not null").collect()))
    assert found[0] == found[1] and len(found[0]) == len(set(found[0]))


def test_merged_sketches(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id", "cast(pow(id % 7919, 2) as double) x", "case when id % 3 = 0 then 'hot' else concat('k', id % 5000) end as s", "cast(null as double) none")
    cols, path = ["id", "x", "s", "none"], str(tmp_path / "k")
    for n in range(4):
        K.add_load(spark, path, n, df.filter(F.col("id") % 4 == n), cols)
    K.add_load(spark, path, 3, df.filter(F.col("id") % 4 == 3), cols)
    merged = K.loads_sketch(spark, path)
    got, whole = ({r.column_name: r for r in K.sketch_profile(s).collect()} for s in (merged, K.sketch(df, cols)))
    for c, distinct in (("id", 60_000), ("x", 7919), ("s", df.select("s").distinct().count()), ("none", 0)):
        assert (got[c].n, got[c].nulls, got[c].lo, got[c].hi) == (whole[c].n, whole[c].nulls, whole[c].lo, whole[c].hi)
        assert got[c].distinct_values == whole[c].distinct_values  # registers merge without loss
        assert abs(got[c].distinct_values - distinct) <= 0.03 * distinct
    assert got["none"].p50 is None and got["s"].p50 is None and got["none"].nulls == 60_000
    for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        rank = df.filter(F.col("x") <= got["x"][name]).count() / 60_000
        assert abs(rank - p) < 0.02
    top = {(r.column_name, r.level): r.n for r in K.top_levels(merged, 1).collect()}
    assert top[("s", "hot")] == 20_000
    assert K.sketch_profile(K.sketch(df.limit(0), cols)).count() == 0


def test_level_dictionary_of_many_levels(spark):
    df = spark.range(30_000).selectExpr("id", "concat('l', least(id, 20000)) as a", "case when id % 2 = 0 then 'x' when id % 3 = 0 then 'y' end as b")
    d = E.level_dictionary(df, ["a", "b"])
    got = {(r.column_name, r.level): (r.n, r.level_index) for r in d.filter("column_name = 'b' or level_index = 0").collect()}
    assert got == {("a", "l20000"): (10_000, 0), ("b", "x"): (15_000, 0), ("b", "y"): (5000, 1)}
    index = d.filter("column_name = 'a'").agg(F.min("level_index"), F.max("level_index"), F.count_distinct("level_index")).first()
    assert tuple(index) == (0, 20_000, 20_001)
    long = E.one_hot_long(df, "id", d, ["a", "b"])
    assert long.filter("column_name = 'b'").count() == 15_000 and long.filter("column_name = 'a'").count() == 29_999
    by_level = E.level_dictionary(df, ["b"], "level")
    assert E.one_hot_long(df, "id", by_level, ["b"], "first").count() == 5000 and E.one_hot_long(df, "id", by_level, ["b"], None).count() == 20_000


def test_sparse_one_hot_equals_the_wide_one(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, None), (6, "b"), (7, "a")], "id int, c string")
    d = E.level_dictionary(df, ["c"])
    sparse = {r.id: list(r.c_ohe.toArray()) for r in E.one_hot_sparse(df.union(spark.createDataFrame([(8, "new")], df.schema)), "c", d).collect()}
    wide = {r.id: [r.c_a, r.c_b] for r in E.one_hot_transform(df, E.one_hot_indexed_fit(df, ["c"])).fillna(0.0).collect()}
    assert sparse.pop(8) == [0.0, 0.0] and sparse == wide
    with pytest.raises(ValueError):
        E.one_hot_sparse(df.filter("c = 'a'"), "c", E.level_dictionary(df.filter("c = 'a'"), ["c"]))
