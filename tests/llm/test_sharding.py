import collections
import math
import zlib

from pyspark.sql import functions as F
from util import SF001, empty_docs, odd_docs, odd_rows

from sparkprep.llm import queries, sharding


def _check_slots(got, shards):
    """got: (shard, slot) pairs. Counts differ by one at most; slots are gapless from 0."""
    slots = collections.defaultdict(list)
    for shard, slot in got:
        slots[shard].append(slot)
    counts = [len(slots[k]) for k in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_sharding_query(spark):
    got = queries.op11_sharding(spark, SF001)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    _check_slots([(r.shard, r.slot) for r in rows], 24)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    raw = [(d.doc_id, (d.text or "").encode()) for d in docs]
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == collections.Counter((k, len(b) + 8, zlib.crc32(b)) for k, b in raw)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert sorted(rows) == sorted(queries.op11_sharding(spark, SF001).collect())


def test_hypergeometric_distribution(spark):
    for good, bad, draws in ((30, 50, 20), (2, 900, 400), (7, 0, 3), (5, 5, 10)):
        n = 40_000
        ids = spark.range(n)
        k = sharding.hypergeometric(F.lit(good) + F.col("id") * 0, F.lit(bad), F.lit(draws), sharding._uniform(F.lit(good), "id"))
        found = {r.k: r["count"] / n for r in ids.select(k.alias("k")).groupBy("k").count().collect()}
        assert all(max(0, draws - bad) <= x <= min(draws, good) for x in found)
        for x in range(max(0, draws - bad), min(draws, good) + 1):
            p = math.comb(good, x) * math.comb(bad, draws - x) / math.comb(good + bad, draws)
            assert abs(found.get(x, 0) - p) < 6 * math.sqrt(p * (1 - p) / n) + 1 / n


def test_hypergeometric_is_the_inverse_of_the_distribution(spark):
    """At evenly spaced u each value comes as often as its probability says, to one draw."""
    n = 10_000
    u = (F.col("id") + 0.5) / n
    k = sharding.hypergeometric(F.lit(40) + F.col("id") * 0, F.lit(60), F.lit(25), u)
    found = {r.k: r["count"] for r in spark.range(n).select(k.alias("k")).groupBy("k").count().collect()}
    for x in range(26):
        assert abs(found.get(x, 0) - n * math.comb(40, x) * math.comb(60, 25 - x) / math.comb(100, 25)) <= 1


def test_matrix_margins_over_several_levels(spark):
    rows = {p: (p * 37) % 91 for p in range(0, 300, 2)}
    counts = spark.createDataFrame(list(rows.items()), "part int, rows long")
    cells = {r.part: r.cells for r in sharding.communication_matrix(counts, 7).collect()}
    assert {p: sum(c) for p, c in cells.items()} == rows
    columns = [sum(c) for c in zip(*cells.values())]
    assert sum(columns) == sum(rows.values()) and max(columns) - min(columns) <= 1
    assert sharding.communication_matrix(counts.limit(0), 7).count() == 0


def test_matrix_cells_follow_the_law(spark):
    """One cell over several seeds, against the mean and spread of the hypergeometric law."""
    counts = spark.createDataFrame([(0, 30), (1, 50), (2, 40)], "part int, rows long")
    cells = [next(r.cells[1] for r in sharding.communication_matrix(counts, 3, seed).collect() if r.part == 2) for seed in range(8)]
    mean = sum(cells) / len(cells)
    sd = math.sqrt(40 * (1 / 3) * (2 / 3) * 80 / 119)
    assert abs(mean - 40 / 3) < 4 * sd / math.sqrt(len(cells))
    assert len(set(cells)) > 2 and all(abs(c - 40 / 3) < 5 * sd for c in cells)


def test_sharding_odd_rows(spark):
    docs = odd_docs(spark).withColumn("slot", F.lit("x")).withColumn("row", F.lit(1)).withColumn("at", F.lit(2)).withColumn("part", F.lit(3)).withColumn("a.b", F.lit(4))
    got = sharding.shuffle_into_shards(docs.repartition(5), 4, bucket_rows=2)
    assert got.columns == [c for c in docs.columns if c != "slot"] + ["shard", "slot"]
    rows = got.collect()
    _check_slots([(r.shard, r.slot) for r in rows], 4)
    assert collections.Counter((r.doc_id, r.text) for r in rows) == collections.Counter((r[0], r[1]) for r in odd_rows())
    assert {(r.row, r["at"], r.part, r["a.b"], r.target) for r in rows} == {(1, 2, 3, 4, "x")}
    assert sharding.shuffle_into_shards(empty_docs(spark), 4).count() == 0
    _check_slots([(r.shard, r.slot) for r in sharding.shuffle_into_shards(docs.limit(3), 5).collect()], 5)


def test_equal_rows_are_spread(spark):
    same = spark.range(0, 3000, 1, 6).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shuffle_into_shards(same, 6, bucket_rows=100).collect()
    _check_slots([(r.shard, r.slot) for r in rows], 6)


def test_order_is_shuffled(spark):
    """Ranks of neighbours in the input have no correlation with their places."""
    rows = sharding.shuffle_into_shards(spark.range(0, 6000, 1, 4), 3, bucket_rows=500).collect()
    place = {r.id: r.shard * 2000 + r.slot for r in rows}
    x = [place[i] - 2999.5 for i in range(6000)]
    var = sum(a * a for a in x)
    assert abs(sum(a * b for a, b in zip(x, x[1:])) / var) < 0.06
    assert abs(sum((i - 2999.5) * a for i, a in enumerate(x)) / var) < 0.06


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "s"), 5)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() and set(back.columns) == set(docs.columns) | {"shard", "slot"}
    _check_slots([(r.shard, r.slot) for r in back.select("shard", "slot").collect()], 5)
