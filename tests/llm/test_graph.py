import pytest
from pyspark.sql import functions as F

from sparkprep.llm import graph


def test_state_of_more_edges_than_a_sum_of_hashes_would_hold(spark):
    edges = lambda parts: spark.range(0, 20_000_000, 1, parts).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    n, check = graph.edge_state(edges(16))
    assert n == 20_000_000 and graph.edge_state(edges(5)) == (n, check)
    assert graph.edge_state(edges(5).filter("u <> 7"))[1] != check and graph.edge_state(edges(5).limit(0))[0] == 0


def test_chain_and_unsettled(spark):
    chain = spark.range(300).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    got = graph.connected_components(chain.unionByName(spark.createDataFrame([(1001, 1000), (1000, 1000)], "u long, v long")))
    assert {(r.node, r.root) for r in got.collect()} == {(i, 0) for i in range(301)} | {(1000, 1000), (1001, 1000)}
    with pytest.raises(RuntimeError, match="settled"):
        graph.connected_components(chain, max_rounds=1)
