import collections
import math

import numpy as np
from util import SF001

from sparkprep.llm import neighbours, queries


def brute(rows, threshold=0.93):
    """rows (vec_id, vector or None, label) -> (vec_id, n_links, component_id) per row."""
    ok = [lab is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float) / max(map(abs, v))) / max(map(abs, v)) if o else None for (_, v, _), o in zip(rows, ok)]
    n = len(rows)
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    key = [-(1 << 63) if r[0] is None else r[0] for r in rows]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min(key[j] for j in seen)
        out.append((rows[i][0], len(near[i]), None if low == -(1 << 63) else low))
    return collections.Counter(out)


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) or r.vec_id is None for r in rows)
    return collections.Counter((r.vec_id, r.n_links, r.component_id) for r in rows)


def test_driver_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got, want = result(queries.op2_embedding_dedup(spark, SF001)), brute(rows)
    assert sum((got & want).values()) >= 0.99 * len(rows)


def test_many_shards_and_blocks(spark):
    rows = [(r.vec_id, r.embedding, r.label % 2) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = result(neighbours.near_vectors(df, shard_rows=60, query_rows=50))
    assert sum((got & brute(rows)).values()) >= 0.99 * len(rows)


def test_odd_rows(spark):
    a, b = [1.0, 0.0, 0.5], [1.0, 0.01, 0.5]
    rows = [(1, a, 1), (1, a, 1), (2, b, 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 0.5], 1),
            (9, [float("nan"), 0.0, 0.5], 1), (10, [float("inf"), 0.0, 0.5], 1), (None, b, 1), (None, None, None), (11, [1.0, 0.0], 1), (12, [1e30, 0.0, 5e29], 1), (13, [1e-30, 0.0, 5e-31], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    rows = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None, lab) for i, v, lab in rows]
    got = neighbours.near_vectors(df.selectExpr("*", "1 as k", "2 as node", "3 as n_links", "4 as unit"))
    assert result(got) == brute(rows)
    assert neighbours.near_vectors(df.limit(0)).count() == 0


def test_recall_of_the_graph():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(150, 32))
    x = np.concatenate([c + 0.12 * rng.normal(size=(rng.integers(1, 30), 32)) for c in centres])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = neighbours.build_hnsw(x.astype(np.float32))
    truth = x @ x.T >= 0.93
    ids, sims = g.search(x.astype(np.float32), 64)
    near = np.zeros_like(truth)
    row, col = np.nonzero((sims >= 0.9299) & (ids >= 0))
    near[row, ids[row, col]] = True
    assert (near & truth).sum() >= 0.97 * truth.sum()
    found = neighbours.linked(g, x, x, 0.93)
    assert not (found & ~truth).any() and (found & truth).sum() >= 0.99 * truth.sum()
    # a graph without links fails its audits: the scan answers
    empty = neighbours.HNSW(g.unit, [np.full((len(x), 2), -1)], 0)
    assert (neighbours.linked(empty, x, x, 0.93) == truth).all()


def test_sparse_links_of_a_large_shard():
    rng = np.random.default_rng(11)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(rng.normal(size=(6000, 256)))
    q = unit(rng.normal(size=(1024, 256)))
    at = np.setdiff1d(np.arange(1024), np.concatenate([np.arange(0, 1024, 16), np.unique(np.linspace(0, 1023, 128).astype(int))]))[::2]
    to = rng.choice(6000, len(at), replace=False)  # no query that an audit may look at has a link
    side = unit(rng.normal(size=(len(at), 256)))
    q[at] = unit(x[to] + 0.37 * unit(side - (side * x[to]).sum(axis=1, keepdims=True) * x[to]))
    truth = q @ x.T >= 0.93
    assert truth.sum() >= 300
    found = neighbours.linked(neighbours.build_hnsw(x.astype(np.float32)), x, q, 0.93)
    assert not (found & ~truth).any() and (found & truth).sum() >= 0.999 * truth.sum()
    # a graph without links fails the audit though no audited query has a link
    empty = neighbours.HNSW(x.astype(np.float32), [np.full((len(x), 2), -1)], 0)
    assert (neighbours.linked(empty, x, q, 0.93) == truth).all()


def test_graph_answers_where_its_audit_passes():
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(400, 12)), 5, axis=0) + 0.3 * rng.normal(size=(2000, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = neighbours.build_hnsw(x.astype(np.float32))
    calls = []
    real = g.search
    g.search = lambda q, width: calls.append((len(q), width)) or real(q, width)
    found, truth = neighbours.linked(g, x, x[:1024], 0.93), x[:1024] @ x.T >= 0.93
    assert calls[-1][0] == 1024 and (found & truth).sum() >= 0.999 * truth.sum() and not (found & ~truth).any()
