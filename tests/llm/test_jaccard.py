import collections
import random

import numpy as np
from util import SF001, empty_docs, odd_docs, odd_rows

from sparkprep.llm import fingerprints, graph, jaccard


def shingle_set(t, n=5):
    w = [x for x in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if x]
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, threshold=0.8):
    sets = [shingle_set(t) for _, t in rows]
    key = [-(1 << 63) if d is None else d for d, _ in rows]
    near = collections.defaultdict(set)
    index = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in index[x] if j > i}:
            if len(s & sets[j]) >= threshold * len(s | sets[j]) - 1e-9:
                near[i].add(j)
                near[j].add(i)
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        if comp[i] == i and i not in ():
            todo, seen = [i], {i}
            while todo:
                for j in near[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            low = min(seen)
            for j in seen:
                comp[j] = low
    least = {}
    for i in range(len(rows)):
        least[comp[i]] = min(least.get(comp[i], key[i]), key[i])
    return collections.Counter((rows[i][0], None if least[comp[i]] == -(1 << 63) else least[comp[i]], len(near[i])) for i in range(len(rows)))


def result(df):
    return collections.Counter((r.doc_id, r.component_id, r.n_links) for r in df.collect())


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 8)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = word()
            rows.append((len(rows), " ".join(own)))
    return rows


def test_random_corpora(spark):
    for seed in range(2):
        rows = corpus(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        assert result(jaccard.similarity_join(df, recall=0.99999)) == brute(rows)


def test_small_blocks_lose_no_links(spark):
    rows = corpus(7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.similarity_join(df, recall=0.99999, block_rows=3, block_classes=2)
    assert result(got) == brute(rows)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = jaccard.similarity_join(odd_docs(spark))
    want = brute(rows)
    # documents without words are alone
    assert result(got) == want
    kept = jaccard.one_of_each_group(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert got.filter("kept").count() == kept.count()
    blank = sum(1 for _, t in rows if not shingle_set(t))
    texts = [r.text for r in kept.collect()]
    assert sum(1 for t in texts if not shingle_set(t)) == blank
    assert jaccard.similarity_join(empty_docs(spark)).count() == 0
    assert jaccard.one_of_each_group(empty_docs(spark)).count() == 0


def test_driver_table(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got, want = result(jaccard.similarity_join(df)), brute(rows)
    assert sum((got & want).values()) >= 0.99 * len(rows)
    near = result(fingerprints.near_duplicates(df))
    assert sum((near & want).values()) >= 0.99 * len(rows)


def test_prefix_is_shortened_to_the_recall():
    assert jaccard.prefix_length(0.8, 16, 6, 0.5) == 6 and jaccard.prefix_length(0.8, 16, 6, 0.999) == 4
    assert jaccard.prefix_length(0.8, 2, 6, 0.99999) == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(1000, x) for x in range(500, 600)] + [(i, i + 1) for i in range(2000, 2060)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_common_counts():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 400, rng.integers(0, 200)).astype(np.uint64)) for _ in range(30)]
    got = jaccard._common(sets, 64)
    for i in range(30):
        for j in range(30):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_groups_keep_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
    for c in ("similar_k", "similar_node", "k", "node", "row", "blank"):
        df = df.selectExpr("*", f"10 * doc_id as {c}")
    got = jaccard.one_of_each_group(df)
    assert got.columns == df.columns and sorted(tuple(r) for r in got.collect()) == [(d, t, *[10 * d] * 6) for d, t in ((1, "a b c d e f"), (3, None))]
