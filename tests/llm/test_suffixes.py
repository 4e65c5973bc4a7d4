import collections
import hashlib
import random

import numpy as np
from util import empty_docs, odd_docs, odd_rows

from sparkprep.llm import suffixes


def brute(rows, window=100):
    """rows (doc_id, text) in any order -> (doc_id, n_bytes, n_removed, n_spans, sha) per row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - window + 1):
            w = raw[i:i + window]
            if w in seen:
                gone[i:i + window] = True
            seen.add(w)
        spans = int(np.sum(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(raw) else 0
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]]) if raw else b""
        out.append((d, len(raw), int(gone[:-1].sum()), spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def got(df):
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def corpus(seed, docs=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randint(10, 60)) for _ in range(12)] + ["a" * 400, "ab" * 150, text(5), "x" * 99]
    rows = []
    for i in range(docs):
        parts = [rng.choice(passages) if rng.random() < 0.5 else text(rng.randint(0, 40)) for _ in range(rng.randint(0, 6))]
        p = rng.choice(passages)
        cut = rng.randint(0, len(p))
        rows.append((rng.randint(0, 40), rng.choice(["", " "]).join(parts) + p[cut:]))
    return rows + [(3, rows[0][1]), (None, rows[1][1]), (None, None), (99, rows[2][1][7:])]


def test_random_corpora(spark):
    for seed in range(3):
        rows = corpus(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert got(suffixes.remove_repeats(df)) == brute(rows), seed


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert got(suffixes.remove_repeats(odd_docs(spark))) == brute(rows)
    assert suffixes.remove_repeats(empty_docs(spark)).count() == 0


def test_kept_text(spark):
    t = "é" * 30 + " some words that are repeated in both of the documents here and there, as passages are. " * 2
    df = spark.createDataFrame([(1, t + "one"), (2, "zz" + t + "two"), (3, None)], "doc_id long, text string")
    r = {x.doc_id: x for x in suffixes.remove_repeats(df, keep_text=True).collect()}
    assert r[1].n_removed == 0 or len(r[1].kept_text) < len(t) + 3
    assert r[2].kept_text == "zztwo" and r[3].kept_text is None


def test_driver_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(suffixes.remove_repeats(df)) == brute(rows)


def test_multikey_order():
    rng = np.random.default_rng(0)
    cols = [rng.integers(0, 4, 500) for _ in range(4)]
    assert (multi := suffixes.multikey_order(cols)).tolist() == np.lexsort(cols[::-1]).tolist() and len(multi) == 500


def test_ties_across_batches():
    t = suffixes._Ties()
    got = [t.of(np.array(x)).tolist() for x in ([5, 5], [5, 7], [7], [], [7, 7, 8])]
    assert got == [[0, 1], [2, 0], [1], [], [2, 3, 0]]


def test_common_line_is_spread():
    """A line in all documents, each with its own text around it: no part gets
    the group whole, and the marks are those of one comparison."""
    rng, window, gram, n, parts = np.random.default_rng(6), 100, 20, 4000, 16
    r = np.zeros(n, suffixes._surrounded(window, gram))
    r["key"], r["doc"], r["place"], r["left"], r["right"] = 77, np.arange(n), 500, 80, 100
    r["bytes"] = rng.integers(97, 123, (n, 180))
    r["bytes"][:, 80:130] = r["bytes"][0, 80:130]
    r["bytes"][2000:2100, 40:] = r["bytes"][5, 40:]  # some repeat more than the line
    sent, marks = suffixes._first_windows(r, window, gram)
    size = np.bincount(suffixes._part_of(sent["hash"], parts), minlength=parts)
    assert size.max() < 1.2 * size.mean()
    late = [suffixes._earlier(sent[suffixes._part_of(sent["hash"], parts) == i], window)[1] for i in range(parts)]
    want = suffixes.compare_windows(r, window, gram)
    got = np.concatenate([marks, *late])
    g, s, e = suffixes.merge_spans(got["doc"], got["start"].astype(np.int64), got["end"].astype(np.int64))
    assert len(want) and list(zip(g, s, e)) == [(x["doc"], x["start"], x["end"]) for x in want]


def test_hot_lines_equal_brute_force(spark):
    line = "a line that is found in every one of the documents"
    rows = [(i, f"{random.Random(i % 50).random()} {'ab' * (i % 7)}\n{line}\n{random.Random(i % 30).random()} {'cd ' * (i % 40)}") for i in range(300)] + corpus(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for hot in (0, 3, 40):
        assert got(suffixes.remove_repeats(df, hot=hot)) == brute(rows), hot


def test_columns_of_the_same_names_stay(spark):
    df = spark.createDataFrame([(1, "x" * 30), (2, "abc " * 60)], "doc_id long, text string").selectExpr("*", "1 as k", "2 as marks", "3 as more", "4 as rest")
    got = suffixes.remove_repeats(df, keep_text=True)
    assert {(r.k, r.marks, r.more, r.rest) for r in got.collect()} == {(1, 2, 3, 4)}
    assert got.columns == ["doc_id", "k", "marks", "more", "rest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    assert sorted(tuple(r) for r in got.select("doc_id", "n_removed", "kept_text").collect()) == sorted(
        tuple(r) for r in suffixes.remove_repeats(df.select("doc_id", "text"), keep_text=True).select("doc_id", "n_removed", "kept_text").collect())
