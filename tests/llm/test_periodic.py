import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from util import SF001, empty_docs, odd_docs, odd_rows

from sparkprep.llm import kernels, periodic, queries, vocabulary


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _brute(w, min_length=6, exponent=4):
    """Every stretch by every period; the smallest period of a stretch stands."""
    n, best = len(w), {}
    ids = np.unique(np.array(w, dtype=object).astype(str), return_inverse=True)[1] if n else np.zeros(0, int)
    for q in range(1, n // exponent + 1):
        same = np.concatenate([[0], (ids[q:] == ids[:-q]).astype(int), [0]])
        edge = np.flatnonzero(np.diff(same))
        for s, e in zip(edge[::2], edge[1::2] + q):
            if e - s >= max(min_length, exponent * q):
                best.setdefault((int(s), int(e)), q)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def _kept(w, runs):
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def _edited(doc_id, text):
    w = _words(text)
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def _sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def _expected(doc_id, text):
    w = _edited(doc_id, text)
    runs = _brute(w)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc_id, len(runs), s, n, q, 1000 * n // q if runs else None, _sha(lines), _sha(_kept(w, runs)))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_periodic_runs(spark, SF001)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = {d.doc_id: _expected(d.doc_id, d.text) for d in docs}
    assert {r.doc_id: tuple(r) for r in got.collect()} == want
    assert sum(w[1] > 0 for w in want.values()) > 5


def _found(texts):
    b, offsets = kernels.utf8(pa.array(texts))
    (_, _, wo), (s, e, p) = periodic.text_runs(b, offsets)
    doc = np.searchsorted(wo, s, "right") - 1
    out = [[] for _ in texts]
    for d, i, j, q in zip(doc, s, e, p):
        out[d].append((int(i - wo[d]), int(j - i), int(q)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_of_few_words(seed):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(150):
        n, k = int(rng.integers(0, 120)), int(rng.integers(1, 4))
        w = [f"w{x}" for x in rng.integers(0, k, n)]
        while rng.random() < 0.8 and len(w) < 400:
            at, q = int(rng.integers(0, len(w) + 1)), int(rng.integers(1, 12))
            root = [f"w{x}" for x in rng.integers(0, k + 1, q)]
            w[at:at] = (root * 12)[:int(rng.integers(q, 9 * q + 1))]
        texts.append(" ".join(w))
    assert _found(texts) == [_brute(_words(t)) for t in texts]


def test_structured_texts():
    fib, thue = ["a", "ab"], "a"
    while len(fib[-1]) < 800:
        fib.append(fib[-1] + fib[-2])
    while len(thue) < 512:
        thue += thue.translate(str.maketrans("ab", "ba"))
    nested = ("a " * 7 + "b ") * 6 + "c "
    texts = [" ".join(fib[-1]), " ".join(thue), " ".join(thue * 5), nested * 5, "x " * 5, "x " * 6, "x y " * 4, "x y x y x y x", "", "one",
             "a b c " * 40 + "a b d " * 40, "p q r s " * 3 + "p q r", ("the cat sat on the mat . " * 9 + "dog ") * 4, "z " * 3000]
    assert _found(texts) == [_brute(_words(t)) for t in texts]
    assert _found(texts[::-1]) == [_brute(_words(t)) for t in texts[::-1]]


def test_long_period():
    rng = np.random.default_rng(5)
    root = [f"w{x}" for x in rng.integers(0, 300, 700)]
    w = [f"v{x}" for x in rng.integers(0, 300, 900)] + root * 5 + root[:123] + ["end"] * 7
    assert _found([" ".join(w), "q " * 9, " ".join(w[::-1])]) == [_brute(x) for x in (w, ["q"] * 9, w[::-1])]


def test_plain_way_is_the_same(monkeypatch):
    texts = ["a b " * 30 + "c", "x " * 40, "a a b " * 9 + "a a a a a a a", "no runs at all here"]
    want = _found(texts)
    monkeypatch.setattr(periodic, "_agree", lambda *a: False)
    assert _found(texts) == want == [_brute(_words(t)) for t in texts]


def test_grammar_derives_the_sequence():
    """Every occurrence of a nonterminal spells what its first one does, and each rule splits inside it."""
    rng = np.random.default_rng(3)
    seq = rng.integers(0, 5, 4000)
    part = np.repeat(np.arange(8), 500)
    seq = seq + 5 * (part // 2)  # two parts a text
    g = periodic.re_pair(seq, part)
    for k in range(len(g.left)):
        own = g.at[g.first[k]:g.first[k + 1]]
        assert 0 < g.left[k] < g.total[k]
        for x in own:
            assert np.array_equal(seq[x:x + g.total[k]], seq[own[0]:own[0] + g.total[k]])
            assert part[x] == part[x + g.total[k] - 1]
    whole = {(int(x), int(t)) for k, t in enumerate(g.total) for x in g.at[g.first[k]:g.first[k + 1]]}
    assert all((500 * i, 500) in whole for i in range(8))


def test_word_numbers_without_hashes(monkeypatch):
    b, offsets = kernels.utf8(pa.array(["aa bb aa cc bb aa"]))
    s, e, _ = kernels.words(b, offsets)
    ids, first, _ = vocabulary.word_ids(b, s, e)
    monkeypatch.setattr(vocabulary, "word_hashes", lambda b, s, e: np.zeros(len(s), np.uint64))
    again, first2, _ = vocabulary.word_ids(b, s, e)
    for x, f in ((ids, first), (again, first2)):
        assert x[0] == x[2] == x[5] and x[1] == x[4] and len(set(x.tolist())) == 3
        assert [bytes(b[s[i]:e[i]]) for i in f[x]] == [bytes(b[i:j]) for i, j in zip(s, e)]


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("runs", F.lit(1)).withColumn("row", F.lit(2)).withColumn("a.b", F.lit(3))
    got = periodic.collapse_runs(docs)
    assert got.columns == [c for c in docs.columns if c != "runs"] + ["runs", "collapsed"]
    rows = got.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        w = _words(r.text)
        runs = _brute(w) if len(w) < 5000 else [(0, len(w), 1)]
        assert [tuple(x) for x in r.runs] == runs and r.collapsed == _kept(w, runs) and r["a.b"] == 3 and r.row == 2
    assert periodic.collapse_runs(empty_docs(spark)).count() == 0
