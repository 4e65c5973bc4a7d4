import collections
import sys

from pyspark.sql import functions as F
from util import ROOT, SF001, empty_docs, odd_docs

sys.path.insert(0, ROOT)
import corpus_pipeline as P  # noqa: E402
from test_jaccard import brute as similar  # noqa: E402
from test_packing_mixing_chat import _check_packing, _targets  # noqa: E402
from test_suffixes import brute as repeats  # noqa: E402


def stages(spark, docs, tmp):
    out = []
    for name, f in P.STAGES:
        f(spark, docs, SF001).write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
        out.append(docs)
    return out


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    lang, near, cut, mixed, packed = stages(spark, docs, str(tmp_path))
    assert all(s.columns == docs.columns for s in (lang, near, cut, mixed))
    # language ID keeps all documents of the learned languages
    assert lang.count() == docs.filter(F.col("text").rlike(r"\p{L}")).count()
    # one document of each group, the first one
    rows = [(r.doc_id, r.text) for r in lang.collect()]
    firsts = {c for d, c, n in similar(rows)}
    assert sorted(r.doc_id for r in near.collect()) == sorted(firsts)
    # repeats: sizes of what is kept (cut code points go, so texts are at most as long)
    rows = [(r.doc_id, r.text) for r in near.collect()]
    want = {d: n - gone for d, n, gone, _, _ in repeats(rows)}
    for r in cut.collect():
        size = len((r.text or "").encode())
        assert want[r.doc_id] - 12 <= size <= want[r.doc_id] and r.n_chars == len(r.text)
    # mix: repeats of whole documents, near the targets
    own = {r.doc_id: r for r in cut.collect()}
    taken = collections.Counter(r.doc_id for r in mixed.collect())
    assert max(taken.values()) <= 3 and all(r.text == own[r.doc_id].text for r in mixed.collect())
    size, target = _targets([(r.source, r.text) for r in own.values()])
    words = lambda r: len(r.text.split())
    for s in size:
        got = sum(n * words(own[d]) for d, n in taken.items() if own[d].source == s)
        assert abs(got - target[s]) <= max(words(r) for r in own.values() if r.source == s)
    assert _check_packing([(r.doc_id, r.text) for r in mixed.collect()], packed.collect()) < 0.05
    assert P.run(spark, SF001).count() == packed.count()


def test_odd_and_empty(spark, tmp_path):
    docs = odd_docs(spark)
    found = stages(spark, docs, str(tmp_path / "odd"))
    assert all(s.columns == docs.columns for s in found[:4]) and found[1].count() > 0
    clash = docs.selectExpr("*", "1 as rejected", "'y' as lang_pred")
    assert P.language_id(spark, clash, SF001).columns == clash.columns
    assert [s.count() for s in stages(spark, empty_docs(spark), str(tmp_path / "empty"))] == [0] * 5
