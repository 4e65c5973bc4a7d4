import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from util import SF001, empty_docs, odd_docs, odd_rows

from sparkprep.llm import phrases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, min_count, longest, share, top):
    """rows: (text, lang)."""
    n, f = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[(lang, tuple(w[i:i + m]))] += 1
    f = {k: v for k, v in f.items() if v >= min_count}
    longer = collections.Counter()
    for (lang, w), a in f.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longer[(lang, w[i:i + m])] = max(longer[(lang, w[i:i + m])], a)
    out = collections.defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) > 1 and not 100 * longer[(lang, w)] >= share * a:
            cuts = [(1000 * a * n[lang] // (f[(lang, w[:k])] * f[(lang, w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), f[(lang, w[:k])], f[(lang, w[k:])]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, own in out.items() for i, (s, a, p, x, y) in enumerate(sorted(own)[:top]))


def _got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("min_count,share,top", [(8, 60, 25)])
def test_driver_table_equals_brute_force(spark, min_count, share, top):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    got = _got(phrases.collocations(docs.repartition(5), min_count, 5, share, top))
    assert len(got) > 20 and got == _brute(rows, min_count, 5, share, top)


ROWS = [("New York, new york! NEW YORK a b a b a b a", "en"), ("new york\tnew york", None), ("new york", "und"), ("x x x x x x x", "en"), ("x x x.x x;x", "de"),
        ("É é É é", "fr"), ("a b c a b c", "fr"), ("one\x0btwo one\ntwo one two", "fr"), ("...", "de"), (None, None), ("", "en"), ("a b a b" * 30, "en")]


def test_small_texts(spark):
    df = spark.createDataFrame(ROWS, "text string, lang string")
    for min_count, longest, share in ((1, 5, 100),):
        assert _got(phrases.collocations(df, min_count, longest, share)) == _brute(ROWS, min_count, longest, share, 2000)


def test_filter_full_of_bits_loses_and_adds_nothing(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, "text string, lang string")
    monkeypatch.setattr(phrases.FrequentFilter, "has", lambda self, h: np.ones(len(h), bool))
    assert _got(phrases.collocations(df, 2, 4)) == _brute(ROWS, 2, 4, 100, 2000)


def test_filter_holds_what_it_was_given(spark):
    lang = np.repeat(phrases._hashes(["en"]), 2000)
    h = phrases._phrase_hash([phrases._hashes([f"w{i}" for i in range(2000)]), phrases._hashes([f"x{i % 7}" for i in range(2000)])], lang)
    given = spark.createDataFrame([(int(x),) for x in h[:500]], "h long").repartition(3)
    keep = phrases.frequent_filter(given)
    assert keep.has(h[:500]).all() and keep.has(h[500:]).mean() < 0.02
    assert len(phrases.frequent_filter(given, most_bits=1 << 10).words) == 16
    assert not phrases.frequent_filter(given.limit(0)).has(h).any()


@pytest.mark.parametrize("held", [8, 1 << 20])
def test_group_count_by_hash(spark, held):
    """Every word with enough occurrences is found, over many ranges and flushes, and hardly another."""
    words = [f"w{i}" for i in range(300) for _ in range(i % 6 + 1)]
    df = spark.createDataFrame([(" ".join(words[k::7]), "en") for k in range(7)], "text string, lang string").repartition(4)
    relation = phrases._word_occurrences(df, limit=64)
    got = {r.h for r in phrases.frequent_hashes(relation, 1, None, 4, 16, held).collect()}
    own = phrases._phrase_hash([phrases._hashes([f"w{i}" for i in range(300)])], np.repeat(phrases._hashes(["en"]), 300))
    assert got == {int(own[i]) for i in range(300) if i % 6 + 1 >= 4}


def test_odd_rows(spark):
    rows = [(r[1], r[2]) for r in odd_rows() if r[0] != 8] + [("long " * 2000, "es")]
    docs = odd_docs(spark).filter("doc_id is null or doc_id <> 8").unionByName(
        odd_docs(spark).limit(1).withColumn("text", F.lit("long " * 2000)).withColumn("lang", F.lit("es")))
    docs = docs.withColumn("phrase", F.lit("x")).withColumn("n", F.lit(1)).withColumn("a", F.lit(1))
    assert _got(phrases.collocations(docs, 2)) == _brute(rows, 2, 5, 100, 2000)
    assert phrases.collocations(empty_docs(spark), 2).count() == 0


def test_products_beyond_64_bits(spark):
    """Counts near 2^40 score exactly."""
    a, n, x, y = (1 << 40) + 12345, (1 << 50) + 77, (1 << 41) + 1, (1 << 42) + 3
    df = spark.createDataFrame([(a, n, x, y)], "a long, n long, l long, r long")
    got = df.select(F.expr("(cast(1000 as decimal(4,0)) * a * n) div (cast(l as decimal(19,0)) * r)")).first()[0]
    assert got == 1000 * a * n // (x * y)
