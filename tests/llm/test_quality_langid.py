import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from util import SF001, empty_docs, odd_docs, odd_rows

from sparkprep.llm import langid, quality, queries

SF01 = "/root/testdata/sf0.01"


def test_quality_held_out_accuracy(spark):
    got = queries.op1_quality(spark, SF01).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in held]) > 0.95


def test_quality_whole_text_counts():
    clean = "the quick brown fox jumps over the lazy dog, then rests. " * 400
    x = next(quality.batch_indicators(pa.array([clean, clean + "*** buy&&& now%%%"])))
    assert (x[0] != x[1]).any()


def test_quality_odd_rows(spark):
    model = quality.fit_quality(["good words in a row. " * 5, "BAD!! BAD!! BAD!!"] * 20, [1, 0] * 20)
    got = quality.score_quality(odd_docs(spark), model)
    rows = got.collect()
    assert len(rows) == len(odd_rows()) and all(0 <= float(r.score) <= 1 for r in rows)
    assert quality.score_quality(empty_docs(spark), model).count() == 0
    none = quality.train_quality(empty_docs(spark), spark.createDataFrame([], "doc_id long, quality int"))
    assert none.score(np.zeros((1, quality.DIMS), bool))[0] == 0.5
    assert len(quality.fit_quality(["a"], [1]).score(np.zeros((2, quality.DIMS), bool))) == 2
    null = spark.createDataFrame([(None, None), (1, None), (2, 1)], "doc_id long, quality int")
    assert quality.labelled_sample(odd_docs(spark), null).count() == 1


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = np.where(x[:, 0] > 0.1, 1, -1)
    rows = [(np.array([0, 1, 2]), np.append(r, 1.0)) for r in x]
    w = quality.dual_coordinate_descent(rows, y, 3, np.full(200, 100.0), rounds=200)
    assert (np.sign(x @ w[:2] + w[2]) == y).mean() > 0.98


def test_langid_held_out_accuracy(spark):
    got = queries.op8_langid(spark, SF01).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.97
    assert not any(r.rejected for r in got)


def test_langid_odd_rows(spark):
    train = spark.createDataFrame([(i, t, lang) for i in range(30) for t, lang in (
        ("the cat sat on the mat and was there", "en"), ("der hund und die katze sind nicht hier", "de"), (None, "fr"), ("12 34", "es"), ("x", None))],
        "id long, text string, lang string")
    model = langid.fit_centroids(train, clusters=2)
    assert set(model.langs) == {"de", "en"}
    got = langid.identify(odd_docs(spark), model).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        letter = bool(r.text) and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letter) and (letter or r.rejected)
    far = langid.identify(spark.createDataFrame([(1, "Привет мир как дела"), (2, "the cat"), (3, "à")], "doc_id long, text string"), model)
    assert {r.doc_id: r.rejected for r in far.collect()}[1] and not {r.doc_id: r.rejected for r in far.collect()}[2]
    assert langid.identify(empty_docs(spark), model).count() == 0
    blank = langid.fit_centroids(empty_docs(spark).selectExpr("doc_id id", "text", "lang"))
    assert {r.lang_pred for r in langid.identify(odd_docs(spark), blank).collect()} <= {"und"} or not blank.langs
    assert langid.identify(odd_docs(spark), model).filter(F.col("source").isNull()).count() == 3


FOREIGN = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności zawarte w niniejszej deklaracji. ",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokaisella on oikeus elämään, vapauteen ja henkilökohtaiseen turvallisuuteen. ",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. Herkesin yaşama, hürriyet ve kişi emniyetine hakkı vardır. ",
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza. Ogni individuo ha diritto alla vita, alla libertà ed alla sicurezza della propria persona. "}


def test_langid_rejects_unlearned_latin_text(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.fit_centroids(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    rng = np.random.default_rng(5)
    planted = {**FOREIGN, **{f"gibberish {i}": " ".join("".join(rng.choice(list(letters), rng.integers(3, 10))) for _ in range(60)) + " "
                             for i, letters in enumerate(("bcdfghjklmnpqrstvwxz", "abcdefghijklmnopqrstuvwxyz"))}}
    far = spark.createDataFrame([(f"{k} {n}", (v * 20)[:n]) for k, v in planted.items() for n in (200, 1000, 4000)], "name string, text string")
    assert [r.name for r in langid.identify(far, model).collect() if not r.rejected] == []
    # one worst labelled row doesn't move the bounds
    junk = docs.select(F.col("doc_id").alias("id"), "text", "lang").union(spark.createDataFrame([(-1, "0f9a3c77e1b2 4b" * 30, "en")], "id long, text string, lang string"))
    assert [r.name for r in langid.identify(far, langid.fit_centroids(junk, per_lang=10**6)).collect() if not r.rejected] == []
    short = docs.select(F.substring("text", 1, 40).alias("text")).filter("length(text) = 40")
    kept = langid.identify(short, model).filter("not rejected").count()
    assert langid.identify(docs, model).filter("rejected").count() == 0 and kept >= 0.99 * short.count()


def test_every_language_is_learned(spark):
    rows = [(40 * i + j, " ".join(f"w{i:03d}{chr(97 + i % 26)}{chr(97 + i // 26)}q" for _ in range(5 + j)), f"l{i:03d}") for i in range(250) for j in range(1 + 2 * (i < 3))]
    model = langid.fit_centroids(spark.createDataFrame(rows, "id long, text string, lang string").selectExpr("*", "0 as rate", "'x' as of"))
    assert model.names == sorted({r[2] for r in rows}) and set(model.langs) == set(model.names)


def test_bounds_come_from_whole_texts():
    pieces = langid._pieces(["a" * 100 + "b" * 100 + "c" * 100 + "d" * 100], 50)
    assert pieces == ["a" * 50, "b" * 50, "c" * 50, "d" * 50] and langid._pieces(["ab"], 8) == []
    assert all(x.strip("é") == "" and x for x in langid._pieces(["é" * 101], 33))
