import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF001 = "/root/testdata/sf0.001"

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    """Nulls in any column, empty and long texts, ties and repeated rows."""
    base = "one two three four five six seven eight nine ten " * 12
    return [
        (1, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, None, None, None, None),
        (4, "", "de", "b", 0), (5, "x", "de", None, 1), (None, base + "tail", "en", "a", 3), (None, None, None, None, None),
        (6, "  \n\t ", "fr", "b", 5), (7, "Ünïcödé wörd \U0001F600 " * 40, "fr", "c", 9), (8, "long " * 60000, "es", "c", 9),
        (8, "other text with the same id as the long one", "es", "c", 9), (9, "a b c", "es", "a", 3), (10, "a  b\nc", "es", "a", 3),
    ]


def odd_docs(spark):
    """With extra columns whose names clash with the operators' own."""
    df = spark.createDataFrame(odd_rows(), DOC)
    for c in ("size", "target", "rank", "length", "k", "u", "v", "node", "root", "class_id", "score", "sequence_id", "words", "mix_copies"):
        df = df.selectExpr("*", f"'x' as {c}")
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOC)
