"""The corpus pipeline: language ID, one document of each near-duplicate
group, removal of repeated byte strings, mixing sources to target weights,
packing. Each stage reads what the one before it has written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm import jaccard, langid, mixing, packing, suffixes
from sparkprep.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language: those rejected by distance, and texts
    without a letter, go. Centroids are learned from the stage's own labelled rows."""
    model = langid.fit_centroids(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    packed = docs.select("text", F.struct(*docs.columns).alias("row")) if _clash(docs) else docs
    kept = langid.identify(packed, model).filter(~F.col("rejected"))
    return kept.select("row.*") if _clash(docs) else kept.select(*docs.columns)


def _clash(docs: DataFrame) -> bool:
    return bool({"lang_pred", "score", "cosine", "rejected"} & set(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of texts with a five-word shingle similarity of 0.8 or more."""
    return jaccard.one_of_each_group(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat 100-byte strings from earlier on;
    n_chars is counted anew where the text has changed. All documents stay."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    narrow = docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]).alias("rest"))
    cut = suffixes.remove_repeats(narrow, keep_text=True)
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept_text")} | {c: F.col("rest").getField(c) for c in rest}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast(kind)).otherwise(F.col("rest").getField("n_chars"))
    return cut.select(*[new[c].alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: Learned centroids, signatures and rounding by hash have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
