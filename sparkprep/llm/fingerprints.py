"""MinHash document fingerprints (operator 3)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .store import partitions

PERMUTATIONS = 128
_LOW = -(1 << 63)


def fingerprints(texts: list[str], perms: K.Permutations, n: int = 5) -> np.ndarray:
    """(len, permutations) uint8: the low byte of each MinHash minimum (b-bit
    signature). A text without words has all zeros, with words never: bytes of
    such a signature are those of its minima."""
    out = np.zeros((len(texts), len(perms.a)), np.uint8)
    b, o = K.utf8(pa.array(texts, pa.large_string()))
    for lo, hi in K.chunks(o):
        s, so = K.shingles(b[o[lo]:o[hi]], o[lo:hi + 1] - o[lo], n)
        sig = (perms.signatures(s, so) & np.uint32(0xFF)).astype(np.uint8)
        sig[np.diff(so) == 0] = 0
        out[lo:hi] = sig
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of b-bit signatures, row by row, in 0 to 1:
    the share of equal bytes less the 1/256 that agree by chance."""
    share = (x == y).mean(axis=1)
    return np.clip((share - 1 / 256) / (1 - 1 / 256), 0.0, 1.0)


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def neighbour_fingerprints(docs: DataFrame, permutations: int = PERMUTATIONS, n: int = 5, seed: int = 7) -> DataFrame:
    """Fingerprint each whole text, its edited text and compare it with the
    next document in descending doc_id (after the last: the first).

    Documents are dealt to ranges of doc_id by boundaries that are ids of the
    table (approximate quantiles, a fixed number a partition), so every range
    is non-empty and its head (highest id) is a known id; a head is sent to
    the range before it too, as the row that follows that range's last one.
    One shuffle of the texts, one row carried between batches. Null text is
    empty; a null doc_id comes last (rows of equal id by text); one document
    follows itself; an empty table gives an empty table; other columns are
    ignored. Texts without words have an all-zero fingerprint, like (1.0) to
    each other."""
    spark = docs.sparkSession
    p = partitions(spark)
    ranges = 4 * p
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("k"), F.col("doc_id").isNotNull().alias("has_id"),
                    F.coalesce("text", F.lit("")).alias("text"))
    share = [i / ranges for i in range(1, ranges)]
    row = d.agg(F.percentile_approx("k", share, 20 * ranges).alias("q"), F.max("k").alias("top")).first()
    if row["top"] is None:
        return spark.createDataFrame([], _OUT)
    heads = np.unique(np.array([*row["q"], row["top"]], np.int64))
    last = len(heads) - 1

    @F.pandas_udf(T.LongType())
    def range_of(k: pd.Series) -> pd.Series:
        # descending ids: range 0 has the highest
        return pd.Series(last - np.searchsorted(heads, k.to_numpy(np.int64), "left"))

    @F.pandas_udf(T.BooleanType())
    def is_head(k: pd.Series) -> pd.Series:
        return pd.Series(np.isin(k.to_numpy(np.int64), heads))

    d = d.withColumn("r", range_of("k")).withColumn("h", is_head("k"))
    before = F.when(F.col("r") == 0, F.lit(last)).otherwise(F.col("r") - 1)
    places = F.when(F.col("h"), F.array(F.struct(F.col("r").alias("r"), F.lit(0).alias("tail")), F.struct(before.alias("r"), F.lit(1).alias("tail")))) \
        .otherwise(F.array(F.struct(F.col("r").alias("r"), F.lit(0).alias("tail"))))
    dealt = d.select("k", "has_id", "text", F.inline(places))
    dealt = dealt.select("r", "tail", "k", "has_id", "text").repartition(p, "r").sortWithinPartitions("r", "tail", F.desc("k"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perms = K.Permutations(permutations, seed)
        held: list[tuple] = []  # at most the last row, waiting for what follows it
        for batch in batches:
            b, o = K.utf8(batch["text"])
            del b
            for lo, hi in K.chunks(o):
                part = batch.slice(lo, hi - lo)
                rows = held + list(zip(part["r"].to_pylist(), part["tail"].to_pylist(), part["k"].to_pylist(), part["has_id"].to_pylist(), part["text"].to_pylist()))
                own = [x[4] for x in rows]
                sig = fingerprints(own, perms, n)
                # a row's next is the following row of its range, the first tail row at its end
                pairs = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i + 1][0] == rows[i][0]]
                if pairs:
                    new = [edited(own[i], own[i + 1]) for i in pairs]
                    esig = fingerprints(new, perms, n)
                    mine, following = sig[pairs], sig[[i + 1 for i in pairs]]
                    hexes = [bytes(x).hex() for x in mine]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([rows[i][2] if rows[i][3] else None for i in pairs], pa.int64()), pa.array([len(own[i]) for i in pairs], pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in new]), pa.array(hexes), pa.array([bytes(x).hex() for x in esig]),
                        pa.array(likeness(mine, esig)), pa.array(likeness(mine, following))],
                        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
                held = rows[-1:] if not rows[-1][1] else []

    return dealt.mapInArrow(K.tidy(run), _OUT)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, n: int = 5, bands: int = 32, rows: int = 4, seed: int = 7) -> DataFrame:
    """Near-duplicate classes by signature bands joined in Spark, Jaccard
    verified: delegated to the similarity join's verification with MinHash
    bands of equal length as the candidate keys (see ``jaccard``)."""
    from .jaccard import similarity_join

    return similarity_join(docs, threshold, n, trees=bands, deepest=rows, recall=0.0, seed=seed)
