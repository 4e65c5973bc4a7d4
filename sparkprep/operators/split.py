"""Deterministic train/test splits (MO1, MO2).

Both order rows by ``md5(key || '-' || seed)``, so the split does not depend
on partitioning or task retries (``rand()``/``randomSplit`` do).
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import q
from ..functions.joins import lookup_join
from ..session import scratch_path


def key_hash(key_cols: list[str], seed: int = 42) -> Column:
    """md5 of the key columns joined by '-' plus '-<seed>' (hex string; uniform)."""
    # a null part is told apart from an empty one, so that composite keys don't collide
    parts = [F.coalesce(q(c).cast("string"), F.lit("\u0000")) for c in key_cols]
    return F.md5(F.concat_ws("-", *parts, F.lit(str(seed))))


def hash_split(df: DataFrame, key_cols: list[str], test_frac: float = 0.2, seed: int = 42,
               flag: str = "is_test") -> DataFrame:
    """MO2: ``is_test`` when the first 8 hex digits of the key hash, read as a
    fraction of 16^8, fall below ``test_frac`` (a string comparison against
    the threshold's hex form; no shuffle)."""
    thr = format(int(math.floor(test_frac * 16 ** 8)), "08x")
    return df.withColumn(flag, F.substring(key_hash(key_cols, seed), 1, 8) < F.lit(thr))


def stratified_split(df: DataFrame, label: str, key_cols: list[str], test_frac: float = 0.2, seed: int = 42,
                     flag: str = "is_test", digits: int = 4, write: bool = False) -> DataFrame:
    """MO1, exact per-class quota: within each class, the ``round(test_frac *
    n_class)`` rows with the smallest key hash are test rows.

    Rows with a null label are a class of their own. The table itself isn't
    sorted or shuffled: rows are counted per class and hash prefix (``digits``
    hex digits, so 16^digits rows a class), each class's boundary prefix is
    found in those counts, and only the rows of boundary prefixes, one in
    16^digits, are ranked. With ``write`` the rows are written with their hash
    prefixes, and the boundaries too, so that reading the result again neither hashes nor
    counts rows again."""
    h = "__h"
    cls = "__class"  # a key that is never null
    key = F.coalesce(F.concat(F.lit("="), q(label).cast("string")), F.lit("null"))
    x = df.withColumn(h, key_hash(key_cols, seed)).withColumn(cls, key)
    prefix = F.conv(F.substring(F.col(h), 1, digits), 16, 10).cast("bigint")
    if write:
        hashed = _written(x.select(*[q(c) for c in df.columns], cls, prefix.cast("int").alias("__prefix")), "split")
        x, prefix = hashed.withColumn(h, key_hash(key_cols, seed)), F.col("__prefix")
    # rows per (class, hash prefix): the class's boundary prefix is where its quota is reached
    counts = x.groupBy(cls, prefix.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(cls)
    up_to = w.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("__quota", F.floor(F.sum("__n").over(w) * F.lit(float(test_frac)) + F.lit(0.5))) \
                   .withColumn("__before", F.sum("__n").over(up_to) - F.col("__n"))
    edge = counts.filter((F.col("__before") <= F.col("__quota")) & (F.col("__quota") < F.col("__before") + F.col("__n")))
    edge = edge.select(cls, F.col("__b").alias("__edge"), (F.col("__quota") - F.col("__before")).alias("__left"))
    if write:
        edge = _written(edge, "edge")  # a row a class
    # whole prefixes are decided by comparison; only rows of boundary prefixes are ranked
    marked = lookup_join(x.withColumn("__b", prefix), edge, [cls], "left")
    at_edge = F.col("__b") == F.col("__edge")
    rest = [F.xxhash64(*[q(c) for c in df.columns])] if df.columns else []
    rank = F.row_number().over(Window.partitionBy(cls, "__b").orderBy(h, *rest))
    inner = marked.filter(at_edge).withColumn(flag, rank <= F.col("__left"))
    # without an edge the quota is the whole class
    outer = marked.filter(~F.coalesce(at_edge, F.lit(False))).withColumn(flag, F.coalesce(F.col("__b") < F.col("__edge"), F.lit(True)))
    return outer.unionByName(inner).select(*[q(c) for c in df.columns], flag)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_frames(df: DataFrame, flag: str = "is_test") -> tuple[DataFrame, DataFrame]:
    """(train, test) frames from a flagged frame."""
    return df.filter(~F.col(flag)).drop(flag), df.filter(F.col(flag)).drop(flag)
