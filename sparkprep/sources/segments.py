"""Mergeable state kept as a table over numbered batches.

Batch ``n`` writes one segment, a folder that is never changed afterwards: its
own rows merged with the segments before it, as far as the lowest set bit of
``n + 1`` reaches (a binary indexed tree). The state after ``n`` batches is
then a union of at most log2(n) + 1 segments, and each row is rewritten log2(n)
times in all. A batch that is run again reads only earlier segments and
overwrites its own, so it adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import path_exists


def tiles(count: int) -> list[int]:
    """The numbers of the segments that together hold batches 0 to ``count - 1``."""
    out = []
    while count > 0:
        out.append(count - 1)
        count &= count - 1
    return out


def _folder(path: str, n: int) -> str:
    return f"{path}/segment={n}"


def add_segment(spark: SparkSession, path: str, n: int, rows: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Write batch ``n``'s segment. ``merge`` takes rows of several batches to
    the rows of all of them together, whatever their order. The batches before
    ``n`` must have been added."""
    below = (n + 1) & n  # batches before the segment's first one
    for k in tiles(n):
        if k >= below:
            rows = rows.unionByName(spark.read.parquet(_folder(path, k)))
    merge(rows).write.mode("overwrite").parquet(_folder(path, n))
    spark.createDataFrame([(n,)], "batch long").coalesce(1).write.mode("overwrite").parquet(f"{path}/last")


def last_batch(spark: SparkSession, path: str) -> int | None:
    """The number of the batch added last; None before the first."""
    return spark.read.parquet(f"{path}/last").first()["batch"] if path_exists(spark, f"{path}/last") else None


def read_state(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], n: int | None = None) -> DataFrame | None:
    """The merged rows of batches 0 to ``n`` (the last one added, unless given); None before the first."""
    n = last_batch(spark, path) if n is None else n
    if n is None:
        return None
    rows = None
    for k in tiles(n + 1):
        part = spark.read.parquet(_folder(path, k))
        rows = part if rows is None else rows.unionByName(part)
    return merge(rows)
