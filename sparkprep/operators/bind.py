"""Row numbers and binding by position (JN2, PJ9) without a one-task window."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_INDEX_BITS = 33  # monotonically_increasing_id: the partition above, the row within it below


def number_rows(df: DataFrame, order_by: list[Column] | None = None, out: str = "row_no") -> DataFrame:
    """``df`` with row numbers from 0 (long): in the order of ``order_by``, a
    distributed sort, or else in the order the rows come in. The numbered rows
    are written once with their partition and place in it; partition counts, a
    small table, give each partition's offset. Ties of ``order_by`` are
    numbered in any order. A column named ``out`` is replaced."""
    spark = df.sparkSession
    kept = [c for c in df.columns if c != out]
    rows = df.sort(*order_by) if order_by else df
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.monotonically_increasing_id().alias("id"))
    path = scratch_path(spark, f"numbered-{uuid.uuid4().hex}")
    rows.select("row", F.shiftright("id", _INDEX_BITS).alias("part"), F.col("id").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)).alias("at")).write.parquet(path)
    rows = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    starts = rows.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    return rows.join(starts, "part").select("row.*", (F.col("before") + F.col("at")).alias(out))


def bind_columns(left: DataFrame, right: DataFrame, left_order: list[Column] | None = None, right_order: list[Column] | None = None) -> DataFrame:
    """The columns of both frames side by side, row by row in each one's order
    (as given, or sorted). Frames of unequal lengths and names in common are
    errors. Rows meet in a join by number, so no key is hot."""
    both = set(left.columns) & set(right.columns)
    if both:
        raise ValueError(f"columns on both sides: {sorted(both)}")
    a, b = number_rows(left, left_order, "__row"), number_rows(right, right_order, "__row")
    n, m = a.count(), b.count()
    if n != m:
        raise ValueError(f"{n} rows can't be bound to {m}")
    return a.join(b, "__row").drop("__row")
