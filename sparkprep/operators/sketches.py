"""Column profiles over many loads by mergeable sketches (PR7, PR8, PR10):
each load is read once, its sketches are kept, and the profile of all loads so
far merges them instead of reading old loads again.

Distinct values: HyperLogLog with 2^14 registers (relative standard error 0.8 %).
Quantiles of numeric columns: KLL with k = 400 (rank error about 0.7 %).
Heavy hitters: the frequent-items sketch with up to ``TRACKED`` values; counts
are exact as long as a column has fewer, and otherwise too high by a bounded
share of the rows. Counts of rows and nulls, least and greatest value are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import numeric_columns, q
from ..sources.segments import add_segment, read_state

HLL_BITS = 14
KLL_K = 400
TRACKED = 10_000


def sketch(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: column_name, n, nulls, lo and hi (numeric columns;
    NaN left out, as for the quantiles) and the sketches. All columns go in one
    pass; a task sends one sketch per column. A frame without rows has no row."""
    nums = numeric_columns(df)
    def entry(c):
        x = F.when(~F.isnan(q(c).cast("double")), q(c).cast("double")) if c in nums else F.lit(None).cast("double")
        return F.struct(F.lit(c).alias("column_name"), q(c).cast("string").alias("v"), x.alias("x"))

    long = df.select(F.inline(F.array(*[entry(c) for c in cols])))
    return long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v").isNull()).alias("nulls"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.hll_sketch_agg("v", F.lit(HLL_BITS)).alias("distinct"), F.kll_sketch_agg_double("x", F.lit(KLL_K)).alias("quantiles"),
        F.expr(f"approx_top_k_accumulate(v, {TRACKED})").alias("frequent"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """The sketches of several frames (``sketch``) as those of all their rows."""
    kll = F.reduce(F.collect_list("quantiles"), F.lit(None).cast("binary"),
                   lambda a, b: F.when(a.isNull(), b).otherwise(F.kll_sketch_merge_double(a, b)))
    return sketches.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.hll_union_agg("distinct").alias("distinct"), kll.alias("quantiles"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"))


def add_load(spark: SparkSession, path: str, n: int, df: DataFrame, cols: list[str]) -> None:
    """Keep load ``n``'s sketches (from 0, without gaps) in the segments under
    ``path``; the same load again replaces itself."""
    add_segment(spark, path, n, sketch(df, cols), merge_sketches)


def loads_sketch(spark: SparkSession, path: str) -> DataFrame | None:
    """The sketches of all loads so far; None before the first."""
    return read_state(spark, path, merge_sketches)


def sketch_profile(sketches: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """PR7, PR10 read from sketches: column_name, n, nulls, lo, hi,
    distinct_values and p<percent> (null for columns without numbers)."""
    quantile = lambda p: F.when(F.col("lo").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(f"p{p * 100:g}")
    return sketches.select("column_name", "n", "nulls", "lo", "hi", F.hll_sketch_estimate("distinct").alias("distinct_values"), *[quantile(p) for p in probs])


def top_levels(sketches: DataFrame, k: int = 20) -> DataFrame:
    """PR8 read from sketches: (column_name, level, n) of each column's ``k``
    most frequent values; nulls are no level."""
    top = sketches.select("column_name", F.inline(F.expr(f"approx_top_k_estimate(frequent, {int(k)})")))
    return top.toDF("column_name", "level", "n").filter(F.col("level").isNotNull())
