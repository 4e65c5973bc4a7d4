"""Drift statistics between a reference and a current frame (DR1-DR10).

Per-column tests follow the usual data-drift preset rules:
numeric columns with more than 5 distinct values use two-sample
Kolmogorov-Smirnov (p < 0.05) when the reference has at most 1000 rows
and the Wasserstein distance normalised by the reference standard deviation
(>= 0.1) otherwise; other columns use chi-square (p < 0.05; a two-proportion
z-test when binary) on small references and the Jensen-Shannon distance
(natural log, >= 0.1) on large ones. The dataset drifts when at least half
the columns do.

All statistics are aggregations over value-level counts: both frames are
pre-aggregated by distinct value (absorbing hot values), ECDFs use bucketed
running sums, and p-values are JVM-side expressions.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.exprs import chi2_sf, ks_asymptotic_p, metric_name_col, normal_two_sided_p, numeric_columns, q
from ..functions.ordered import running_sums
from ..session import cut_lineage

SMALL_REFERENCE_ROWS = 1000
NUMERIC_MIN_DISTINCT = 5  # numeric columns need more distinct values than this for numeric tests
STD_FLOOR = 0.001
#: Sample sizes (smaller, larger) up to which the Kolmogorov-Smirnov p-value is exact.
EXACT_SIZES = (1000, 10_000)


def exact_ks_p(d: float, n1: int, n2: int) -> float:
    """P(D >= d) for two samples without ties, exactly: the orders of the
    pooled sample are the lattice paths from (0, 0) to (n1, n2), all equally
    likely; those that never leave the band where the distribution functions
    differ by less than d are counted row by row, as running sums. The
    absolute error is below 1e-9."""
    n1, n2 = sorted((int(n1), int(n2)))
    if n1 == 0:
        return math.nan
    g = math.gcd(n1, n2)
    gap, j = round(d * (n1 // g * n2)), np.arange(n2 + 1) * (n1 // g)
    if gap <= 0:
        return 1.0
    u, scale = (j < gap).astype(float), 0.0
    for i in range(1, n1 + 1):
        inside = np.abs(i * (n2 // g) - j) < gap
        u = np.cumsum(u * inside) * inside
        top = u.max()
        if top == 0:
            return 1.0
        u /= top
        scale += math.log(top)
    if u[-1] == 0:
        return 1.0
    paths = math.lgamma(n1 + n2 + 1) - math.lgamma(n1 + 1) - math.lgamma(n2 + 1)
    return min(1.0, max(0.0, -math.expm1(min(0.0, math.log(u[-1]) + scale - paths))))


def _is_small(n1, n2) -> bool:
    return min(n1, n2) <= EXACT_SIZES[0] and max(n1, n2) <= EXACT_SIZES[1]


@F.pandas_udf(DoubleType())
def _exact_ks_p(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([exact_ks_p(x, a, b) if x == x and _is_small(a, b) else None for x, a, b in zip(d, n1, n2)], dtype="float64")


def ks_p(d: Column, n1: Column, n2: Column) -> Column:
    """The two-sample p-value: exact for sizes up to ``EXACT_SIZES``,
    asymptotic beyond. One row a column of the tables compared, so the Python
    worker's share is some additions over two sample sizes."""
    small = (F.least(n1, n2) <= EXACT_SIZES[0]) & (F.greatest(n1, n2) <= EXACT_SIZES[1])
    return F.when(small, _exact_ks_p(d.cast("double"), n1.cast("long"), n2.cast("long"))).otherwise(ks_asymptotic_p(d, n1, n2))


def _value_counts(ref: DataFrame, cur: DataFrame, col: str, cast: str) -> DataFrame:
    r = ref.select(q(col).cast(cast).alias("v")).filter(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("c_ref"))
    c = cur.select(q(col).cast(cast).alias("v")).filter(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("c_cur"))
    return r.join(c, "v", "full_outer").select("v", F.coalesce("c_ref", F.lit(0)).alias("c_ref"),
                                               F.coalesce("c_cur", F.lit(0)).alias("c_cur"))


def _ecdf(ref: DataFrame, cur: DataFrame, col: str, with_next: bool = False) -> DataFrame:
    vc = _value_counts(ref, cur, col, "double")
    cum = running_sums(vc, "v", {"ref": F.col("c_ref"), "cur": F.col("c_cur")}, with_next=with_next)
    return cum


def ks_test(ref: DataFrame, cur: DataFrame, col: str, alpha: float = 0.05, exact: bool = True) -> DataFrame:
    """DR2: D = max |F_ref - F_cur| over all distinct values; p as in ``ks_p``
    or, unless ``exact``, asymptotic at any size."""
    e = _ecdf(ref, cur, col)
    tot = e.agg(F.sum("c_ref").alias("n1"), F.sum("c_cur").alias("n2")).first()
    n1, n2 = tot["n1"], tot["n2"]
    stat = e.agg(F.max(F.abs(F.col("cum_ref") / F.lit(float(n1)) - F.col("cum_cur") / F.lit(float(n2)))).alias("statistic"))
    p = (ks_p if exact else ks_asymptotic_p)(F.col("statistic"), F.lit(n1), F.lit(n2))
    return stat.select(F.lit(col).alias("column_name"), F.lit("ks").alias("test"), "statistic", p.alias("p_value"),
                       F.lit(alpha).alias("threshold"), (p < alpha).alias("drifted"),
                       F.lit(n1).cast("bigint").alias("n_ref"), F.lit(n2).cast("bigint").alias("n_cur"))


def wasserstein(ref: DataFrame, cur: DataFrame, col: str, threshold: float = 0.1) -> DataFrame:
    """DR3: W1 = sum |F_ref(x_i) - F_cur(x_i)| (x_{i+1} - x_i) over sorted distinct
    values, divided by max(population std of the reference, 0.001)."""
    e = _ecdf(ref, cur, col, with_next=True)
    tot = ref.agg(F.count(q(col)).alias("n1"), F.stddev_pop(q(col).cast("double")).alias("sd")).first()
    n2 = cur.agg(F.count(q(col)).alias("n2")).first()["n2"]
    n1 = tot["n1"]
    sd = max(tot["sd"] or 0.0, STD_FLOOR)
    w = e.agg(F.sum(F.abs(F.col("cum_ref") / F.lit(float(n1)) - F.col("cum_cur") / F.lit(float(n2)))
                    * (F.col("next_key") - F.col("v"))).alias("w"))
    stat = F.coalesce(F.col("w"), F.lit(0.0)) / F.lit(sd)
    return w.select(F.lit(col).alias("column_name"), F.lit("wasserstein").alias("test"), stat.alias("statistic"),
                    F.lit(None).cast("double").alias("p_value"), F.lit(threshold).alias("threshold"),
                    (stat >= threshold).alias("drifted"), F.lit(n1).cast("bigint").alias("n_ref"),
                    F.lit(n2).cast("bigint").alias("n_cur"))


def _shares(ref: DataFrame, cur: DataFrame, col: str) -> DataFrame:
    vc = _value_counts(ref, cur, col, "string")
    tot = vc.agg(F.sum("c_ref").alias("n1"), F.sum("c_cur").alias("n2")).first()
    return vc.select("v", "c_ref", "c_cur", (F.col("c_ref") / F.lit(float(tot["n1"]))).alias("p"),
                     (F.col("c_cur") / F.lit(float(tot["n2"]))).alias("q")), tot["n1"], tot["n2"]


def jensen_shannon(ref: DataFrame, cur: DataFrame, col: str, threshold: float = 0.1) -> DataFrame:
    """DR4: sqrt(0.5 KL(p||m) + 0.5 KL(q||m)), m = (p+q)/2, natural log, over the union of levels."""
    s, n1, n2 = _shares(ref, cur, col)
    m = (F.col("p") + F.col("q")) / 2.0
    kl = lambda a: F.when(F.col(a) > 0, F.col(a) * F.log(F.col(a) / m)).otherwise(F.lit(0.0))
    js = s.agg(F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(kl("p")) + 0.5 * F.sum(kl("q")))).alias("statistic"))
    return js.select(F.lit(col).alias("column_name"), F.lit("jensenshannon").alias("test"), "statistic",
                     F.lit(None).cast("double").alias("p_value"), F.lit(threshold).alias("threshold"),
                     (F.col("statistic") >= threshold).alias("drifted"), F.lit(n1).cast("bigint").alias("n_ref"),
                     F.lit(n2).cast("bigint").alias("n_cur"))


def chi_square(ref: DataFrame, cur: DataFrame, col: str, alpha: float = 0.05) -> DataFrame:
    """DR5: observed current counts vs reference counts scaled by n_cur/n_ref,
    statistic sum (obs - exp)^2 / exp over the union of levels, k-1 degrees
    of freedom (a level absent from the reference gives an infinite statistic)."""
    s, n1, n2 = _shares(ref, cur, col)
    k = n2 / n1
    exp = F.col("c_ref") * F.lit(float(k))
    term = F.when(exp > 0, F.pow(F.col("c_cur") - exp, 2) / exp).otherwise(
        F.when(F.col("c_cur") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0)))
    a = s.agg(F.sum(term).alias("statistic"), F.count(F.lit(1)).alias("k"))
    p = chi2_sf(F.col("statistic"), F.col("k") - 1)
    p = F.when(F.col("statistic") == float("inf"), F.lit(0.0)).otherwise(p)
    return a.select(F.lit(col).alias("column_name"), F.lit("chisquare").alias("test"), "statistic", p.alias("p_value"),
                    F.lit(alpha).alias("threshold"), (p < alpha).alias("drifted"),
                    F.lit(n1).cast("bigint").alias("n_ref"), F.lit(n2).cast("bigint").alias("n_cur"))


def proportion_z(ref: DataFrame, cur: DataFrame, col: str, positive=None, alpha: float = 0.05) -> DataFrame:
    """DR6: two-proportion z-test on the share of ``positive`` (default: the
    smallest level of the union), pooled variance, two-sided p."""
    if positive is None:
        positive = (ref.select(q(col).cast("string").alias("v")).union(cur.select(q(col).cast("string").alias("v")))
                    .filter(F.col("v").isNotNull()).agg(F.min("v")).first()[0])
    v = q(col).cast("string")
    both = ref.select(F.lit(0).alias("__s"), v.alias("__v")).unionByName(cur.select(F.lit(1).alias("__s"), v.alias("__v")))
    row = both.agg(
        F.count_if((F.col("__s") == 0) & F.col("__v").isNotNull()).alias("n1"),
        F.count_if((F.col("__s") == 0) & (F.col("__v") == F.lit(positive))).alias("x1"),
        F.count_if((F.col("__s") == 1) & F.col("__v").isNotNull()).alias("n2"),
        F.count_if((F.col("__s") == 1) & (F.col("__v") == F.lit(positive))).alias("x2"),
    ).select("n1", "n2", (F.col("x1") / F.col("n1") - F.col("x2") / F.col("n2")).alias("d"),
             ((F.col("x1") + F.col("x2")) / (F.col("n1") + F.col("n2"))).alias("pp"))
    z = F.try_divide(F.col("d"), F.sqrt(F.col("pp") * (F.lit(1.0) - F.col("pp"))
                                        * (F.lit(1.0) / F.col("n1") + F.lit(1.0) / F.col("n2"))))
    p = F.coalesce(normal_two_sided_p(z), F.lit(1.0))
    return row.select(F.lit(col).alias("column_name"), F.lit("z").alias("test"), F.coalesce(z, F.lit(0.0)).alias("statistic"),
                      p.alias("p_value"), F.lit(alpha).alias("threshold"), (p < alpha).alias("drifted"),
                      F.col("n1").cast("bigint").alias("n_ref"), F.col("n2").cast("bigint").alias("n_cur"))


def unmatched_columns(ref: DataFrame, cur: DataFrame) -> list[tuple[str, str]]:
    """DR9: (column, frame) of columns that only one frame has; they are not compared."""
    return ([(c, "reference") for c in ref.columns if c not in set(cur.columns)]
            + [(c, "current") for c in cur.columns if c not in set(ref.columns)])


def reference_profile(ref: DataFrame, cols: list[str]) -> tuple[int, dict[str, float]]:
    """Rows of the reference, and the spread of each of its numeric columns among ``cols``."""
    nums = [c for c in numeric_columns(ref) if c in cols]
    row = ref.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_pop(q(c).cast("double")).alias(f"s{i}") for i, c in enumerate(nums)]).first()
    return row["n"], {c: max(row[f"s{i}"] or 0.0, STD_FLOOR) for i, c in enumerate(nums)}


def level_counts(df: DataFrame, cols: list[str], numeric: list[str], side: str) -> DataFrame:
    """(column_name, x, v, c_ref, c_cur): how often each value occurs, as the
    count of ``side`` (ref or cur). Values of ``numeric`` columns are doubles
    ``x`` (long ones beyond 2^53 may fall together), others texts ``v``; nulls
    are not counted."""
    def entry(c):
        x, v = (q(c).try_cast("double"), F.lit(None).cast("string")) if c in numeric else (F.lit(None).cast("double"), q(c).cast("string"))
        return F.struct(F.lit(c).alias("column_name"), x.alias("x"), v.alias("v"))

    long = df.select(F.inline(F.array(*[entry(c) for c in cols]))).filter(F.coalesce(F.col("v"), F.col("x").cast("string")).isNotNull())
    return long.groupBy("column_name", "x", "v").agg(*[(F.count(F.lit(1)) if s == side else F.lit(0).cast("long")).alias(f"c_{s}") for s in ("ref", "cur")])


def add_counts(counts: DataFrame) -> DataFrame:
    """Rows of ``level_counts`` of several frames, together."""
    return counts.groupBy("column_name", "x", "v").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))


def column_drift(ref: DataFrame, cur: DataFrame, cols: list[str] | None = None,
                 small_reference: int = SMALL_REFERENCE_ROWS, tests: dict[str, str] | None = None,
                 alpha: float = 0.05, distance: float = 0.1, exact: bool = True) -> DataFrame:
    """DR1-DR7 per column: one row per compared column (the intersection of
    both frames' columns, DR9). The preset rule takes the small-sample tests up
    to ``small_reference`` reference rows; ``tests`` names a column's test
    outright (ks, wasserstein, chisquare, z or jensenshannon). The p-value of
    ks is as in ``ks_p`` or, unless ``exact``, asymptotic at any size.

    DR7: a numeric column with more than 5 distinct values (over both frames)
    gets a numeric test, a column of exactly two the z-test on small
    references, any other a test of shares.

    All columns go together: one pass counts every (column, value) on both
    sides and is written once; kinds, totals and all statistics are
    aggregates over that table, so the number of jobs does not depend on the
    number of columns. Only a few scalars per column reach the driver."""
    cols = cols or [c for c in ref.columns if c in set(cur.columns)]
    rows, spread = reference_profile(ref, cols)
    nums = list(spread)
    counts = cut_lineage(add_counts(level_counts(ref, cols, nums, "ref").unionByName(level_counts(cur, cols, nums, "cur"))))
    return drift_of_counts(counts, cols, rows, spread, small_reference, tests, alpha, distance, exact)


def drift_of_counts(counts: DataFrame, cols: list[str], rows: int, spread: dict[str, float],
                    small_reference: int = SMALL_REFERENCE_ROWS, tests: dict[str, str] | None = None,
                    alpha: float = 0.05, distance: float = 0.1, exact: bool = True) -> DataFrame:
    """``column_drift`` from written counts of both sides (``add_counts``) and
    the reference's profile."""
    tests = tests or {}
    spark = counts.sparkSession
    found = {r["column_name"]: r for r in counts.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("levels"), F.sum("c_ref").alias("n1"), F.sum("c_cur").alias("n2")).collect()}
    small = rows <= small_reference
    plan = []
    for c in cols:
        levels = found[c]["levels"] if c in found else 0
        if c in tests:
            test = tests[c]
        elif c in spread and levels > NUMERIC_MIN_DISTINCT:
            test = "ks" if small else "wasserstein"
        else:
            test = ("z" if levels == 2 else "chisquare") if small else "jensenshannon"
        n1, n2 = (found[c]["n1"], found[c]["n2"]) if c in found else (0, 0)
        plan.append((c, test, n1, n2, spread.get(c, 1.0)))
    # a row a column: broadcast, as a join dealt by column name would give one task all values of a column
    planned = F.broadcast(spark.createDataFrame(plan, "column_name string, test string, n_ref bigint, n_cur bigint, spread double"))
    share = lambda count, n: F.try_divide(F.col(count).cast("double"), F.col(n).cast("double"))
    ordered = ("ks", "wasserstein")

    numeric = counts.join(planned.filter(F.col("test").isin(*ordered)).select("column_name"), "column_name", "left_semi")
    numeric = numeric.groupBy("column_name", F.coalesce(F.col("x"), F.col("v").cast("double")).alias("x")).agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))
    steps = running_sums(numeric, "x", {"ref": F.col("c_ref"), "cur": F.col("c_cur")}, partition_cols=["column_name"], with_next=True).join(planned, "column_name")
    gap = F.abs(share("cum_ref", "n_ref") - share("cum_cur", "n_cur"))
    numeric = steps.groupBy("column_name").agg(
        F.max(gap).alias("ks"), F.coalesce(F.sum(gap * (F.col("next_key") - F.col("x"))), F.lit(0.0)).alias("w"))

    levels = counts.join(planned.filter(~F.col("test").isin(*ordered)), "column_name").withColumn("v", F.coalesce("v", F.col("x").cast("string")))
    p, c = share("c_ref", "n_ref"), share("c_cur", "n_cur")
    kl = lambda x: F.when(x > 0, x * F.log(x / ((p + c) / 2.0))).otherwise(F.lit(0.0))
    expected = F.col("c_ref") * share("n_cur", "n_ref")
    term = F.when(expected > 0, F.pow(F.col("c_cur") - expected, 2) / expected).otherwise(
        F.when(F.col("c_cur") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0)))
    levels = levels.groupBy("column_name").agg(
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(kl(p)) + 0.5 * F.sum(kl(c)))).alias("js"), F.sum(term).alias("chi"),
        F.count(F.lit(1)).alias("k"), F.min_by("c_ref", "v").alias("x1"), F.min_by("c_cur", "v").alias("x2"))

    j = planned.join(numeric, "column_name", "left").join(levels, "column_name", "left")
    pooled = F.try_divide((F.col("x1") + F.col("x2")).cast("double"), (F.col("n_ref") + F.col("n_cur")).cast("double"))
    z = F.try_divide(share("x1", "n_ref") - share("x2", "n_cur"),
                     F.sqrt(pooled * (1.0 - pooled) * (F.try_divide(F.lit(1.0), F.col("n_ref")) + F.try_divide(F.lit(1.0), F.col("n_cur")))))
    test = F.col("test")
    statistic = (F.when(test == "ks", F.col("ks")).when(test == "wasserstein", F.col("w") / F.col("spread"))
                 .when(test == "jensenshannon", F.col("js")).when(test == "chisquare", F.col("chi")).otherwise(F.coalesce(z, F.lit(0.0))))
    p_value = (F.when(test == "ks", (ks_p if exact else ks_asymptotic_p)(F.col("ks"), F.col("n_ref"), F.col("n_cur")))
               .when(test == "chisquare", chi2_sf(F.col("chi"), F.col("k") - 1))
               .when(test == "z", F.coalesce(normal_two_sided_p(z), F.lit(1.0))))
    by_p = test.isin("ks", "chisquare", "z")
    threshold = F.when(by_p, F.lit(alpha)).otherwise(F.lit(distance))
    out = j.select("column_name", "test", statistic.alias("statistic"), p_value.alias("p_value"), threshold.alias("threshold"), "n_ref", "n_cur", by_p.alias("by_p"))
    drifted = F.coalesce(F.when(F.col("by_p"), F.col("p_value") < F.col("threshold")).otherwise(F.col("statistic") >= F.col("threshold")), F.lit(False))
    return out.select("column_name", "test", "statistic", "p_value", "threshold", drifted.alias("drifted"), "n_ref", "n_cur")


def dataset_drift(per_column: DataFrame, share_threshold: float = 0.5) -> DataFrame:
    """DR1: number and share of drifted columns; dataset drift when share >= 0.5."""
    a = per_column.agg(F.count(F.lit(1)).alias("number_of_columns"),
                       F.count_if(F.col("drifted")).alias("number_of_drifted_columns"))
    share = F.col("number_of_drifted_columns") / F.col("number_of_columns")
    return a.select("number_of_columns", "number_of_drifted_columns", share.alias("share_of_drifted_columns"),
                    (share >= share_threshold).alias("dataset_drift"))


def drift_metrics(per_column: DataFrame, prefix: str = "DataDriftTable") -> DataFrame:
    """DR8 + DR10: flatten to (metric, value) with sanitised metric names;
    only numeric values are kept."""
    ds = dataset_drift(per_column)
    rows = ds.select(F.explode(F.array(
        F.struct(F.lit(f"{prefix} dataset_drift").alias("metric"), F.col("dataset_drift").cast("double").alias("value")),
        F.struct(F.lit(f"{prefix} number_of_drifted_columns").alias("metric"),
                 F.col("number_of_drifted_columns").cast("double").alias("value")),
        F.struct(F.lit(f"{prefix} share_of_drifted_columns").alias("metric"),
                 F.col("share_of_drifted_columns").cast("double").alias("value")),
    )).alias("m")).select("m.*")
    cols = per_column.select(F.concat(F.lit("ValueDrift("), F.col("column_name"), F.lit(")")).alias("metric"),
                             F.col("statistic").cast("double").alias("value"))
    out = rows.unionByName(cols)
    return out.filter(F.col("value").isNotNull() & ~F.isnan("value")).select(metric_name_col(F.col("metric")).alias("metric"), "value")
