"""Profiling and exploration statistics (PR1-PR23, ST1-ST4).

Per-column loops of the exploration notebooks become one job each: the
columns are unpivoted to long form inside the scan stage and aggregated
once, so partial aggregation keeps the shuffle at (columns x levels) per
partition. Results are tables, not charts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import exact_quantiles
from ..functions.exprs import long_form, numeric_columns, q, string_columns

# --------------------------------------------------------------------------- nulls (PR1-PR3, PR9)


def null_counts(df: DataFrame, cols: list[str] | None = None, percent_digits: int = 2) -> DataFrame:
    """PR1-PR3: (ordinal, column, null_count, null_percent) in one aggregate."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(q(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_count"))
               for i, c in enumerate(cols)]
    return agg.select(F.col("__n"), F.explode(F.array(*entries)).alias("e")).select(
        "e.ordinal", "e.column_name", "e.null_count",
        F.round(F.try_divide(F.col("e.null_count") * 100.0, F.col("__n").cast("double")), percent_digits).alias("null_percent"),
    )


def numeric_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PR9 ``Num_info``: (column, null_values, null_percent 1 dp), nulls desc (ST1)."""
    cols = cols or numeric_columns(df)
    return (null_counts(df, cols, 1)
            .select("ordinal", "column_name", F.col("null_count").alias("null_values"), "null_percent")
            .orderBy(F.desc("null_values"), "ordinal"))


# --------------------------------------------------------------------------- frequencies (PR4-PR6, PR23)


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """PR4/PR5 (+ST2): (value, count[, percent]) over non-null values, count
    desc then value. ``percent`` uses the non-null row count."""
    nn = df.filter(q(col).isNotNull())
    vc = nn.groupBy(q(col).alias("value")).count()
    if normalize:
        tot = nn.count()  # one scalar; a global window would run on one task
        vc = vc.withColumn("percent", F.col("count") * 100.0 / F.lit(float(tot)))
    return vc.orderBy(F.desc("count"), "value")


def frequencies(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PR6 for every column in one job: (column, value, count, percent) with
    nulls as ``value = NULL`` rows (the missing count); percent is over
    non-null rows of that column."""
    cols = cols or df.columns
    lf = long_form(df, cols)
    counts = lf.groupBy("column_name", "value").count()
    # per-column non-null totals: at most len(cols) rows, so the broadcast is bounded
    totals = counts.filter(F.col("value").isNotNull()).groupBy("column_name").agg(F.sum("count").alias("__nn"))
    return counts.join(F.broadcast(totals), "column_name", "left").select(
        "column_name", "value", "count",
        F.when(F.col("value").isNotNull(), F.col("count") * 100.0 / F.col("__nn")).alias("percent"),
    )


def top_level_share(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PR23: per column, the most frequent non-null level and its share (%)
    of non-null rows; ties to the smallest value."""
    fr = frequencies(df, cols).filter(F.col("value").isNotNull())
    best = fr.groupBy("column_name").agg(
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("top_value"),
        F.max("count").alias("top_count"), F.sum("count").alias("non_null"),
    )
    return best.select("column_name", "top_value", "top_count",
                       (F.col("top_count") * 100.0 / F.col("non_null")).alias("top_percent"))


# --------------------------------------------------------------------------- distinct (PR7, PR8)


def distinct_counts(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """PR7: (column, distinct_non_null, distinct_with_null, is_unique).
    ``approx`` switches to HyperLogLog++ for very wide/huge inputs."""
    cols = cols or df.columns
    n = F.count(F.lit(1)).alias("__n")
    aggs = [n]
    for i, c in enumerate(cols):
        d = F.approx_count_distinct(q(c)) if approx else F.count_distinct(q(c))
        aggs += [d.alias(f"d{i}"), F.max(q(c).isNull().cast("int")).alias(f"z{i}")]
    agg = df.agg(*aggs)
    entries = [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                        F.col(f"d{i}").alias("distinct_non_null"),
                        (F.col(f"d{i}") + F.coalesce(F.col(f"z{i}"), F.lit(0))).alias("distinct_with_null"))
               for i, c in enumerate(cols)]
    return agg.select("__n", F.explode(F.array(*entries)).alias("e")).select(
        "e.*", (F.col("e.distinct_with_null") == F.col("__n")).alias("is_unique"))


def categorical_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PR8 ``Cat_info``: (column, unique_values, null_values, null_percent
    1 dp), sorted by null count desc. Distinct counts come from one
    long-form ``groupBy(column, value)`` (no per-column distinct Expand).
    The list of distinct values is a separate long table:
    ``distinct_values``; it is never collected into one array."""
    cols = cols or string_columns(df)
    total = df.count()
    lf = long_form(df, cols, with_ordinal=True)
    per_level = lf.groupBy("ordinal", "column_name", "value").count()
    prof = per_level.groupBy("ordinal", "column_name").agg(
        F.count("value").alias("unique_values"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)).alias("null_values"),
    )
    return prof.select(
        "ordinal", "column_name", "unique_values", F.col("null_values").cast("bigint").alias("null_values"),
        F.round(F.col("null_values") * 100.0 / F.lit(float(total) if total else float("nan")), 1).alias("null_percent"),
    ).orderBy(F.desc("null_values"), "ordinal")


def distinct_values(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PR8's ``values`` as rows: (column, value) including a NULL value row."""
    cols = cols or string_columns(df)
    return long_form(df, cols).distinct()


# --------------------------------------------------------------------------- describe (PR10)


def describe(df: DataFrame, cols: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """PR10: count, mean, sample std, min, 25/50/75 % (linear interpolation,
    exact by ``exact_quantiles``; ``accuracy`` switches to
    ``percentile_approx``), max — one row per column."""
    cols = cols or numeric_columns(df)
    lf = long_form(df, cols, value_type="double", with_ordinal=True)
    if accuracy is None:
        found = exact_quantiles(df, {c: q(c) for c in cols}, [0.25, 0.5, 0.75])  # three scalars per column
        number = lambda x: "cast(null as double)" if x is None else f"double('{x!r}')"
        rows = [f"when column_name = '{c.replace(chr(39), chr(92) + chr(39))}' then array({', '.join(map(number, found[c]))})" for c in cols]
        pct = F.expr(f"case {' '.join(rows)} end") if rows else F.lit(None).cast("array<double>")
        return (lf.groupBy("ordinal", "column_name").agg(
            F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max")).withColumn("__p", pct)
            .select("ordinal", "column_name", "count", "mean", "std", "min",
                    F.col("__p")[0].alias("p25"), F.col("__p")[1].alias("p50"), F.col("__p")[2].alias("p75"), "max"))
    pct = F.percentile_approx(F.col("value"), [0.25, 0.5, 0.75], accuracy)
    return lf.groupBy("ordinal", "column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), pct.alias("__p"), F.max("value").alias("max"),
    ).select("ordinal", "column_name", "count", "mean", "std", "min",
             F.col("__p")[0].alias("p25"), F.col("__p")[1].alias("p50"), F.col("__p")[2].alias("p75"), "max")


# --------------------------------------------------------------------------- group stats (PR11-PR15)


def group_sum_share(df: DataFrame, group_col: str, value_col: str, digits: int = 1) -> DataFrame:
    """PR11 + PR12: per group sum and its share of the total (%, rounded)."""
    g = df.groupBy(q(group_col).alias(group_col)).agg(F.sum(q(value_col)).alias("total"))
    tot = df.agg(F.sum(q(value_col)).cast("double").alias("t")).first()["t"]  # one scalar
    return g.withColumn("share_percent", F.round(F.col("total") * 100.0 / F.lit(tot), digits))


def group_mean(df: DataFrame, group_col: str, value_cols: list[str]) -> DataFrame:
    """PR13."""
    return df.groupBy(q(group_col).alias(group_col)).agg(*[F.avg(q(c)).alias(f"mean_{c}") for c in value_cols])


def group_contrast(df: DataFrame, group_col: str, cols: list[str] | None = None, threshold: float = 50.0) -> DataFrame:
    """PR14 ``analyze_grouped_means``: means of every numeric column for the
    two groups (ordered by key), ``pct_diff = (m1 - m0) / m0 * 100`` (NULL when
    m0 = 0) and ``vastly_different = abs(pct_diff) > threshold``.
    Raises unless there are exactly two groups."""
    cols = cols or numeric_columns(df, exclude=(group_col,))
    df = df.filter(q(group_col).isNotNull())  # a null key is not a group
    lf = long_form(df, cols, ids=[group_col], value_type="double", with_ordinal=True)
    means = lf.groupBy(group_col, "ordinal", "column_name").agg(F.avg("value").alias("mean"))
    n_groups = means.select(group_col).distinct().count()
    if n_groups != 2:
        raise ValueError(f"The group column '{group_col}' must have exactly 2 unique values for comparison.")
    per_col = means.groupBy("ordinal", "column_name").agg(
        F.min_by("mean", q(group_col)).alias("mean_0"), F.max_by("mean", q(group_col)).alias("mean_1"),
        F.min(q(group_col)).cast("string").alias("group_0"), F.max(q(group_col)).cast("string").alias("group_1"),
    )
    pct = F.try_divide((F.col("mean_1") - F.col("mean_0")) * 100.0, F.col("mean_0"))
    return per_col.select("ordinal", "column_name", "group_0", "group_1", "mean_0", "mean_1",
                          pct.alias("pct_diff"), (F.abs(pct) > threshold).alias("vastly_different"))


def crosstab_pct(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    """PR15: for every categorical column, (column, level, target, count,
    row_percent) where row_percent normalises within the level. One job for
    all columns; null levels are excluded as pandas' crosstab does."""
    cols = cols or string_columns(df, exclude=(target,))
    lf = long_form(df, cols, ids=[target]).filter(F.col("value").isNotNull() & q(target).isNotNull())
    ct = lf.groupBy("column_name", F.col("value").alias("level"), q(target).alias("target")).count()
    lvl = F.sum("count").over(Window.partitionBy("column_name", "level"))
    return ct.withColumn("row_percent", F.col("count") * 100.0 / lvl)


# --------------------------------------------------------------------------- correlation (PR16)


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PR16: pairwise-complete Pearson correlation for all pairs in one
    aggregate; long form (col_a, col_b, corr), both triangles and diagonal."""
    cols = cols or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]

    def pearson(a: str, b: str) -> Column:
        # not F.corr, which raises for a constant column
        x, y = q(a).cast("double"), q(b).cast("double")
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.coalesce(F.try_divide(F.covar_pop(x, y), spread), F.lit(float("nan")))

    aggs = [pearson(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)]
    aggs += [F.min(q(c)).alias(f"lo{k}") for k, c in enumerate(cols)] + [F.max(q(c)).alias(f"hi{k}") for k, c in enumerate(cols)]
    row = df.agg(*aggs)
    entries = []
    for k, (a, b) in enumerate(pairs):
        entries.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{k}").alias("corr")))
        entries.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"r{k}").alias("corr")))
    for k, c in enumerate(cols):  # a constant column has no correlation, not even with itself
        own = F.when(F.col(f"lo{k}") < F.col(f"hi{k}"), F.lit(1.0)).otherwise(F.lit(float("nan")))
        entries.append(F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), own.alias("corr")))
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


# --------------------------------------------------------------------------- distributions (PR17-PR20)


def _min_max_count(df: DataFrame, col: str):
    r = df.agg(F.min(q(col).cast("double")).alias("lo"), F.max(q(col).cast("double")).alias("hi"),
               F.count(q(col)).alias("n")).first()
    return r["lo"], r["hi"], r["n"]


def bin_index(c: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin 0..bins-1 over [lo, hi]; the top edge belongs to the
    last bin (``width_bucket`` would return bins+1 there)."""
    if hi == lo:
        return F.lit(0)
    return F.least(F.floor((c.cast("double") - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """PR17: (bin, lower, upper, count) for all ``bins`` bins, empty ones included."""
    lo, hi, n = _min_max_count(df, col)
    if n == 0:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, count bigint")
    width = (hi - lo) / bins if hi > lo else 0.0
    counts = (df.filter(q(col).isNotNull()).groupBy(bin_index(q(col), lo, hi, bins).alias("bin")).count())
    edges = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = edges.join(counts, "bin", "left")
    return out.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


def auto_bin_count(df: DataFrame, col: str, accuracy: int | None = None) -> int:
    """PR18: numpy's 'auto' rule = the larger bin count of Sturges
    (log2(n) + 1) and Freedman-Diaconis (width 2 IQR n^(-1/3))."""
    pct = F.lit(None) if accuracy is None else F.percentile_approx(q(col).cast("double"), [0.25, 0.75], accuracy)
    r = df.agg(F.count(q(col)).alias("n"), F.min(q(col)).alias("lo"), F.max(q(col)).alias("hi"), F.first(pct).alias("p") if accuracy is None else pct.alias("p")).first()
    n, lo, hi = r["n"], r["lo"], r["hi"]
    if not n or hi == lo:
        return 1
    quartiles = exact_quantiles(df, {col: q(col)}, [0.25, 0.75])[col] if accuracy is None else r["p"]
    sturges_w = (hi - lo) / (math.log2(n) + 1.0)
    iqr = quartiles[1] - quartiles[0]
    fd_w = 2.0 * iqr * n ** (-1.0 / 3.0)
    width = min(sturges_w, fd_w) if fd_w > 0 else sturges_w
    return max(1, int(math.ceil((hi - lo) / width)))


def histogram_auto(df: DataFrame, col: str) -> DataFrame:
    """PR18."""
    return histogram(df, col, auto_bin_count(df, col))


def kde(df: DataFrame, col: str, grid_points: int = 200, cut: float = 3.0) -> DataFrame:
    """PR19: Gaussian kernel density on an even grid from ``min - cut*h`` to
    ``max + cut*h`` with Scott's bandwidth ``h = std * n^(-1/5)``.

    Each distinct value evaluates its kernel at every grid point with one
    higher-order expression, ``posexplode`` feeds a partial aggregation by
    grid point in the same stage, so only ``grid_points`` sums per partition
    are shuffled."""
    r = df.agg(F.count(q(col)).alias("n"), F.stddev_samp(q(col).cast("double")).alias("s"),
               F.min(q(col).cast("double")).alias("lo"), F.max(q(col).cast("double")).alias("hi")).first()
    n, s, lo, hi = r["n"], r["s"], r["lo"], r["hi"]
    spark = df.sparkSession
    if not n or not s:
        return spark.createDataFrame([], "point int, x double, density double")
    h = s * n ** (-1.0 / 5.0)
    a, b = lo - cut * h, hi + cut * h
    step = (b - a) / (grid_points - 1)
    x = q(col).cast("double")
    grid = F.transform(F.sequence(F.lit(0), F.lit(grid_points - 1)), lambda i: F.lit(a) + i.cast("double") * F.lit(step))
    kern = F.transform(grid, lambda g: F.col("n") * F.exp(-F.pow((g - F.col("v")) / F.lit(h), 2) / F.lit(2.0)))
    # equal values are evaluated once; the distinct ones are dealt over all tasks, since each costs grid_points kernels
    values = df.filter(q(col).isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    values = values.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    sums = values.select(F.posexplode(kern).alias("point", "k")).groupBy("point").agg(F.sum("k").alias("s"))
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    return sums.select(F.col("point").cast("int").alias("point"),
                       (F.lit(a) + F.col("point").cast("double") * F.lit(step)).alias("x"),
                       (F.col("s") * F.lit(norm)).alias("density"))


def box_stats(df: DataFrame, cols: list[str] | None = None, whis: float = 1.5) -> DataFrame:
    """PR20: per column q1, median, q3, iqr, whisker_low/high (most extreme
    values inside ``q -/+ whis*IQR``) and outlier count. Two aggregations:
    quartiles, then whiskers/outliers with the quartiles as literals."""
    cols = cols or numeric_columns(df)
    qs = describe(df, cols).select("column_name", "p25", "p50", "p75").collect()  # one row per column
    lims = {r["column_name"]: (r["p25"], r["p50"], r["p75"]) for r in qs}
    aggs = []
    for i, c in enumerate(cols):
        q1, _, q3 = lims[c]
        if q1 is None:
            aggs += [F.lit(None).cast("double").alias(f"wl{i}"), F.lit(None).cast("double").alias(f"wh{i}"),
                     F.lit(0).cast("bigint").alias(f"o{i}")]
            continue
        lo_f, hi_f = q1 - whis * (q3 - q1), q3 + whis * (q3 - q1)
        v = q(c).cast("double")
        aggs += [F.min(F.when(v >= lo_f, v)).alias(f"wl{i}"), F.max(F.when(v <= hi_f, v)).alias(f"wh{i}"),
                 F.count_if((v < lo_f) | (v > hi_f)).alias(f"o{i}")]
    row = df.agg(*aggs)
    entries = []
    for i, c in enumerate(cols):
        q1, med, q3 = lims[c]
        entries.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(q1).cast("double").alias("q1"), F.lit(med).cast("double").alias("median"),
            F.lit(q3).cast("double").alias("q3"),
            (F.lit(q3).cast("double") - F.lit(q1).cast("double")).alias("iqr"),
            F.col(f"wl{i}").alias("whisker_low"), F.col(f"wh{i}").alias("whisker_high"),
            F.col(f"o{i}").cast("bigint").alias("outliers")))
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def outlier_rows(df: DataFrame, col: str, whis: float = 1.5) -> DataFrame:
    """PR20: rows outside the whiskers' fences."""
    b = box_stats(df, [col], whis).first()
    if b["q1"] is None:
        return df.limit(0)
    lo_f, hi_f = b["q1"] - whis * b["iqr"], b["q3"] + whis * b["iqr"]
    v = q(col).cast("double")
    return df.filter((v < lo_f) | (v > hi_f))


# --------------------------------------------------------------------------- head / shape / report (PR21, PR22, ST4)


def head(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """PR22/ST4: first rows by an explicit key (a distributed top-k)."""
    return df.orderBy(*(order_by or df.columns[:1])).limit(n)


def shape(df: DataFrame) -> tuple[int, int]:
    """PR22."""
    return df.count(), len(df.columns)


def profile_report(df: DataFrame, target: str | None = None, max_rows: int | None = None, max_cols: int | None = None,
                   seed: int = 42) -> dict[str, DataFrame]:
    """PR21: the automatic profile as tables over all rows and columns, or
    over a sample of at most ``max_rows`` and ``max_cols`` (IO2) if given."""
    from ..sources.tables import profile_sample

    s = profile_sample(df, max_rows, max_cols, seed)
    nums = numeric_columns(s, exclude=(target,) if target else ())
    cats = string_columns(s, exclude=(target,) if target else ())
    out = {
        "nulls": null_counts(s),
        "categorical": categorical_profile(s, cats) if cats else None,
        "numeric": describe(s, nums) if nums else None,
        "frequencies": frequencies(s, cats) if cats else None,
        "correlation": corr_matrix(s, nums) if len(nums) > 1 else None,
        "box": box_stats(s, nums) if nums else None,
    }
    if target and cats:
        out["crosstab"] = crosstab_pct(s, target, cats)
    return {k: v for k, v in out.items() if v is not None}
