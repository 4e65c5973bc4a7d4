"""Cleaning, projection, value rewriting and imputation (CL1-CL18, PJ1-PJ11).

Every operator is ``DataFrame -> DataFrame`` (or returns a small fitted
statistic) built from native expressions; column names and constants are
parameters.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordered import exact_quantiles
from ..functions.exprs import NUMERIC_TYPES, numeric_columns, q, snake_name, string_columns
from ..functions.joins import lookup_join

# --------------------------------------------------------------------------- guards (CL17)


def require_non_empty(df: DataFrame, what: str = "Input DataFrame") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty.")
    return df


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Column(s) {missing} not found in DataFrame.")
    return df


# --------------------------------------------------------------------------- projection (PJ*)


def sanitize_columns(df: DataFrame, rule=snake_name) -> DataFrame:
    """PJ1: rename every column with ``rule`` in one projection; raise on collision."""
    new = [rule(c) for c in df.columns]
    dupes = sorted({n for n in new if new.count(n) > 1})
    if dupes:
        raise ValueError(f"Column names collide after sanitising: {dupes}")
    return df.select(*[q(c).alias(n) for c, n in zip(df.columns, new)])


def drop_columns(df: DataFrame, cols: Iterable[str], strict: bool = False) -> DataFrame:
    """PJ2 (ignore missing) / PJ3 (``strict``: error if a column is missing)."""
    cols = list(cols)
    if strict:
        require_columns(df, cols)
    keep = [c for c in df.columns if c not in set(cols)]
    return df.select(*[q(c) for c in keep])


def constant_columns(df: DataFrame, cols: Iterable[str] | None = None) -> list[str]:
    """PJ4 fit: columns with exactly one distinct non-null value. One pass with
    ``count/min/max`` per column (no distinct aggregation, no Expand):
    exactly one distinct non-null value <=> count > 0 and min = max."""
    cols = list(cols) if cols is not None else df.columns
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(q(c)).alias(f"n{i}"), F.min(q(c)).alias(f"lo{i}"), F.max(q(c)).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return [c for i, c in enumerate(cols) if row[f"n{i}"] > 0 and row[f"lo{i}"] == row[f"hi{i}"]]


def drop_constant_columns(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """PJ4."""
    return drop_columns(df, constant_columns(df, cols))


def value_share(df: DataFrame, col: str, value) -> float | None:
    """Share of ``value`` among non-null values of ``col`` (PR5 for one level)."""
    r = df.agg(F.avg(F.when(q(col).isNull(), None).otherwise((q(col) == F.lit(value)).cast("double"))).alias("s")).first()
    return r["s"]


def drop_if_share_below(df: DataFrame, col: str, value, min_share: float = 0.01) -> DataFrame:
    """PJ5: drop ``col`` when the share of ``value`` is below ``min_share``."""
    if col not in df.columns:
        return df
    share = value_share(df, col, value)
    return df.drop(col) if share is None or share < min_share else df


def select_by_type(df: DataFrame, kind: str = "numeric", exclude: Iterable[str] = ()) -> list[str]:
    """PJ6: ``numeric`` | ``non_numeric`` | ``string`` | ``integral_or_fractional``."""
    ex = set(exclude)
    if kind == "numeric":
        return numeric_columns(df, ex)
    if kind == "string":
        return string_columns(df, ex)
    if kind == "non_numeric":
        return [f.name for f in df.schema.fields if not isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]
    if kind == "integral_or_fractional":
        return [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.LongType, T.DoubleType)) and f.name not in ex]
    raise ValueError(f"unknown kind {kind!r}")


def split_features_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """PJ7: feature names and the target; features and label stay in one row (JN3)."""
    require_columns(df, [target])
    return [c for c in df.columns if c != target], target


def align_columns(df: DataFrame, cols: list[str], fill=0, keep_others: bool = True) -> DataFrame:
    """PJ8: reorder to ``cols``; absent columns are added as ``fill``."""
    proj = [q(c) if c in df.columns else F.lit(fill).cast("double").alias(c) for c in cols]
    rest = [q(c) for c in df.columns if c not in set(cols)] if keep_others else []
    return df.select(*rest, *proj)


def case_label(c: Column, zero_label: str = "Not Converted", other_label: str = "Converted") -> Column:
    """PJ10: ``0 -> zero_label``, anything else -> ``other_label`` (nulls stay null)."""
    return F.when(c.isNull(), None).when(c == 0, F.lit(zero_label)).otherwise(F.lit(other_label))


def column_info(df: DataFrame) -> DataFrame:
    """PJ11: (ordinal, column, non_null, dtype) in one aggregate."""
    counts = df.agg(*[F.count(q(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    entries = [
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"), F.col(f"c{i}").alias("non_null"),
                 F.lit(t).alias("dtype"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


# --------------------------------------------------------------------------- rows (CL1, CL2, CL14-CL16)


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """CL1: whole-row dedupe; nulls compare equal. Partial aggregation makes a
    hot duplicate group cheap (one row per group per partition is shuffled)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def duplicate_flags(df: DataFrame) -> DataFrame:
    """CL2: ``duplicated().value_counts()`` as rows (duplicated bool, count)."""
    groups = df.groupBy(*[q(c) for c in df.columns]).count()
    tot = groups.agg(
        F.count(F.lit(1)).alias("first_seen"),
        F.sum(F.col("count") - 1).alias("repeats"),
    )
    return tot.select(
        F.explode(
            F.array(
                F.struct(F.lit(False).alias("duplicated"), F.col("first_seen").cast("bigint").alias("count")),
                F.struct(F.lit(True).alias("duplicated"), F.coalesce(F.col("repeats"), F.lit(0)).cast("bigint").alias("count")),
            )
        ).alias("r")
    ).select("r.*")


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """CL14 (any column) / CL16 (listed columns)."""
    return df.na.drop(how="any", subset=subset)


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """CL15."""
    return df.filter(q(col) == F.lit(value))


def filter_null(df: DataFrame, col: str, is_null: bool = True) -> DataFrame:
    """CL15."""
    return df.filter(q(col).isNull() if is_null else q(col).isNotNull())


# --------------------------------------------------------------------------- value rewriting (CL3-CL7)


def placeholders_to_null(df: DataFrame, placeholder: str = "Select", cols: Iterable[str] | None = None) -> DataFrame:
    """CL3: placeholder -> NULL in string columns only (comparing a number
    with a string fails under ANSI), in one projection."""
    strings = set(string_columns(df))
    targets = strings if cols is None else strings & set(cols)
    return df.select(*[
        (F.when(q(c) == F.lit(placeholder), F.lit(None).cast("string")).otherwise(q(c)) if c in targets else q(c)).alias(c)
        for c in df.columns
    ])


def chained_closure(mapping: Mapping) -> dict:
    """CL5 helper: the result of applying ``mapping``'s rules one after
    another (``x = v if x == k``) to each key; a value that equals no key is
    never rewritten, so the closure over the keys describes the whole chain."""
    out = {}
    for start in mapping:
        x = start
        for k, v in mapping.items():
            if x == k:
                x = v
        out[start] = x
    return out


def map_expr(c: Column, mapping: Mapping, default=None) -> Column:
    """Simultaneous lookup: each value is rewritten at most once."""
    if mapping:
        m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        out = F.when(c.isin(list(mapping.keys())), F.element_at(m, c)).otherwise(c)
    else:
        out = c
    return F.coalesce(out, F.lit(default)) if default is not None else out


def map_values(df: DataFrame, col: str, mapping: Mapping, default=None, sequential: bool = False) -> DataFrame:
    """CL4 (simultaneous, default) / CL5 (``sequential``: chained rules, where
    earlier outputs are re-mapped by later rules). Nulls become ``default``."""
    m = chained_closure(mapping) if sequential else dict(mapping)
    return df.withColumn(col, map_expr(q(col), m, default))


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """CL6: per-column null fill with constants."""
    return df.select(*[
        (F.coalesce(q(c), F.lit(values[c]).cast(df.schema[c].dataType)) if c in values else q(c)).alias(c)
        for c in df.columns
    ])


def replace_values(df: DataFrame, to_replace: list, value, subset: list[str]) -> DataFrame:
    """CL7: targeted replace of listed values by one value."""
    return df.select(*[
        (F.when(q(c).isin(to_replace), F.lit(value)).otherwise(q(c)) if c in subset else q(c)).alias(c)
        for c in df.columns
    ])


# --------------------------------------------------------------------------- imputation (CL8-CL11)


def medians(df: DataFrame, cols: list[str], relative_error: float | None = None) -> dict[str, float | None]:
    """CL8/CL9 fit: exact interpolating median per column
    (``exact_quantiles``), or ``percentile_approx`` with accuracy ~
    1/relative_error. Only one scalar per column reaches the driver."""
    if not cols:
        return {}
    if relative_error is None:
        return {c: v[0] for c, v in exact_quantiles(df, {c: q(c) for c in cols}, [0.5]).items()}
    acc = max(1, int(round(1.0 / relative_error))) if relative_error > 0 else 1_000_000
    aggs = [F.percentile_approx(q(c).cast("double"), 0.5, acc).alias(f"m{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def fill_numeric(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """Null fill for numeric columns; a ``None`` statistic (all-null column)
    leaves the column untouched. Integral columns filled with a fractional
    median become double (as pandas does)."""
    out = []
    for c in df.columns:
        if c in values and values[c] is not None:
            dt = df.schema[c].dataType
            v = float(values[c])
            if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)) and v.is_integer():
                out.append(F.coalesce(q(c), F.lit(int(v)).cast(dt)).alias(c))
            else:
                out.append(F.coalesce(q(c).cast("double"), F.lit(v)).alias(c))
        else:
            out.append(q(c))
    return df.select(*out)


def impute_median(df: DataFrame, cols: list[str], relative_error: float | None = None) -> DataFrame:
    """CL8 (exact, batch scope) / CL9 (approximate)."""
    return fill_numeric(df, medians(df, cols, relative_error))


def mode_value(df: DataFrame, col: str):
    """CL10 fit: most frequent non-null value; ties go to the smallest value."""
    r = (df.filter(q(col).isNotNull()).groupBy(q(col).alias("v")).count()
         .orderBy(F.desc("count"), F.asc("v")).limit(1).first())
    return None if r is None else r["v"]


def impute_mode(df: DataFrame, col: str) -> DataFrame:
    """CL10."""
    v = mode_value(df, col)
    return df if v is None else fill_constant(df, {col: v})


def impute_mean_conditional(df: DataFrame, col: str, cond: Column) -> DataFrame:
    """CL11: fill nulls of ``col`` with the mean of ``col`` over rows where
    ``cond`` holds, and only on rows where ``cond`` holds."""
    m = df.filter(cond).agg(F.avg(q(col).cast("double")).alias("m")).first()["m"]
    if m is None:
        return df
    return df.withColumn(col, F.when(q(col).isNull() & cond, F.lit(m)).otherwise(q(col).cast("double")))


# --------------------------------------------------------------------------- rare levels (CL12, CL13)


def rare_levels(df: DataFrame, col: str, min_count: int = 10) -> DataFrame:
    """CL12: levels with fewer than ``min_count`` rows; nulls are never a level."""
    return (df.filter(q(col).isNotNull()).groupBy(q(col).alias("level")).count()
            .filter(F.col("count") < min_count))


def group_rare(df: DataFrame, col: str, rare: DataFrame, other: str = "Others") -> DataFrame:
    """CL13: rewrite levels found in the fitted ``rare`` table (column
    ``level``) to ``other`` via a lookup join (broadcast when the table is
    proven small, salted shuffle otherwise)."""
    flag = "__is_rare"
    lk = rare.select(F.col("level").alias(col)).distinct().withColumn(flag, F.lit(True))
    joined = lookup_join(df, lk, [col], "left")
    return joined.select(*[
        (F.when(F.col(flag), F.lit(other)).otherwise(q(c)) if c == col else q(c)).alias(c) for c in df.columns
    ])


def group_rare_list(df: DataFrame, col: str, levels: list, other: str = "Others") -> DataFrame:
    """CL13 for a short fitted list: an ``IN`` list (``OptimizeIn`` turns it into a hash set)."""
    if not levels:
        return df
    return df.withColumn(col, F.when(q(col).isin(levels), F.lit(other)).otherwise(q(col)))
