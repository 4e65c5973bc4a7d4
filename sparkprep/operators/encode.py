"""Fitted encoders (EN1-EN7).

Fit statistics are computed for all columns in one long-form aggregation.
Applying them is a lookup join per column, which Spark broadcasts or shuffles
by the table's bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import long_form, q
from ..functions.joins import lookup_join
from ..session import cut_lineage
from .bind import number_rows


# --------------------------------------------------------------------------- target encoding (EN1-EN3)


@dataclass
class TargetEncoding:
    """Fitted state: ``stats`` has (column, level, n, target_mean, encoded);
    unknown and missing levels encode to ``prior``."""
    cols: list[str]
    prior: float
    stats: DataFrame
    suffix: str = ""
    drop_source: bool = False


def _level_stats(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    lf = long_form(df, cols, ids=[target], var="column_name", val="level")
    return (lf.filter(F.col("level").isNotNull())
            .groupBy("column_name", "level")
            .agg(F.count(F.lit(1)).alias("n"), F.avg(q(target).cast("double")).alias("target_mean")))


def smoothed_value(n: Column, mean: Column, prior: float, min_samples_leaf: float, smoothing: float,
                   single_to_prior: bool = True) -> Column:
    """``w = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing))``,
    ``enc = prior * (1 - w) + mean * w``; a level seen once gets the prior."""
    w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n.cast("double") - F.lit(float(min_samples_leaf))) / F.lit(float(smoothing))))
    enc = F.lit(prior) * (F.lit(1.0) - w) + mean * w
    return F.when(n == 1, F.lit(prior)).otherwise(enc) if single_to_prior else enc


def target_encoding_fit(df: DataFrame, cols: list[str], target: str, min_samples_leaf: float = 20,
                        smoothing: float = 10.0, single_to_prior: bool = True) -> TargetEncoding:
    """EN1: smoothed target encoding (defaults 20 / 10)."""
    prior = df.agg(F.avg(q(target).cast("double")).alias("p")).first()["p"]
    st = _level_stats(df, cols, target)
    st = st.withColumn("encoded", smoothed_value(F.col("n"), F.col("target_mean"), prior, min_samples_leaf,
                                                 smoothing, single_to_prior))
    return TargetEncoding(list(cols), prior, st)


def mean_encoding_fit(df: DataFrame, cols: list[str], target: str) -> TargetEncoding:
    """EN3 fit: plain per-level mean of the target; unknown/missing -> NULL;
    output ``<col>_encoded`` and the source column dropped."""
    st = _level_stats(df, cols, target).withColumn("encoded", F.col("target_mean"))
    return TargetEncoding(list(cols), None, st, suffix="_encoded", drop_source=True)


def apply_level_values(df: DataFrame, cols: list[str], stats: DataFrame, value_col: str, default,
                       suffix: str = "", drop_source: bool = False) -> DataFrame:
    """Replace each column's level by ``stats.value_col`` (keyed by column,
    level); unmatched -> ``default``."""
    small = stats.select("column_name", "level", value_col)
    out_name = {c: f"{c}{suffix}" for c in cols}
    dflt = F.lit(default).cast("double")
    out = df
    for c in cols:
        lk = small.filter(F.col("column_name") == c).select(F.col("level").alias(f"__lvl_{c}"), F.col(value_col).alias(f"__enc_{c}"))
        out = lookup_join(out.withColumn(f"__lvl_{c}", q(c).cast("string")), lk, [f"__lvl_{c}"], "left").drop(f"__lvl_{c}")
    proj = []
    for c in df.columns:
        if c in out_name:
            v = F.coalesce(F.col(f"__enc_{c}"), dflt)
            if drop_source:
                proj.append(v.alias(out_name[c]))
            else:
                proj.append(v.alias(out_name[c]) if suffix else v.alias(c))
                if suffix:
                    proj.append(q(c))
        else:
            proj.append(q(c))
    return out.select(*proj)


def target_encoding_transform(df: DataFrame, enc: TargetEncoding) -> DataFrame:
    """EN2 (and EN3 apply)."""
    return apply_level_values(df, enc.cols, enc.stats, "encoded", enc.prior, enc.suffix, enc.drop_source)


# --------------------------------------------------------------------------- one-hot (EN4-EN7)


@dataclass
class OneHot:
    """Fitted one-hot state: the output levels per column, in output order.
    A ``None`` level stands for NULL."""
    levels: dict[str, list] = field(default_factory=dict)
    passthrough: list[str] = field(default_factory=list)  # EN6: columns left raw (fewer than 2 levels)
    null_policy: str = "zero"  # zero | skip


def one_hot_name(col: str, level) -> str:
    return f"{col}_{'nan' if level is None else level}"


def _levels_table(df: DataFrame, cols: list[str]) -> DataFrame:
    lf = long_form(df, cols, var="column_name", val="level")
    return lf.groupBy("column_name", "level").count()


def one_hot_fit(df: DataFrame, cols: list[str], null_as_level: bool = True, max_levels: int | None = None) -> OneHot:
    """EN4: all levels sorted (null last when ``null_as_level``), drop the
    first; unknown levels -> all zeros. ``max_levels`` refuses wider columns."""
    rows = _levels_table(df, cols).collect()  # they become the schema: one output column per level
    out = {}
    for c in cols:
        lv = sorted(r["level"] for r in rows if r["column_name"] == c and r["level"] is not None)
        if null_as_level and any(r["column_name"] == c and r["level"] is None for r in rows):
            lv.append(None)
        if max_levels is not None and len(lv) > max_levels:
            raise ValueError(f"column {c} has {len(lv)} levels (> {max_levels}); group rare levels first")
        out[c] = lv[1:]
    return OneHot(out)


def one_hot_batch(df: DataFrame, cols: list[str]) -> DataFrame:
    """EN5: dummies fitted on the batch itself, first sorted level of the batch
    dropped, null -> all zeros. Output columns depend on the batch."""
    return one_hot_transform(df, one_hot_fit(df, cols, null_as_level=False))


def one_hot_indexed_fit(df: DataFrame, cols: list[str], null_policy: str = "zero",
                        max_levels: int | None = None) -> OneHot:
    """EN6 + EN7: levels ordered by frequency desc (ties by label), the last
    (least frequent) dropped; a column with fewer than two non-null levels
    stays raw. Level counts for all columns come from one aggregation (the
    gate of EN7 reads the same table)."""
    rows = _levels_table(df, cols).collect()  # they become the schema: one output column per level
    out, passthrough = {}, []
    for c in cols:
        lv = sorted(((r["level"], r["count"]) for r in rows if r["column_name"] == c and r["level"] is not None),
                    key=lambda t: (-t[1], t[0]))
        if len(lv) < 2:
            passthrough.append(c)
            continue
        out[c] = [name for name, _ in lv[:-1]]
    return OneHot(out, passthrough, null_policy)


def level_gate(df: DataFrame, cols: list[str]) -> DataFrame:
    """EN7: non-null distinct level count of every column in one job."""
    return _levels_table(df, cols).filter(F.col("level").isNotNull()).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("levels"))


def one_hot_transform(df: DataFrame, oh: OneHot, drop_source: bool = True) -> DataFrame:
    """Apply a fitted one-hot: scalar double columns ``<col>_<level>``."""
    proj = []
    new_cols = []
    for c in df.columns:
        if c in oh.levels:
            for lv in oh.levels[c]:
                e = q(c).isNull() if lv is None else q(c).eqNullSafe(F.lit(lv))
                new_cols.append(e.cast("double").alias(one_hot_name(c, lv)))
            if not drop_source:
                proj.append(q(c))
        else:
            proj.append(q(c))
    out = df.select(*proj, *new_cols)
    if oh.null_policy == "skip":
        cond = None
        for c in oh.levels:
            cond = q(c).isNotNull() if cond is None else cond & q(c).isNotNull()
        if cond is not None:
            out = df.filter(cond).select(*proj, *new_cols)
    return out


def index_one_hot_vector(df: DataFrame, col: str, handle_invalid: str = "keep") -> DataFrame:
    """EN6 for the ML path: ``<col>_ohe`` vector (frequency-ordered index,
    last level dropped). ``handle_invalid='skip'`` reproduces the table job's
    row removal on nulls (CL18)."""
    idx = StringIndexer(inputCol=col, outputCol=f"{col}_index", stringOrderType="frequencyDesc",
                        handleInvalid=handle_invalid).fit(df)
    out = idx.transform(df)
    ohe = OneHotEncoder(inputCol=f"{col}_index", outputCol=f"{col}_ohe", dropLast=True).fit(out)
    return ohe.transform(out).drop(col, f"{col}_index")


# --------------------------------------------------------------------------- levels as a table (EN4, EN6 for many levels)


def level_dictionary(df: DataFrame, cols: list[str], order: str = "frequency") -> DataFrame:
    """(column_name, level, n, level_index): the levels of each column, numbered
    from 0 by frequency (most frequent first, ties by level: EN6) or by
    ``order="level"`` (EN4). The numbers come from one distributed sort of the
    distinct levels; no level reaches the driver, so there is no bound on their
    number. Nulls are no level. The table is written once."""
    counts = _levels_table(df, cols).filter(F.col("level").isNotNull()).withColumnRenamed("count", "n")
    by = [F.col("column_name"), F.col("level")] if order == "level" else [F.col("column_name"), F.col("n").desc(), F.col("level")]
    numbered = number_rows(counts, by, "__no")
    first = numbered.groupBy("column_name").agg(F.min("__no").alias("__first"))
    return cut_lineage(numbered.join(first, "column_name").select("column_name", "level", "n", (F.col("__no") - F.col("__first")).alias("level_index")))


def dropped_level(levels: DataFrame, drop: str | None = "last") -> DataFrame:
    """The (column_name, level_index) that stands for all zeros: the last one
    (EN6), the first one (EN4) or none."""
    pick = {"last": F.max("level_index"), "first": F.min("level_index"), None: F.lit(None).cast("long")}[drop]
    return levels.groupBy("column_name").agg(pick.alias("dropped"))


def one_hot_long(df: DataFrame, key: str, levels: DataFrame, cols: list[str], drop: str | None = "last") -> DataFrame:
    """One-hot in long form: (key, column_name, level_index, value 1.0), a row
    for each non-zero place. Nulls, levels that the dictionary lacks and the
    dropped level have no row. Rows meet the dictionary in one join, which
    Spark broadcasts or shuffles by its bytes; adaptive execution splits a hot
    level."""
    kept = levels.join(dropped_level(levels, drop), "column_name").filter(~F.col("level_index").eqNullSafe(F.col("dropped")))
    lf = long_form(df, cols, ids=[key], val="level").filter(F.col("level").isNotNull())
    out = lookup_join(lf, kept.select("column_name", "level", "level_index"), ["column_name", "level"], "inner")
    return out.select(q(key), "column_name", "level_index", F.lit(1.0).alias("value"))


def one_hot_sparse(df: DataFrame, col: str, levels: DataFrame, out: str | None = None) -> DataFrame:
    """``df`` with ``<col>_ohe``, a sparse vector as wide as the dictionary's
    levels of ``col`` less one: the last level, nulls and unknown levels are
    all zeros (EN6). One number per row is kept, whatever the width. Columns of
    ``df`` named ``__level`` or ``__index`` are errors."""
    clash = {"__level", "__index"} & set(df.columns)
    if clash:
        raise ValueError(f"columns named {sorted(clash)}")
    own = levels.filter(F.col("column_name") == col).select(F.col("level").alias("__level"), F.col("level_index").cast("double").alias("__index"))
    size = own.count()
    if size < 2:
        raise ValueError(f"column {col} has fewer than two levels; leave it as it is (EN7)")
    x = df.withColumn("__level", q(col).cast("string"))
    x = lookup_join(x, own, "__level", "left").withColumn("__index", F.coalesce("__index", F.lit(float(size - 1))))
    encoder = OneHotEncoder(inputCol="__index", outputCol=out or f"{col}_ohe", dropLast=True).fit(own)
    return encoder.transform(x).select(*[q(c) for c in df.columns], q(out or f"{col}_ohe"))
