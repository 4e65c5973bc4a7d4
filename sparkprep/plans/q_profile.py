"""Registered queries for profiling operators (PR*, ST*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import as_double
from ..operators import profile as P
from ..sources.tables import table
from .q_clean import ORDERS_NULLS_SQL, PLACEHOLDER, orders_with_nulls
from .registry import register

_ORD_NULLS_PH = f"""(select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderkey % 17 = 0 then null else o_totalprice end as o_totalprice,
  nullif(o_orderpriority, '{PLACEHOLDER}') as o_orderpriority from orders)"""


def _orders_traps(spark, sf):
    from ..operators.clean import placeholders_to_null
    o = orders_with_nulls(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return placeholders_to_null(o, PLACEHOLDER)


def _union(parts):
    return "\nunion all\n".join(parts)


_NULL_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@register("null_profile", _union([
    f"select {i} as ordinal, '{c}' as column_name, count(*) filter (where {c} is null) as null_count, "
    f"round(cast(count(*) filter (where {c} is null) as double) * 100 / cast(count(*) as double), 2) as null_percent from {_ORD_NULLS_PH}"
    for i, c in enumerate(_NULL_COLS)]))
def null_profile(spark, sf):
    """PR2 (+PR3)."""
    return P.null_counts(_orders_traps(spark, sf))


@register("cat_profile", _union([
    f"select {i} as ordinal, '{c}' as column_name, count(distinct {c}) as unique_values, "
    f"count(*) filter (where {c} is null) as null_values, "
    f"round(cast(count(*) filter (where {c} is null) as double) * 100 / cast(count(*) as double), 1) as null_percent from {_ORD_NULLS_PH}"
    for i, c in enumerate(["o_orderstatus", "o_orderpriority"])]))
def cat_profile(spark, sf):
    """PR8 ``Cat_info`` (value lists are the separate ``distinct_values`` table)."""
    return P.categorical_profile(_orders_traps(spark, sf), ["o_orderstatus", "o_orderpriority"])


@register("distinct_values", _union([
    f"select distinct '{c}' as column_name, {c} as value from {_ORD_NULLS_PH}" for c in ["o_orderstatus", "o_orderpriority"]]))
def distinct_values(spark, sf):
    """PR8 ``values`` column as rows (NULL included)."""
    return P.distinct_values(_orders_traps(spark, sf), ["o_orderstatus", "o_orderpriority"])


@register("num_profile", _union([
    f"select {i} as ordinal, '{c}' as column_name, count(*) filter (where {c} is null) as null_values, "
    f"round(cast(count(*) filter (where {c} is null) as double) * 100 / cast(count(*) as double), 1) as null_percent from {_ORD_NULLS_PH}"
    for i, c in enumerate(["o_orderkey", "o_custkey", "o_totalprice"])]))
def num_profile(spark, sf):
    """PR9 ``Num_info``."""
    return P.numeric_profile(_orders_traps(spark, sf))


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("describe", _union([
    f"select {i} as ordinal, '{c}' as column_name, count({c}) as count, (avg({c})) as mean, (stddev_samp({c})) as std, "
    f"min({c}) as min, (quantile_cont({c}, 0.25)) as p25, (quantile_cont({c}, 0.5)) as p50, "
    f"(quantile_cont({c}, 0.75)) as p75, max({c}) as max from lineitem"
    for i, c in enumerate(_DESC_COLS)]))
def describe(spark, sf):
    """PR10 with exact interpolated quartiles."""
    d = P.describe(table(spark, sf, "lineitem"), _DESC_COLS)
    return d.select("ordinal", "column_name", "count", as_double(F.col("mean")).alias("mean"), as_double(F.col("std")).alias("std"),
                    "min", as_double(F.col("p25")).alias("p25"), as_double(F.col("p50")).alias("p50"),
                    as_double(F.col("p75")).alias("p75"), "max")


@register("value_counts", """select p_brand as value, count(*) as count from part where p_brand is not null group by p_brand""")
def value_counts(spark, sf):
    """PR4 (+ST2 order)."""
    return P.value_counts(table(spark, sf, "part"), "p_brand")


@register("value_share", """select c_mktsegment as value, count(*) as count,
(cast(count(*) as double) * 100 / (select cast(count(*) as double) from customer where c_mktsegment is not null)) as percent
from customer where c_mktsegment is not null group by c_mktsegment""")
def value_share(spark, sf):
    """PR5: relative frequencies (non-null denominator) x 100."""
    v = P.value_counts(table(spark, sf, "customer"), "c_mktsegment", normalize=True)
    return v.select("value", "count", as_double(F.col("percent")).alias("percent"))


_FREQ_COLS = ["o_orderstatus", "o_orderpriority"]


@register("freq_all_columns", f"""with lf as ({_union([f"select '{c}' as column_name, {c} as value from {_ORD_NULLS_PH}" for c in _FREQ_COLS])}),
c as (select column_name, value, count(*) as count from lf group by column_name, value),
t as (select column_name, sum(count) as nn from c where value is not null group by column_name)
select c.column_name, c.value, c.count, (case when c.value is not null then cast(c.count as double) * 100 / cast(t.nn as double) end) as percent
from c left join t on c.column_name = t.column_name""")
def freq_all_columns(spark, sf):
    """PR6: missing + value counts for every column in one job."""
    f = P.frequencies(_orders_traps(spark, sf), _FREQ_COLS)
    return f.select("column_name", "value", "count", as_double(F.col("percent")).alias("percent"))


@register("top_share", f"""with lf as ({_union([f"select '{c}' as column_name, {c} as value from {_ORD_NULLS_PH}" for c in _FREQ_COLS])}),
c as (select column_name, value, count(*) as count from lf where value is not null group by column_name, value),
r as (select *, row_number() over (partition by column_name order by count desc, value) as rn,
      sum(count) over (partition by column_name) as nn from c)
select column_name, value as top_value, count as top_count, (cast(count as double) * 100 / cast(nn as double)) as top_percent
from r where rn = 1""")
def top_share(spark, sf):
    """PR23: the dominant level's share per column."""
    t = P.top_level_share(_orders_traps(spark, sf), _FREQ_COLS)
    return t.select("column_name", "top_value", "top_count", as_double(F.col("top_percent")).alias("top_percent"))


@register("distinct_incl_null", _union([
    f"select {i} as ordinal, '{c}' as column_name, count(distinct {c}) as distinct_non_null, "
    f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as distinct_with_null, "
    f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end) = count(*) as is_unique from {_ORD_NULLS_PH}"
    for i, c in enumerate(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])]))
def distinct_incl_null(spark, sf):
    """PR7: distinct counts with and without NULL; id-column test."""
    return P.distinct_counts(_orders_traps(spark, sf))


@register("id_columns", "select column_name from (" + _union([
    f"select '{c}' as column_name, count(distinct {c}) + max(case when {c} is null then 1 else 0 end) = count(*) as u from customer"
    for c in ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]]) + ") where u")
def id_columns(spark, sf):
    """PR7 used as the id-column test: columns whose distinct count (with null) equals the row count."""
    d = P.distinct_counts(table(spark, sf, "customer"))
    return d.filter(F.col("is_unique") & F.col("column_name").isin("c_custkey", "c_name", "c_nationkey", "c_mktsegment")).select("column_name")


@register("group_sum_share", """select l_returnflag, (sum(l_quantity)) as total,
round(sum(l_quantity) * 100 / (select sum(l_quantity) from lineitem), 1) as share_percent from lineitem group by l_returnflag""")
def group_sum_share(spark, sf):
    """PR11 + PR12."""
    g = P.group_sum_share(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity")
    return g.select("l_returnflag", as_double(F.col("total")).alias("total"), "share_percent")


@register("group_mean", """select l_returnflag, (avg(l_extendedprice)) as mean_l_extendedprice, (avg(l_discount)) as mean_l_discount
from lineitem group by l_returnflag""")
def group_mean(spark, sf):
    """PR13."""
    g = P.group_mean(table(spark, sf, "lineitem"), "l_returnflag", ["l_extendedprice", "l_discount"])
    return g.select("l_returnflag", *[as_double(F.col(c)).alias(c) for c in ["mean_l_extendedprice", "mean_l_discount"]])


_CONTRAST_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("group_contrast", _union([
    f"""select {i} as ordinal, '{c}' as column_name, 'F' as group_0, 'O' as group_1,
(avg({c}) filter (where l_linestatus = 'F')) as mean_0, (avg({c}) filter (where l_linestatus = 'O')) as mean_1,
((avg({c}) filter (where l_linestatus = 'O') - avg({c}) filter (where l_linestatus = 'F')) * 100 / nullif(avg({c}) filter (where l_linestatus = 'F'), 0)) as pct_diff,
abs((avg({c}) filter (where l_linestatus = 'O') - avg({c}) filter (where l_linestatus = 'F')) * 100 / nullif(avg({c}) filter (where l_linestatus = 'F'), 0)) > 1.0 as vastly_different
from lineitem""" for i, c in enumerate(_CONTRAST_COLS)]))
def group_contrast(spark, sf):
    """PR14 on the two line statuses (threshold 1 %)."""
    g = P.group_contrast(table(spark, sf, "lineitem"), "l_linestatus", _CONTRAST_COLS, threshold=1.0)
    return g.select("ordinal", "column_name", "group_0", "group_1", as_double(F.col("mean_0")).alias("mean_0"),
                    as_double(F.col("mean_1")).alias("mean_1"), as_double(F.col("pct_diff")).alias("pct_diff"), "vastly_different")


_CONTRAST_G = "nullif(l_returnflag, 'N')"


@register("group_contrast_nulls", f"""with l as (select *, {_CONTRAST_G} as g from lineitem)
select 0 as ordinal, 'l_quantity' as column_name, 'A' as group_0, 'R' as group_1, avg(l_quantity) filter (where g = 'A') as mean_0,
  avg(l_quantity) filter (where g = 'R') as mean_1,
  (avg(l_quantity) filter (where g = 'R') - avg(l_quantity) filter (where g = 'A')) * 100 / avg(l_quantity) filter (where g = 'A') as pct_diff,
  abs((avg(l_quantity) filter (where g = 'R') - avg(l_quantity) filter (where g = 'A')) * 100 / avg(l_quantity) filter (where g = 'A')) > 50.0 as vastly_different
from l""")
def group_contrast_nulls(spark, sf):
    """PR14 where a third of the group keys are null: they are no group."""
    li = table(spark, sf, "lineitem").select("l_quantity", F.expr(_CONTRAST_G).alias("g"))
    return P.group_contrast(li, "g", ["l_quantity"])


@register("profile_report_nulls", _union([
    f"""select {i} as ordinal, '{c}' as column_name, cast(count(*) filter (where {c} is null) as bigint) as null_count from {_ORD_NULLS_PH}"""
    for i, c in enumerate(["o_orderstatus", "o_totalprice", "o_orderpriority"])]))
def profile_report_nulls(spark, sf):
    """PR21: the report's null table, over all rows."""
    o = orders_with_nulls(spark, sf)
    o = o.withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != PLACEHOLDER, F.col("o_orderpriority")))
    report = P.profile_report(o.select("o_orderstatus", "o_totalprice", "o_orderpriority"))
    return report["nulls"].select("ordinal", "column_name", "null_count")


@register("crosstab_pct", _union([
    f"""select column_name, level, target, count, (cast(count as double) * 100 / cast(sum(count) over (partition by column_name, level) as double)) as row_percent
from (select '{c}' as column_name, {c} as level, o_orderstatus as target, count(*) as count
      from {_ORD_NULLS_PH} where {c} is not null group by {c}, o_orderstatus)"""
    for c in ["o_orderpriority"]]))
def crosstab_pct(spark, sf):
    """PR15: row-normalised crosstab of each categorical column vs the target."""
    o = _orders_traps(spark, sf)
    ct = P.crosstab_pct(o, "o_orderstatus", ["o_orderpriority"])
    return ct.select("column_name", "level", "target", "count", as_double(F.col("row_percent")).alias("row_percent"))


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql():
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS:
            if a == b:
                parts.append(f"select '{a}' as col_a, '{b}' as col_b, cast(1 as double) as corr")
            else:
                parts.append(f"select '{a}' as col_a, '{b}' as col_b, (corr({a}, {b})) as corr from lineitem")
    return _union(parts)


@register("corr_matrix", _corr_sql())
def corr_matrix(spark, sf):
    """PR16: all pairs in one aggregate."""
    c = P.corr_matrix(table(spark, sf, "lineitem"), _CORR_COLS)
    return c.select("col_a", "col_b", as_double(F.col("corr")).alias("corr"))


def _hist_sql(col, src, bins):
    return f"""with s as (select min({col}) as lo, max({col}) as hi from {src}),
b as (select least(cast(floor(({col} - s.lo) * {float(bins)} / (s.hi - s.lo)) as integer), {bins - 1}) as bin, count(*) as c
      from {src}, s where {col} is not null group by 1),
g as (select cast(range as integer) as bin from range({bins}))
select g.bin, (s.lo + g.bin * ((s.hi - s.lo) / {bins})) as lower, (s.lo + (g.bin + 1) * ((s.hi - s.lo) / {bins})) as upper,
  coalesce(b.c, 0) as count from g cross join s left join b on g.bin = b.bin"""


@register("hist_fixed", _hist_sql("o_totalprice", "orders", 30))
def hist_fixed(spark, sf):
    """PR17: 30 equal-width bins, top edge in the last bin."""
    h = P.histogram(table(spark, sf, "orders"), "o_totalprice", 30)
    return h.select("bin", as_double(F.col("lower")).alias("lower"), as_double(F.col("upper")).alias("upper"), "count")


_HIST_AUTO_SQL = """with s as (select count(value) as n, min(value) as lo, max(value) as hi,
  quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events),
w as (select n, lo, hi, (hi - lo) / (log2(cast(n as double)) + 1.0) as sw,
  2.0 * (q3 - q1) * pow(cast(n as double), cast(-1.0 as double) / cast(3.0 as double)) as fw from s),
b as (select lo, hi, greatest(1, cast(ceil((hi - lo) / (case when fw > 0 then least(sw, fw) else sw end)) as integer)) as bins from w),
h as (select least(cast(floor((e.value - b.lo) * cast(b.bins as double) / (b.hi - b.lo)) as integer), b.bins - 1) as bin, count(*) as c
      from events e, b where e.value is not null group by 1),
g as (select cast(unnest(range(bins)) as integer) as bin from b)
select g.bin, (b.lo + g.bin * ((b.hi - b.lo) / b.bins)) as lower, (b.lo + (g.bin + 1) * ((b.hi - b.lo) / b.bins)) as upper,
  coalesce(h.c, 0) as count from g cross join b left join h on g.bin = h.bin"""


@register("hist_auto", _HIST_AUTO_SQL)
def hist_auto(spark, sf):
    """PR18: bin count = the larger of Sturges and Freedman-Diaconis (numpy's 'auto')."""
    h = P.histogram_auto(table(spark, sf, "events"), "value")
    return h.select("bin", as_double(F.col("lower")).alias("lower"), as_double(F.col("upper")).alias("upper"), "count")


_KDE_SQL = """with s as (select count(value) as n, stddev_samp(value) as sd, min(value) as lo, max(value) as hi from events),
p as (select n, sd * pow(cast(n as double), cast(-0.2 as double)) as h, lo, hi from s),
q as (select n, h, lo - 3.0 * h as a, ((hi + 3.0 * h) - (lo - 3.0 * h)) / 199 as step from p),
g as (select cast(range as integer) as point, a + cast(range as double) * step as x, n, h from q, range(200))
select point, (x) as x,
  (sum(exp(-pow((x - e.value) / h, 2) / 2.0)) * (1.0 / (n * h * sqrt(2.0 * pi())))) as density
from g, events e where e.value is not null group by point, x, n, h"""


@register("kde", _KDE_SQL)
def kde(spark, sf):
    """PR19: Gaussian KDE on a 200-point grid, Scott bandwidth."""
    k = P.kde(table(spark, sf, "events"), "value")
    return k.select("point", as_double(F.col("x")).alias("x"), as_double(F.col("density")).alias("density"))


_BOX_COLS = ["o_totalprice"]


@register("box_stats", """with q as (select quantile_cont(o_totalprice, 0.25) as q1, quantile_cont(o_totalprice, 0.5) as med,
  quantile_cont(o_totalprice, 0.75) as q3 from orders)
select 'o_totalprice' as column_name, (q1) as q1, (med) as median, (q3) as q3, (q3 - q1) as iqr,
  (min(o_totalprice) filter (where o_totalprice >= q1 - 1.5 * (q3 - q1))) as whisker_low,
  (max(o_totalprice) filter (where o_totalprice <= q3 + 1.5 * (q3 - q1))) as whisker_high,
  count(*) filter (where o_totalprice < q1 - 1.5 * (q3 - q1) or o_totalprice > q3 + 1.5 * (q3 - q1)) as outliers
from orders, q group by q1, med, q3""")
def box_stats(spark, sf):
    """PR20: quartiles, whiskers, outlier count."""
    b = P.box_stats(table(spark, sf, "orders"), _BOX_COLS)
    return b.select("column_name", *[as_double(F.col(c)).alias(c) for c in ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]],
                    "outliers")


@register("outliers", """with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events)
select event_id, value from events, q where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)""")
def outliers(spark, sf):
    """PR20: rows outside the 1.5 IQR fences."""
    return P.outlier_rows(table(spark, sf, "events"), "value").select("event_id", "value")


@register("head_rows", """select o_orderkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 5""")
def head_rows(spark, sf):
    """PR22/ST4: first rows by key (a top-k report)."""
    return P.head(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), 5, ["o_orderkey"])


@register("quantiles_infinite", """
with x as (
  select case when l_linenumber = 1 then 'infinity'::double when l_linenumber = 2 then '-infinity'::double when l_linenumber = 3 then 'nan'::double
    when l_linenumber <> 4 then l_extendedprice::double end as mixed,
    case when l_linenumber <= 4 then 'infinity'::double else l_quantity::double end as high from lineitem),
y as (select case when not isnan(mixed) then mixed end as mixed, high from x)
select 'mixed' as name, count(mixed) as n, quantile_cont(mixed, 0.05) as p05, quantile_cont(mixed, 0.5) as p50, quantile_cont(mixed, 0.95) as p95 from y
union all select 'high', count(high), quantile_cont(high, 0.05), quantile_cont(high, 0.5), quantile_cont(high, 0.95) from y
""")
def quantiles_infinite(spark, sf):
    """PR10 / PR20: exact quantiles of columns with infinities at both ends, NaN and nulls."""
    from ..functions.ordered import exact_quantiles

    n, inf = F.col("l_linenumber"), float("inf")
    df = table(spark, sf, "lineitem").select(
        F.when(n == 1, F.lit(inf)).when(n == 2, F.lit(-inf)).when(n == 3, F.lit(float("nan"))).when(n != 4, F.col("l_extendedprice").cast("double")).alias("mixed"),
        F.when(n <= 4, F.lit(inf)).otherwise(F.col("l_quantity").cast("double")).alias("high"))
    found = exact_quantiles(df, {c: F.col(c) for c in df.columns}, [0.05, 0.5, 0.95])
    counts = df.agg(*[F.count(F.when(~F.isnan(c), F.col(c))).alias(c) for c in df.columns]).first()
    return spark.createDataFrame([(c, counts[c], *found[c]) for c in df.columns], "name string, n long, p05 double, p50 double, p95 double")
