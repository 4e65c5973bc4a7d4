"""Registered queries for drift statistics (DR1-DR8): orders placed before
1998-01-01 (reference) vs from then on (current), whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import erfc_sql, metric_name_col, as_double
from ..operators import drift as D
from ..sources.tables import table
from .registry import register

CUT = "1998-01-01"


def ref_cur(spark, sf):
    o = table(spark, sf, "orders")
    cut = F.lit(CUT).cast("timestamp_ntz")
    return o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut)


_R = f"(select * from orders where o_orderdate < TIMESTAMP '{CUT}')"
_C = f"(select * from orders where o_orderdate >= TIMESTAMP '{CUT}')"
_OUT = "column_name, test, statistic, p_value, threshold, drifted, n_ref, n_cur"


def _rounded(df):
    return df.select("column_name", "test", as_double(F.col("statistic")).alias("statistic"),
                     as_double(F.col("p_value")).alias("p_value"), "threshold", "drifted", "n_ref", "n_cur")


def _ecdf_sql(col: str) -> str:
    return f"""vc as (select v, sum(cr) as cr, sum(cc) as cc from (
    select cast({col} as double) as v, 1 as cr, 0 as cc from {_R} where {col} is not null
    union all select cast({col} as double), 0, 1 from {_C} where {col} is not null) group by v),
n as (select sum(cr) as n1, sum(cc) as n2 from vc),
cum as (select v, sum(cr) over (order by v) as fr, sum(cc) over (order by v) as fc,
        lead(v) over (order by v) as nx from vc)"""


def ks_sql(col: str, alpha: float = 0.05) -> str:
    lam = "((sqrt(ne) + 0.12 + 0.11 / sqrt(ne)) * d)"
    series = f"list_sum(list_transform(range(1, 101), lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * {lam} * {lam})))"
    p = f"(case when {lam} < 0.001 then 1.0 else least(1.0, greatest(0.0, 2.0 * {series})) end)"
    return f"""with {_ecdf_sql(col)},
s as (select max(abs(cast(fr as double) / n1 - cast(fc as double) / n2)) as d,
      cast(any_value(n1) as double) * any_value(n2) / (any_value(n1) + any_value(n2)) as ne,
      any_value(n1) as n1, any_value(n2) as n2 from cum, n)
select '{col}' as column_name, 'ks' as test, (d) as statistic, ({p}) as p_value,
  cast({alpha} as double) as threshold, {p} < {alpha} as drifted, cast(n1 as bigint) as n_ref, cast(n2 as bigint) as n_cur from s"""


def wasserstein_sql(col: str, thr: float = 0.1) -> str:
    return f"""with {_ecdf_sql(col)},
sd as (select greatest(coalesce(stddev_pop(cast({col} as double)), 0.0), 0.001) as sd from {_R}),
w as (select coalesce(sum(abs(cast(fr as double) / n1 - cast(fc as double) / n2) * (nx - v)), 0.0) as w,
      any_value(n1) as n1, any_value(n2) as n2 from cum, n)
select '{col}' as column_name, 'wasserstein' as test, (w / sd) as statistic, cast(null as double) as p_value,
  cast({thr} as double) as threshold, w / sd >= {thr} as drifted, cast(n1 as bigint) as n_ref, cast(n2 as bigint) as n_cur from w, sd"""


def _shares_sql(col: str) -> str:
    return f"""vc as (select v, sum(cr) as cr, sum(cc) as cc from (
    select cast({col} as varchar) as v, 1 as cr, 0 as cc from {_R} where {col} is not null
    union all select cast({col} as varchar), 0, 1 from {_C} where {col} is not null) group by v),
n as (select sum(cr) as n1, sum(cc) as n2 from vc),
sh as (select v, cr, cc, cast(cr as double) / n1 as p, cast(cc as double) / n2 as q, n1, n2 from vc, n)"""


def js_sql(col: str, thr: float = 0.1) -> str:
    m = "((p + q) / 2.0)"
    return f"""with {_shares_sql(col)},
j as (select sqrt(greatest(0.0, 0.5 * sum(case when p > 0 then p * ln(p / {m}) else 0.0 end)
                              + 0.5 * sum(case when q > 0 then q * ln(q / {m}) else 0.0 end))) as js,
      any_value(n1) as n1, any_value(n2) as n2 from sh)
select '{col}' as column_name, 'jensenshannon' as test, (js) as statistic, cast(null as double) as p_value,
  cast({thr} as double) as threshold, js >= {thr} as drifted, cast(n1 as bigint) as n_ref, cast(n2 as bigint) as n_cur from j"""


def chi_sql(col: str, alpha: float = 0.05) -> str:
    """Oracle by the closed sums over half the degrees of freedom, term by term
    in log space: exp(-h) sum h^i / i! for an even number; for an odd one the
    same with half-integers after erfc(sqrt(h)). Independent of the code's method."""
    even = "list_sum(list_transform(range(0, cast(dof // 2 as bigint)), lambda i: exp(i * ln(x / 2.0) - x / 2.0 - lgamma(i + 1.0))))"
    odd = "coalesce(list_sum(list_transform(range(0, cast((dof - 1) // 2 as bigint)), lambda i: exp((i + 0.5) * ln(x / 2.0) - x / 2.0 - lgamma(i + 1.5)))), 0.0)"
    q = f"(case when x <= 0 then 1.0 when isinf(x) then 0.0 when dof % 2 = 0 then {even} else {erfc_sql('sqrt(x / 2.0)')} + {odd} end)"
    return f"""with {_shares_sql(col)},
a as (select sum(case when cast(cr as double) * n2 / n1 > 0 then pow(cc - cast(cr as double) * n2 / n1, 2) / (cast(cr as double) * n2 / n1)
                      when cc > 0 then 'inf'::double else 0.0 end) as x,
      count(*) - 1 as dof, any_value(n1) as n1, any_value(n2) as n2 from sh)
select '{col}' as column_name, 'chisquare' as test, (x) as statistic, (least(1.0, greatest(0.0, {q}))) as p_value,
  cast({alpha} as double) as threshold, {q} < {alpha} as drifted, cast(n1 as bigint) as n_ref, cast(n2 as bigint) as n_cur from a"""


def z_sql(col: str, positive: str, alpha: float = 0.05) -> str:
    z = "(d / sqrt(pp * (1.0 - pp) * (1.0 / n1 + 1.0 / n2)))"
    p = erfc_sql(f"(abs({z}) / sqrt(2.0))")
    return f"""with a as (select
   count({col}) filter (where s = 0) as n1, count(*) filter (where s = 0 and v = '{positive}') as x1,
   count({col}) filter (where s = 1) as n2, count(*) filter (where s = 1 and v = '{positive}') as x2
   from (select 0 as s, {col}, cast({col} as varchar) as v from {_R} union all select 1, {col}, cast({col} as varchar) from {_C})),
b as (select n1, n2, cast(x1 as double) / n1 - cast(x2 as double) / n2 as d, cast(x1 + x2 as double) / (n1 + n2) as pp from a)
select '{col}' as column_name, 'z' as test, ({z}) as statistic, ({p}) as p_value,
  cast({alpha} as double) as threshold, {p} < {alpha} as drifted, cast(n1 as bigint) as n_ref, cast(n2 as bigint) as n_cur from b"""


@register("drift_ks", ks_sql("o_totalprice"))
def drift_ks(spark, sf):
    """DR2: two-sample KS on o_totalprice, p-value asymptotic at any size."""
    r, c = ref_cur(spark, sf)
    return _rounded(D.ks_test(r, c, "o_totalprice", exact=False))


_KS_SMALL = """with recursive v as (select c_acctbal as x, count(*) filter (where c_nationkey = 0) as a, count(*) filter (where c_nationkey = 1) as b
  from customer where c_nationkey in (0, 1) and c_acctbal is not null group by 1),
n as (select sum(a)::bigint as n1, sum(b)::bigint as n2 from v),
gaps as (select max(abs(ca * n2 - cb * n1))::bigint as gap from (select sum(a) over (order by x) as ca, sum(b) over (order by x) as cb from v) cross join n),
paths as (
  select 0::bigint as i, list_transform(range(0, n2 + 1), lambda j: if(j * n1 < gap, 1.0::double, 0.0)) as u from n cross join gaps
  union all
  select i + 1, list_transform(range(0, n2 + 1), lambda j: if(abs((i + 1) * n2 - j * n1) < gap,
    list_sum(list_transform(range(0, j + 1), lambda t: if(abs((i + 1) * n2 - t * n1) < gap, u[t + 1], 0.0))), 0.0))
  from paths cross join n cross join gaps where i < n1),
p as (select greatest(0.0, least(1.0, 1 - u[n2 + 1] / exp(lgamma(n1 + n2 + 1) - lgamma(n1 + 1) - lgamma(n2 + 1)))) as p from paths join n on i = n1)
select 'c_acctbal' as column_name, 'ks' as test, gap::double / n1 / n2 as statistic, p as p_value, 0.05::double as threshold, p < 0.05 as drifted, n1 as n_ref, n2 as n_cur
from p cross join n cross join gaps"""


@register("drift_ks_small", _KS_SMALL)
def drift_ks_small(spark, sf):
    """DR2 on small samples: account balances of two nations' customers, with the exact p-value."""
    customers = table(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    return _rounded(D.ks_test(customers.filter("c_nationkey = 0"), customers.filter("c_nationkey = 1"), "c_acctbal"))


@register("drift_wasserstein", wasserstein_sql("o_totalprice"))
def drift_wasserstein(spark, sf):
    """DR3: normalised Wasserstein distance on o_totalprice."""
    r, c = ref_cur(spark, sf)
    return _rounded(D.wasserstein(r, c, "o_totalprice"))


@register("drift_js", js_sql("o_orderpriority"))
def drift_js(spark, sf):
    """DR4: Jensen-Shannon distance on o_orderpriority."""
    r, c = ref_cur(spark, sf)
    return _rounded(D.jensen_shannon(r, c, "o_orderpriority"))


@register("drift_chi2", chi_sql("o_orderpriority"))
def drift_chi2(spark, sf):
    """DR5: chi-square on o_orderpriority level counts."""
    r, c = ref_cur(spark, sf)
    return _rounded(D.chi_square(r, c, "o_orderpriority"))


@register("drift_chi2_many_levels", chi_sql("o_orderkey % 1003"))
def drift_chi2_many_levels(spark, sf):
    """DR5 on a column with more than a thousand levels."""
    r, c = ref_cur(spark, sf)
    name = "o_orderkey % 1003"
    return _rounded(D.chi_square(r.withColumn(name, F.expr(name)), c.withColumn(name, F.expr(name)), name))


@register("drift_prop_z", z_sql("o_orderstatus", "F"))
def drift_prop_z(spark, sf):
    """DR6: two-proportion z-test on the share of status 'F'."""
    r, c = ref_cur(spark, sf)
    return _rounded(D.proportion_z(r, c, "o_orderstatus", positive="F"))


_SUMMARY_COLS = ["o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority"]


def _by_size(small_sql: str, large_sql: str) -> str:
    """Pick the small- or large-reference test by the reference row count."""
    n = f"(select count(*) from {_R})"
    return (f"select * from ({small_sql}) where {n} <= {D.SMALL_REFERENCE_ROWS} "
            f"union all select * from ({large_sql}) where {n} > {D.SMALL_REFERENCE_ROWS}")


_SUMMARY_SQL = "\nunion all\n".join(
    [_by_size(ks_sql(c), wasserstein_sql(c)) for c in ["o_totalprice", "o_custkey"]]
    + [_by_size(chi_sql(c), js_sql(c)) for c in ["o_orderstatus", "o_orderpriority"]])


@register("drift_summary", _SUMMARY_SQL)
def drift_summary(spark, sf):
    """DR1 + DR7: per-column test chosen by type and size (large reference:
    Wasserstein for numeric, Jensen-Shannon for categorical)."""
    r, c = ref_cur(spark, sf)
    return _rounded(D.column_drift(r, c, _SUMMARY_COLS, exact=False))  # as its SQL; drift_ks_small has the exact p-value


@register("drift_dataset", f"""with t as ({_SUMMARY_SQL})
select count(*) as number_of_columns, count(*) filter (where drifted) as number_of_drifted_columns,
  (cast(count(*) filter (where drifted) as double) / count(*)) as share_of_drifted_columns,
  cast(count(*) filter (where drifted) as double) / count(*) >= 0.5 as dataset_drift from t""")
def drift_dataset(spark, sf):
    """DR1: dataset-level drift flag and share."""
    r, c = ref_cur(spark, sf)
    d = D.dataset_drift(D.column_drift(r, c, _SUMMARY_COLS))
    return d.select("number_of_columns", "number_of_drifted_columns",
                    as_double(F.col("share_of_drifted_columns")).alias("share_of_drifted_columns"), "dataset_drift")


@register("metric_names", r"""select distinct event_type,
  replace(lower(regexp_replace('ValueDrift(' || event_type || ') Score #1:' || event_type, '[^\w\-/ .]', '_', 'g')), ' ', '_') as metric
from events""")
def metric_names(spark, sf):
    """DR8: metric-name sanitising over names built from event types."""
    e = table(spark, sf, "events").select("event_type").distinct()
    raw = F.concat(F.lit("ValueDrift("), F.col("event_type"), F.lit(") Score #1:"), F.col("event_type"))
    return e.select("event_type", metric_name_col(raw).alias("metric"))
