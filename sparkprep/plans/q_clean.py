"""Registered queries for cleaning and projection operators (CL*, PJ*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import as_double
from ..operators import clean as C
from ..sources.tables import table
from .registry import register

PLACEHOLDER = "4-NOT SPECIFIED"


def orders_with_nulls(spark, sf):
    """orders with injected traps: the priority placeholder and a null price
    on every 17th key (same expressions in the oracle)."""
    o = table(spark, sf, "orders")
    return o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 17 == 0, F.lit(None)).otherwise(F.col("o_totalprice")))


ORDERS_NULLS_SQL = """(select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderkey % 17 = 0 then null else o_totalprice end as o_totalprice,
  o_orderdate, o_orderpriority from orders)"""

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _null_profile_sql(src: str, cols: list[str], digits: int) -> str:
    parts = [
        f"select {i} as ordinal, '{c}' as column_name, count(*) filter (where {c} is null) as null_count, "
        f"round(cast(count(*) filter (where {c} is null) as double) * 100 / cast(count(*) as double), {digits}) as null_percent from {src}"
        for i, c in enumerate(cols)
    ]
    return "\nunion all\n".join(parts)


@register("clean_placeholder", _null_profile_sql(
    f"(select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, nullif(o_orderpriority, '{PLACEHOLDER}') as o_orderpriority from orders)",
    _ORDER_COLS, 2))
def clean_placeholder(spark, sf):
    """CL3 + PR1 + PR3."""
    from ..operators.profile import null_counts
    return null_counts(C.placeholders_to_null(table(spark, sf, "orders"), PLACEHOLDER))


_EVENTS_DUP_SQL = "(select * from events union all select * from events where event_id % 10 = 0)"


def events_with_dups(spark, sf):
    e = table(spark, sf, "events")
    return e.unionByName(e.filter(F.col("event_id") % 10 == 0))


@register("clean_dedup", f"""select distinct event_id, ts, user_id, event_type, value, props from {_EVENTS_DUP_SQL}""")
def clean_dedup(spark, sf):
    """CL1."""
    return C.drop_duplicates(events_with_dups(spark, sf))


@register("dup_flags", f"""with g as (select count(*) as c from {_EVENTS_DUP_SQL} group by all_cols)
select false as duplicated, count(*) as "count" from g
union all select true as duplicated, cast(coalesce(sum(c - 1), 0) as bigint) as "count" from g""".replace(
    "group by all_cols", "group by event_id, ts, user_id, event_type, value, props"))
def dup_flags(spark, sf):
    """CL2."""
    return C.duplicate_flags(events_with_dups(spark, sf))


@register("clean_dropna", f"""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
from (select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 17 = 0 then null else o_totalprice end as o_totalprice,
  nullif(o_orderpriority, '{PLACEHOLDER}') as o_orderpriority from orders)
where o_orderkey is not null and o_custkey is not null and o_orderstatus is not null and o_totalprice is not null and o_orderpriority is not null""")
def clean_dropna(spark, sf):
    """CL14 on orders with injected nulls (placeholder + every 17th price)."""
    o = C.placeholders_to_null(orders_with_nulls(spark, sf), PLACEHOLDER)
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return C.drop_null_rows(o)


# A swap-shaped map shows the difference between simultaneous and chained rewriting.
EVENT_MAP = {"click": "view", "view": "other", "error": "issue"}
_MAP_SIM_SQL = "case event_type when 'click' then 'view' when 'view' then 'other' when 'error' then 'issue' else event_type end"
_MAP_SEQ_SQL = "case event_type when 'click' then 'other' when 'view' then 'other' when 'error' then 'issue' else event_type end"


@register("map_simultaneous", f"""select event_type, coalesce({_MAP_SIM_SQL}, 'Other') as mapped, count(*) as n
from events group by event_type, mapped""")
def map_simultaneous(spark, sf):
    """CL4."""
    e = table(spark, sf, "events").withColumn("mapped", F.col("event_type"))
    return C.map_values(e, "mapped", EVENT_MAP, default="Other").groupBy("event_type", "mapped").agg(F.count(F.lit(1)).alias("n"))


@register("map_sequential", f"""select event_type, coalesce({_MAP_SEQ_SQL}, 'Other') as mapped, count(*) as n
from events group by event_type, mapped""")
def map_sequential(spark, sf):
    """CL5: chained rules (click -> view -> other)."""
    e = table(spark, sf, "events").withColumn("mapped", F.col("event_type"))
    return C.map_values(e, "mapped", EVENT_MAP, default="Other", sequential=True).groupBy("event_type", "mapped").agg(
        F.count(F.lit(1)).alias("n"))


# Rare threshold = the mean rows per level, so both sides are non-empty at every scale.
_RARE_SQL_T = "(select cast(count(*) as double) / count(distinct props) from events)"


def _rare_threshold(e):
    r = e.agg((F.count(F.lit(1)) / F.count_distinct("props")).alias("t")).first()
    return r["t"]


@register("rare_levels", f"""select props as level, count(*) as "count" from events where props is not null
group by props having count(*) < {_RARE_SQL_T}""")
def rare_levels(spark, sf):
    """CL12 on events.props."""
    e = table(spark, sf, "events")
    return C.rare_levels(e, "props", _rare_threshold(e))


@register("rare_group", f"""with r as (select props from events group by props having count(*) < {_RARE_SQL_T})
select case when r.props is not null then 'Others' else e.props end as props, count(*) as n
from events e left join r on e.props = r.props group by 1""")
def rare_group(spark, sf):
    """CL13: rare props levels -> 'Others' via a lookup join."""
    e = table(spark, sf, "events")
    rare = C.rare_levels(e, "props", _rare_threshold(e))
    return C.group_rare(e, "props", rare).groupBy("props").agg(F.count(F.lit(1)).alias("n"))


@register("fill_const", f"""select coalesce(nullif(o_orderpriority, '{PLACEHOLDER}'), 'Unknown') as o_orderpriority, count(*) as n
from orders group by 1""")
def fill_const(spark, sf):
    """CL3 + CL6."""
    o = C.placeholders_to_null(table(spark, sf, "orders"), PLACEHOLDER)
    return C.fill_constant(o, {"o_orderpriority": "Unknown"}).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@register("fill_mode", f"""with o as (select case when o_orderkey % 7 = 0 then null else o_orderstatus end as s from orders),
m as (select s from o where s is not null group by s order by count(*) desc, s limit 1)
select coalesce(o.s, (select s from m)) as o_orderstatus, count(*) as n from o group by 1""")
def fill_mode(spark, sf):
    """CL10: every 7th status nulled, then filled with the most frequent one."""
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return C.impute_mode(o, "o_orderstatus").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("impute_median", f"""with o as {ORDERS_NULLS_SQL}
select o_orderkey, (coalesce(o_totalprice, (select median(o_totalprice) from o))) as o_totalprice from o""")
def impute_median(spark, sf):
    """CL8: exact median fill (batch scope)."""
    o = orders_with_nulls(spark, sf).select("o_orderkey", "o_totalprice")
    return C.impute_median(o, ["o_totalprice"]).select("o_orderkey", as_double(F.col("o_totalprice")).alias("o_totalprice"))


@register("impute_mean_cond", f"""with o as {ORDERS_NULLS_SQL}
select o_orderkey, (case when o_totalprice is null and o_orderstatus <> 'P'
  then (select avg(o_totalprice) from o where o_orderstatus <> 'P') else o_totalprice end) as o_totalprice from o""")
def impute_mean_cond(spark, sf):
    """CL11: mean fill only where the condition holds (status <> 'P')."""
    o = orders_with_nulls(spark, sf).select("o_orderkey", "o_orderstatus", "o_totalprice")
    out = C.impute_mean_conditional(o, "o_totalprice", F.col("o_orderstatus") != "P")
    return out.select("o_orderkey", as_double(F.col("o_totalprice")).alias("o_totalprice"))


@register("impute_median_approx")
def impute_median_approx(spark, sf):
    """CL9: approximate median (relative error 0.25 as in the table job). Rows-only check."""
    o = orders_with_nulls(spark, sf).select("o_orderkey", "o_totalprice")
    return C.impute_median(o, ["o_totalprice"], relative_error=0.25)


@register("sanitize_names", """select p_partkey as part_key, p_name as part_name, p_brand as "brand.code", p_size as size
from part""")
def sanitize_names(spark, sf):
    """PJ1: title case with spaces -> snake case (a dot survives)."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("Part Name"),
                                         F.col("p_brand").alias("Brand.Code"), F.col("p_size").alias("Size"))
    return C.sanitize_columns(p)


@register("drop_ignore_missing", "select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer")
def drop_ignore_missing(spark, sf):
    """PJ2: listed columns dropped, the missing one ignored."""
    return C.drop_columns(table(spark, sf, "customer"), ["c_name", "not_a_column"])


@register("align_columns", "select c_name, c_nationkey, c_mktsegment, c_custkey, c_acctbal, cast(0 as double) as c_extra from customer")
def align_columns(spark, sf):
    """PJ8: reorder with a zero-filled absent column."""
    return C.align_columns(table(spark, sf, "customer"), ["c_custkey", "c_acctbal", "c_extra"], fill=0)


@register("drop_constant", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, mixed from (select *, case when c_custkey % 2 = 0 then 'a' else 'b' end as mixed from customer)")
def drop_constant(spark, sf):
    """PJ4: a constant column and a constant-with-nulls column are dropped."""
    c = table(spark, sf, "customer").withColumns({
        "const_col": F.lit("x"),
        "const_with_nulls": F.when(F.col("c_custkey") % 3 == 0, F.lit("y")),
        "mixed": F.when(F.col("c_custkey") % 2 == 0, F.lit("a")).otherwise(F.lit("b")),
    })
    return C.drop_constant_columns(c)


@register("drop_dominant", "select c_custkey, c_mktsegment from customer")
def drop_dominant(spark, sf):
    """PJ5: a flag column whose 'Yes' share is below 1 % is dropped."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment").withColumn(
        "do_not_call", F.when(F.col("c_custkey") == 1, F.lit("Yes")).otherwise(F.lit("No")))
    return C.drop_if_share_below(c, "do_not_call", "Yes", 0.01)


@register("case_label", """select case when o_orderstatus = 'F' then 'Converted' else 'Not Converted' end as label, count(*) as n
from orders group by 1""")
def case_label(spark, sf):
    """PJ10."""
    o = table(spark, sf, "orders").withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))
    return o.groupBy(C.case_label(F.col("y")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("column_info", """select 0 as ordinal, 'o_orderkey' as column_name, count(o_orderkey) as non_null, 'bigint' as dtype from orders
union all select 1, 'o_custkey', count(o_custkey), 'bigint' from orders
union all select 2, 'o_orderstatus', count(o_orderstatus), 'string' from orders
union all select 3, 'o_totalprice', count(case when o_orderkey % 17 = 0 then null else o_totalprice end), 'double' from orders
union all select 4, 'o_orderdate', count(o_orderdate), 'timestamp_ntz' from orders
union all select 5, 'o_orderpriority', count(o_orderpriority), 'string' from orders""")
def column_info(spark, sf):
    """PJ11: name, non-null count and type per column."""
    return C.column_info(orders_with_nulls(spark, sf))


@register("filters_and_replace", """select o_orderkey, case when o_orderstatus in ('P', 'F') then 'X' else o_orderstatus end as o_orderstatus, o_orderpriority
from orders where o_orderpriority = '1-URGENT' and o_custkey is not null""")
def filters_and_replace(spark, sf):
    """CL15 (equals, not null) + CL16 + CL7 (targeted replace) + PJ3 (strict drop)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "o_totalprice")
    o = C.filter_null(C.filter_equals(o, "o_orderpriority", "1-URGENT"), "o_custkey", is_null=False)
    o = C.drop_null_rows(o, subset=["o_orderstatus"])
    return C.drop_columns(C.replace_values(o, ["P", "F"], "X", ["o_orderstatus"]), ["o_custkey", "o_totalprice"], strict=True)


@register("typed_columns", """select 'numeric' as kind, unnest(['o_orderkey', 'o_custkey', 'o_totalprice']) as column_name
union all select 'string', unnest(['o_orderstatus', 'o_orderpriority'])
union all select 'feature', unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_orderpriority'])""")
def typed_columns(spark, sf):
    """PJ6 + PJ7: column names by type, and the features beside a target, of the orders table."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    C.require_columns(C.require_non_empty(o), ["o_totalprice"])
    rows = [("numeric", c) for c in C.select_by_type(o, "numeric")] + [("string", c) for c in C.select_by_type(o, "string")]
    rows += [("feature", c) for c in C.split_features_target(o, "o_totalprice")[0]]
    return spark.createDataFrame(rows, "kind string, column_name string")
