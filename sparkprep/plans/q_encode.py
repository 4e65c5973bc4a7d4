"""Registered queries for encoders (EN1-EN7) and the flagship feature chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import as_double
from ..operators import clean as C
from ..operators import encode as E
from ..sources.tables import table
from .q_clean import PLACEHOLDER
from .registry import register

# smoothed target encoding in SQL: w = 1/(1+exp(-(n-20)/10)); enc = prior*(1-w) + mean*w; n = 1 -> prior
_W = "(1.0 / (1.0 + exp(-(cast(n as double) - 20.0) / 10.0)))"
_ENC = f"case when n = 1 then prior else prior * (1.0 - {_W}) + m * {_W} end"

_PRIO_SQL = f"coalesce(nullif(o_orderpriority, '{PLACEHOLDER}'), 'Unknown')"


def _orders_prio(spark, sf):
    o = table(spark, sf, "orders")
    o = C.placeholders_to_null(o, PLACEHOLDER)
    o = C.fill_constant(o, {"o_orderpriority": "Unknown"})
    return o.withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))


@register("target_enc_smooth", f"""with t as (select {_PRIO_SQL} as level, case when o_orderstatus = 'F' then 1 else 0 end as y from orders),
p as (select avg(y) as prior from t),
s as (select level, count(*) as n, avg(y) as m from t group by level)
select 'o_orderpriority' as column_name, level, n, (m) as target_mean, ({_ENC}) as encoded from s, p""")
def target_enc_smooth(spark, sf):
    """EN1 (flagship slice): placeholder -> null -> 'Unknown' -> smoothed
    target encoding against status = 'F'."""
    enc = E.target_encoding_fit(_orders_prio(spark, sf), ["o_orderpriority"], "y")
    return enc.stats.select("column_name", "level", "n", as_double(F.col("target_mean")).alias("target_mean"),
                            as_double(F.col("encoded")).alias("encoded"))


@register("target_enc_apply_unseen", f"""with t as (select o_orderkey, {_PRIO_SQL} as level, case when o_orderstatus = 'F' then 1 else 0 end as y from orders),
f as (select * from t where level <> '5-LOW'),
p as (select avg(y) as prior from f),
s as (select level, count(*) as n, avg(y) as m from f group by level),
e as (select level, {_ENC} as enc from s, p)
select t.o_orderkey, (coalesce(e.enc, (select prior from p))) as o_orderpriority from t left join e on t.level = e.level""")
def target_enc_apply_unseen(spark, sf):
    """EN2: fit without '5-LOW', transform all rows; the unseen level gets the prior."""
    o = _orders_prio(spark, sf)
    enc = E.target_encoding_fit(o.filter(F.col("o_orderpriority") != "5-LOW"), ["o_orderpriority"], "y")
    out = E.target_encoding_transform(o.select("o_orderkey", "o_orderpriority"), enc)
    return out.select("o_orderkey", as_double(F.col("o_orderpriority")).alias("o_orderpriority"))


@register("target_enc_join", f"""with t as (select o_orderkey, {_PRIO_SQL} as level, case when o_orderstatus = 'F' then 1 else 0 end as y from orders),
p as (select avg(y) as prior from t),
s as (select level, count(*) as n, avg(y) as m from t group by level),
e as (select level, {_ENC} as enc from s, p)
select t.o_orderkey, (coalesce(e.enc, (select prior from p))) as o_orderpriority from t left join e on t.level = e.level""")
def target_enc_join(spark, sf):
    """EN2 through the join path (map literals disabled): the lookup join of
    JN1 — broadcast when the level table is proven small, salted otherwise."""
    o = _orders_prio(spark, sf)
    enc = E.target_encoding_fit(o, ["o_orderpriority"], "y")
    out = E.apply_level_values(o.select("o_orderkey", "o_orderpriority"), enc.cols, enc.stats, "encoded", enc.prior)
    return out.select("o_orderkey", as_double(F.col("o_orderpriority")).alias("o_orderpriority"))


@register("target_enc_mean", """with s as (select event_type, avg(case when value > 50 then 1 else 0 end) as m from events group by event_type)
select e.event_id, (s.m) as event_type_encoded from events e left join s on e.event_type = s.event_type""")
def target_enc_mean(spark, sf):
    """EN3: plain mean encoding of events.event_type vs value > 50 (JN1: left join, rename, drop key)."""
    e = table(spark, sf, "events").select("event_id", "event_type", (F.col("value") > 50).cast("int").alias("y"))
    enc = E.mean_encoding_fit(e, ["event_type"], "y")
    out = E.target_encoding_transform(e.select("event_id", "event_type"), enc)
    return out.select("event_id", as_double(F.col("event_type_encoded")).alias("event_type_encoded"))


def _segments(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    # a null level on every 11th customer
    return c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")))


_SEG_SQL = "(select c_custkey, case when c_custkey % 11 = 0 then null else c_mktsegment end as c_mktsegment from customer)"


def _one_hot_sql(levels_expr_order: str, drop: str, null_col: bool) -> str:
    """Long-form (c_custkey, feature, value) oracle: the Spark side unpivots
    its wide one-hot output so the level set need not be known in SQL."""
    return f"""with s as {_SEG_SQL},
lv as (select c_mktsegment as level, row_number() over (order by {levels_expr_order}) as rk, count(*) over () as k
       from (select c_mktsegment, count(*) as cnt from s {'' if null_col else 'where c_mktsegment is not null'} group by c_mktsegment)),
keep as (select level from lv where {drop})
select s.c_custkey, 'c_mktsegment_' || coalesce(keep.level, 'nan') as feature,
  case when (s.c_mktsegment = keep.level) or (s.c_mktsegment is null and keep.level is null) then cast(1 as double) else cast(0 as double) end as value
from s, keep"""


def _unpivot_one_hot(df, key, prefix):
    feats = [c for c in df.columns if c.startswith(prefix)]
    if not feats:
        return df.sparkSession.createDataFrame([], f"{key} bigint, feature string, value double")
    return df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value"))
                                              for c in feats])).alias("kv")).select(key, "kv.feature", "kv.value")


@register("one_hot_fitted", _one_hot_sql("c_mktsegment nulls last", "rk > 1", True))
def one_hot_fitted(spark, sf):
    """EN4: sorted levels, null its own (last) level, first level dropped."""
    s = _segments(spark, sf)
    oh = E.one_hot_fit(s, ["c_mktsegment"])
    return _unpivot_one_hot(E.one_hot_transform(s, oh), "c_custkey", "c_mktsegment_")


@register("one_hot_droplast", _one_hot_sql("cnt desc, c_mktsegment", "rk < k", False))
def one_hot_droplast(spark, sf):
    """EN6: frequency-ordered levels, least frequent dropped, null -> zeros."""
    s = _segments(spark, sf)
    oh = E.one_hot_indexed_fit(s, ["c_mktsegment"])
    return _unpivot_one_hot(E.one_hot_transform(s, oh), "c_custkey", "c_mktsegment_")


@register("one_hot_batch", _one_hot_sql("c_mktsegment", "rk > 1", False).replace(
    "case when (s.c_mktsegment = keep.level)", "case when (s.c_mktsegment = keep.level and s.c_mktsegment is not null)"))
def one_hot_batch(spark, sf):
    """EN5: dummies of the batch, first seen level dropped, null -> zeros."""
    s = _segments(spark, sf)
    return _unpivot_one_hot(E.one_hot_batch(s, ["c_mktsegment"]), "c_custkey", "c_mktsegment_")


@register("level_gate", """select 'c_mktsegment' as column_name, count(distinct c_mktsegment) as levels from customer
union all select 'const_col', 1
union all select 'o_flag', count(distinct case when c_custkey % 2 = 0 then 'Yes' end) from customer""")
def level_gate(spark, sf):
    """EN7: non-null level count per column in one job (gate for EN6)."""
    c = table(spark, sf, "customer").withColumns({
        "const_col": F.lit("x"), "o_flag": F.when(F.col("c_custkey") % 2 == 0, F.lit("Yes"))})
    return E.level_gate(c, ["c_mktsegment", "const_col", "o_flag"])
