"""Registered queries for the composite feature chain (EN8-EN12): the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import as_double
from ..sources.tables import table
from .features import FeatureEngineer, FeatureSpec, minimal_clean
from .q_clean import PLACEHOLDER
from .registry import register

# A geometrically skewed level (x = 1 + key % 1024; level = floor(log2 x)) so
# that rare levels (< 1 % of rows) exist at every scale.
_BAND_BOUNDS = [512, 256, 128, 64, 32, 16, 8, 4, 2]


def band_col(key):
    x = F.lit(1) + key % 1024
    e = F.when(x >= 1024, F.lit("b10"))
    for b in _BAND_BOUNDS:
        e = e.when(x >= b, F.lit(f"b{b.bit_length() - 1}"))
    return e.otherwise(F.lit("b0"))


def _band_sql(key: str) -> str:
    x = f"(1 + {key} % 1024)"
    parts = " ".join(f"when {x} >= {b} then 'b{b.bit_length() - 1}'" for b in [1024] + _BAND_BOUNDS)
    return f"case {parts} else 'b0' end"


SEGMENT_MAP = {"AUTOMOBILE": "MOTOR", "MACHINERY": "MOTOR"}


def flagship_spec() -> FeatureSpec:
    return FeatureSpec(
        target="converted",
        te_cols=["o_orderpriority", "band"],
        ohe_cols=["c_mktsegment"],
        numeric_cols=["o_totalprice", "c_acctbal"],
        drop_cols=["o_orderdate", "c_name", "o_custkey"],
        placeholder=PLACEHOLDER,
        value_maps={"c_mktsegment": {"map": SEGMENT_MAP, "default": "Other"}},
        fills={"o_orderpriority": "Unknown"},
        rare_col="band",
        rare_min_share=0.01,
    )


def flagship_frame(spark, sf):
    """orders joined to customers with the lead-table traps: a placeholder
    priority, null prices on every 17th key, a skewed level with rare values."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left").drop("c_custkey")
    return j.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", band_col(F.col("o_orderkey")).alias("band"),
        "c_name", "c_mktsegment",
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "c_acctbal", (F.col("o_orderstatus") == "F").cast("int").alias("converted"),
    )


_W = "(1.0 / (1.0 + exp(-(cast(n as double) - 20.0) / 10.0)))"
_ENC = f"case when n = 1 then prior else prior * (1.0 - {_W}) + m * {_W} end"

FULL_FEATURES_SQL = f"""with j as (
  select o.o_orderkey,
    coalesce(nullif(o.o_orderpriority, '{PLACEHOLDER}'), 'Unknown') as prio,
    {_band_sql('o.o_orderkey')} as band0,
    coalesce(case c.c_mktsegment when 'AUTOMOBILE' then 'MOTOR' when 'MACHINERY' then 'MOTOR' else c.c_mktsegment end, 'Other') as seg,
    case when o.o_orderkey % 17 = 0 then null else o.o_totalprice end as price,
    c.c_acctbal as bal,
    case when o.o_orderstatus = 'F' then 1 else 0 end as converted
  from orders o left join customer c on o.o_custkey = c.c_custkey),
r as (select band0 from j group by band0 having count(*) < 0.01 * (select count(*) from j)),
g as (select j.*, case when band0 in (select band0 from r) then 'Others' else band0 end as band from j),
p as (select avg(converted) as prior from g),
md as (select median(price) as mp, median(bal) as mb from g),
s1 as (select prio as level, count(*) as n, avg(converted) as m from g group by prio),
e1 as (select level, {_ENC} as enc from s1, p),
s2 as (select band as level, count(*) as n, avg(converted) as m from g group by band),
e2 as (select level, {_ENC} as enc from s2, p),
lv as (select seg, row_number() over (order by seg) as rk from (select distinct seg from g))
select g.o_orderkey,
  (coalesce(e1.enc, p.prior)) as o_orderpriority,
  (coalesce(e2.enc, p.prior)) as band,
  (coalesce(g.price, md.mp)) as o_totalprice,
  (coalesce(g.bal, md.mb)) as c_acctbal,
  g.converted,
  lv_seg.feature, lv_seg.value
from g cross join p cross join md
left join e1 on g.prio = e1.level
left join e2 on g.band = e2.level
cross join lateral (select 'c_mktsegment_' || lv.seg as feature,
                           case when g.seg = lv.seg then cast(1 as double) else cast(0 as double) end as value
                    from lv where lv.rk > 1) lv_seg"""


def _long_one_hot(df, keep, prefix):
    feats = [c for c in df.columns if c.startswith(prefix)]
    return df.select(*keep, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value"))
                                                 for c in feats])).alias("kv")).select(*keep, "kv.feature", "kv.value")


@register("full_features", FULL_FEATURES_SQL)
def full_features(spark, sf):
    """EN9 flagship: fit the canonical chain on orders x customers and
    transform the same rows. The one-hot block is reported in long form
    (feature, value) so the oracle need not know the level set."""
    df = flagship_frame(spark, sf)
    model = FeatureEngineer(flagship_spec()).fit(df)
    out = model.transform(df)
    base = ["o_orderkey", *[as_double(F.col(c)).alias(c) for c in ["o_orderpriority", "band", "o_totalprice", "c_acctbal"]],
            "converted"]
    return _long_one_hot(out.select(*base, *[c for c in out.columns if c.startswith("c_mktsegment_")]),
                         ["o_orderkey", "o_orderpriority", "band", "o_totalprice", "c_acctbal", "converted"], "c_mktsegment_")


@register("full_features_wide")
def full_features_wide(spark, sf):
    """EN9 as a user sees it: the wide feature frame (rows-only; the
    long-form ``full_features`` carries the oracle)."""
    df = flagship_frame(spark, sf)
    return FeatureEngineer(flagship_spec()).fit(df).transform(df)


@register("full_preprocess", f"""with j as (
  select o.o_orderkey, coalesce(nullif(o.o_orderpriority, '{PLACEHOLDER}'), 'Unknown') as prio_filled,
    nullif(o.o_orderpriority, '{PLACEHOLDER}') as prio_raw,
    case when o.o_orderstatus = 'F' then 1 else 0 end as converted from orders o),
p as (select avg(converted) as prior from j),
s as (select prio_raw as level, count(*) as n, avg(converted) as m from j where prio_raw is not null group by prio_raw),
e as (select level, {_ENC} as enc from s, p)
select j.o_orderkey, (coalesce(e.enc, p.prior)) as o_orderpriority, j.converted
from j cross join p left join e on j.prio_filled = e.level""")
def full_preprocess(spark, sf):
    """EN10: the encoder is fitted before the null fill, so the fill value
    ('Unknown', unseen at fit) encodes to the prior."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("converted"))
    spec = FeatureSpec(target="converted", te_cols=["o_orderpriority"], placeholder=PLACEHOLDER,
                       fills={"o_orderpriority": "Unknown"}, fit_order="encode_before_fill", one_hot="none")
    out = FeatureEngineer(spec).fit(o).transform(o)
    return out.select("o_orderkey", as_double(F.col("o_orderpriority")).alias("o_orderpriority"), "converted")


@register("table_job_features")
def table_job_features(spark, sf):
    """EN11: the table-job path on orders x customers — sanitised names,
    dedupe, chained maps, approximate batch medians (error 0.25), plain mean
    encoding to ``<col>_encoded`` and frequency-ordered one-hot with the
    rarest level dropped. Rows-only (approximate medians)."""
    df = flagship_frame(spark, sf).withColumnRenamed("c_mktsegment", "Market Segment")
    spec = FeatureSpec(target="converted", te_cols=["o_orderpriority", "band"], ohe_cols=["market_segment"],
                       numeric_cols=["o_totalprice", "c_acctbal"], drop_cols=["o_orderdate", "c_name", "o_custkey"],
                       placeholder=PLACEHOLDER, value_maps={"market_segment": {"map": SEGMENT_MAP, "default": "Other"}},
                       sequential_maps=True, fills={"o_orderpriority": "Unknown"}, rare_col="band", rare_min_share=0.01,
                       median_scope="batch", median_relative_error=0.25, encoding="mean", one_hot="indexed",
                       dedupe=True, sanitize=True)
    return FeatureEngineer(spec).fit(df).transform(df)


@register("minimal_clean", f"""select distinct o_orderkey, o_custkey, o_orderstatus, nullif(o_orderpriority, '{PLACEHOLDER}') as o_orderpriority
from (select * from orders union all select * from orders where o_orderkey % 5 = 0)""")
def minimal_clean_q(spark, sf):
    """EN8: dedupe + placeholder -> null."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    o = o.unionByName(o.filter(F.col("o_orderkey") % 5 == 0))
    return minimal_clean(o, PLACEHOLDER)
