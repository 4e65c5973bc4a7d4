"""Registered queries of second-order boosting, exact attributions,
permutation importance and binding by position (MO5, EX1, EX2, JN2, PJ9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attribution as A
from ..operators import bind
from ..operators import boosting as B
from ..operators import evaluate as V
from ..operators import explain as X
from ..session import cut_lineage
from ..sources.tables import table
from .q_train import FEATS, _is_large, _lineitem, _lineitem_split
from .registry import register


@register("newton_boost_eval")
def newton_boost_eval(spark, sf):
    """MO5 + EV1-EV3: second-order boosting (100 rounds, step 0.1, depth 6, L2
    penalty 1) on lineitem, label R, held-out metrics."""
    train, test = _lineitem_split(spark, sf)
    model = B.fit_newton(cut_lineage(train), FEATS, "label", B.NewtonParams(rounds=100, step=0.1, depth=6))
    pred = model.transform(test).withColumn("label", F.col("label").cast("int"))
    m = V.binary_metrics(pred, "label")
    return m.select(F.lit("newton_boosting").alias("model"), *[F.col(c).cast("double").alias(c) for c in ["accuracy", "precision", "recall", "f1"]], "tp", "fp", "tn", "fn")


@register("newton_split_gains", """
with x as (
  select case when l_returnflag = 'R' then -536870912 else 536870912 end::bigint as g, 268435456::bigint as h,
    case when l_linenumber <> 7 then l_quantity::double end as l_quantity, l_discount::double as l_discount, l_tax::double as l_tax from lineitem),
long as (
  select 'l_quantity' as feature, l_quantity as v, g, h from x union all select 'l_discount', l_discount, g, h from x union all select 'l_tax', l_tax, g, h from x),
cells as (select feature, v, sum(g) as g, sum(h) as h, count(*) as n from long where v is not null group by feature, v),
missing as (select feature, sum(g) as g, sum(h) as h, count(*) as n from long where v is null group by feature),
whole as (select feature, sum(g) as g, sum(h) as h, count(*) as n from long group by feature),
below as (
  select feature, v, sum(g) over w as g, sum(h) over w as h, sum(n) over w as n from cells window w as (partition by feature order by v)),
sides as (
  select b.feature, b.v as threshold, true as missing_left, b.g + coalesce(m.g, 0) as lg, b.h + coalesce(m.h, 0) as lh, b.n + coalesce(m.n, 0) as ln
  from below b left join missing m using (feature)
  union all
  select b.feature, b.v, false, b.g, b.h, b.n from below b join missing m using (feature)),
u as (
  select feature, threshold, missing_left, lg / 1073741824.0::double as lg, lh / 1073741824.0::double as lh, ln,
    (w.g - lg) / 1073741824.0::double as rg, (w.h - lh) / 1073741824.0::double as rh, w.n - ln as rn,
    w.g / 1073741824.0::double as ag, w.h / 1073741824.0::double as ah
  from sides join whole w using (feature))
select feature, threshold, missing_left, ln::bigint as left_n, rn::bigint as right_n,
  0.5 * (lg * lg / (lh + 1) + rg * rg / (rh + 1) - ag * ag / (ah + 1)) as gain
from u where ln > 0 and rn > 0 and lh >= 1 and rh >= 1
""")
def newton_split_gains(spark, sf):
    """MO5: the gain of every root split of the first round, on columns of few
    values so that each value is an edge; some quantities are left out."""
    feats = ["l_quantity", "l_discount", "l_tax"]
    df = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"), F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("l_quantity"), "l_discount", "l_tax")
    edges = B.bin_edges(df, feats)
    binned = B.to_bins(df, feats, edges, ["label", F.lit(0.0).alias("margin")])
    gains = B.split_gains(B.histograms(binned, len(feats), [], {}, 0), B.NewtonParams())
    rows = [(i, k, c, e) for i, (c, own) in enumerate(zip(feats, edges)) for k, e in enumerate(own)]  # at most 255 a feature
    names = spark.createDataFrame(rows, "feature int, bin int, name string, threshold double")
    return gains.join(F.broadcast(names), ["feature", "bin"]).select(F.col("name").alias("feature"), "threshold", "missing_left", "left_n", "right_n", "gain")


@register("tree_attributions_exact", """
with s as (
  select l_orderkey, l_linenumber, l_quantity::double <= 25 as q25, l_quantity::double <= 10 as q10, l_discount::double <= 0.05 as d5 from lineitem),
c as (
  select avg(q25::int) as a, avg(d5::int) filter (q25) as b, avg(q10::int) as t, avg(d5::int) as d from s),
v as (
  select l_orderkey, l_linenumber,
    a * (b * 0.9 + (1 - b) * 0.4) + (1 - a) * 0.1 as v0,
    case when q25 then b * 0.9 + (1 - b) * 0.4 else 0.1 end as vq,
    a * (case when d5 then 0.9 else 0.4 end) + (1 - a) * 0.1 as vd,
    case when q25 then (case when d5 then 0.9 else 0.4 end) else 0.1 end as vqd,
    2 * (case when q10 then -0.3 else 0.2 end) as sq, 2 * (t * -0.3 + (1 - t) * 0.2) as sq0,
    0.5 * (case when d5 then 1.0 else 3.0 end) as sd, 0.5 * (d * 1.0 + (1 - d) * 3.0) as sd0
  from s, c)
select l_orderkey, l_linenumber, v0 + sq0 + sd0 as base, 0.5 * ((vq - v0) + (vqd - vd)) + sq - sq0 as l_quantity, 0.5 * ((vd - v0) + (vqd - vq)) + sd - sd0 as l_discount
from v
""")
def tree_attributions_exact(spark, sf):
    """EX2: exact attributions of a tree over two features and two stumps (with
    weights) for every line, covers counted on the table."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    q25, q10, d5 = F.col("l_quantity") <= 25, F.col("l_quantity") <= 10, F.col("l_discount") <= 0.05
    n = li.agg(F.count("*"), F.count_if(q25), F.count_if(q25 & d5), F.count_if(q10), F.count_if(d5)).first()
    leaf = lambda v, cover: A.Node(-1, 0.0, -1, -1, v, float(cover))
    ens = A.Ensemble([
        [A.Node(0, 25.0, 1, 2, 0.0, float(n[0])), A.Node(1, 0.05, 3, 4, 0.0, float(n[1])), leaf(0.1, n[0] - n[1]), leaf(0.9, n[2]), leaf(0.4, n[1] - n[2])],
        [A.Node(0, 10.0, 1, 2, 0.0, float(n[0])), leaf(-0.3, n[3]), leaf(0.2, n[0] - n[3])],
        [A.Node(1, 0.05, 1, 2, 0.0, float(n[0])), leaf(1.0, n[4]), leaf(3.0, n[0] - n[4])]], [1.0, 2.0, 0.5])
    return A.tree_attributions(li, ens, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount"])


@register("tree_attribution_summary")
def tree_attribution_summary(spark, sf):
    """EX2: ranked summary of the exact attributions of a full-size boosted
    ensemble (100 rounds, depth 3) for every line."""
    from ..operators import train as T

    train, _ = _lineitem_split(spark, sf)
    large = _is_large(spark, sf)
    model = T.retrain("gradient_boosting", train if large else cut_lineage(train), FEATS, "label", {"maxIter": 100, "maxDepth": 3}, written=large)
    rows = A.tree_attributions(_lineitem(spark, sf), A.spark_ensemble(model), ["l_orderkey", "l_linenumber"], FEATS)
    return A.attribution_summary(rows, FEATS)


@register("permutation_importance", """
with x as (
  select l_orderkey, l_linenumber, l_quantity::double as l_quantity, l_discount::double as l_discount, l_tax::double as l_tax,
    (l_quantity > 30 or l_discount > 0.07)::int as label,
    row_number() over (order by md5(l_orderkey || '-' || l_linenumber || '-42'), l_orderkey, l_linenumber, l_quantity, l_discount, l_tax) - 1 as no from lineitem),
y as (
  select x.label, x.l_quantity as q, x.l_discount as d, z.l_quantity as pq, z.l_discount as pd
  from x join x z on z.no = (x.no + 1) % (select count(*) from x)),
s as (
  select avg(((q > 30 or d > 0.05)::int = label)::int) as base, avg(((pq > 30 or d > 0.05)::int = label)::int) as l_quantity,
    avg(((q > 30 or pd > 0.05)::int = label)::int) as l_discount from y),
f as (
  select 'l_quantity' as feature, base, l_quantity as permuted from s union all select 'l_discount', base, l_discount from s union all select 'l_tax', base, base from s)
select feature, base, permuted, base - permuted as importance, (row_number() over (order by permuted - base, feature))::int as rank from f
""")
def permutation_importance(spark, sf):
    """EX1: how much the accuracy of a fixed rule falls when a feature is permuted over all lines."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in ("l_quantity", "l_discount", "l_tax")],
        ((F.col("l_quantity") > 30) | (F.col("l_discount") > 0.07)).cast("int").alias("label"))
    rule = lambda df: df.withColumn("prediction", ((F.col("l_quantity") > 30) | (F.col("l_discount") > 0.05)).cast("int"))
    return X.permutation_importance(li, rule, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@register("bind_by_position", """
with o as (select o_orderkey, o_totalprice::double as o_totalprice, row_number() over (order by o_orderkey) as no from orders),
p as (select o_custkey, row_number() over (order by o_totalprice desc, o_orderkey) as no from orders)
select o_orderkey, o_totalprice, o_custkey as bound_custkey from o join p using (no)
""")
def bind_by_position(spark, sf):
    """JN2 / PJ9: orders by key, side by side with customer keys in order of price."""
    o = table(spark, sf, "orders")
    right = o.select(F.col("o_custkey").alias("bound_custkey"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("k"))
    got = bind.bind_columns(o.select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice")), right, [F.col("o_orderkey")], [F.col("price").desc(), F.col("k")])
    return got.select("o_orderkey", "o_totalprice", "bound_custkey")
