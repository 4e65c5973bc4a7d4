"""Registered queries for splits and evaluation (MO1, MO2, EV1-EV5, ST3/IO14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import as_double
from ..operators import evaluate as V
from ..operators import split as S
from ..sources.tables import table
from .registry import register

_H = "md5(cast(o_orderkey as varchar) || '-42')"


@register("strat_split", f"""select o_orderkey, o_orderstatus,
  row_number() over (partition by o_orderstatus order by {_H})
    <= floor(count(*) over (partition by o_orderstatus) * 0.2 + 0.5) as is_test
from orders""")
def strat_split(spark, sf):
    """MO1: exact per-class 20 % test quota by key hash, seed 42."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.stratified_split(o, "o_orderstatus", ["o_orderkey"], 0.2, 42)


_NULL_LABEL = "nullif(o_orderstatus, 'P')"


@register("strat_split_null_label", f"""select o_orderkey, {_NULL_LABEL} as label,
  row_number() over (partition by {_NULL_LABEL} order by {_H})
    <= floor(count(*) over (partition by {_NULL_LABEL}) * 0.2 + 0.5) as is_test
from orders""")
def strat_split_null_label(spark, sf):
    """MO1 where a third of the labels are null: those rows are a class too."""
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(_NULL_LABEL).alias("label"))
    return S.stratified_split(o, "label", ["o_orderkey"], 0.2, 42)


@register("hash_split", f"""select o_orderkey, substr({_H}, 1, 8) < '33333333' as is_test from orders""")
def hash_split(spark, sf):
    """MO2: hash-threshold 80/20 split, seed 42."""
    o = table(spark, sf, "orders").select("o_orderkey")
    return S.hash_split(o, ["o_orderkey"], 0.2, 42)


def _scored(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("label"),
                     F.col("l_discount").alias("score"),
                     (F.col("l_discount") >= 0.05).cast("int").alias("prediction"))


_SCORED_SQL = """(select case when l_returnflag = 'R' then 1 else 0 end as label, l_discount as score,
  case when l_discount >= 0.05 then 1 else 0 end as prediction from lineitem)"""


@register("metrics_binary", f"""with c as (select count(*) filter (where label = 1 and prediction = 1) as tp,
  count(*) filter (where label = 0 and prediction = 1) as fp, count(*) filter (where label = 0 and prediction = 0) as tn,
  count(*) filter (where label = 1 and prediction = 0) as fn from {_SCORED_SQL})
select tp, fp, tn, fn,
  (coalesce(cast(tp + tn as double) / nullif(tp + fp + tn + fn, 0), 0.0)) as accuracy,
  (coalesce(cast(tp as double) / nullif(tp + fp, 0), 0.0)) as precision,
  (coalesce(cast(tp as double) / nullif(tp + fn, 0), 0.0)) as recall,
  (coalesce(cast(2 * tp as double) / nullif(2 * tp + fp + fn, 0), 0.0)) as f1 from c""")
def metrics_binary(spark, sf):
    """EV1 + EV2 on lineitem: label R, prediction discount >= 0.05."""
    m = V.binary_metrics(_scored(spark, sf))
    return m.select("tp", "fp", "tn", "fn", *[as_double(F.col(c)).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


@register("confusion", f"""with s as {_SCORED_SQL}, cells as (select * from (values (0, 0), (0, 1), (1, 0), (1, 1)) t(actual, predicted))
select cells.actual, cells.predicted, count(s.label) as count from cells left join s on s.label = cells.actual and s.prediction = cells.predicted
group by cells.actual, cells.predicted""")
def confusion(spark, sf):
    """EV3: zero-filled 2x2 confusion matrix."""
    return V.confusion_matrix(_scored(spark, sf))


_ROC_SQL = f"""with per as (select cast(score as double) as threshold, count(*) filter (where label = 1) as pos,
  count(*) filter (where label = 0) as neg from {_SCORED_SQL} group by 1),
t as (select sum(pos) as P, sum(neg) as N from per),
c as (select threshold, pos, neg, sum(pos) over (order by threshold desc) as tp, sum(neg) over (order by threshold desc) as fp from per)"""


@register("roc_points", f"""{_ROC_SQL}
select threshold, pos, neg, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
  (cast(tp as double) / P) as tpr, (cast(fp as double) / N) as fpr from c, t""")
def roc_points(spark, sf):
    """EV5: ROC points per distinct score (ties grouped)."""
    r = V.roc_points(_scored(spark, sf))
    return r.select("threshold", "pos", "neg", "tp", "fp", as_double(F.col("tpr")).alias("tpr"), as_double(F.col("fpr")).alias("fpr"))


@register("roc_auc", f"""{_ROC_SQL}
select (sum(neg * (tp - pos / 2.0)) / (any_value(P) * any_value(N))) as auc,
  cast(any_value(P) as bigint) as positives, cast(any_value(N) as bigint) as negatives from c, t""")
def roc_auc(spark, sf):
    """EV4: AUC with ties counted half."""
    a = V.roc_auc(_scored(spark, sf))
    return a.select(as_double(F.col("auc")).alias("auc"), "positives", "negatives")


@register("best_run", """with runs as (select l_returnflag as run_name, avg(l_discount) as f1 from lineitem group by l_returnflag),
r as (select run_name, f1, row_number() over (order by f1 desc, run_name) as rk from runs)
select run_name, (f1) as f1 from r where rk = 1""")
def best_run(spark, sf):
    """ST3 + IO14: arg-max of a metric over a runs table (one candidate per
    return flag, metric = mean discount); the first best wins ties."""
    from ..operators.registry_tables import best_by_metric
    runs = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("run_name")).agg(F.avg("l_discount").alias("f1"))
    b = best_by_metric(runs, "f1", tie_cols=["run_name"])
    return b.select("run_name", as_double(F.col("f1")).alias("f1"))
