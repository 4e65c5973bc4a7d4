"""Registered queries for sources, sinks and the incremental stream (IO1,
IO5, IO6, IO8). Each writes its intermediate data under a fresh folder of
the shared checkpoint directory and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.exprs import as_double
from ..operators import registry_tables as R
from ..operators.clean import placeholders_to_null
from ..session import scratch_path
from ..sources.sinks import conform, csv_table_sink, full_refresh_load
from ..sources.tables import read_csv, table
from ..streaming.incremental import file_stream, incremental_load
from .q_clean import PLACEHOLDER
from .registry import register

ORDERS_DDL = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


def _scratch(spark, what):
    return scratch_path(spark, f"{what}-{uuid.uuid4().hex}")


@register("csv_roundtrip", f"""select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  case when o_orderpriority = '{PLACEHOLDER}' then null else o_orderpriority end as o_orderpriority from orders""")
def csv_roundtrip(spark, sf):
    """IO1: orders written as header CSV with the placeholder spelled 'NA',
    read back with a declared schema; pandas' missing tokens become NULL."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.when(F.col("o_orderpriority") == PLACEHOLDER, F.lit("NA")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    path = _scratch(spark, "csv")
    csv_table_sink(o, path, mode="overwrite")
    return read_csv(spark, path, schema=ORDERS_DDL, multi_line=False)


_QUOTED = """'he said "' || o_orderstatus || '", then' || chr(10) || o_orderpriority"""


@register("csv_quotes", f"""select o_orderkey, {_QUOTED} as remark from orders""")
def csv_quotes(spark, sf):
    """IO1: quotes, commas and line ends inside values, written with doubled quotes and read back."""
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(_QUOTED.replace("||", "||")).alias("remark"))
    path = _scratch(spark, "csvq")
    o.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return read_csv(spark, path, schema="o_orderkey bigint, remark string")


@register("csv_infer_nulls", """select o_orderkey, case when o_orderkey % 3 = 0 then null else o_custkey end as cust,
  case when o_orderkey % 5 = 0 then null else o_totalprice end as price, o_orderkey % 2 = 0 as even from orders""")
def csv_infer_nulls(spark, sf):
    """IO1: numeric columns that spell missing values NA and nan get their type after the tokens are taken out."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("case when o_orderkey % 3 = 0 then 'NA' else cast(o_custkey as string) end").alias("cust"),
        F.expr("case when o_orderkey % 5 = 0 then 'nan' else cast(o_totalprice as string) end").alias("price"),
        F.expr("o_orderkey % 2 = 0").alias("even"))
    path = _scratch(spark, "csvn")
    o.write.option("header", True).csv(path)
    return read_csv(spark, path, multi_line=False)


@register("registry_best_run", """select cast(o_orderstatus as varchar) as run_name, avg(o_totalprice) as value from orders
group by o_orderstatus order by value desc, run_name limit 1""")
def registry_best_run(spark, sf):
    """IO13 -> IO14: metrics logged as a run each, read back from the table, the best run chosen."""
    base = _scratch(spark, "runs")
    means = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.avg("o_totalprice").alias("value")).collect()  # one run a status
    for r in means:
        R.log_metrics(spark, base, "orders", R.new_run_id(), r["o_orderstatus"], {"mean_price": r["value"]})
    runs = R.read_metrics(spark, base).filter(F.col("name") == "mean_price").select("run_name", "value")
    return R.best_by_metric(runs, "value", ["run_name"])


@register("stream_replay", """select event_id, user_id, event_type from events""")
def stream_replay(spark, sf):
    """IO8: the same load run twice over a folder, the second time from an
    empty checkpoint, adds each event once."""
    src, out = _scratch(spark, "src"), _scratch(spark, "out")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    events.write.parquet(src)
    for _ in range(2):
        incremental_load(spark, file_stream(spark, src, events.schema), out, _scratch(spark, "ckpt"), ["event_id"])
    return spark.read.parquet(out)


@register("warehouse_load", f"""select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  nullif(o_orderpriority, '{PLACEHOLDER}') as o_orderpriority from orders""")
def warehouse_load(spark, sf):
    """IO5: CL1 + CL3, conform to the declared schema, full-refresh load, reload."""
    o = table(spark, sf, "orders").select("o_orderpriority", "o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey")
    cleaned = placeholders_to_null(o.dropDuplicates(), PLACEHOLDER)
    path = _scratch(spark, "warehouse")
    full_refresh_load(cleaned, ORDERS_DDL, path=path)
    return spark.read.parquet(path)


@register("csv_sink_partitioned", """select o_orderkey, (o_totalprice) as o_totalprice, o_orderstatus from orders""")
def csv_sink_partitioned(spark, sf):
    """IO6: CSV sink partitioned by status, read back (partition column restored)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = _scratch(spark, "csvsink")
    csv_table_sink(o, path, mode="overwrite", partition_by=["o_orderstatus"])
    back = spark.read.option("header", True).schema("o_orderkey bigint, o_totalprice double, o_orderstatus string").csv(path)
    return back.select("o_orderkey", as_double(F.col("o_totalprice")).alias("o_totalprice"), "o_orderstatus")


@register("stream_incremental", f"""select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  nullif(o_orderpriority, '{PLACEHOLDER}') as o_orderpriority from orders""")
def stream_incremental(spark, sf):
    """IO8: availableNow file stream over the orders table -> per-batch clean
    and key dedupe against the target -> append; then a second run that must
    add nothing. Stream = batch."""
    schema = table(spark, sf, "orders").select(*[c.split()[0] for c in ORDERS_DDL.split(", ")]).schema
    target, ckpt = _scratch(spark, "stream-target"), _scratch(spark, "stream-ckpt")
    for _ in range(2):
        src = file_stream(spark, sf, table(spark, sf, "orders").schema, glob="orders.parquet")
        src = src.select(*schema.fieldNames())
        incremental_load(spark, src, target, ckpt, ["o_orderkey"],
                         transform=lambda b: placeholders_to_null(b, PLACEHOLDER))
    return spark.read.parquet(target)


@register("conform_schema", """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(null as varchar) as o_orderpriority from orders""")
def conform_schema(spark, sf):
    """IO5 helper in non-strict mode: select/cast to the declared DDL, a
    missing column added as NULL."""
    o = table(spark, sf, "orders").select("o_totalprice", "o_orderkey", "o_custkey", "o_orderstatus")
    return conform(o, ORDERS_DDL, strict=False)
