"""Registered queries for state kept over loads and batches: drift and dedupe
on streams (SC2, CL1), the indexed incremental load (IO8), sketches of many
loads (PR7, PR8, PR10) and level dictionaries (EN4, EN6). Each writes its
stand-in loads, made from the whole given tables, and its state under a fresh
folder of the shared checkpoint directory."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import sketches as K
from ..session import scratch_path
from ..sources.tables import table
from ..streaming.drift_state import DriftState
from ..streaming.incremental import append_stream, dedupe_stream, file_stream, incremental_load, stream_drift
from .q_drift import _SUMMARY_COLS, _SUMMARY_SQL, _rounded, ref_cur
from .registry import register

LOADS = 3


def _scratch(spark, what):
    return scratch_path(spark, f"{what}-{uuid.uuid4().hex}")


@register("stream_drift", _SUMMARY_SQL)
def stream_drift_query(spark, sf):
    """SC2, DR1, DR7 on a stream: later orders arrive in files, a batch each,
    and are compared with the earlier ones; equals the drift of whole tables."""
    ref, cur = ref_cur(spark, sf)
    src = _scratch(spark, "drift-src")
    cur.select(*_SUMMARY_COLS).repartition(LOADS).write.parquet(src)
    state = DriftState(spark, _scratch(spark, "drift-state"), ref, _SUMMARY_COLS)
    stream_drift(file_stream(spark, src, cur.select(*_SUMMARY_COLS).schema, max_files_per_trigger=1), state, _scratch(spark, "ckpt"))
    return _rounded(state.drift(exact=False))  # as its SQL


@register("stream_dedupe", "select event_id, user_id, event_type from events")
def stream_dedupe_query(spark, sf):
    """CL1 on a stream: every event arrives twice, the second time in a later
    file, some of them late; the delay covers the 30 days of the table."""
    src, out = _scratch(spark, "dedupe-src"), _scratch(spark, "dedupe-out")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    for _ in range(2):
        events.write.mode("append").parquet(src)
    stream = file_stream(spark, src, events.schema, max_files_per_trigger=1)
    append_stream(dedupe_stream(stream, ["event_id"], "ts", "31 days"), out, _scratch(spark, "ckpt"))
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@register("stream_incremental_indexed", "select o_orderkey, o_custkey, o_totalprice from orders")
def stream_incremental_indexed(spark, sf):
    """IO8 with a key index: orders arrive in files sorted by key, then all of
    them once more; only target files that may hold a key are joined."""
    src, out, index = _scratch(spark, "src"), _scratch(spark, "indexed"), _scratch(spark, "index")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    orders.repartitionByRange(LOADS, "o_orderkey").write.parquet(src)
    orders.repartition(2).write.mode("append").parquet(src)
    stream = file_stream(spark, src, orders.schema, max_files_per_trigger=1)
    incremental_load(spark, stream, out, _scratch(spark, "ckpt"), ["o_orderkey"], index_path=index)
    return spark.read.parquet(out)


def _loads_sketch(spark, sf, cols):
    orders, path = table(spark, sf, "orders"), _scratch(spark, "sketches")
    for n in range(LOADS):
        K.add_load(spark, path, n, orders.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(LOADS)) == n), cols)
    return K.loads_sketch(spark, path)


@register("sketch_profile")
def sketch_profile_query(spark, sf):
    """PR7, PR10 over many loads: the orders in three loads, sketched one by one
    and merged; distinct values and quartiles are estimates."""
    return K.sketch_profile(_loads_sketch(spark, sf, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]))


@register("sketch_top_levels", """select 'o_orderstatus' as column_name, o_orderstatus as level, count(*) as n from orders where o_orderstatus is not null group by 2
union all select 'o_orderpriority', o_orderpriority, count(*) from orders where o_orderpriority is not null group by 2""")
def sketch_top_levels(spark, sf):
    """PR8 over many loads: the merged frequent items, exact where a column has fewer levels than are tracked."""
    return K.top_levels(_loads_sketch(spark, sf, ["o_orderstatus", "o_orderpriority"]), 100)


def _levels_sql(col: str) -> str:
    return f"""select o_orderkey, '{col}' as column_name, cast(k as bigint) as level_index, cast(1 as double) as value from orders join (
  select level, row_number() over (order by n desc, level) - 1 as k, row_number() over (order by n, level desc) as from_last
  from (select cast({col} as varchar) as level, count(*) as n from orders where {col} is not null group by 1)) on cast({col} as varchar) = level
where from_last > 1"""


@register("one_hot_long", " union all ".join(_levels_sql(c) for c in ("o_custkey", "o_orderpriority")))
def one_hot_long(spark, sf):
    """EN6 for many levels: all customers' keys and the priorities as levels, in
    long form by a dictionary that stays a table; the rarest level is dropped."""
    orders, cols = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey", "o_orderpriority"]
    return E.one_hot_long(orders, "o_orderkey", E.level_dictionary(orders, cols), cols)
