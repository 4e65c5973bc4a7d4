"""Incremental loads, dedupe and stream scoring with Structured Streaming
(IO8, CL1, SC2).

The reference's job bookmarks become a file-source stream with a
checkpoint and ``trigger(availableNow=True)``: each run processes only files
not seen by earlier runs, in micro-batches, then stops. Whole-row dedupe on
an unbounded stream would need unbounded state, so each micro-batch is
deduplicated within itself and against the target table by key (a
left-anti join with the target files that a key index can't rule out), which
keeps the result equal to a batch dedupe by key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import q
from ..session import cut_lineage
from ..sources.tables import path_exists
from . import key_index
from .drift_state import DriftState


def file_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(source_dir)


def incremental_load(spark: SparkSession, source: DataFrame, target_path: str, checkpoint: str,
                     key_cols: list[str], transform: Callable[[DataFrame], DataFrame] | None = None,
                     partition_by: list[str] | None = None, index_path: str | None = None) -> None:
    """IO8: run one ``availableNow`` pass of ``source`` into the Parquet table
    at ``target_path``: per micro-batch, apply ``transform`` (e.g. CL3),
    dedupe by key within the batch and against rows already in the target,
    append. Idempotent per batch id via the checkpoint; safe to re-run. With
    ``index_path`` (a folder beside the target) only those target files are
    read whose key range and Bloom filter don't rule out all of the batch's
    keys (``key_index``); without it, the key columns of the whole target."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        b = transform(batch) if transform else batch
        b = b.dropDuplicates(key_cols)
        if path_exists(spark, target_path):
            if index_path is None:
                b = b.join(spark.read.parquet(target_path).select(*key_cols), key_cols, "left_anti")
            else:
                b = cut_lineage(b)
                files = key_index.matching_files(spark, target_path, index_path, b, key_cols)
                if files:
                    known = spark.read.option("basePath", target_path).parquet(*files).select(*key_cols)
                    b = b.join(known, key_cols, "left_anti")
        w = b.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(target_path)

    run = (source.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    run.awaitTermination()


def dedupe_stream(source: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """CL1 on a stream: the first row of each key. A key is kept in the state
    store until the watermark (the latest ``event_time`` less ``delay``) has
    passed its row by ``delay``, so the state holds the keys of a window of
    that length, not of the whole stream; for windows beyond the executors'
    memory set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB
    provider. The result is that of a batch dedupe by key as long as repeats
    lie within ``delay`` of the first row and no row is later than that: Spark
    drops rows behind the watermark. Where rows may be later than any bound,
    take ``incremental_load``, which compares with the target. Null keys are
    equal to each other. An ``event_time`` without time zone is returned as a
    timestamp of the session's zone."""
    if isinstance(source.schema[event_time].dataType, T.TimestampNTZType):
        source = source.withColumn(event_time, q(event_time).cast("timestamp"))
    return source.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def append_stream(stream: DataFrame, target_path: str, checkpoint: str) -> None:
    """One ``availableNow`` pass of ``stream`` into Parquet files at
    ``target_path`` by the file sink, whose log keeps a replayed batch from
    adding rows."""
    run = (stream.writeStream.format("parquet").option("path", target_path).option("checkpointLocation", checkpoint)
           .outputMode("append").trigger(availableNow=True).start())
    run.awaitTermination()


def stream_drift(source: DataFrame, state: DriftState, checkpoint: str) -> None:
    """DR1-DR7 on a stream: one ``availableNow`` pass that adds each batch's
    value counts to ``state``; ``state.drift()`` then equals the drift of all
    rows so far, and a replayed batch changes nothing."""
    run = (source.writeStream.foreachBatch(state.add).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    run.awaitTermination()


def stream_score(source: DataFrame, feature_model, classifier_model, key: str, sink_path: str, checkpoint: str,
                 drift: DriftState | None = None) -> None:
    """SC2 on a stream: stateless transform + predict per micro-batch,
    written to ``sink_path``/batch_id=<n> (fitted statistics only; batch-scope
    medians are not allowed on streams). A replayed batch overwrites its own
    folder, so it adds no rows. With ``drift`` each batch's raw rows are also
    added to that state, and the drift of all rows so far is written to
    ``sink_path``_drift/batch_id=<n>."""
    from ..operators.score import score

    if getattr(getattr(feature_model, "spec", None), "median_scope", "fit") == "batch":
        raise ValueError("batch-scope medians cannot be used on a stream; fit them instead")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        score(batch, feature_model, classifier_model, key).write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")
        if drift is not None:
            drift.add(batch, batch_id)
            drift.drift(batch_id).write.mode("overwrite").parquet(f"{sink_path}_drift/batch_id={batch_id}")

    run = (source.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    run.awaitTermination()
