"""Written intermediate tables and sized broadcasts for the llm operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Frames of at most this many rows (all their columns are fixed-width here) may be broadcast.
BROADCAST_ROWS = 50_000


def materialise(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when a *written* narrow table has at most ``rows`` rows
    (its count is a metadata read); otherwise the join shuffles it."""
    return F.broadcast(df) if df.count() <= rows else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
