"""Drift of a stream against a fixed reference (SC2, DR1-DR7): value counts
per column are the state, and every statistic is read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift as D
from ..session import cut_lineage
from ..sources.segments import add_segment, last_batch, read_state
from ..sources.tables import path_exists


class DriftState:
    """Counts of every (column, value) of the reference, written once under
    ``path``, and of the batches added, in segments. The state has a row per
    distinct value, whatever the number of rows; it is shuffled and stored as
    any table. ``cols`` are compared (by default the reference's columns)."""

    def __init__(self, spark: SparkSession, path: str, reference: DataFrame, cols: list[str] | None = None):
        self.spark, self.path = spark, path
        self.cols = cols or reference.columns
        profile = f"{path}/profile"
        if not path_exists(spark, profile):  # written last, so a reference that is there is whole
            rows, spread = D.reference_profile(reference, self.cols)
            D.level_counts(reference, self.cols, list(spread), "ref").write.mode("overwrite").parquet(f"{path}/reference")
            spark.createDataFrame([(rows, spread)], "rows long, spread map<string, double>").coalesce(1).write.parquet(profile)
        row = spark.read.parquet(profile).first()
        self.rows, self.spread = row["rows"], row["spread"]

    def add(self, batch: DataFrame, n: int) -> None:
        """Add batch ``n`` (from 0, without gaps); again, it replaces itself. A
        column that the batch lacks is an error."""
        counts = D.level_counts(batch, self.cols, list(self.spread), "cur")
        add_segment(self.spark, f"{self.path}/batches", n, counts, D.add_counts)

    def drift(self, n: int | None = None, **rules) -> DataFrame:
        """``column_drift`` of the reference and batches 0 to ``n`` (all, unless
        given); ``rules`` as there. Before the first batch, no row is compared."""
        counts = self.spark.read.parquet(f"{self.path}/reference")
        added = read_state(self.spark, f"{self.path}/batches", D.add_counts, n)
        if added is not None:
            counts = counts.unionByName(added)
        return D.drift_of_counts(cut_lineage(D.add_counts(counts)), self.cols, self.rows, self.spread, **rules)

    def last(self) -> int | None:
        return last_batch(self.spark, f"{self.path}/batches")

    def rows_added(self) -> int:
        """Non-null values counted in the first column: a cheap check of what the state holds."""
        added = read_state(self.spark, f"{self.path}/batches", D.add_counts)
        return 0 if added is None else added.filter(F.col("column_name") == self.cols[0]).agg(F.coalesce(F.sum("c_cur"), F.lit(0))).first()[0]
