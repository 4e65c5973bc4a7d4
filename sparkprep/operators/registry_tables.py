"""Run, metric, parameter and model-registry tables (IO11-IO14, ST3).

Append-only Parquet tables under a shared path (or catalog tables), so a
run log is queryable with the same engine: best run = arg-max query,
latest model = ``max_by(path, version)`` with a numeric version.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import path_exists

METRICS_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("ts", T.TimestampType()),
])
PARAMS_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("ts", T.TimestampType()),
])
REGISTRY_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("path", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("created", T.TimestampType()),
])


def new_run_id() -> str:
    return uuid.uuid4().hex


def best_by_metric(runs: DataFrame, metric: str, tie_cols: list[str] | None = None, strict_min: float | None = None) -> DataFrame:
    """ST3/IO14: the row with the highest ``metric``; ties go to the first by
    ``tie_cols``. ``strict_min`` keeps only rows with metric > strict_min
    (the reference starts from 0.0 with a strict comparison)."""
    r = runs if strict_min is None else runs.filter(F.col(metric) > F.lit(strict_min))
    return r.orderBy(F.desc(metric), *(tie_cols or [])).limit(1)


def _append(df: DataFrame, base: str, name: str) -> None:
    """Add rows in a folder of their own below the table: writers that append
    to one folder at once would remove each other's unfinished files."""
    df.write.parquet(os.path.join(base, name, f"rows-{uuid.uuid4().hex}"))


def _read(spark: SparkSession, base: str, name: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(os.path.join(base, name))


def log_metrics(spark: SparkSession, base: str, experiment: str, run_id: str, run_name: str,
                metrics: dict[str, float]) -> DataFrame:
    """IO13: append (experiment, run, metric, value, ts) rows; non-numeric
    values are skipped (DR10)."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(experiment, run_id, run_name, k, float(v), now) for k, v in metrics.items()
            if isinstance(v, (int, float)) and not isinstance(v, bool) or isinstance(v, bool)]
    df = spark.createDataFrame(rows, METRICS_SCHEMA)
    _append(df, base, "metrics")
    return df


def log_metrics_frame(metrics: DataFrame, base: str, experiment: str, run_id: str, run_name: str) -> None:
    """IO13 for metrics that are already a DataFrame (metric, value): the rows
    go straight from the executors to the table."""
    out = metrics.select(F.lit(experiment).alias("experiment"), F.lit(run_id).alias("run_id"),
                         F.lit(run_name).alias("run_name"), F.col("metric").alias("name"),
                         F.col("value").cast("double").alias("value"), F.current_timestamp().cast("timestamp").alias("ts"))
    _append(out.filter(F.col("value").isNotNull()), base, "metrics")


def log_params(spark: SparkSession, base: str, experiment: str, run_id: str, run_name: str, params: dict) -> DataFrame:
    """IO13: parameters as strings."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    df = spark.createDataFrame([(experiment, run_id, run_name, k, str(v), now) for k, v in params.items()], PARAMS_SCHEMA)
    _append(df, base, "params")
    return df


def read_metrics(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, base, "metrics", METRICS_SCHEMA)


def read_params(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, base, "params", PARAMS_SCHEMA)


def _registry(spark: SparkSession, base: str) -> DataFrame | None:
    if not path_exists(spark, os.path.join(base, "registry")):
        return None
    return _read(spark, base, "registry", REGISTRY_SCHEMA)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist yet; False if it does. On a
    local path the operating system decides, elsewhere the file system's own
    create without overwrite (atomic on HDFS and stores with conditional puts)."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    fs.mkdirs(p.getParent())
    if fs.getUri().getScheme() == "file":
        try:
            os.close(os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            return True
        except FileExistsError:
            return False
    try:
        fs.create(p, False).close()
        return True
    except Exception:
        if fs.exists(p):
            return False
        raise


def register_model(spark: SparkSession, base: str, name: str, model_path: str, run_id: str) -> int:
    """IO11: append a new version (previous max + 1) of ``name``. The number is
    taken by creating its version file, so that of several writers each gets
    its own; a writer that dies before its row is appended leaves a gap."""
    reg = _registry(spark, base)
    latest = 0
    if reg is not None:
        latest = reg.filter(F.col("model") == name).agg(F.max("version")).first()[0] or 0
    version = int(latest) + 1
    folder = hashlib.sha256(name.encode()).hexdigest()
    while not claim(spark, os.path.join(base, "registry_versions", folder, str(version))):
        version += 1
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    _append(spark.createDataFrame([(name, version, model_path, run_id, now)], REGISTRY_SCHEMA), base, "registry")
    return version


def latest_model_path(spark: SparkSession, base: str, name: str) -> tuple[int, str] | None:
    """IO11: the path of the highest (numeric) version."""
    reg = _registry(spark, base)
    if reg is None:
        return None
    r = reg.filter(F.col("model") == name).agg(F.max("version").alias("v"), F.max_by("path", "version").alias("p")).first()
    return None if r["v"] is None else (int(r["v"]), r["p"])
