"""Scans: driver test tables, CSV with pandas-style null tokens, catalog and
JDBC warehouse tables (IO1-IO4)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The strings pandas' CSV reader turns into missing values by
# default (its documented ``na_values`` list).
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in the file system that ``path`` names;
    any other trouble with it is an error."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def null_tokens_to_null(df: DataFrame, tokens=PANDAS_NULL_TOKENS, cols=None) -> DataFrame:
    """Map pandas' default missing tokens to NULL in string columns (one projection)."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = set(cols) if cols is not None else strings
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in targets and f.name in strings:
            c = F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    pandas_nulls: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """IO1/IO2: header CSV as pandas writes and reads it, with doubled quotes
    and line ends inside quotes. Such a file can't be split, so one task reads
    all of it; where no value holds a line end, ``multi_line=False`` lets Spark
    split files. A declared schema is preferred (no inference
    pass). Without one, columns are read as strings, pandas' missing tokens
    become NULL first, and each column then gets the narrowest of bigint,
    double and boolean that holds all its values, found in one aggregation."""
    reader = (spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line))
    if schema is not None:
        df = reader.schema(schema).csv(path)
        return null_tokens_to_null(df) if pandas_nulls else df
    df = reader.csv(path)
    if pandas_nulls:
        df = null_tokens_to_null(df)
    cols = [F.col(f"`{c}`") for c in df.columns]
    kinds = {"bigint": r"[+-]?\d{1,18}", "double": r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", "boolean": "(?i:true|false)"}
    fits = [F.coalesce(F.every(F.trim(c).rlike(f"^{p}$")), F.lit(False)).alias(f"{k}{i}") for i, c in enumerate(cols) for k, p in kinds.items()]
    row = df.agg(*fits).first() if cols else None
    kind = [next((k for k in kinds if row[f"{k}{i}"]), "string") for i in range(len(cols))]
    return df.select(*[(c if k == "string" else F.trim(c).cast(k)).alias(n) for c, k, n in zip(cols, kind, df.columns)])


def profile_sample(df: DataFrame, max_rows: int | None = 150_000, max_cols: int | None = 50, seed: int = 42) -> DataFrame:
    """IO2: the profiler's row/column caps. This is a sampling operator by
    design (the automatic profile reads at most ``max_rows``): a Bernoulli
    sample sized from the row count, then the first ``max_cols`` columns.
    None lifts a cap."""
    cols = df.columns[:max_cols]
    out = df.select(*[F.col(f"`{c}`") for c in cols])
    if max_rows is None:
        return out
    n = df.count()
    if n > max_rows:
        out = out.sample(fraction=min(1.0, 1.05 * max_rows / n), seed=seed).limit(max_rows)
    return out


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """IO3."""
    return spark.table(name)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table_name: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """IO4: warehouse scan, parallel when a numeric partition column is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table_name)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions or 64)
        )
    return reader.load()


def qcol(name: str) -> Column:
    """Column reference that survives spaces and dots in names."""
    return F.col(f"`{name}`")
