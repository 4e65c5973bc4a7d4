"""A key index beside a Parquet table: per file its rows, the range of its
first key column and a Bloom filter of its keys, so that an incremental load
joins only files that may hold one of its keys (IO8).

The filter is a table of 64-bit words (file, slot, word): a key sets four bits
of the word its hash chooses, about four keys share a word (16 bits a key), and
so some 1 % of absent keys are taken for present. A filter can rule a file out
only if all of the batch's keys in the file's range miss, so it is asked only
for files with at most ``ASK`` of them; the others are read. Either way the
files returned hold every key that the batch and the table have in common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import q
from ..sources.tables import path_exists

KEYS_PER_WORD = 4
BITS_PER_KEY = 4
#: Keys of a batch in a file's range up to which the file's filter is asked.
ASK = 200
#: Ranges that a batch's keys are counted in.
RANGES = 64


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[q(k) for k in keys])


def _mask(h: Column) -> Column:
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 6 * i + 8), F.lit(64)).cast("int")) for i in range(BITS_PER_KEY)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def _slot(h: Column, words: Column) -> Column:
    return F.pmod(F.xxhash64(h), words)


def _index_new(spark: SparkSession, target: str, index: str, keys: list[str]) -> None:
    """Add the files that the index lacks: those of the last load, or of one
    that ended before its files were indexed. Files are entered last, so that a
    file in the index has its filter."""
    files = spark.read.parquet(target).inputFiles()
    known = set()
    if path_exists(spark, f"{index}/files"):
        known = {r["file"] for r in spark.read.parquet(f"{index}/files").select("file").collect()}  # as many as the listing above
    new = [f for f in files if f not in known]
    if not new:
        return
    rows = spark.read.option("basePath", target).parquet(*new).select(F.input_file_name().alias("file"), q(keys[0]).alias("k"), _hash(keys).alias("h"))
    entries = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k").isNull()).alias("nulls"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    entries = entries.withColumn("words", F.ceil(F.col("n") / KEYS_PER_WORD))
    # a row a file, as in the listing above: broadcast, as a join dealt by file would give one task all rows of a file
    words = rows.join(F.broadcast(entries.select("file", "words")), "file").groupBy("file", _slot(F.col("h"), F.col("words")).alias("slot")).agg(F.bit_or(_mask(F.col("h"))).alias("word"))
    words.write.mode("append").parquet(f"{index}/words")
    empty = spark.createDataFrame([(f,) for f in new], "file string")
    empty.join(entries, "file", "left").write.mode("append").parquet(f"{index}/files")


def matching_files(spark: SparkSession, target: str, index: str, batch: DataFrame, keys: list[str]) -> list[str]:
    """The files of ``target`` that may hold a key of ``batch`` (a written
    frame). Null keys join nothing; files without rows match nothing."""
    _index_new(spark, target, index, keys)
    present = batch.select(q(keys[0]).alias("k"), _hash(keys).alias("h")).filter(F.col("k").isNotNull())
    spread = present.repartitionByRange(RANGES, "k").groupBy(F.spark_partition_id().alias("part")).agg(
        F.count(F.lit(1)).alias("m"), F.min("k").alias("from"), F.max("k").alias("to"))
    files = spark.read.parquet(f"{index}/files")
    kind = files.schema["lo"].dataType.simpleString()
    found = [tuple(r) for r in spread.collect()]  # at most RANGES rows, and fixed from here on
    ranges = F.broadcast(spark.createDataFrame(found, f"part int, m long, from {kind}, to {kind}"))
    meets = files.join(ranges, (F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from")))
    near = meets.groupBy("file").agg(F.first("words").alias("words"), F.sum("m").alias("m"), F.collect_list("part").alias("parts")).collect()  # some of the files listed
    read = [r["file"] for r in near if r["m"] > ASK]
    ask = [(r["file"], r["words"], r["parts"]) for r in near if r["m"] <= ASK]
    if ask:
        asked = spark.createDataFrame(ask, "file string, words long, parts array<int>").select("file", "words", F.explode("parts").alias("part"))
        dealt = present.join(ranges, F.col("k").between(F.col("from"), F.col("to"))).select("part", "h")  # a key lies in one range
        pairs = dealt.join(asked, "part").select("file", _slot(F.col("h"), F.col("words")).alias("slot"), _mask(F.col("h")).alias("mask"))  # at most ASK a file
        words = spark.read.parquet(f"{index}/words")
        hit = pairs.join(words, ["file", "slot"]).filter(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"))
        read += [r["file"] for r in hit.select("file").distinct().collect()]
    return sorted(read)
