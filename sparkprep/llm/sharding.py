"""Uniform sharding with exact shard sizes by a hypergeometric communication
matrix (operator 11): DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise, partitions, small_or_shuffled

#: Rows of one partition index that monotonically_increasing_id keeps apart (its own layout).
_LOCAL_BITS = 33
#: Partitions below one node of the tree the matrix is drawn along, as a power of two.
_FAN_BITS = 4


def _let(value: Column, use) -> Column:
    """``use(value)`` with value worked out once, also inside a lambda."""
    return F.transform(F.array(value), use)[0]


def _uniform(*key: Column) -> Column:
    """A double in [0, 1) from the hash of a key: 53 of its bits."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") / F.lit(float(1 << 53))


def _steps(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(1).cast("long"), n)).otherwise(F.array().cast("array<bigint>"))


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` rows, drawn without replacement from ``good`` and
    ``bad`` ones, are good: the inverse of the distribution at ``u``, as a long.

    Probabilities are taken relative to the mode's by the ratios of their
    neighbours, as far as 9 standard deviations and 20 steps to either side;
    what lies beyond is less than doubles resolve."""
    whole = F.struct(good.cast("double").alias("g"), bad.cast("double").alias("b"), draws.cast("double").alias("n"), u.alias("u"))

    def at_mode(x: Column) -> Column:
        total = x["g"] + x["b"]
        lo, hi = F.greatest(F.lit(0.0), x["n"] - x["b"]), F.least(x["n"], x["g"])
        mode = F.least(F.greatest(F.floor((x["n"] + 1) * (x["g"] + 1) / (total + 2)).cast("double"), lo), hi)
        spread = F.sqrt(x["n"] * x["g"] / F.greatest(total, F.lit(1.0)) * x["b"] / F.greatest(total, F.lit(1.0))
                        * (total - x["n"]) / F.greatest(total - 1, F.lit(1.0)))
        reach = F.ceil(spread * 9 + 20).cast("double")
        return F.struct(x["g"].alias("g"), x["b"].alias("b"), x["n"].alias("n"), x["u"].alias("u"), mode.alias("mode"),
                        F.least(hi - mode, reach).cast("long").alias("up"), F.least(mode - lo, reach).cast("long").alias("down"))

    def ratio(x: Column, i: Column, upwards: bool) -> Column:
        """Probability of the i-th value above (below) the mode over that of the value before it."""
        if upwards:
            k = x["mode"] + i - 1
            return (x["g"] - k) / (k + 1) * ((x["n"] - k) / (x["b"] - x["n"] + k + 1))
        k = x["mode"] - i + 1
        return k / (x["g"] - k + 1) * ((x["b"] - x["n"] + k) / (x["n"] - k + 1))

    def mass(x: Column, upwards: bool) -> Column:
        zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        step = lambda a, i: _let(a["w"] * ratio(x, i, upwards), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum")))
        return F.aggregate(_steps(x["up" if upwards else "down"]), zero, step, lambda a: a["sum"])

    def walk(x: Column, target: Column, upwards: bool) -> Column:
        """The first step whose mass, summed from the mode on, passes ``target``; null if none does."""
        zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("at"))
        step = lambda a, i: _let(a["w"] * ratio(x, i, upwards), lambda w: F.struct(
            w.alias("w"), (a["sum"] + w).alias("sum"), F.coalesce(a["at"], F.when(target < a["sum"] + w, i)).alias("at")))
        return F.aggregate(_steps(x["up" if upwards else "down"]), zero, step, lambda a: a["at"])

    def pick(x: Column) -> Column:
        sums = F.struct(mass(x, True).alias("above"), mass(x, False).alias("below"))

        def choose(s: Column) -> Column:
            target = x["u"] * (s["above"] + s["below"] + 1) - 1
            return F.when(target < 0, F.lit(0).cast("long")).when(target < s["above"], F.coalesce(walk(x, target, True), F.lit(0))).otherwise(
                -F.coalesce(walk(x, target - s["above"], False), F.lit(0)))

        return x["mode"].cast("long") + _let(sums, choose)

    return _let(whole, lambda x: _let(at_mode(x), pick))


def _share(room: Column, rows: Column, *key: Column) -> Column:
    """How many of ``rows`` rows go to each shard when ``room`` (an array) is
    what each still has to get, and all orders are alike: one row of the
    multivariate hypergeometric distribution, shard by shard."""
    zero = F.struct(rows.alias("need"), F.aggregate(room, F.lit(0).cast("long"), lambda a, x: a + x).alias("pool"),
                    F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        k = hypergeometric(x, a["pool"] - x, a["need"], _uniform(*key, F.size(a["out"])))
        return _let(k, lambda k: F.struct((a["need"] - k).alias("need"), (a["pool"] - x).alias("pool"), F.concat(a["out"], F.array(k)).alias("out")))

    return F.aggregate(room, zero, step, lambda a: a["out"])


def communication_matrix(counts: DataFrame, shards: int, seed: int = 11) -> DataFrame:
    """``counts`` (part int from 0, rows long; a written table, one row a
    partition) -> (part, cells): how many rows of each partition go to each
    shard, drawn as in a uniform shuffle of all rows. Rows add up to the
    partition's rows, columns to rows/shards, rounded down or up (the first
    shards have one more).

    The draw goes down a tree of partitions, 16 to a node: a node shares its
    cells among its children one after another. Nodes of a level are
    independent rows, so that the work is spread, and a draw depends on its
    place and ``seed`` only. No rows give an empty table."""
    spark = counts.sparkSession
    total, last = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.max("part"), F.lit(0))).first()
    levels = max(1, -(-int(last).bit_length() // _FAN_BITS))
    size = lambda j: F.lit(total // shards).cast("long") + F.when(j < total % shards, 1).otherwise(0)
    cells = spark.range(1).select(F.col("id").cast("int").alias("node"), F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), size).alias("cells"))
    for level in reversed(range(levels)):
        low = F.shiftright("part", _FAN_BITS * level)
        nodes = counts.groupBy(F.shiftright("part", _FAN_BITS * (level + 1)).alias("node"), low.alias("child")).agg(F.sum("rows").alias("rows"))
        nodes = nodes.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("child", "rows"))).alias("children"))  # at most 16
        zero = F.struct(F.col("cells").alias("room"), F.array().cast("array<struct<node:int,cells:array<bigint>>>").alias("out"))

        def deal(a: Column, c: Column) -> Column:
            drawn = _share(a["room"], c["rows"], F.lit(seed), F.lit(level), c["child"])  # noqa: B023
            return _let(drawn, lambda d: F.struct(F.zip_with(a["room"], d, lambda x, y: x - y).alias("room"),
                                                  F.concat(a["out"], F.array(F.struct(c["child"].alias("node"), d.alias("cells")))).alias("out")))

        shared = F.aggregate("children", zero, deal, lambda a: a["out"])
        cells = cells.join(nodes, "node").repartition(partitions(spark), "node").select(F.inline(shared))
    return cells.select(F.col("node").alias("part"), "cells")


def shuffle_into_shards(rows: DataFrame, shards: int = 24, seed: int = 11, bucket_rows: int = 100_000) -> DataFrame:
    """``rows`` with shard (int, 0 to shards - 1) and slot (long, gapless from
    0 in each shard): a uniform shuffle of all rows, cut into shards whose row
    counts differ by one at most.

    1. Every partition of ``rows`` is permuted on the spot (sorted by hash, no
       exchange) and written with the place of each row.
    2. ``communication_matrix`` draws how many rows each partition sends to
       each shard; the first places go to shard 0, the next to shard 1, ...
    3. Rows are exchanged by shard and a bucket within it (dealt by hash,
       about ``bucket_rows`` rows each, so that no shard is one task), and
       permuted again within the bucket; slots go on from bucket to bucket.

    Any columns are kept as they are, nulls included; they may bear any names
    but clash with none, as they travel in one struct. Columns named shard or
    slot are replaced. Equal rows are rows like all others: a text that holds
    a third of the table is spread over all shards. An empty table gives an
    empty one. A rerun over the same files and session settings agrees."""
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    place = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.monotonically_increasing_id().alias("id"))
    place = place.sortWithinPartitions(F.xxhash64(F.lit(seed), "id"), "id").select("row", F.monotonically_increasing_id().alias("at"))
    placed = materialise(place.select("row", F.shiftright("at", _LOCAL_BITS).cast("int").alias("part"),
                                      F.col("at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("at")), "placed")
    counts = materialise(placed.groupBy("part").agg(F.count("*").alias("rows")), "parts")
    cells = communication_matrix(counts, shards, seed)
    sums = F.aggregate("cells", F.array().cast("array<bigint>"), lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)))))
    ends = small_or_shuffled(materialise(cells.select("part", sums.alias("ends")), "matrix"))
    sent = placed.join(ends, "part").select("row", "part", "at", F.size(F.filter("ends", lambda e: e <= F.col("at"))).alias("shard"))

    buckets = max(1, -(-placed.count() // (shards * bucket_rows)))
    sent = sent.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "part", "at"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sent.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    again = Window.partitionBy("shard", "bucket").orderBy(F.xxhash64(F.lit(seed + 2), "part", "at"), "part", "at")
    out = sent.withColumn("no", F.row_number().over(again) - 1).join(offsets, ["shard", "bucket"])
    return out.select("row.*", "shard", (F.col("no") + F.col("before")).cast("long").alias("slot"))


def write_shards(rows: DataFrame, path: str, shards: int = 24, seed: int = 11) -> None:
    """Parquet files below ``path``/shard=N, each sorted by slot; a shard has a
    file per bucket, and files of a shard read by slot range give its order."""
    out = shuffle_into_shards(rows, shards, seed)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
