"""Mixing sources to target weights by pivotal dependent rounding (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .store import materialise, partitions, small_or_shuffled

#: Words are runs of anything but space, \t, \n, \v, \f and \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(stats: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size) -> also rank, weight and target words.

    Sources in code-point order (null last) weigh ``cycle`` repeating and
    share the sum of all sizes by weight. A target stops at ``most`` times its
    source's size and the excess is shared again by weight until none is
    above: sources are capped in order of most*size/weight, so the capped set
    is a prefix of that order, found with running sums. One row per source
    (a mix is declared over a bounded list of sources), so ordered windows
    over this table are small whatever the number of documents."""
    ranked = stats.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    ranked = ranked.withColumn("weight", F.element_at(weights, (F.col("rank") % len(cycle) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.lit(most) * F.col("source_size"))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("rank").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    level = ranked.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    level = level.withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # the first source whose share of what is left stays within its cap fixes the rate for itself and all later ones
    level = level.withColumn("rate", F.col("left") / F.col("open"))
    fits = F.col("rate") * F.col("weight") <= F.col("cap")
    rate = F.first(F.when(fits, F.col("rate")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = level.withColumn("target", F.least(F.coalesce(rate, F.lit(most) * 1e300) * F.col("weight"), F.col("cap")))
    return out.select("source", "source_size", "rank", "weight", "target")


def _coin(seed: int, *keys: int) -> float:
    x = seed
    for k in keys:
        x = (x ^ (k & 0xFFFFFFFFFFFFFFFF)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 29
        x = x * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 32
    return (x >> 11) / float(1 << 53)


def pivot(p: float, s: float, q: float, t: float, coin: float) -> tuple[float, float]:
    """Move mass between the fractional probabilities p (of s words) and q (of
    t words) until one is 0 or 1. p*s + q*t stays as it is, and so do the
    expectations of p and q."""
    up = min(1.0 - p, q * t / s)       # p rises by up, q falls
    down = min(p, (1.0 - q) * t / s)   # p falls by down, q rises
    if coin * (up + down) < down:
        p2, q2 = p + up, q - up * s / t
    else:
        p2, q2 = p - down, q + down * s / t
    if up + down <= 0:
        p2, q2 = (1.0 if p >= 0.5 else 0.0), q
    snap = lambda x: 0.0 if x < 1e-12 else 1.0 if x > 1 - 1e-12 else x
    return snap(p2), snap(q2)


def _tournament(seed: int, last: bool):
    """Over partitions sorted by (rank, bucket, u): one residual per group is
    carried from row to row, so memory doesn't grow with a group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held = None, None

        def settle(x, final):
            r, b, u, s, p = x
            if final:
                p = 1.0 if _coin(seed, u, 77) < p else 0.0
            return (r, b, u, s, p)

        for pdf in batches:
            out = []
            for r, b, u, s, p in zip(pdf["rank"].tolist(), pdf["bucket"].tolist(), pdf["u"].tolist(), pdf["words"].tolist(), pdf["p"].tolist()):
                if (r, b) != group:
                    if held is not None:
                        out.append(settle(held, last))
                    group, held = (r, b), None
                if p <= 0.0 or p >= 1.0 or s <= 0:
                    out.append((r, b, u, s, 1.0 if p >= 1.0 else 0.0))
                elif held is None:
                    held = (r, b, u, s, p)
                else:
                    hr, hb, hu, hs, hp = held
                    hp, p = pivot(hp, hs, p, s, _coin(seed, hu, u))
                    held = None
                    for x in ((hr, hb, hu, hs, hp), (r, b, u, s, p)):
                        if 0.0 < x[4] < 1.0:
                            held = x
                        else:
                            out.append(x)
            yield pd.DataFrame(out, columns=["rank", "bucket", "u", "words", "p"])
        if held is not None:
            yield pd.DataFrame([settle(held, last)], columns=["rank", "bucket", "u", "words", "p"])

    return run


_UNIT = "rank int, bucket long, u long, words double, p double"


def mix_copies(units: DataFrame, seed: int = 11, bucket_rows: int = 4096, fan_in: int = 256) -> DataFrame:
    """Round fractional copy probabilities. ``units``: rank int (the source),
    u long (unit id), words double, p double in [0, 1] -> (rank, u, up) with up
    0 or 1. Units are dealt to buckets of about ``bucket_rows`` by a hash of
    their id, each bucket pairs them until one residual is left, and residuals
    meet in a tree of ``fan_in`` children until each source has one, which a
    coin settles. A source's sum of p*words thus changes by less than one unit.
    Everything depends on ids only, so reruns agree."""
    spark = units.sparkSession
    counts = units.groupBy("rank").agg(F.ceil(F.count("*") / bucket_rows).cast("long").alias("buckets"))
    level = units.join(F.broadcast(counts), "rank").select(
        "rank", F.pmod(F.xxhash64("u", F.lit(seed)), F.col("buckets")).alias("bucket"), "u", "words", "p")
    widest = counts.agg(F.max("buckets")).first()[0] or 0
    done = None
    while widest:
        last = widest <= 1
        got = materialise(
            level.repartition(partitions(spark), "rank", "bucket").sortWithinPartitions("rank", "bucket", "u")
            .mapInPandas(K.tidy(_tournament(seed, last)), _UNIT), "mix")
        whole = got.filter("p <= 0 or p >= 1").select("rank", "u", F.col("p").cast("int").alias("up"))
        done = whole if done is None else done.unionByName(whole)
        level = got.filter("p > 0 and p < 1").withColumn("bucket", (F.col("bucket") / fan_in).cast("long"))
        widest = 0 if last else -(-widest // fan_in)
    return done if done is not None else units.select("rank", "u", F.lit(0).alias("up")).limit(0)


def mix_sources(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: float = 3.0, seed: int = 11, chunk: int = 4096) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source, ...) with what a mix takes
    of it: docs' own columns plus mix_size, mix_source_size, mix_target and
    mix_copies (names that docs already has are overwritten; any other name is
    kept).

    Equal rows form one unit. A unit of r rows expects r*target/source size
    copies; the fraction of that number is rounded by ``mix_copies``, and the
    whole is dealt to the rows evenly, so that copies of equal rows differ by
    one at most and never exceed ceil(most). Equal rows are aggregated before
    they are shuffled and dealt out again in runs of ``chunk`` rows. A null
    text has size 0; documents of size 0 take part with 0 words and get floor
    copies; a source of size 0 has target 0; an empty table gives an empty
    table. A null doc_id is a value like any other."""
    spark = docs.sparkSession
    own = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    docs = docs.drop(*own)
    maps = {f.name for f in docs.schema.fields if "map<" in f.dataType.simpleString()}
    content = F.xxhash64(*[F.to_json(F.struct(c)) if c in maps else F.col(c) for c in docs.columns])
    key = ["doc_id", "source", "size", "content"]
    keyed = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), content.alias("content"), F.struct(*docs.columns).alias("row"))
    # narrow, written once: the word counts feed the statistics and the units
    sized = materialise(keyed.groupBy(*key).agg(F.count("*").alias("rows")), "sizes")
    stats = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = materialise(source_targets(stats, cycle, most), "targets")
    expected = F.when(F.col("source_size") > 0, F.col("rows") * (F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    units = sized.join(small_or_shuffled(targets), sized["source"].eqNullSafe(targets["source"])).select(
        *[sized[c] for c in key], "rows", "rank", "source_size", "target", expected.alias("expected"), F.xxhash64("doc_id", "size", "content", F.lit("unit")).alias("u"))
    whole = F.floor("expected")
    ups = mix_copies(units.select("rank", "u", F.col("size").cast("double").alias("words"), (F.col("expected") - whole).alias("p")), seed)
    decided = units.join(ups.groupBy("rank", "u").agg(F.max("up").alias("up")), ["rank", "u"], "left").select(
        *[F.col(c).alias(f"unit_{c}") for c in key], "rows", F.col("source_size").cast("long").alias("mix_source_size"), F.col("target").alias("mix_target"),
        (whole + F.coalesce("up", F.lit(0))).alias("copies"))

    def same(names):
        on = F.lit(True)
        for c in names:
            on = on & F.col(c).eqNullSafe(F.col(f"unit_{c}"))
        return on

    result = lambda df, copies: df.select("row.*", F.col("size").alias("mix_size"), "mix_source_size", "mix_target", copies.cast("int").alias("mix_copies"))
    single = result(keyed.join(decided.filter("rows = 1"), same(key)), F.col("copies"))
    again = sized.filter("rows > 1")
    ids = small_or_shuffled(materialise(again.select(F.col("doc_id").alias("unit_doc_id")).distinct(), "repeated"))
    repeated = keyed.join(ids, same(["doc_id"]), "left_semi").groupBy(*key).agg(F.first("row").alias("row"))
    repeated = repeated.join(decided.filter("rows > 1"), same(key)).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / chunk))))
    repeated = repeated.repartition(partitions(spark), *key, "run").withColumn(
        "no", F.explode(F.sequence(F.col("run") * chunk, F.least(F.col("rows"), (F.col("run") + 1) * chunk) - 1)))
    each = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("no") < F.col("copies") % F.col("rows"), 1).otherwise(0)
    return single.unionByName(result(repeated, each))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document repeated as often as it is taken, with docs' own columns."""
    keys = ["doc_id", "source", "text"]
    rest = [c for c in docs.columns if c not in keys]
    packed = docs.select(*keys, *([F.struct(*rest).alias("mix_rest")] if rest else []))
    taken = mix_sources(packed, **options).where("mix_copies > 0")
    taken = taken.withColumn("mix_no", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    return taken.select(*[F.col(c) if c in keys else F.col("mix_rest").getField(c).alias(c) for c in docs.columns])
