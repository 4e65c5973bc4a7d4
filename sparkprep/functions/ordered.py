"""Running (cumulative) sums in a global order without a one-task window.

A window with no PARTITION BY runs on a single task. ECDFs (drift), ROC
curves and exact per-class split ranks all need running sums in a global
order, so they use a two-level scheme instead:

1. every row gets a bucket that is monotone in the order key (approximate
   quantiles of the key, or a hash prefix when the key is a uniform hash);
2. per-bucket totals (a small table: buckets x partitions) get exclusive
   prefix offsets with a window over that small table;
3. the running sum inside each bucket is a window partitioned by bucket,
   plus the bucket's offset.

Rows should be unique in (partition_cols, order_col): pre-aggregate ties
first (e.g. ``groupBy(score)``), which also absorbs a hot value.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import lookup_join

_BKT = "__bkt"


def quantile_buckets(df: DataFrame, order_col: str, buckets: int, accuracy: int = 10_000) -> DataFrame:
    """Add ``__bkt`` from approximate quantiles of a numeric ``order_col``.
    Only ``buckets - 1`` boundary scalars reach the driver."""
    if buckets <= 1:
        return df.withColumn(_BKT, F.lit(0))
    qs = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(F.col(order_col).cast("double"), qs, accuracy).alias("b")).first()
    bounds = sorted({float(b) for b in (row["b"] or []) if b is not None})
    splits = [float("-inf")] + bounds + [float("inf")]
    tmp = "__ord_dbl"
    out = Bucketizer(splits=splits, inputCol=tmp, outputCol=_BKT, handleInvalid="keep").transform(
        df.withColumn(tmp, F.col(order_col).cast("double"))
    )
    return out.drop(tmp).withColumn(_BKT, F.col(_BKT).cast("int"))


def running_sums(
    df: DataFrame,
    order_col: str,
    sum_cols: dict[str, Column],
    partition_cols: tuple[str, ...] | list[str] = (),
    descending: bool = False,
    buckets: int | None = None,
    bucket_expr: Column | None = None,
    with_next: bool = False,
) -> DataFrame:
    """Append inclusive running sums ``cum_<name>`` of each ``sum_cols``
    expression, ordered by ``order_col`` (ascending unless ``descending``)
    within ``partition_cols``. ``bucket_expr`` (monotone in ``order_col``)
    skips the quantile pass. ``with_next`` also appends ``next_key``, the
    following ``order_col`` value in the same order (NULL for the last)."""
    parts = list(partition_cols)
    key_order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    # as many buckets as the session deals shuffles into, which grows with the cluster and the data
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = df.select("*", *[e.alias(f"__v_{n}") for n, e in sum_cols.items()])
    if bucket_expr is not None:
        base = base.withColumn(_BKT, bucket_expr)
    else:
        base = quantile_buckets(base, order_col, buckets)
    bkt_order = F.col(_BKT).desc() if descending else F.col(_BKT).asc()
    totals = base.groupBy(*parts, _BKT).agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sum_cols])
    w_off = Window.partitionBy(*parts).orderBy(bkt_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts, _BKT, *[F.coalesce(F.sum(f"__t_{n}").over(w_off), F.lit(0)).alias(f"__o_{n}") for n in sum_cols]
    )
    joined = lookup_join(base, offsets, parts + [_BKT], "left")
    w_in = Window.partitionBy(*parts, _BKT).orderBy(key_order).rowsBetween(Window.unboundedPreceding, 0)
    extra = []
    if with_next:
        # next key in order: inside the bucket by ``lead``; for a bucket's last
        # row, the first key of the following non-empty bucket (small table)
        w_first = Window.partitionBy(*parts).orderBy(bkt_order)
        firsts = base.groupBy(*parts, _BKT).agg(
            (F.max(order_col) if descending else F.min(order_col)).alias("__first"))
        firsts = firsts.select(*parts, _BKT, F.lead("__first").over(w_first).alias("__next_bkt_first"))
        joined = lookup_join(joined, firsts, parts + [_BKT], "left")
        w_lead = Window.partitionBy(*parts, _BKT).orderBy(key_order)
        extra.append(F.coalesce(F.lead(order_col).over(w_lead), F.col("__next_bkt_first")).alias("next_key"))
    out = joined.select(
        *df.columns,
        *[(F.col(f"__o_{n}") + F.sum(f"__v_{n}").over(w_in)).alias(f"cum_{n}") for n in sum_cols],
        *extra,
    )
    return out


def exact_quantiles(df: DataFrame, cols: dict[str, Column], probs: list[float], bins: int = 256) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation of several numeric expressions
    at once, without sorting or keeping values: each wanted rank has a range of
    values; a pass counts the values of every range in ``bins`` equal bins (with
    each bin's own least and greatest value), and the range shrinks to the bin
    that holds the rank, until that bin has one value only. State is ranks x
    bins rows, whatever the data; a pass is one scan with partial aggregation,
    and doubles need a handful. Infinities are values at either end of the
    ranks (halfway between the two is NaN). Nulls and NaN are left out; a
    column without values gives nulls."""
    names = list(cols)
    value = {n: cols[n].cast("double") for n in names}
    value = {n: F.when(~F.isnan(v), v) for n, v in value.items()}
    base = df.select(*[value[n].alias(f"v{i}") for i, n in enumerate(names)])
    top = float("inf")
    finite = lambda v: F.when(F.abs(v) < top, v)
    firsts = (("n", F.count), ("lo", lambda v: F.min(finite(v))), ("hi", lambda v: F.max(finite(v))), ("neg", lambda v: F.count_if(v == -top)), ("pos", lambda v: F.count_if(v == top)))
    row = base.agg(*[f(F.col(f"v{i}")).alias(f"{k}{i}") for i in range(len(names)) for k, f in firsts]).first() if names else None
    ranks = {i: sorted({r for q in probs for x in [q * (row[f"n{i}"] - 1)] for r in (int(x), min(int(x) + 1, row[f"n{i}"] - 1))})
             for i in range(len(names)) if row[f"n{i}"]}
    found: dict[tuple[int, int], float] = {}
    todo = {}  # range and the count below it
    for i, r in [(i, r) for i, rs in ranks.items() for r in rs]:
        if r < row[f"neg{i}"] or r >= row[f"n{i}"] - row[f"pos{i}"]:
            found[(i, r)] = -top if r < row[f"neg{i}"] else top
        else:
            todo[(i, r)] = (row[f"lo{i}"], row[f"hi{i}"], row[f"neg{i}"])
    while todo:
        for key in [k for k, (lo, hi, _) in todo.items() if lo == hi]:
            found[key] = todo.pop(key)[0]
        ranges = sorted({(i, lo, hi) for (i, _), (lo, hi, _) in todo.items()})
        if not ranges:
            break
        parts = []
        for no, (i, lo, hi) in enumerate(ranges):
            v = F.col(f"v{i}")
            width = hi / 2 - lo / 2
            bin_ = F.least(F.floor((v / 2 - F.lit(lo / 2)) / F.lit(width) * bins), F.lit(bins - 1)).cast("int") if width else (v >= hi).cast("int")
            parts.append(F.when((v >= lo) & (v <= hi), F.struct(F.lit(no).alias("no"), bin_.alias("bin"), v.alias("v"))))
        got = base.select(F.inline(F.filter(F.array(*parts), lambda x: x.isNotNull()))).groupBy("no", "bin").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()  # at most ranges x bins rows
        by = {}
        for r in sorted(got, key=lambda r: (r["no"], r["bin"])):
            by.setdefault(ranges[r["no"]], []).append((r["n"], r["lo"], r["hi"]))
        for (i, rank), (lo, hi, below) in list(todo.items()):
            for n, l, h in by[(i, lo, hi)]:
                if rank < below + n:
                    todo[(i, rank)] = (l, h, below)
                    break
                below += n
    out = {}
    for i, name in enumerate(names):
        own = []
        for q in probs:
            if i not in ranks:
                own.append(None)
                continue
            x = q * (row[f"n{i}"] - 1)
            a, b = found[(i, int(x))], found[(i, min(int(x) + 1, row[f"n{i}"] - 1))]
            part = x - int(x)
            if a == b or not part:
                own.append(a)
            elif abs(a) == top or abs(b) == top:
                own.append(a * (1 - part) + b * part)
            else:
                own.append(a + (b - a) * part)
        out[name] = own
    return out
