"""Second-order (Newton) gradient boosting of regression trees for a 0/1 label
(MO5), as Spark aggregations.

Features are put into quantile bins once, rows with the same label and bins
are counted, as they share their margins in every round, and that table is written.
A tree grows level by level: tasks send their rows down the tree and add up
the gradients and hessians of the log loss by (node, feature, bin), one
shuffle joins these sums by (node, feature), whose best split is found there,
and only these splits reach the driver, which takes the best of each node.
Up to ``LOCAL_CELLS`` different rows of bins are one task's from the first tree to
the last, as a level then takes less time than a job of Spark's does; sums, and
so the trees, are the same.
``split_gains`` gives all splits with their gains, as a table.

Gradients and hessians are rounded to whole multiples of 2^-30 before they are
summed, so sums are exact and a fit gives the same trees however the rows are
partitioned and whichever tasks are run again.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ShortType, StructField, StructType

from ..functions.exprs import q
from ..session import scratch_path
from .train import written_rows

UNIT = float(1 << 30)
#: Counted rows a task of a fit gets.
TASK_CELLS = 50_000
#: Different rows of bins that one task fits all trees on at most.
LOCAL_CELLS = 2_000_000
_CELL = ("node", "feature", "bin", "g", "h", "n")


@dataclass(frozen=True)
class NewtonParams:
    """Defaults of the usual second-order library: L2 penalty 1, no minimum
    gain, a hessian of 1 or more in each child, first probability 0.5."""

    rounds: int = 100
    step: float = 0.1
    depth: int = 6
    l2: float = 1.0
    min_gain: float = 0.0
    min_child_hessian: float = 1.0
    base_probability: float = 0.5
    bins: int = 256


@dataclass
class Split:
    """A node's split: rows whose bin of ``feature`` is at most ``bin`` go
    left, and rows without a value if ``missing_left``."""

    feature: int
    bin: int
    missing_left: bool
    gain: float
    left_value: float
    right_value: float
    cover: tuple[int, int] = (0, 0)


#: Node numbers are those of a binary heap: the root is 1, children of k are 2k and 2k + 1.
Tree = dict[int, Split]


class _Flat:
    """A tree as arrays by node number, for whole batches of binned rows. A
    leaf leads to itself."""

    def __init__(self, tree: Tree):
        top = 2 * max(tree, default=0) + 2
        self.levels = max(tree, default=0).bit_length()
        # columns of ``_sides``: twice the feature, plus 1 where missing values go right
        self.column, self.bin = np.zeros(top, np.int64), np.full(top, _ABOVE, np.int64)
        self.left, self.value = np.arange(top), np.zeros(top)
        for k, s in tree.items():
            self.column[k], self.bin[k], self.left[k] = 2 * s.feature + (not s.missing_left), s.bin, 2 * k
            self.value[2 * k], self.value[2 * k + 1] = s.left_value, s.right_value

    def nodes(self, sides: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``sides``."""
        n = sides.shape[1]
        at, row, flat = np.ones(n, np.int64), np.arange(n), sides.ravel()
        for _ in range(self.levels):
            at = self.left[at] + (flat[self.column[at] * n + row] > self.bin[at])
        return at


#: More than any bin.
_ABOVE = 1 << 20


def _sides(b: np.ndarray) -> np.ndarray:
    """(2 x features, rows): each feature's bins with missing ones below all others, then above."""
    out = np.empty((2 * b.shape[1], len(b)), np.int64)
    out[::2] = b.T
    out[1::2] = np.where(b.T < 0, _ABOVE + 1, b.T)
    return out


def _bins_of(batch: pa.RecordBatch, n_features: int) -> np.ndarray:
    return np.stack([batch[f"b{i}"].to_numpy() for i in range(n_features)], axis=1).astype(np.int64) if n_features else np.zeros((batch.num_rows, 0), np.int64)


def _added(margin: np.ndarray, sides: np.ndarray, trees: list[_Flat]) -> np.ndarray:
    for t in trees:
        margin = margin + t.value[t.nodes(sides)]
    return margin


def with_margins(binned: DataFrame, trees: list[Tree], n_features: int) -> DataFrame:
    """``binned`` with what ``trees`` add to its margin."""
    flat = [_Flat(t) for t in trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = _added(batch["margin"].to_numpy(), _sides(_bins_of(batch, n_features)), flat)
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))

    return binned.mapInArrow(run, binned.schema)


def bin_edges(df: DataFrame, features: list[str], bins: int = 256, accuracy: int = 10_000) -> list[list[float]]:
    """Upper edges of each feature's bins: approximate quantiles (rank error
    1/accuracy), equal ones once; the last bin is open. At most bins - 1
    numbers a feature reach the driver. A feature without values has none."""
    probs = [(i + 1) / bins for i in range(bins - 1)]
    clean = lambda c: F.when(~F.isnan(q(c).cast("double")), q(c).cast("double"))
    row = df.agg(*[F.percentile_approx(clean(c), probs, accuracy).alias(f"e{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(row[f"e{i}"] or [])) for i in range(len(features))]


def to_bins(df: DataFrame, features: list[str], edges: list[list[float]], keep: list[Column]) -> DataFrame:
    """``keep`` and columns b0, b1, ...: the number of edges below each value,
    -1 for null and NaN."""
    rows = df.select(F.struct(*keep).alias("kept"), *[F.coalesce(q(c).cast("double"), F.lit(float("nan"))).alias(f"b{i}") for i, c in enumerate(features)])
    known, kept = [np.array(e) for e in edges], rows.schema["kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch["kept"]]
            for i, e in enumerate(known):
                v = batch[f"b{i}"].to_numpy()
                cols.append(pa.array(np.where(np.isnan(v), -1, np.searchsorted(e, v)).astype(np.int16)))
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    kind = StructType([kept, *[StructField(f"b{i}", ShortType()) for i in range(len(features))]])
    return rows.mapInArrow(run, kind).select("kept.*", *[f"b{i}" for i in range(len(features))])


def gradients(label: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the log loss, in units of 2^-30."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - label) * UNIT).astype(np.int64), np.rint(p * (1 - p) * UNIT).astype(np.int64)


def histograms(binned: DataFrame, n_features: int, since: list[Tree], tree: Tree, level: int) -> DataFrame:
    """(node, feature, bin, g, h, n): sums over the rows of ``binned`` that
    reach ``level`` of the tree being grown, their margins raised by the trees
    ``since``. Tasks send one row per cell that has rows, so what is shuffled
    depends on nodes, features and bins only."""
    flat, grown = [_Flat(t) for t in since], _Flat(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[int, tuple[int, int, int]] = {}
        for batch in batches:
            b = _bins_of(batch, n_features)
            sides = _sides(b)
            g, h = gradients(batch["label"].to_numpy(), _added(batch["margin"].to_numpy(), sides, flat))
            node = grown.nodes(sides)
            i = np.flatnonzero(node >= (1 << level))
            for f in range(n_features):
                key, back, n = np.unique((node[i] * n_features + f) * (1 << 16) + b[i, f] + 1, return_inverse=True, return_counts=True)
                sums = [np.zeros(len(key), np.int64) for _ in "gh"]
                for x, to in zip((g, h), sums):
                    np.add.at(to, back, x[i])
                for k, a, c, m in zip(key.tolist(), sums[0].tolist(), sums[1].tolist(), n.tolist()):
                    x, y, z = cells.get(k, (0, 0, 0))
                    cells[k] = (x + a, y + c, z + m)
        key = np.array(list(cells), np.int64)
        own = np.array(list(cells.values()), np.int64).reshape(-1, 3)
        cols = [key // ((1 << 16) * n_features), key // (1 << 16) % n_features, key % (1 << 16) - 1, *own.T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).astype(k)) for c, k in zip(cols, ("i4",) * 3 + ("i8",) * 3)], list(_CELL))

    sent = binned.mapInArrow(run, "node int, feature int, bin int, g long, h long, n long")
    # dealt by (node, feature), as the windows over the bins need it: one exchange for both
    return sent.repartition("node", "feature").groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


def split_gains(hist: DataFrame, p: NewtonParams) -> DataFrame:
    """Every allowed split of ``hist`` with its gain: node, feature, bin,
    missing_left, gain, left and right sums. The windows run over the bins of
    one (node, feature), at most bins + 1 rows each."""
    one, upto = "over (partition by node, feature)", "over (partition by node, feature order by bin rows between unbounded preceding and current row)"
    sums = [f"sum({c}) {one} as all_{c}" for c in "ghn"] + [f"sum(if(bin < 0, {c}, 0)) {one} as none_{c}" for c in "ghn"]
    s = hist.selectExpr("node", "feature", "bin", *sums, *[f"sum(if(bin < 0, 0, {c})) {upto} as below_{c}" for c in "ghn"]).filter("bin >= 0")
    s = s.selectExpr("*", "explode(if(none_n > 0, array(true, false), array(true))) as missing_left")
    s = s.selectExpr("*", *[f"below_{c} + if(missing_left, none_{c}, 0) as left_{c}" for c in "ghn"])
    s = s.selectExpr("*", *[f"all_{c} - left_{c} as right_{c}" for c in "ghn"])
    score = lambda w: f"({w}_g / {UNIT}D) * ({w}_g / {UNIT}D) / ({w}_h / {UNIT}D + {float(p.l2)}D)"
    least = float(p.min_child_hessian * UNIT)
    s = s.filter(f"left_n > 0 and right_n > 0 and left_h >= {least}D and right_h >= {least}D")
    return s.selectExpr("node", "feature", "bin", "missing_left", f"0.5D * ({score('left')} + {score('right')} - {score('all')}) - {float(p.min_gain)}D as gain",
                        *[f"{w}_{c}" for w in ("left", "right") for c in "ghn"])


def best_splits(gains: DataFrame) -> DataFrame:
    """The split of most gain (above 0) of each node; ties go to the smallest
    feature, then bin, then to rows without a value on the left."""
    return gains.filter("gain > 0").groupBy("node").agg(
        F.expr("max_by(struct(*), struct(gain, -feature, -bin, missing_left)) as s")).selectExpr("s.*")


def _sums(key: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of the whole numbers ``x`` by ``key``: in two parts, as
    doubles hold them only up to 2^53."""
    high = np.bincount(key, weights=x >> 24, minlength=size).astype(np.int64)
    return (high << 24) + np.bincount(key, weights=x & ((1 << 24) - 1), minlength=size).astype(np.int64)


def _best_of(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: NewtonParams) -> tuple | None:
    """The split of most gain of one (node, feature), as ``split_gains`` and
    ``best_splits`` find it, from its sums by bin (missing values first):
    bin, missing_left, gain, then g, h and n on the left and on the right."""
    below = [np.cumsum(x[1:]) for x in (g, h, n)]
    best = None
    for missing_left in (True, False) if n[0] else (True,):
        left = [b + x[0] * missing_left for b, x in zip(below, (g, h, n))]
        right = [x.sum() - a for a, x in zip(left, (g, h, n))]
        score = lambda a, b: (a / UNIT) * (a / UNIT) / (b / UNIT + p.l2)
        with np.errstate(all="ignore"):
            gain = 0.5 * (score(left[0], left[1]) + score(right[0], right[1]) - score(g.sum(), h.sum())) - p.min_gain
        least = p.min_child_hessian * UNIT
        ok = (n[1:] > 0) & (left[2] > 0) & (right[2] > 0) & (left[1] >= least) & (right[1] >= least) & (gain > 0)
        if ok.any():
            k = int(np.argmax(np.where(ok, gain, -np.inf)))
            if best is None or (gain[k], -k) > (best[2], -best[0]):
                best = (k, missing_left, float(gain[k]), *[int(x[k]) for x in (*left, *right)])
    return best


_FOUND = "node int, feature int, bin int, missing_left boolean, gain double, left_g long, left_h long, left_n long, right_g long, right_h long, right_n long"


def level_splits(counted: DataFrame, n_features: int, since: list[Tree], tree: Tree, level: int, p: NewtonParams) -> DataFrame:
    """The best split of each (node, feature) of ``level`` that has one with a
    gain above 0. ``counted`` has binned rows that stand for ``n`` rows each.
    Tasks send the sums of a (node, feature) as one row of arrays, bins + 2
    long, so what is shuffled depends on tasks, nodes and features only."""
    flat, grown, first, width = [_Flat(t) for t in since], _Flat(tree), 1 << level, p.bins + 1
    size = first * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            b = _bins_of(batch, n_features)
            sides, n = _sides(b), batch["n"].to_numpy()
            g, h = gradients(batch["label"].to_numpy(), _added(batch["margin"].to_numpy(), sides, flat))
            node = grown.nodes(sides) - first
            i = np.flatnonzero(node >= 0)
            if len(i) and total is None:
                total = np.zeros((n_features, 3, size), np.int64)
            for f in range(n_features if len(i) else 0):
                key = node[i] * width + b[i, f] + 1
                for c, x in enumerate((g * n, h * n, n)):
                    total[f, c] += _sums(key, x[i], size)
        if total is not None:
            by = total.reshape(n_features, 3, first, width)
            at = np.argwhere(by[:, 2].any(axis=2))
            sums = [pa.array([by[f, c, k] for f, k in at], pa.list_(pa.int64())) for c in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(at[:, 1] + first, pa.int32()), pa.array(at[:, 0], pa.int32()), *sums], ["node", "feature", "g", "h", "n"])

    def best(key: tuple, part: pa.Table) -> pa.Table:
        sums = [np.sum([x.as_py() for x in part[c]], axis=0, dtype=np.int64) for c in "ghn"]
        found = _best_of(*sums, p)
        rows = [] if found is None else [{f.name: v for f, v in zip(kind, (key[0].as_py(), key[1].as_py(), *found))}]
        return pa.Table.from_pylist(rows, kind)

    kind = pa.schema([(w, {"int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "long": pa.int64()}[t]) for w, t in (f.split() for f in _FOUND.split(", "))])
    sent = counted.mapInArrow(run, "node int, feature int, g array<long>, h array<long>, n array<long>")
    return sent.groupBy("node", "feature").applyInArrow(best, _FOUND)


def _value(p: NewtonParams, g: int, h: int) -> float:
    return -p.step * (g / UNIT) / (h / UNIT + p.l2)


def _local_trees(bins: np.ndarray, n0: np.ndarray, n1: np.ndarray, p: NewtonParams, base: float) -> Iterator[Tree]:
    """The trees on ``bins`` (features, cells; -1 is missing) that ``n0`` rows
    of label 0 and ``n1`` of label 1 have. Of two children, the sums of the one with
    fewer cells are added up; the other one's are what its parent has besides."""
    b, n, width, margin = bins.astype(np.int64) + 1, n0 + n1, p.bins + 1, np.full(bins.shape[1], base)
    # doubles hold the sums of up to 2^22 rows
    add = (lambda key, x, size: np.bincount(key, weights=x, minlength=size).astype(np.int64)) if n.sum() < 1 << 22 else _sums
    for _ in range(p.rounds):
        (g0, h), (g1, _) = gradients(0.0, margin), gradients(1.0, margin)
        sums, tree = (g0 * n0 + g1 * n1, h * n, n), {}
        at, cells, node, heap = np.ones(len(n), np.int64), np.arange(len(n)), np.zeros(len(n), np.int64), [1]
        hist = np.stack([[add(own, x, width)[None] for x in sums] for own in b]) if len(b) else np.zeros((0, 3, 1, width), np.int64)
        value = np.zeros(2 << p.depth)
        for level in range(p.depth):
            split = []
            for k, number in enumerate(heap):
                found = [(f, s) for f in range(len(b)) if hist[f, 2, k].any() and (s := _best_of(*hist[f, :, k], p))]
                if found:
                    f, (cut, missing_left, gain, lg, lh, ln, rg, rh, rn) = max(found, key=lambda t: (t[1][2], -t[0]))
                    tree[number] = Split(f, cut, missing_left, gain, _value(p, lg, lh), _value(p, rg, rh), (ln, rn))
                    value[2 * number], value[2 * number + 1] = tree[number].left_value, tree[number].right_value
                    split.append(k)
            if not split:
                break
            rank = np.full(len(heap), -1)
            rank[split] = np.arange(len(split))
            s = [tree[heap[k]] for k in split]
            keep = rank[node] >= 0
            cells, parent = cells[keep], rank[node[keep]]
            own = b[np.array([x.feature for x in s])[parent], cells]
            right = np.where(own == 0, np.array([not x.missing_left for x in s])[parent], own > np.array([x.bin for x in s])[parent] + 1)
            at[cells] = 2 * at[cells] + right
            node = 2 * parent + right
            heap = [c for k in split for c in (2 * heap[k], 2 * heap[k] + 1)]
            if level + 1 < p.depth:
                many = np.bincount(node, minlength=len(heap)).reshape(-1, 2)
                less = (many[:, 1] < many[:, 0]).astype(np.int64)
                few = np.flatnonzero(right == less[parent])
                key, some = parent[few] * width, cells[few]
                part = np.stack([[add(key + own[some], x[some], len(split) * width).reshape(-1, width) for x in sums] for own in b])
                whole, hist = hist[:, :, split], np.empty((len(b), 3, len(heap), width), np.int64)
                to = 2 * np.arange(len(split))
                hist[:, :, to + less], hist[:, :, to + 1 - less] = part, whole - part
        if not tree:
            return  # no split gains anything: later rounds would see the same sums
        yield tree
        margin = margin + value[at]


def _fit_local(binned: DataFrame, n_features: int, p: NewtonParams, base: float) -> list[Tree] | None:
    """All trees by one task; None if ``binned`` has too many different rows of bins."""
    spark, names = binned.sparkSession, [f"b{i}" for i in range(n_features)]
    counted = _written(spark, binned.groupBy(*names).agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")), "cells")
    if counted.count() > LOCAL_CELLS:
        return None
    got = {c: v.to_numpy() for c, v in zip(counted.columns, counted.toArrow().columns)}  # at most LOCAL_CELLS rows
    bins = np.stack([got[c] for c in names]) if names else np.zeros((0, len(got["n0"])), np.int16)
    held = spark.sparkContext.broadcast((bins, got["n0"], got["n1"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in (k for b in batches for k in b["id"].to_pylist()):
            for i, tree in enumerate(_local_trees(*held.value, p, base)):
                yield pa.RecordBatch.from_pydict({"no": [i], "tree": [json.dumps({str(k): asdict(s) for k, s in tree.items()})]}, pa.schema([("no", pa.int32()), ("tree", pa.string())]))

    rows = spark.range(0, 1, 1, 1).mapInArrow(run, "no int, tree string").collect()  # a row a tree
    held.unpersist()
    return [_tree_of(json.loads(r["tree"])) for r in sorted(rows, key=lambda r: r["no"])]


def _tree_of(body: dict) -> Tree:
    return {int(k): Split(**{**s, "cover": tuple(s["cover"])}) for k, s in body.items()}


@dataclass
class NewtonModel:
    """Fitted trees over binned features; ``base`` is the first margin."""

    features: list[str]
    edges: list[list[float]]
    params: NewtonParams
    base: float
    trees: list[Tree] = field(default_factory=list)

    def margins(self, df: DataFrame, keep: list[Column]) -> DataFrame:
        """``keep`` and margin."""
        rows = to_bins(df, self.features, self.edges, [F.struct(*keep).alias("kept"), F.lit(self.base).alias("margin")])
        return with_margins(rows, self.trees, len(self.features)).select("kept.*", "margin")

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with p1 (the probability of label 1) and prediction (1 from 0.5 on)."""
        out = self.margins(df, [F.col(f"`{c}`") for c in df.columns])
        p = 1 / (1 + F.exp(-F.col("margin")))
        return out.withColumn("p1", p).withColumn("prediction", (F.col("p1") >= 0.5).cast("int")).drop("margin")

    def save(self, spark: SparkSession, path: str) -> None:
        """One row of JSON as text: the model is a few hundred numbers a tree."""
        body = {"features": self.features, "edges": self.edges, "params": asdict(self.params), "base": self.base,
                "trees": [{str(k): asdict(s) for k, s in t.items()} for t in self.trees]}
        spark.createDataFrame([(json.dumps(body),)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NewtonModel:
        body = json.loads(spark.read.text(path).first()[0])
        return cls(body["features"], body["edges"], NewtonParams(**body["params"]), body["base"], [_tree_of(t) for t in body["trees"]])


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fit_newton(df: DataFrame, features: list[str], label: str = "label", params: NewtonParams = NewtonParams(), refresh: int = 5) -> NewtonModel:
    """Fit on ``df`` (``label`` 0 or 1; rows with another or no label are left out).

    Rows are counted by bins, and one task grows the trees (``_fit_local``). Beyond
    ``LOCAL_CELLS`` they are counted by label and bins. That table with each row's margin is
    written, and written again every ``refresh`` trees; the trees since are
    applied on reading. A level is one job; the driver holds the splits of one
    tree, at most features x (2^depth - 1) to choose from, and the fitted ones.

    A frame without labelled rows gives a model without trees."""
    spark, n = df.sparkSession, len(features)
    df = df.filter(q(label).isin(0, 1))
    base = math.log(params.base_probability / (1 - params.base_probability))
    model = NewtonModel(features, bin_edges(df, features, params.bins), params, base)
    binned = to_bins(df, features, model.edges, [q(label).cast("double").alias("label")])
    trees = _fit_local(binned, n, params, base) if n else None
    if trees is not None:
        model.trees = trees
        return model
    counted = binned.groupBy(*binned.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("margin", F.lit(base))
    table = written_rows(counted, counted.columns, TASK_CELLS)
    since: list[Tree] = []
    for _ in range(params.rounds):
        tree: Tree = {}
        for level in range(params.depth):
            best: dict[int, Row] = {}
            for r in level_splits(table, n, since, tree, level, params).collect():  # at most features x 2^level rows
                k = best.get(r["node"])
                if k is None or (r["gain"], -r["feature"]) > (k["gain"], -k["feature"]):
                    best[r["node"]] = r
            for r in best.values():
                value = lambda w: _value(params, r[f"{w}_g"], r[f"{w}_h"])  # noqa: B023, E731
                tree[r["node"]] = Split(r["feature"], r["bin"], r["missing_left"], r["gain"], value("left"), value("right"), (r["left_n"], r["right_n"]))
            if not best:
                break
        if not tree:
            break  # no split gains anything: later rounds would see the same sums
        model.trees.append(tree)
        since.append(tree)
        if len(since) == refresh:
            table, since = _written(spark, with_margins(table, since, n), "binned"), []
    return model
