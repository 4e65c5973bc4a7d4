"""Exact per-row attributions of a fitted tree ensemble (EX2).

The value of a set of features for a row is the ensemble's expectation when
only these features are known: a split on a known feature sends the row its
way, a split on another one averages its sides by the training rows they got.
Each leaf adds to the Shapley values of the features on its path. With z the
share of training rows that the path's splits on a feature let through and o
1 or 0 as they let the row through, what a leaf adds for feature i is
``value * (o_i - z_i)`` times the sum, over k, of the k-th coefficient of
``prod_{j != i} (z_j + o_j y)`` weighted by ``k! (m - k - 1)! / m!``, m being
the number of features on the path. Values plus the base (the expectation
with no feature known) add up to the ensemble's output.

Rows are handled in Arrow batches, whole arrays at a time; nothing is
shuffled. Rows between the same thresholds have the same values, so a task
with more rows than there are such cells works out the cells' values once. The ensemble travels with the task: its size is that of the fitted
model, which the driver holds anyway.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.exprs import q
from ..session import scratch_path
from .boosting import NewtonModel


@dataclass(frozen=True)
class Node:
    """``feature`` < 0 marks a leaf. Rows whose value is at most ``threshold``
    go left; rows without a value as ``missing_left`` says. ``cover`` counts
    the training rows."""

    feature: int
    threshold: float
    left: int
    right: int
    value: float
    cover: float
    missing_left: bool = False


@dataclass(frozen=True)
class Ensemble:
    """Trees (nodes by number, the root is 0) with weights; the output is
    ``base`` and the weighted values of the leaves reached."""

    trees: list[list[Node]]
    weights: list[float]
    base: float = 0.0


def newton_ensemble(model: NewtonModel) -> Ensemble:
    """The margin of a ``NewtonModel``: thresholds are the upper edges of bins."""
    trees = []
    for tree in model.trees:
        nodes: list[Node] = []

        def add(k: int, value: float, cover: float) -> int:
            at = len(nodes)  # noqa: B023
            nodes.append(None)  # noqa: B023
            if k not in tree:  # noqa: B023
                nodes[at] = Node(-1, 0.0, -1, -1, value, cover)  # noqa: B023
                return at
            s = tree[k]  # noqa: B023
            left, right = add(2 * k, s.left_value, s.cover[0]), add(2 * k + 1, s.right_value, s.cover[1])  # noqa: B023
            edges = model.edges[s.feature]
            nodes[at] = Node(s.feature, edges[s.bin] if s.bin < len(edges) else math.inf, left, right, 0.0, cover, s.missing_left)  # noqa: B023
            return at

        add(1, 0.0, float(sum(tree[1].cover)))
        trees.append(nodes)
    return Ensemble(trees, [1.0] * len(trees), model.base)


def spark_ensemble(pipeline_model: PipelineModel, spark: SparkSession | None = None) -> Ensemble:
    """The ensemble of a pipeline whose last stage is a fitted forest or
    boosted trees with continuous features: the probability of class 1 of a
    forest, the margin of boosted trees. Nodes are read from the model's own
    saved form, a table of nodes. Splits of bins become splits of the values
    that a bucketizer ahead of the trees puts into them."""
    clf = pipeline_model.stages[-1]
    binner = pipeline_model.stages[0]
    bounds = binner.getSplitsArray() if isinstance(binner, Bucketizer) else None

    def threshold(feature: int, t: float) -> float:
        if bounds is None:
            return t
        upper = bounds[feature][min(math.floor(t) + 1, len(bounds[feature]) - 1)]
        return upper if upper == math.inf else math.nextafter(upper, -math.inf)

    spark = spark or SparkSession.getActiveSession()
    path = scratch_path(spark, f"ensemble-{uuid.uuid4().hex}")
    clf.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # one row a node of the model
    forest = "Forest" in type(clf).__name__
    by_tree: dict[int, dict[int, object]] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], {})[r["id"]] = r
    trees = []
    for t in sorted(by_tree):
        own, number = by_tree[t], {k: i for i, k in enumerate(sorted(by_tree[t]))}
        nodes = []
        for k in sorted(own):
            r = own[k]
            stats = list(r["impurityStats"])
            # rows of a node: counted bins stand for several each, and boosted trees' statistics begin with the sum of weights
            cover = float(r["rawCount"]) if bounds is None else stats[0]
            value = (stats[1] / sum(stats) if sum(stats) else 0.0) if forest else r["prediction"]
            if r["leftChild"] < 0:
                nodes.append(Node(-1, 0.0, -1, -1, value, cover))
                continue
            if r["split"]["numCategories"] != -1:
                raise ValueError("splits on categories have no threshold; index categories as continuous features")
            f = r["split"]["featureIndex"]
            nodes.append(Node(f, threshold(f, r["split"]["leftCategoriesOrThreshold"][0]), number[r["leftChild"]], number[r["rightChild"]], 0.0, cover))
        trees.append(nodes)
    return Ensemble(trees, [1 / len(trees)] * len(trees) if forest else list(clf.treeWeights))


class _Path:
    """The way to a leaf, feature by feature: the interval of values let
    through, whether a missing value is, and the share of training rows."""

    def __init__(self, value: float):
        self.value = value
        self.low: dict[int, float] = {}
        self.high: dict[int, float] = {}
        self.missing: dict[int, bool] = {}
        self.share: dict[int, float] = {}


def _paths(nodes: list[Node], weight: float) -> list[_Path]:
    out = []

    def walk(k: int, steps: list[tuple[Node, bool, float]]) -> None:
        n = nodes[k]
        if n.feature < 0:
            p = _Path(n.value * weight)
            for parent, left, share in steps:
                f = parent.feature
                p.low[f] = max(p.low.get(f, -math.inf), -math.inf if left else parent.threshold)
                p.high[f] = min(p.high.get(f, math.inf), parent.threshold if left else math.inf)
                p.missing[f] = p.missing.get(f, True) and parent.missing_left == left
                p.share[f] = p.share.get(f, 1.0) * share
            out.append(p)
            return
        for child, left in ((n.left, True), (n.right, False)):
            walk(child, [*steps, (n, left, nodes[child].cover / n.cover if n.cover else 0.0)])

    walk(0, [])
    return out


def _leaf_tables(z: np.ndarray) -> np.ndarray:
    """What a path of features with shares ``z`` and leaf value 1 gives each
    of them, for every combination of o: an array (2^m, m), bit j of the row
    number being o_j."""
    m = len(z)
    o = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1
    weights = np.array([math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) for k in range(m)])
    out = np.zeros((1 << m, m))
    for i in range(m):
        poly = np.zeros((1 << m, m))
        poly[:, 0] = 1
        for j in range(m):
            if j != i:
                up = np.concatenate([np.zeros((1 << m, 1)), poly[:, :-1]], axis=1)
                poly = poly * z[j] + up * o[:, j:j + 1]
        out[:, i] = (o[:, i] - z[i]) * (poly @ weights)
    return out


#: Cells between thresholds whose values a task holds at most.
CELLS_MOST = 300_000


class Attributor:
    """Shapley values of batches of rows, leaf by leaf. A leaf holds a table of
    2^m rows for the m features on its path, so m is at most ``most``. Once it
    has seen as many rows as there are cells between thresholds, it looks rows
    up in a table of the cells' values."""

    def __init__(self, ensemble: Ensemble, n_features: int, most: int = 16):
        self.n_features = n_features
        self.base = ensemble.base
        self.leaves = []
        # the thresholds of each feature; its cell k holds the values above k of them, the last one the missing ones
        self.cuts = [np.array(sorted({n.threshold for t in ensemble.trees for n in t if n.feature == i})) for i in range(n_features)]
        self.cells, self.seen, self.table = math.prod(len(c) + 2 for c in self.cuts), 0, None
        for nodes, weight in zip(ensemble.trees, ensemble.weights):
            for p in _paths(nodes, weight):
                f = sorted(p.share)
                if len(f) > most:
                    raise ValueError(f"a path of {len(f)} features; at most {most} are handled")
                z = np.array([p.share[i] for i in f])
                self.base += p.value * float(np.prod(z))
                if f:
                    self.leaves.append((f, [p.low[i] for i in f], [p.high[i] for i in f], [p.missing[i] for i in f], _leaf_tables(z) * p.value))

    def values(self, x: np.ndarray) -> np.ndarray:
        """(rows, features) attributions of ``x`` (rows, features; NaN is missing)."""
        if self.seen < self.cells or self.cells > CELLS_MOST:
            self.seen += len(x)
            return self._by_leaves(x)
        if self.table is None:
            # a value of each cell, the largest
            each = np.meshgrid(*[np.concatenate([c, [np.inf, np.nan]]) for c in self.cuts], indexing="ij")
            self.table = self._by_leaves(np.stack([v.ravel() for v in each], axis=1))
        at = np.zeros(len(x), np.int64)
        for i, c in enumerate(self.cuts):
            at = at * (len(c) + 2) + np.where(np.isnan(x[:, i]), len(c) + 1, np.searchsorted(c, x[:, i]))
        return self.table[at]

    def _by_leaves(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.n_features))
        none = np.isnan(x)
        column = [np.ascontiguousarray(x[:, i]) for i in range(self.n_features)]
        for f, low, high, missing, table in self.leaves:
            row = np.zeros(len(x), np.int64)
            for j, i in enumerate(f):
                through = (column[i] > low[j]) & (column[i] <= high[j])
                if missing[j]:
                    through |= none[:, i]
                row += through.astype(np.int64) << j
            out[:, f] += table[row]
        return out


def tree_attributions(df: DataFrame, ensemble: Ensemble, key: list[str], feature_cols: list[str]) -> DataFrame:
    """``key`` columns, base, and one column of attributions per feature, named
    as the feature: base and a row's attributions add up to the ensemble's
    output for it. Null and NaN are missing values. Rows stay where they are."""
    rows = df.select(F.struct(*[q(c) for c in key]).alias("key"), *[F.coalesce(q(c).cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(feature_cols)])
    work = Attributor(ensemble, len(feature_cols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch[f"x{i}"].to_numpy() for i in range(work.n_features)], axis=1)
            v = work.values(x)
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(np.full(len(x), work.base)), *[pa.array(np.ascontiguousarray(v[:, i])) for i in range(work.n_features)]],
                                             ["key", "base", *[f"x{i}" for i in range(work.n_features)]])

    kind = StructType([rows.schema["key"], StructField("base", DoubleType()), *[StructField(f"x{i}", DoubleType()) for i in range(len(feature_cols))]])
    out = rows.mapInArrow(run, kind)
    return out.select("key.*", "base", *[F.col(f"x{i}").alias(c) for i, c in enumerate(feature_cols) if c not in key],
                      *[F.col(f"x{i}").alias(f"{c}_attribution") for i, c in enumerate(feature_cols) if c in key])


def attribution_summary(attributions: DataFrame, feature_cols: list[str]) -> DataFrame:
    """(feature, mean_abs, mean, rank): the ranked summary over all rows."""
    if not feature_cols:
        return attributions.sparkSession.createDataFrame([], "feature string, mean_abs double, mean double, rank int")
    means = [f(q(c)).alias(f"{k}{i}") for i, c in enumerate(feature_cols) for k, f in (("a", lambda v: F.avg(F.abs(v))), ("m", F.avg))]
    each = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("mean_abs"), F.col(f"m{i}").alias("mean")) for i, c in enumerate(feature_cols)])
    s = attributions.agg(F.count(F.lit(1)).alias("n"), *means).filter("n > 0").select(F.inline(each))
    ahead = s.select(F.struct((-F.col("mean_abs")).alias("m"), F.col("feature").alias("f")).alias("o")).agg(F.sort_array(F.collect_list("o")).alias("all"))  # a row a feature
    return s.join(F.broadcast(ahead)).select("feature", "mean_abs", "mean", F.array_position(F.transform("all", lambda o: o["f"]), F.col("feature")).cast("int").alias("rank"))
