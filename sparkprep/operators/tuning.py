"""Staged grid search (MO6, MO7): one fit serves all ensemble sizes.

Points of a grid that differ only in the number of trees or rounds share one
fit a fold, of the largest size. Its first k trees are the ensemble of size k:
exactly so for boosting, whose rounds depend on earlier ones only; a forest's
first k trees are a forest of k trees, though of other bags than a fit of k
trees would draw. The held-out fold is read once for all sizes: rows between
the same thresholds reach the same leaves, so they are counted first, and each
such cell goes down the trees once, in Arrow batches that give their confusion
counts for every size. The reference's grids of 27
points then take 9 fits a fold, not 27. Forests, and boosted trees from
``COUNT_FROM`` rows on, are fitted and scored on counted cells
(``counted.search``), where points that differ in a forest's depth share a fit too.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import q
from .attribution import Ensemble, Node, newton_ensemble, spark_ensemble
from .boosting import NewtonParams, fit_newton
from .evaluate import binary_metrics_of_counts
from . import counted
from . import train as T
from .train import SEED, grid_for, make_classifier, retrain, with_folds

#: The parameter that counts trees or rounds, by kind of model.
SIZE = {"random_forest": "numTrees", "gradient_boosting": "maxIter", "boosting_depth6": "maxIter", "newton_boosting": "rounds"}


class _Tree:
    def __init__(self, nodes: list[Node]):
        self.feature = np.array([n.feature for n in nodes])
        self.threshold = np.array([n.threshold for n in nodes])
        self.left = np.array([n.left for n in nodes])
        self.right = np.array([n.right for n in nodes])
        self.value = np.array([n.value for n in nodes], float)
        self.missing_left = np.array([n.missing_left for n in nodes])

    def reached(self, x: np.ndarray) -> np.ndarray:
        """Values of the leaves that the rows of ``x`` reach."""
        at = np.zeros(len(x), int)
        rows = np.arange(len(x))
        while len(rows):
            here = at[rows]
            rows, here = rows[self.feature[here] >= 0], here[self.feature[here] >= 0]
            v = x[rows, self.feature[here]]
            left = np.where(np.isnan(v), self.missing_left[here], v <= self.threshold[here])
            at[rows] = np.where(left, self.left[here], self.right[here])
        return self.value[at]


def staged_counts(df: DataFrame, features: list[str], label: str, ensemble: Ensemble, sizes: list[int], votes: bool) -> DataFrame:
    """Confusion counts of the first ``size`` trees on ``df``, for all
    ``sizes`` in one pass: size, tp, fp, tn, fn. With ``votes`` trees give
    probabilities, and class 1 needs more than half; otherwise the sum must be
    above 0. A size beyond the ensemble's counts all of its trees. Rows whose
    label is not 0 or 1 are left out; null features are NaN; an empty frame
    gives zeros."""
    stages = sorted(set(sizes))
    names = [f"x{i}" for i in range(len(features))]
    # the thresholds of each feature; its cell k holds the values above k of them
    cuts = [np.array(sorted({n.threshold for t in ensemble.trees for n in t if n.feature == i})) for i in range(len(features))]

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [batch[c].to_numpy(zero_copy_only=False).astype(float) for c in names]
            at = [pa.array(np.where(np.isnan(v), -1, np.searchsorted(c, v)).astype(np.int32)) for v, c in zip(x, cuts)]
            yield pa.RecordBatch.from_arrays([batch["y"], *at], ["y", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [_Tree(t) for t in ensemble.trees]
        # a value of each cell, the largest; cell -1 holds the missing ones
        values = [np.concatenate([c, [np.inf, np.nan]]) for c in cuts]
        total = np.zeros((len(stages), 4), np.int64)
        for batch in batches:
            y, n = batch["y"].to_numpy(zero_copy_only=False) == 1, batch["n"].to_numpy()
            x = np.stack([v[batch[c].to_numpy()] for c, v in zip(names, values)], axis=1) if names else np.zeros((len(y), 0))
            margin, done = np.full(len(y), ensemble.base), 0
            for i, size in enumerate(stages):
                for t in range(done, min(size, len(trees))):
                    margin += trees[t].reached(x) * (1.0 if votes else ensemble.weights[t])
                done = max(done, min(size, len(trees)))
                yes = 2 * margin > done if votes else margin > 0
                total[i] += [n[y & yes].sum(), n[~y & yes].sum(), n[~y & ~yes].sum(), n[y & ~yes].sum()]
        yield pa.RecordBatch.from_arrays([pa.array(stages, pa.int32()), *(pa.array(c) for c in total.T)], ["size", "tp", "fp", "tn", "fn"])

    rows = df.filter(q(label).isin(0, 1)).select(q(label).cast("double").alias("y"), *[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    cells = rows.mapInArrow(cell, ", ".join(["y double", *[f"{c} int" for c in names]])).groupBy("y", *names).agg(F.count(F.lit(1)).alias("n"))
    # dealt anew: few cells would otherwise all go down the trees in one task
    cells = cells.repartition(df.sparkSession.sparkContext.defaultParallelism)
    kind = "size int, tp long, fp long, tn long, fn long"
    counted = cells.mapInArrow(run, kind).unionByName(df.sparkSession.createDataFrame([(s, 0, 0, 0, 0) for s in stages], kind))
    return counted.groupBy("size").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "tn", "fn")])


@dataclass
class GridPoint:
    """``f1`` has the F1 of class 1 on each fold."""

    params: dict
    f1: list[float] = field(default_factory=list)

    @property
    def mean_f1(self) -> float:
        return sum(self.f1) / len(self.f1)


def grid_points(kind: str, which: str = "local") -> list[dict]:
    """The points of a grid of MO7 as parameter dicts. Second-order boosting
    has the axes of the other boosted trees under its own names."""
    if kind != "newton_boosting":
        return [{p.name: v for p, v in m.items()} for m in grid_for(kind, make_classifier(kind), which)]
    names = {"maxDepth": "depth", "stepSize": "step", "maxIter": "rounds"}
    return [{names[k]: v for k, v in p.items()} for p in grid_points("boosting_depth6", which)]


def _fit(kind: str, train: DataFrame, features: list[str], label: str, params: dict) -> Ensemble:
    if kind == "newton_boosting":
        return newton_ensemble(fit_newton(train, features, label, NewtonParams(**params)))
    return spark_ensemble(retrain(kind, train, features, label, params), train.sparkSession)


def _counted_f1(kind: str, data: DataFrame, features: list[str], label: str, points: list[dict], folds: int) -> list[list[float]] | None:
    """F1 by point and fold on counted cells; None where they don't serve."""
    if kind == "newton_boosting" or not points or data.count() < (1 if kind == "random_forest" else T.COUNT_FROM):
        return None
    all_of = [make_classifier(kind, **p) for p in points]
    bins = {c.getMaxBins() for c in all_of}
    if len(bins) > 1 or not all(counted.handled(c) for c in all_of):
        return None
    cells = counted.count_cells(data, features, label, *bins, folds)
    return T.counted_f1(kind, cells[1:], points, data.sparkSession) if cells else None


def staged_search(kind: str, train: DataFrame, features: list[str], label: str, points: list[dict], key_cols: list[str],
                  folds: int = 3, parallelism: int = 2, seed: int = SEED) -> list[GridPoint]:
    """k-fold F1 of class 1 for every point of a grid, in the grid's order.
    Folds come from a hash of ``key_cols``. The input is cut to the columns
    used and written once; (shared fit, fold) pairs run from ``parallelism``
    driver threads, each a distributed job. The driver holds fitted trees and
    one row of counts a size."""
    size = SIZE[kind]
    default = NewtonParams().rounds if kind == "newton_boosting" else getattr(make_classifier(kind), f"get{size[0].upper()}{size[1:]}")()
    data = T.plain_rows(with_folds(train, key_cols, folds, seed), [*features, label, "fold"])
    f1 = _counted_f1(kind, data, features, label, points, folds)
    if f1:
        return [GridPoint(p, f) for p, f in zip(points, f1)]
    data = T.dealt(data)
    shared: dict[tuple, set[int]] = {}
    rest_of = lambda p: tuple(sorted((k, v) for k, v in p.items() if k != size))
    for p in points:
        shared.setdefault(rest_of(p), set()).add(p.get(size, default))

    def one(job: tuple) -> tuple[tuple, int, dict[int, float]]:
        rest, fold = job
        ensemble = _fit(kind, data.filter(F.col("fold") != fold), features, label, {**dict(rest), size: max(shared[rest])})
        counts = staged_counts(data.filter(F.col("fold") == fold), features, label, ensemble, list(shared[rest]), kind == "random_forest")
        return rest, fold, {r["size"]: r["f1"] for r in binary_metrics_of_counts(counts, "size").collect()}  # one row a size

    jobs = [(rest, fold) for rest in shared for fold in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        found = {(rest, fold): f1 for rest, fold, f1 in pool.map(inheritable_thread_target(train.sparkSession)(one), jobs)}
    return [GridPoint(p, [found[rest_of(p), fold][p.get(size, default)] for fold in range(folds)]) for p in points]


def best_point(results: list[GridPoint]) -> GridPoint:
    """The highest mean F1; of equal ones the first of the grid."""
    return max(results, key=lambda r: r.mean_f1)


def cross_validate_staged(kind: str, train: DataFrame, feature_cols: list[str], label: str = "label", grid: str = "cloud", folds: int = 3,
                          parallelism: int = 2, key_cols: list[str] | None = None, **params):
    """``train.cross_validate`` by staged evaluation: (model refitted on all
    rows with the best point, best parameters, mean F1 of each point)."""
    if not key_cols:
        raise ValueError("folds come from key columns")
    points = [{**params, **p} for p in grid_points(kind, grid)]
    results = staged_search(kind, train, feature_cols, label, points, key_cols, folds, parallelism)
    best = best_point(results).params
    if kind == "newton_boosting":
        return fit_newton(train, feature_cols, label, NewtonParams(**best)), best, [r.mean_f1 for r in results]
    return retrain(kind, train, feature_cols, label, best), best, [r.mean_f1 for r in results]
