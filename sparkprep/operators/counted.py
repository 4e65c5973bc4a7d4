"""Tree ensembles fitted on counted cells (MO3-MO7).

A tree of Spark's sees nothing of a row but its label and the bin of each
feature. Rows with the same bins are a cell, and a cell with the number of its
rows by label stands for all of them: at most bins^features cells, never more
than rows. Cells are counted in two passes over the rows (quantiles, counts),
for all folds of a cross-validation at once; no later step reads rows. Tasks
then grow whole trees, each on all cells, so that a fit is one job and not one
a tree level: a forest's trees are dealt to all tasks, boosted trees, which
depend on each other, are one task's.

Trees are Spark's: gini or variance gain, a random half (or so) of the features
a node in a forest, Poisson bags (a cell of n rows draws from Poisson(n), the
law of n draws from Poisson(1)), leaves merged where both sides say the same.
Fitted trees become a model of Spark's through its saved form.

What can't be counted (values or labels that are missing or infinite, labels
that are not 0 or 1, no row of label 1, settings that are not handled, more
cells than ``CELLS_MOST``) is left to the caller: ``count_cells`` gives None.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import q
from ..session import scratch_path

#: Cells, of all folds together, that tasks hold at most.
CELLS_MOST = 1_000_000
#: Points of a sketch of quantiles; rows that are sorted or counted at a time.
POINTS, BUFFER = 20_000, 1_000_000
#: Trees of a task when held-out rows are scored.
CHUNK = 20
_KNOWN = {"labelCol", "featuresCol", "numTrees", "maxDepth", "seed", "minInstancesPerNode", "maxBins", "maxIter", "stepSize", "lossType"}


@dataclass(frozen=True)
class Cells:
    """Counted rows: thresholds of each feature, and for each cell its bins
    (features, cells), the rows of a fit by label (n0, n1) and the held-out ones (h0, h1)."""

    points: list[np.ndarray]
    bins: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    h0: np.ndarray
    h1: np.ndarray


def handled(clf) -> bool:
    return isinstance(clf, RandomForestClassifier | GBTClassifier) and all(p.name in _KNOWN for p in clf.params if clf.isSet(p))


def _compressed(v: np.ndarray, w: np.ndarray | None, most: float = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values with their weights, equal ones added up; more than
    ``most`` become as many, each the largest of its share of the ranks."""
    if w is None:  # a row each
        v, upto = np.sort(v), np.arange(1, len(v) + 1)
    else:
        order = np.argsort(v, kind="stable")
        v, upto = v[order], np.cumsum(w[order])
    last = np.flatnonzero(np.r_[v[1:] != v[:-1], True]) if len(v) else np.zeros(0, int)
    v, upto = v[last], upto[last]
    if len(v) > most:
        at = np.unique(np.searchsorted(upto, np.arange(1, most + 1) * (upto[-1] / most)).clip(max=len(v) - 1))
        v, upto = v[at], upto[at]
    return v, np.diff(upto, prepend=0)


def _thresholds(v: np.ndarray, w: np.ndarray, bins: int) -> list[float]:
    """Halfway between neighbours of at most ``bins`` values, else their quantiles."""
    v, w = _compressed(v, w, math.inf)
    if len(v) <= bins:
        return [a + (b - a) / 2 if math.isfinite(b - a) else a for a, b in zip(v.tolist(), v[1:].tolist())]
    upto = np.cumsum(w)
    at = np.searchsorted(upto, np.ceil(np.arange(1, bins) / bins * upto[-1])).clip(max=len(v) - 1)
    return np.unique(v[at]).tolist()


def _batches(rows: Iterator[pa.RecordBatch], n: int) -> Iterator[list[np.ndarray]]:
    """Columns of about ``n`` rows at a time."""
    held, many = [], 0
    for b in rows:
        held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
        many += b.num_rows
        if many >= n:
            yield [np.concatenate(c) for c in zip(*held)]
            held, many = [], 0
    if many:
        yield [np.concatenate(c) for c in zip(*held)]


def thresholds(rows: DataFrame, n_features: int, bins: int, folds: int = 0) -> list[list[np.ndarray]] | None:
    """Thresholds of each feature on all rows, then without each fold, in one
    pass over (x0, x1, ..., y, fold). Rank errors are within 2/10,000: a task sends
    at most ``POINTS`` points a fold and feature. None if a value can't be counted."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, int], list] = {}
        for cols in _batches(batches, BUFFER):
            *x, y, fold = cols
            if not (np.isin(y, (0, 1)).all() and all(np.isfinite(c).all() for c in x)):
                yield pa.RecordBatch.from_pydict({"feature": [-1], "fold": [-1], "v": [[]], "w": [[]]}, kind)
                return
            for k in np.unique(fold).tolist():
                own = fold == k
                for i, c in enumerate(x):
                    kept.setdefault((i, k), []).append(_compressed(c[own], None))
        for (i, k), parts in kept.items():
            v, w = _compressed(*[np.concatenate(p) for p in zip(*parts)])
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([k], pa.int32()), pa.array([v], pa.list_(pa.float64())), pa.array([w], pa.list_(pa.int64()))], schema=kind)

    def cut(key: tuple, part: pa.Table) -> pa.Table:
        i, out = key[0].as_py(), []
        own = sorted(zip(part["fold"].to_pylist(), ([x.values.to_numpy(), y.values.to_numpy()] for x, y in zip(part["v"], part["w"]))), key=lambda t: t[0])
        for s in range(folds + 1) if i >= 0 else [-1]:
            parts = [vw for k, vw in own if k != s - 1] if i >= 0 else []
            out.append({"feature": i, "s": s, "points": _thresholds(*[np.concatenate(p) for p in zip(*parts)], bins) if parts else []})
        return pa.Table.from_pylist(out, pa.schema([("feature", pa.int32()), ("s", pa.int32()), ("points", pa.list_(pa.float64()))]))

    kind = pa.schema([("feature", pa.int32()), ("fold", pa.int32()), ("v", pa.list_(pa.float64())), ("w", pa.list_(pa.int64()))])
    sent = rows.mapInArrow(sketch, "feature int, fold int, v array<double>, w array<long>")
    got = sent.groupBy("feature").applyInArrow(cut, "feature int, s int, points array<double>").collect()  # features x (folds + 1) rows of bins numbers
    if any(r["feature"] < 0 for r in got):
        return None
    by = {(r["s"], r["feature"]): np.array(r["points"], float) for r in got}
    return [[by.get((s, i), np.zeros(0)) for i in range(n_features)] for s in range(folds + 1)]


def count_cells(rows: DataFrame, features: list[str], label: str, bins: int, folds: int = 0) -> list[Cells] | None:
    """The cells of all rows, then for each of ``folds`` (column ``fold``,
    from 0) those of the other folds' rows, by thresholds of their own, with
    the fold's rows as held-out ones. Two passes over ``rows``."""
    spark, n = rows.sparkSession, len(features)
    x = [F.coalesce(q(c).cast("double"), F.lit(math.nan)).alias(f"x{i}") for i, c in enumerate(features)]
    rows = rows.select(*x, F.coalesce(q(label).cast("double"), F.lit(-1.0)).alias("y"), (F.col("fold") if folds else F.lit(0)).cast("int").alias("fold"))
    points = thresholds(rows, n, bins, folds)
    if points is None or not n:
        return None
    widths = [np.array([len(p) + 1 for p in own], dtype=object) for own in points]
    if any(math.prod(w) >= 1 << 62 for w in widths):
        return None
    steps = [np.array([math.prod(w[:i]) for i in range(n)], np.int64) for w in widths]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in _batches(batches, BUFFER):
            *x, y, fold = cols
            for s, (own, step) in enumerate(zip(points, steps)):
                code = sum(np.searchsorted(p, c) * m for p, c, m in zip(own, x, step))
                group = (y == 1) + 2 * (fold == s - 1)
                for g in range(4):
                    cell, many = np.unique(code[group == g], return_counts=True)
                    if len(cell):
                        none = np.zeros(len(cell), np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(none + s, pa.int64()), pa.array(cell, pa.int64()), *[pa.array(many if k == g else none) for k in range(4)]], ["s", "code", "n0", "n1", "h0", "h1"])

    sent = rows.mapInArrow(count, "s long, code long, n0 long, n1 long, h0 long, h1 long")
    path = scratch_path(spark, f"cells-{uuid.uuid4().hex}")
    sent.groupBy("s", "code").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "h0", "h1")]).write.parquet(path)
    counted = spark.read.schema("s long, code long, n0 long, n1 long, h0 long, h1 long").parquet(path)
    if counted.count() > CELLS_MOST:
        return None
    got = {c: v.to_numpy() for c, v in zip(counted.columns, counted.toArrow().columns)}  # at most CELLS_MOST rows
    order, out = np.lexsort((got["code"], got["s"])), []
    for s, (own, step) in enumerate(zip(points, steps)):
        at = order[got["s"][order] == s]
        code = got["code"][at]
        if not got["n1"][at].any():
            return None  # a single class
        out.append(Cells(own, np.stack([(code // m % int(w)).astype(np.int16) for m, w in zip(step, widths[s])]), *[got[c][at] for c in ("n0", "n1", "h0", "h1")]))
    return out


@dataclass
class Tree:
    """Nodes level by level: split (rows with a bin up to ``bin`` go left),
    children (-1 in a leaf), gain, level and the sums of the node's rows."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    gain: np.ndarray
    level: np.ndarray
    sums: np.ndarray


def gini(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of sums (rows of label 0, of label 1), and what a split should
    leave the sides most of: the sum of squares over rows."""
    n = s[0] + s[1]
    return n, (s[0] * s[0] + s[1] * s[1]) / np.maximum(n, 1)


def variance(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of sums (rows, values, squares)."""
    return s[0], s[1] * s[1] / np.maximum(s[0], 1)


def grow(bins: np.ndarray, widths: list[int], sums: np.ndarray, score, depth: int, least: int, rng=None, choose: int | None = None,
         scored: int = 2, held: np.ndarray | None = None, marks: tuple[int, ...] = ()) -> tuple[Tree, list[np.ndarray]]:
    """A tree on cells with ``sums`` (the first ``scored`` of them tell a
    split's ``score``), at most ``depth`` levels, ``least`` rows a side,
    ``choose`` of the features a node drawn by ``rng``. For each depth of
    ``marks``, the nodes that the cells ``held`` reach when the tree ends there."""
    some = score(sums)[0] > 0
    b, x = bins[:, some], sums[:, some].astype(float)
    node, first, level, parts = np.zeros(b.shape[1], np.int64), 0, 0, []
    total = x.sum(axis=1, keepdims=True)
    reached = np.zeros(0 if held is None else held.shape[1], np.int64)
    going, at, ends = np.arange(len(reached)), np.zeros(len(reached), np.int64), {}
    while True:
        many, (size, whole) = total.shape[1], score(total)
        gain, feature, cut = np.zeros(many), np.full(many, -1), np.zeros(many, np.int64)
        if level < depth:
            may = (size >= 2 * least) & ((total[0] > 0) & (total[1] > 0) if score is gini else True)
            drawn = rng.random((many, len(widths))).argsort(axis=1).argsort(axis=1) < choose if choose is not None and choose < len(widths) else None
            for f, width in enumerate(widths):
                own = may if drawn is None else may & drawn[:, f]
                if width < 2 or not own.any():
                    continue
                i = np.flatnonzero(own[node]) if not own.all() else slice(None)
                key = (np.cumsum(own) - 1)[node[i]] * width + b[f, i]
                cells = [np.bincount(key, weights=x[k, i], minlength=int(own.sum()) * width) for k in range(scored)]
                # bins that have rows, by node
                used = np.flatnonzero(score(np.stack(cells))[0])
                by = used // width
                start = np.flatnonzero(np.r_[True, by[1:] != by[:-1]])
                upto = [np.cumsum(c[used]) for c in cells]
                left = np.stack([u - (u[start] - c[used[start]])[by] for u, c in zip(upto, cells)])
                right = total[:scored, own][:, by] - left
                (ln, ls), (rn, rs) = score(left), score(right)
                got = np.where((ln >= least) & (rn >= least) & (np.arange(len(by)) != np.r_[start[1:] - 1, len(by) - 1][by]), ls + rs, -np.inf)
                top = np.maximum.reduceat(got, start)
                hit = np.flatnonzero(got == top[by])
                hit = hit[np.r_[True, by[hit[1:]] != by[hit[:-1]]]]  # the first of equal ones
                mine = (top - whole[own]) / size[own]
                better = mine > gain[own]
                to = np.flatnonzero(own)[better]
                gain[to], feature[to], cut[to] = mine[better], f, (used % width)[hit][better]
        split = gain > 1e-15
        child = first + many + 2 * (np.cumsum(split) - 1)
        parts.append((np.where(split, feature, -1), cut, np.where(split, child, -1), np.where(split, child + 1, -1), gain, np.full(many, level), total))
        if level in marks:
            ends[level] = reached.copy()
        if not split.any():
            break
        inner = 2 * (np.cumsum(split) - 1)

        def down(cells: np.ndarray, node: np.ndarray) -> np.ndarray:
            flat = feature[node] * cells.shape[1] + np.arange(cells.shape[1])  # noqa: B023
            return inner[node] + (cells.ravel()[flat] > cut[node])  # noqa: B023

        keep = split[node]
        if not keep.all():
            b, x, node = b[:, keep], x[:, keep], node[keep]
        node = down(b, node)
        if len(going):
            keep = split[at]
            going, at = going[keep], at[keep]
            at = down(held[:, going], at)
            reached[going] = first + many + at
        first, level = first + many, level + 1
        total = np.stack([np.bincount(node, weights=c, minlength=2 * int(split.sum())) for c in x])
    tree = Tree(*[np.concatenate(c, axis=-1) for c in zip(*parts)])
    return tree, [ends.get(m, reached) for m in marks]


def merged(tree: Tree, said: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The node that each node of ``tree``, ended at ``depth``, is part of
    once sides that say the same are merged; and what merged nodes say."""
    inner, said = (tree.left >= 0) & (tree.level < depth), said.copy()
    one, levels = ~inner, [np.flatnonzero(inner & (tree.level == k)) for k in range(min(depth, int(tree.level.max()) + 1))]
    for i in reversed(levels):
        same = one[tree.left[i]] & one[tree.right[i]] & (said[tree.left[i]] == said[tree.right[i]])
        one[i] = same
        said[i[same]] = said[tree.left[i[same]]]
    top = np.arange(len(inner))
    for i in levels:
        for side in (tree.left, tree.right):
            top[side[i]] = np.where(one[i], top[i], side[i])
    return top, said


def _bag(cells: Cells, seed: int, number: int, trees: int) -> tuple[np.random.Generator, np.ndarray]:
    rng, n = np.random.default_rng([seed & 0xFFFFFFFF, number]), np.stack([cells.n0, cells.n1])
    return rng, rng.poisson(n) if trees > 1 else n


def _forest_tree(cells: Cells, number: int, p: dict, **more) -> tuple[Tree, list[np.ndarray]]:
    rng, bag = _bag(cells, p["seed"], number, p["numTrees"])
    n = len(cells.points)
    return grow(cells.bins, [len(c) + 1 for c in cells.points], bag, gini, p["maxDepth"], p["minInstancesPerNode"], rng,
                n if p["numTrees"] == 1 else math.ceil(math.sqrt(n)), **more)


def _boosted(cells: Cells, p: dict) -> Iterator[tuple[Tree, np.ndarray]]:
    """Trees of the logistic loss on labels -1 and 1, and the cells' margins after each."""
    margin, n = np.zeros(len(cells.n0)), np.stack([cells.n0, cells.n1]).astype(float)
    widths = [len(c) + 1 for c in cells.points]
    for k in range(p["maxIter"]):
        away = [y * (4 / (1 + np.exp(2 * y * margin)) if k else 1.0) for y in (-1.0, 1.0)]
        sums = np.stack([n[0] + n[1], n[0] * away[0] + n[1] * away[1], n[0] * away[0] ** 2 + n[1] * away[1] ** 2])
        tree, (leaf,) = grow(cells.bins, widths, sums, variance, p["maxDepth"], p["minInstancesPerNode"], held=cells.bins, marks=(p["maxDepth"],))
        margin = margin + (p["stepSize"] if k else 1.0) * (tree.sums[1] / tree.sums[0])[leaf]
        yield tree, margin


_NODE = "treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int, featureIndex int, threshold double"


def _node_rows(tree: Tree, number: int, points: list[np.ndarray], depth: int, forest: bool) -> pa.RecordBatch:
    """A tree in the saved form of Spark's, merged, its nodes numbered anew."""
    s = tree.sums
    said = (s[1] > s[0]).astype(float) if forest else s[1] / s[0]
    impurity = 1 - gini(s)[1] / (s[0] + s[1]) if forest else np.maximum(s[2] - s[1] * s[1] / s[0], 0) / s[0]
    top, said = merged(tree, said, depth)
    kept = np.flatnonzero(top == np.arange(len(top)))
    number_of = np.full(len(top), -1)
    number_of[kept] = np.arange(len(kept))
    inner = tree.left[kept] >= 0
    inner[inner] = (top[tree.left[kept][inner]] == tree.left[kept][inner])
    child = lambda side: np.where(inner, number_of[np.where(inner, side[kept], 0)], -1)
    at = [points[f][b] if i else 0.0 for f, b, i in zip(tree.feature[kept], tree.bin[kept], inner)]
    rows = s[0] + s[1] if forest else s[0]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(kept), number), pa.int32()), pa.array(np.arange(len(kept)), pa.int32()), pa.array(said[kept]), pa.array(impurity[kept]),
        pa.array(s[:, kept].T.tolist(), pa.list_(pa.float64())), pa.array(np.rint(rows[kept]).astype(np.int64)), pa.array(np.where(inner, tree.gain[kept], -1.0)),
        pa.array(child(tree.left), pa.int32()), pa.array(child(tree.right), pa.int32()), pa.array(np.where(inner, tree.feature[kept], -1), pa.int32()), pa.array(at, pa.float64())],
        [f.split()[0] for f in _NODE.split(", ")])


def _settings(clf) -> dict:
    return {p.name: clf.getOrDefault(p) for p in clf.params if p.name in _KNOWN and (clf.isSet(p) or clf.hasDefault(p))}


def fit(clf, cells: Cells, spark: SparkSession):
    """``clf`` fitted on ``cells``, as a model of Spark's. The nodes go from
    the tasks into the model's saved form, which is then loaded."""
    forest, p = isinstance(clf, RandomForestClassifier), _settings(clf)
    trees = p["numTrees" if forest else "maxIter"]
    held = spark.sparkContext.broadcast(cells)
    tasks = min(trees, spark.sparkContext.defaultParallelism * 2) if forest else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in (k for b in batches for k in b["id"].to_pylist()):
            if forest:
                for t in range(task, trees, tasks):
                    yield _node_rows(_forest_tree(held.value, t, p)[0], t, held.value.points, p["maxDepth"], True)
            else:
                for t, (tree, _) in enumerate(_boosted(held.value, p)):
                    yield _node_rows(tree, t, held.value.points, p["maxDepth"], False)

    nodes = spark.range(0, tasks, 1, tasks).mapInArrow(run, _NODE)
    inner = F.col("featureIndex") >= 0
    split = F.struct("featureIndex", F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    data = nodes.select("treeID", F.struct("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", split.alias("split")).alias("nodeData"))
    path, empty = (scratch_path(spark, f"{k}-{uuid.uuid4().hex}") for k in ("fitted", "shape"))
    data.write.parquet(f"{path}/data")
    held.unpersist()
    # what surrounds the nodes comes from a fit of one tree without splits
    names = [f"x{i}" for i in range(len(cells.points))]
    two = spark.createDataFrame([(0.0, *[0.0] * len(names)), (1.0, *[0.0] * len(names))], ", ".join(f"{c} double" for c in ("y", *names)))
    size = "numTrees" if forest else "maxIter"
    one = clf.copy({clf.getParam(size): 1, clf.labelCol: "y", clf.featuresCol: "v"}).fit(VectorAssembler(inputCols=names, outputCol="v").transform(two))
    one.write().save(empty)
    about = json.loads(spark.read.text(f"{empty}/metadata").first()[0])
    own = {"labelCol": p["labelCol"], "featuresCol": p["featuresCol"], size: trees}
    about |= {"numTrees": trees, "paramMap": about["paramMap"] | own, "uid": clf.uid}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = spark.read.parquet(f"{empty}/treesMetadata")
    _, text, _ = each.first()
    tree = json.loads(text)
    tree["paramMap"] |= {"labelCol": p["labelCol"], "featuresCol": p["featuresCol"]}
    weight = lambda t: 1.0 if forest or not t else float(p["stepSize"])
    rows = [(t, json.dumps(tree | {"uid": f"{tree['uid']}_{t}"}), weight(t)) for t in range(trees)]
    spark.createDataFrame(rows, each.schema).coalesce(1).write.parquet(f"{path}/treesMetadata")
    return (RandomForestClassificationModel if forest else GBTClassificationModel).load(path)


def search(kind_of: type, folds: list[Cells], points: list[dict], spark: SparkSession) -> DataFrame:
    """(fold, point, tp, fp, tn, fn): the counts on the held-out rows of each
    fold by ensembles of all ``points`` (settings of a classifier). Points
    that differ in size or, in a forest, depth only share their trees: an
    ensemble's first k trees are that of size k, and a tree that ends at a
    depth is the deeper one, cut there. A task grows trees and sends the sums
    of what they say on the held-out cells."""
    forest = kind_of is RandomForestClassifier
    size, free = "numTrees" if forest else "maxIter", {"numTrees", "maxDepth"} if forest else {"maxIter"}
    shared: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        # alone, a tree has no bag and all features
        shared.setdefault((tuple(sorted((k, v) for k, v in p.items() if k not in free)), forest and p["numTrees"] == 1), []).append(i)
    groups, jobs = list(shared.values()), []
    for g, own in enumerate(groups):
        stops = sorted({points[i][size] for i in own})
        ends = sorted({*stops, *range(0, stops[-1], CHUNK)}) if forest else [0, stops[-1]]
        ends = ends if ends[0] == 0 else [0, *ends]
        jobs += [(f, g, a, b) for a, b in zip(ends, ends[1:]) for f in range(len(folds))]
    held = spark.sparkContext.broadcast([(c, np.flatnonzero(c.h0 + c.h1)) for c in folds])

    def counts(yes: np.ndarray, c: Cells, at: np.ndarray) -> list[int]:
        return [int(x) for x in (c.h1[at][yes].sum(), c.h0[at][yes].sum(), c.h0[at][~yes].sum(), c.h1[at][~yes].sum())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for job in (k for b in batches for k in b["id"].to_pylist()):
            f, g, a, b = jobs[job]
            c, at = held.value[f]
            own = [points[i] for i in groups[g]]
            if forest:
                depths = tuple(sorted({p["maxDepth"] for p in own}))
                total = np.zeros((len(depths), len(at)))
                deep = own[0] | {"maxDepth": depths[-1]}
                for t in range(a, b):
                    tree, ends = _forest_tree(c, t, deep, held=c.bins[:, at], marks=depths)
                    share = tree.sums[1] / (tree.sums[0] + tree.sums[1])
                    for k, (d, end) in enumerate(zip(depths, ends)):
                        total[k] += share[merged(tree, tree.sums[1] > tree.sums[0], d)[0][end]]
                for d, sums in zip(depths, total):
                    yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([g], pa.int32()), pa.array([d], pa.int32()), pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([sums], pa.list_(pa.float64()))], list(names))
            else:
                deep = own[0] | {"maxIter": b}
                for t, (_, margin) in enumerate(_boosted(c, deep), 1):
                    if any(p["maxIter"] == t for p in own):
                        yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([g], pa.int32()), pa.array([deep["maxDepth"]], pa.int32()), pa.array([0], pa.int32()), pa.array([t], pa.int32()), pa.array([margin[at]], pa.list_(pa.float64()))], list(names))

    def told(key: tuple, part: pa.Table) -> pa.Table:
        f, g, d = (k.as_py() for k in key)
        c, at = held.value[f]
        sums, out = np.zeros(len(at)), []
        for end, row in sorted(zip(part["upto"].to_pylist(), range(part.num_rows))):
            own = part["sums"][row].values.to_numpy()
            sums = sums + own if forest else own
            yes = 2 * sums > end if forest else sums > 0
            out += [dict(zip(kind.names, (f, i, *counts(yes, c, at)))) for i in groups[g] if points[i][size] == end and points[i]["maxDepth"] == d]
        return pa.Table.from_pylist(out, kind)

    names = ("fold", "shared", "depth", "since", "upto", "sums")
    kind = pa.schema([("fold", pa.int32()), ("point", pa.int32()), *[(c, pa.int64()) for c in ("tp", "fp", "tn", "fn")]])
    sent = spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, "fold int, shared int, depth int, since int, upto int, sums array<double>")
    return sent.groupBy("fold", "shared", "depth").applyInArrow(told, "fold int, point int, tp long, fp long, tn long, fn long")
