"""Model explanation (EX1, EX2).

EX1 reads the fitted trees' impurity importances, or measures how much a
score falls when a feature's values are permuted. EX2 is exact in
``attribution.py``; here it re-aims per-row
additive attributions as sampled Shapley values computed by Spark: each
row fans out to ``permutations x (features + 1)`` feature-mixing variants
(a fixed fan-out, not a pairing of rows), the fitted model scores all
variants, and one aggregation by row averages the marginal contributions. Per permutation the contributions telescope, so
``base_value + sum(contributions) = score`` holds exactly per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.exprs import q
from . import attribution as A
from .bind import number_rows
from .evaluate import positive_probability
from .split import key_hash
from .train import written_rows
from .tuning import _Tree


def feature_importance(pipeline_model, feature_cols: list[str]) -> DataFrame:
    """EX1: (feature, importance, rank) from the last stage's ``featureImportances``."""
    clf = pipeline_model.stages[-1]
    imp = clf.featureImportances.toArray().tolist()
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    rows = sorted(zip(feature_cols, imp), key=lambda t: -t[1])
    return s.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)], "feature string, importance double, rank int")


def permutation_importance(df: DataFrame, predict: Callable[[DataFrame], DataFrame], key: list[str], feature_cols: list[str],
                           label: str = "label", metric: str = "accuracy", seed: int = 42) -> DataFrame:
    """EX1: (feature, base, permuted, importance, rank): the metric
    ("accuracy" or "f1" of class 1) of ``predict``, and of ``predict`` with
    one feature permuted; importance is their difference.

    Rows are put in the order of a hash of ``key`` and ``seed`` by a
    distributed sort (then key, features and label), and each takes the feature's value of the next one (the
    last one that of the first): a permutation without a fixed place, the same
    for every feature. ``predict`` gets all variants of ``df``'s key, label and
    features in one frame and adds ``prediction``. An empty frame gives nulls."""
    rows = df.select(F.struct(*[q(c) for c in key]).alias("__key"), key_hash(key, seed).alias("__hash"), q(label).alias("__label"), F.struct(*[q(c) for c in feature_cols]).alias("__x"))
    rows = number_rows(rows, [F.col("__hash"), F.col("__key"), F.col("__x"), F.col("__label")], "__no")
    n = rows.count()
    donors = rows.select(F.pmod(F.col("__no") - 1, F.lit(max(1, n))).alias("__no"), F.col("__x").alias("__y"))
    variant = lambda i: F.struct(F.lit(i).alias("__variant"), *[F.col(f"__{'y' if j == i else 'x'}").getField(c).alias(c) for j, c in enumerate(feature_cols)])
    fan = rows.join(donors, "__no").select("__key", "__label", F.inline(F.array(*[variant(i) for i in range(-1, len(feature_cols))])))
    names = [c for c in key if c not in feature_cols]
    scored = predict(fan.select("__variant", *[F.col("__key").getField(c).alias(c) for c in names], F.col("__label").alias(label), *feature_cols))
    p, y = F.col("prediction").cast("int"), q(label).cast("int")
    hits = F.sum(((p == 1) & (y == 1)).cast("long"))
    score = {"accuracy": F.sum((p == y).cast("long")) / F.count("*"), "f1": F.try_divide(2 * hits, F.sum(p) + F.sum(y))}[metric]
    got = scored.groupBy("__variant").agg(score.cast("double").alias("score"))
    got = got.agg(F.map_from_entries(F.collect_list(F.struct("__variant", "score"))).alias("m"))  # a row a feature
    each = F.transform(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("feature")) for i, c in enumerate(feature_cols)]), lambda x: F.struct(
        (F.try_element_at("m", x["i"]) - F.try_element_at("m", F.lit(-1))).alias("less"), x["feature"].alias("feature"), F.try_element_at("m", x["i"]).alias("permuted")))
    out = got.select(F.try_element_at("m", F.lit(-1)).alias("base"), F.posexplode(F.array_sort(each)))
    return out.select("col.feature", "base", "col.permuted", (-F.col("col.less")).alias("importance"), (F.col("pos") + 1).alias("rank"))


def sampled_shapley(model, df: DataFrame, key: str, feature_cols: list[str], background: DataFrame,
                    permutations: int = 8, seed: int = 42, max_background: int = 10_000) -> DataFrame:
    """EX2: (key, feature, contribution) plus a ``__base__`` row per key.

    ``background`` must be small (its size is checked; it is broadcast): for
    each (row, permutation) one background row is picked by hash; features
    are switched from background to row values in a permutation order drawn
    from a hash of (row, permutation). Rows that share a key are averaged.

    All variants of a row are scored and taken together before anything is
    shuffled: those of a tree ensemble over ``feature_cols`` in Arrow batches,
    those of any other model by its ``transform``."""
    d = len(feature_cols)
    bg = background.select(*[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(feature_cols)]).limit(max_background + 1)
    known = sorted((tuple(r) for r in bg.collect()), key=lambda r: [(v is not None, v != v, v if v == v else 0.0) for v in r])  # nulls first, NaN last
    if not known:
        raise ValueError("empty background frame")
    if len(known) > max_background:
        raise ValueError(f"background frame too large to broadcast; pass a sample of at most {max_background} rows")
    rows = df.select(q(key).alias("__key"), *[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(feature_cols)])
    rows = written_rows(rows, rows.columns)  # scored in as many tasks as its rows take
    pick = lambda p: F.pmod(F.xxhash64(F.col("__key"), p, F.lit(seed)), F.lit(len(known))).cast("int")
    # a permutation has the features in the order of a hash of (key, permutation, feature)
    ranks = lambda p: F.array_sort(F.array(*[F.struct(F.xxhash64(F.col("__key"), p, F.lit(seed), F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(d)]))
    order = lambda p: F.transform(ranks(p), lambda s: s["i"])
    ensemble = _tree_ensemble(model, feature_cols)
    if ensemble is not None:
        each = [F.lit(p) for p in range(permutations)]
        drawn = rows.select("*", F.array(*[pick(p) for p in each]).alias("__b"), F.flatten(F.array(*[order(p) for p in each])).alias("__order"))
        work = _Variants(ensemble, isinstance(model.stages[-1], RandomForestClassificationModel), np.array(known, float), d, permutations)
        got = drawn.mapInArrow(work.run, StructType([rows.schema["__key"], *[StructField(f"c{i}", DoubleType()) for i in range(d + 1)]]))
        got = got.groupBy("__key").agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(d + 1)])
    else:
        got = _scored_variants(model, rows, feature_cols, known, permutations, pick, order)
    parts = [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("contribution")) for i, c in enumerate([*feature_cols, "__base__"])]
    return got.select(F.col("__key").alias(key), F.inline(F.array(*parts)))


def _tree_ensemble(model, feature_cols: list[str]) -> A.Ensemble | None:
    """The trees of a fitted pipeline that puts ``feature_cols`` into a forest
    or boosted trees, as ``train.retrain`` makes it; None for another model."""
    stages = getattr(model, "stages", [])
    if not stages or not isinstance(stages[-1], (GBTClassificationModel, RandomForestClassificationModel)):
        return None
    if [type(s) for s in stages[:-1]] not in ([VectorAssembler], [Bucketizer, SQLTransformer, VectorAssembler]) or stages[0].getInputCols() != feature_cols:
        return None
    try:
        return A.spark_ensemble(model)
    except ValueError:  # splits on categories
        return None


class _Variants:
    """Contributions of rows by a tree ensemble. A tree's splits are bits of
    a number, 1 for the right side; switching a feature from background to row
    exchanges the bits of its splits, and a table of the tree gives the value
    that the bits lead to. Trees of more than 8 splits are walked instead."""

    def __init__(self, ensemble: A.Ensemble, votes: bool, background: np.ndarray, d: int, permutations: int):
        self.d, self.permutations, self.background, self.base = d, permutations, background, ensemble.base
        self.logistic, self.walked, self.splits, masks, tables = not votes, [], [], [], []
        for nodes, weight in zip(ensemble.trees, ensemble.weights):
            inner = [i for i, n in enumerate(nodes) if n.feature >= 0]
            if len(inner) > 8:
                self.walked.append((nodes, weight))
                continue
            bit, pattern = {k: j for j, k in enumerate(inner)}, np.arange(256)
            at = np.zeros(len(pattern), int)
            for _ in inner:
                for k in inner:
                    here = at == k
                    at[here] = np.where(pattern[here] >> bit[k] & 1, nodes[k].right, nodes[k].left)
            self.splits.append([(j, nodes[k]) for k, j in bit.items()])
            masks.append([sum(1 << j for k, j in bit.items() if nodes[k].feature == i) for i in range(d)])
            tables.append(np.array([nodes[k].value for k in at]) * weight)
        self.masks = np.ascontiguousarray(np.array(masks, np.uint8).reshape(-1, d).T)  # (features, trees)
        self.table = np.concatenate([*tables, np.zeros(0)])
        self.first = np.arange(len(tables), dtype=np.intp) * 256

    def _bits(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the sides that ``x`` takes at each tree's splits."""
        out = np.zeros((len(x), len(self.splits)), np.uint8)
        for t, splits in enumerate(self.splits):
            for j, s in splits:
                v = x[:, s.feature]
                right = ~(v <= s.threshold) if not s.missing_left else v > s.threshold
                out[:, t] |= right.astype(np.uint8) << np.uint8(j)
        return out

    def _probability(self, total: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-2 * total)) if self.logistic else total

    def values(self, x: np.ndarray, picked: np.ndarray, order: np.ndarray) -> np.ndarray:
        """(rows, features + 1): contributions of ``x``, then the base; ``picked``
        and ``order`` have a row's background and features by permutation."""
        n, row = len(x), np.arange(len(x))
        own, other = self._bits(x), self._bits(self.background)
        walked = [(_Tree(t), w) for t, w in self.walked]
        out = np.zeros((n, self.d + 1))
        for p in range(self.permutations):
            at, mixed, before = other[picked[:, p]], self.background[picked[:, p]], None
            for s in range(self.d + 1):
                feature = order[:, p, s - 1] if s else None
                if s:
                    mixed[row, feature] = x[row, feature]
                    at ^= (at ^ own) & self.masks[feature]
                total = self.base + self.table.take(at + self.first).sum(axis=1)
                for tree, weight in walked:
                    total += tree.reached(mixed) * weight
                score = self._probability(total)
                if s:
                    out[row, feature] += score - before
                else:
                    out[:, self.d] += score
                before = score
        return out / self.permutations

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["__key", *[f"c{i}" for i in range(self.d + 1)]]
        for batch in batches:
            x = np.stack([batch[f"x{i}"].to_numpy(zero_copy_only=False).astype(float) for i in range(self.d)], axis=1)
            picked = batch["__b"].flatten().to_numpy().reshape(len(x), self.permutations)
            order = batch["__order"].flatten().to_numpy().reshape(len(x), self.permutations, self.d)
            # some rows at a time, so that their arrays (rows x trees) stay in the processor's cache
            got = np.concatenate([self.values(x[i:i + 1000], picked[i:i + 1000], order[i:i + 1000]) for i in range(0, len(x), 1000)] or [np.zeros((0, self.d + 1))])
            yield pa.RecordBatch.from_arrays([batch["__key"], *[pa.array(np.ascontiguousarray(c)) for c in got.T]], names)


def _scored_variants(model, rows: DataFrame, feature_cols: list[str], known: list[tuple], permutations: int, pick, order) -> DataFrame:
    """(__key, c0, c1, ..., base last) by the model's ``transform``: step s of
    a permutation has its first s features from the row. The score of a step
    counts for the feature just switched and against the next one, so all of
    them are sums over the key's variants, added up before they are shuffled."""
    d, spark = len(feature_cols), rows.sparkSession
    bg = spark.createDataFrame([(b, *r) for b, r in enumerate(known)], ", ".join(["__b int", *[f"b{i} double" for i in range(d)]]))
    perms = rows.withColumn("__p", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    perms = perms.withColumn("__b", pick(F.col("__p"))).join(F.broadcast(bg), "__b").withColumn("__order", order(F.col("__p")))
    steps = perms.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(d))))
    # a feature takes the row's value when its position in the permutation is at most the step
    mixed = steps.select("__key", "__s", "__order", *[
        F.when(F.array_position(F.col("__order"), F.lit(i)) <= F.col("__s"), F.col(f"x{i}")).otherwise(F.col(f"b{i}")).alias(c) for i, c in enumerate(feature_cols)])
    scored = positive_probability(model.transform(mixed)).select(
        "__key", "__s", "p1", F.try_element_at("__order", F.greatest("__s", F.lit(1))).alias("__now"), F.try_element_at("__order", F.col("__s") + 1).alias("__next"))
    first = F.col("__s") == 0
    share = lambda i: F.when(~first & (F.col("__now") == i), F.col("p1")).otherwise(0.0) - F.when(F.col("__next") == i, F.col("p1")).otherwise(0.0)
    return scored.groupBy("__key").agg(*[(F.sum(share(i)) / F.count_if(first)).alias(f"c{i}") for i in range(d)], F.avg(F.when(first, F.col("p1"))).alias(f"c{d}"))
