"""Training, model selection and retraining (MO3-MO10) on Spark ML.

Features and label stay in one DataFrame (no index alignment). Folds for
cross-validation come from a key hash, so they do not depend on
partitioning. Candidate fits are Spark ML jobs; ``parallelism`` runs grid
points concurrently from driver threads (each fit is itself distributed).

A fit reads its rows once a tree level, so they are written once, with the
columns used only, and dealt into enough tasks (``written_rows``). Trees see
nothing of a row but its label and the bin of each feature; from ``COUNT_FROM``
rows on they are fitted on counted cells (``counted.py``): at most
bins^features, never more than rows. Where cells are too many for a task,
boosted trees are Spark's on distinct (label, bins), weighted by their rows
(``_fit_counted``), and forests are Spark's on all rows.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import q
from ..session import cut_lineage, scratch_path
from . import counted
from .evaluate import binary_metrics, binary_metrics_of_counts, positive_probability, roc_auc
from .split import key_hash

SEED = 42
#: Rows a task of a fit gets at most.
TASK_ROWS = 100_000
FOREST_TASK_ROWS = 1_000_000
#: Rows from which trees are fitted on counted cells.
COUNT_FROM = 500_000
#: Bins of a feature, as the classifiers have them unless told otherwise.
BINS = 32


def assembler(feature_cols: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=feature_cols, outputCol=out, handleInvalid="keep")


def plain_rows(data: DataFrame, cols: list[str]) -> DataFrame:
    """``cols`` of ``data``, written once."""
    spark, kept = data.sparkSession, data.select(*[q(c) for c in cols])
    path = scratch_path(spark, f"rows-{uuid.uuid4().hex}")
    kept.write.parquet(path)
    return spark.read.schema(kept.schema).parquet(path)


def dealt(out: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """More than ``task_rows`` rows are dealt into tasks of about as many, at
    least one a core."""
    n = out.count()
    return out if n <= min(task_rows, TASK_ROWS) else out.repartition(max(math.ceil(n / task_rows), out.sparkSession.sparkContext.defaultParallelism))


def written_rows(data: DataFrame, cols: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """``cols`` of ``data``, written once and dealt into tasks."""
    return dealt(plain_rows(data, cols), task_rows)


def make_classifier(kind: str, label: str = "label", **params):
    """MO3-MO5: 'random_forest' (100 trees, depth 10), 'gradient_boosting'
    (100 rounds, step 0.1, depth 3) and 'boosting_depth6' (the second-order
    boosting stand-in: logistic loss, depth 6). Any default can be overridden."""
    if kind == "random_forest":
        base = dict(numTrees=100, maxDepth=10, seed=SEED)
        cls = RandomForestClassifier
    elif kind == "gradient_boosting":
        base = dict(maxIter=100, stepSize=0.1, maxDepth=3, seed=SEED, lossType="logistic")
        cls = GBTClassifier
    elif kind == "boosting_depth6":
        base = dict(maxIter=100, stepSize=0.1, maxDepth=6, seed=SEED, lossType="logistic")
        cls = GBTClassifier
    else:
        raise KeyError(f"unknown classifier {kind!r}")
    base.update(params)
    return cls(labelCol=label, featuresCol="features", **base)


def f1_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    """F1 of the positive class (not the weighted F1)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def grid_for(kind: str, clf, which: str = "local"):
    """MO7 grids. 'local': one point per model; 'cloud': 27 points each.
    Unlimited depth maps to 30 (Spark's maximum); the minimum split size has
    no exact twin and maps to ``minInstancesPerNode`` (an approximation)."""
    b = ParamGridBuilder()
    if which == "cloud":
        if kind == "random_forest":
            b = b.addGrid(clf.numTrees, [100, 200, 300]).addGrid(clf.maxDepth, [30, 10, 20]).addGrid(
                clf.minInstancesPerNode, [2, 5, 10])
        else:
            b = b.addGrid(clf.maxDepth, [3, 5, 7]).addGrid(clf.stepSize, [0.1, 0.01, 0.001]).addGrid(
                clf.maxIter, [100, 200, 300])
    elif which == "local":
        if kind == "random_forest":
            b = b.addGrid(clf.numTrees, [clf.getNumTrees()]).addGrid(clf.maxDepth, [clf.getMaxDepth()])
        else:
            b = b.addGrid(clf.maxIter, [clf.getMaxIter()]).addGrid(clf.stepSize, [clf.getStepSize()])
    return b.build()


def with_folds(df: DataFrame, key_cols: list[str], folds: int = 3, seed: int = SEED, out: str = "fold") -> DataFrame:
    """Deterministic fold id from the key hash."""
    return df.withColumn(out, F.pmod(F.conv(F.substring(key_hash(key_cols, seed), 1, 8), 16, 10).cast("bigint"),
                                     F.lit(folds)).cast("int"))


@dataclass
class CandidateResult:
    name: str
    ok: bool
    metrics: dict = field(default_factory=dict)
    best_params: dict = field(default_factory=dict)
    error: str | None = None
    model: object | None = None


def cross_validate(kind: str, train: DataFrame, feature_cols: list[str], label: str = "label", grid: str = "local",
                   folds: int = 3, parallelism: int = 2, key_cols: list[str] | None = None, cells: list[counted.Cells] | None = None, **params):
    """MO6: grid search, k-fold CV scored by F1 of class 1, refit on the best
    point; on ``cells`` (of all rows, then by fold) if they are given."""
    clf = make_classifier(kind, label, **params)
    if cells and counted.handled(clf) and clf.getMaxBins() == BINS:
        maps = [{p.name: v for p, v in m.items()} for m in grid_for(kind, clf, grid)]
        means = [sum(f) / len(f) for f in counted_f1(kind, cells[1:], [{**params, **m} for m in maps], train.sparkSession)]
        best = maps[max(range(len(maps)), key=lambda i: means[i])]
        best_clf = make_classifier(kind, label, **{**params, **best})
        return PipelineModel([assembler(feature_cols), counted.fit(best_clf, cells[0], train.sparkSession)]), best, means
    pipe = Pipeline(stages=[assembler(feature_cols), clf])
    grid_maps = grid_for(kind, clf, grid)
    data = with_folds(train, key_cols, folds) if key_cols else train
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid_maps, evaluator=f1_evaluator(label),
                        numFolds=folds, parallelism=parallelism, seed=SEED,
                        **({"foldCol": "fold"} if key_cols else {}))
    model = cv.fit(data)
    best_i = max(range(len(model.avgMetrics)), key=lambda i: model.avgMetrics[i])
    best = {p.name: v for p, v in grid_maps[best_i].items()}
    return model, best, list(model.avgMetrics)


def counted_f1(kind: str, folds: list[counted.Cells], points: list[dict], spark) -> list[list[float]]:
    """F1 of class 1 of each point of a grid on each fold, from counted cells."""
    settings = [counted._settings(make_classifier(kind, **p)) for p in points]
    counts = counted.search(type(make_classifier(kind)), folds, settings, spark)
    got = {(r["fold"], r["point"]): r["f1"] for r in binary_metrics_of_counts(counts, "fold", "point").collect()}  # folds x points rows
    return [[got[f, i] for f in range(len(folds))] for i in range(len(points))]


def evaluate_candidates(train: DataFrame, test: DataFrame, feature_cols: list[str], label: str = "label",
                        candidates: dict[str, dict] | None = None, grid: str = "local", folds: int = 3,
                        key_cols: list[str] | None = None, parallelism: int = 2, count_from: int | None = None) -> tuple[list[CandidateResult], CandidateResult]:
    """MO8: each candidate in isolation (a failure is recorded, not raised),
    metrics on the held-out frame as queries, best by strict F1 > 0.0. From
    ``count_from`` rows on, all candidates are fitted on cells counted once."""
    candidates = candidates or {"random_forest": {}, "gradient_boosting": {}, "boosting_depth6": {}}
    # several fits read one frame, several metrics the other: cut the plans once
    rows = plain_rows(train, list(dict.fromkeys([*feature_cols, label, *(key_cols or [])])))
    test = cut_lineage(test.select(*[q(c) for c in dict.fromkeys([*feature_cols, label])]))
    many = bool(key_cols and feature_cols) and rows.count() >= max(1, COUNT_FROM if count_from is None else count_from)
    cells = counted.count_cells(with_folds(rows, key_cols, folds), feature_cols, label, BINS, folds) if many else None
    train = dealt(rows)
    results: list[CandidateResult] = []
    best, best_f1 = None, 0.0
    for name, params in candidates.items():
        try:
            model, best_params, _ = cross_validate(name, train, feature_cols, label, grid, folds, parallelism, key_cols, cells,
                                                   **params)
            pred = positive_probability(model.transform(test)).select(q(label), F.col("prediction").cast("int").alias("prediction"), "p1")
            pred = cut_lineage(pred)  # scored once for all metrics
            m = binary_metrics(pred.withColumn(label, q(label).cast("int")), label).first().asDict()
            m["roc_auc"] = roc_auc(pred, label, "p1").first()["auc"]
            r = CandidateResult(name, True, m, best_params, model=model)
            if m["f1"] > best_f1:
                best, best_f1 = r, m["f1"]
        except Exception as e:  # noqa: BLE001 - isolate each candidate, as the reference does
            r = CandidateResult(name, False, error=f"{type(e).__name__}: {e}")
        results.append(r)
    if not any(r.ok for r in results):
        raise ValueError("No models were successfully evaluated.")
    return results, best


def results_frame(spark, results: list[CandidateResult]) -> DataFrame:
    """Candidate metrics as a table (run_name, metric, value)."""
    rows = [(r.name, k, float(v)) for r in results if r.ok for k, v in r.metrics.items()
            if isinstance(v, (int, float)) and not (isinstance(v, float) and math.isnan(v))]
    return spark.createDataFrame(rows, "run_name string, metric string, value double")


def retrain(kind: str, data: DataFrame, feature_cols: list[str], label: str = "label", params: dict | None = None,
            count_from: int | None = None, written: bool = False):
    """MO9: refit the winner on all rows with its best parameters. ``written``
    says that ``data`` has many rows and is cheap to read again."""
    clf = make_classifier(kind, label, **(params or {}))
    least = max(1, COUNT_FROM if count_from is None else count_from)
    # a task of a forest sends sums for every node of a level of all trees, so it has few tasks
    task_rows = FOREST_TASK_ROWS if kind == "random_forest" else TASK_ROWS
    rows = data if written else plain_rows(data, [*feature_cols, label])
    many = bool(feature_cols) and (written or rows.count() >= least)
    cells = counted.count_cells(rows, feature_cols, label, clf.getMaxBins()) if many and counted.handled(clf) else None
    if cells:
        return PipelineModel([assembler(feature_cols), counted.fit(clf, cells[0], data.sparkSession)])
    rows = dealt(plain_rows(data, [*feature_cols, label]) if written else rows, task_rows)
    if many and kind != "random_forest":
        return _fit_counted(clf, rows, feature_cols, label)
    return Pipeline(stages=[assembler(feature_cols), clf]).fit(rows)


def split_points(rows: DataFrame, feature_cols: list[str], bins: int) -> list[list[float]]:
    """Thresholds between the bins of each feature (a value equal to one lies
    below it): halfway between neighbours where a feature has at most ``bins``
    values, else its approximate quantiles. At most ``bins`` numbers a feature
    reach the driver, or 2 x ``bins`` values of one that has few."""
    value = [q(c).cast("double") for c in feature_cols]
    value = [F.when(~F.isnan(v), v) for v in value]
    probs = [(i + 1) / bins for i in range(bins - 1)]
    row = rows.agg(*[f(v).alias(f"{k}{i}") for i, v in enumerate(value) for k, f in (("n", F.approx_count_distinct), ("e", lambda v: F.percentile_approx(v, probs, 10_000)))]).first()
    few = [i for i in range(len(value)) if 0 < row[f"n{i}"] <= 2 * bins]
    own = rows.agg(*[F.collect_set(value[i]).alias(f"v{i}") for i in few]).first() if few else None
    out = []
    for i in range(len(value)):
        known = sorted(set(own[f"v{i}"])) if i in few else []
        if 0 < len(known) <= bins:
            out.append([a + (b - a) / 2 if math.isfinite(b - a) else a for a, b in zip(known, known[1:])])
        else:
            out.append(sorted(set(row[f"e{i}"] or [])))
    return out


def _fit_counted(clf, rows: DataFrame, feature_cols: list[str], label: str) -> PipelineModel:
    """Fit boosted trees on distinct (label, bins) with their counts as
    weights. Trees split bins; a bucketizer ahead of them, part of the model,
    finds a row's bins. Null, NaN and infinite values are errors in a fit, as
    they are without counting; in scoring null and NaN go right."""
    names = [f"__bin{i}" for i in range(len(feature_cols))]
    points = split_points(rows, feature_cols, clf.getMaxBins() - 1)
    # a bucket is closed on its left, a tree's side on its right: raise each threshold to the next number
    splits = [[-math.inf, *sorted({math.nextafter(p, math.inf) for p in own} - {math.inf, -math.inf}), math.inf] for own in points]
    splits = [s if len(s) > 2 else [-math.inf, 0.0, math.inf] for s in splits]
    binner = Bucketizer(inputCols=feature_cols, outputCols=names, splitsArray=splits, handleInvalid="keep")
    known = rows.select(q(label), *[F.when(F.abs(q(c).cast("double")) < math.inf, q(c).cast("double")).alias(c) for c in feature_cols])
    counted = binner.transform(known).groupBy(q(label), *names).agg(F.count(F.lit(1)).cast("double").alias("__rows"))
    cells = written_rows(counted, [label, *names, "__rows"])
    # trees must not take bins for unordered categories, as the bucketizer's column metadata has it
    codes = [f"__code{i}" for i in range(len(names))]
    plain = SQLTransformer(statement=f"SELECT *, {', '.join(f'{b} + 0.0D AS {c}' for b, c in zip(names, codes))} FROM __THIS__")
    fitted = Pipeline(stages=[plain, assembler(codes), clf.copy().setWeightCol("__rows")]).fit(cells)
    return PipelineModel([binner, *fitted.stages])
