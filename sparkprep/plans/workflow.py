"""End-to-end training workflow (MO10): prepare -> drift -> evaluate ->
retrain -> persist -> register, with runs and metrics logged as tables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import drift as D
from ..operators import registry_tables as R
from ..operators import split as S
from ..operators import train as T
from ..session import cut_lineage
from .features import FeatureEngineer, FeatureSpec


@dataclass(frozen=True)
class JobConfig:
    """IO9: the parameters of a training job, typed, with defaults."""

    label: str = "converted"
    test_fraction: float = 0.2
    folds: int = 3
    seed: int = 42
    experiment: str = "lead_scoring"
    model_name: str = "best_model"
    base_path: str = ""

    @classmethod
    def of(cls, values: Mapping[str, str]) -> "JobConfig":
        """From name -> text pairs (job arguments); an unknown name is an error."""
        known = {f.name: f for f in fields(cls)}
        unknown = sorted(set(values) - set(known))
        if unknown:
            raise ValueError(f"unknown parameters: {unknown}")
        return cls(**{k: type(known[k].default)(v) for k, v in values.items()})


def build_and_train(df: DataFrame, spec: FeatureSpec, key_cols: list[str], base: str,
                    candidates: dict[str, dict] | None = None, model_name: str = "best_model",
                    fit_scope: str = "train", folds: int = 3, experiment: str = "lead_scoring") -> dict:
    """MO10. ``fit_scope='train'`` (default) fits the feature model on the
    training rows only; ``'full'`` reproduces fitting on all rows before the
    split (D7). Returns a summary dict; all artefacts live under ``base``."""
    C.require_non_empty(df)
    C.require_columns(df, [spec.target])
    label = spec.target
    flagged = S.stratified_split(df, label, key_cols, 0.2, 42)
    train_raw, test_raw = S.split_frames(flagged)
    fm = FeatureEngineer(spec).fit(df if fit_scope == "full" else train_raw)
    # both are read many times below: by drift, by every candidate's folds, by evaluation
    train = cut_lineage(fm.transform(train_raw).withColumn(label, F.col(label).cast("double")))
    test = cut_lineage(fm.transform(test_raw).withColumn(label, F.col(label).cast("double")))
    feats = [c for c in train.columns if c != label and c not in key_cols]

    # drift train vs test, logged as metrics (DR1, DR8, IO13)
    per_col = D.column_drift(train.select(*feats), test.select(*feats), feats)
    drift_run = R.new_run_id()
    R.log_metrics_frame(D.drift_metrics(per_col), base, "train_vs_test_drift", drift_run, "drift")

    results, best = T.evaluate_candidates(train, test, feats, label, candidates, folds=folds, key_cols=key_cols)
    for r in results:
        run = R.new_run_id()
        if r.ok:
            R.log_metrics(train.sparkSession, base, experiment, run, f"Candidate_{r.name}", r.metrics)
            R.log_params(train.sparkSession, base, experiment, run, f"Candidate_{r.name}", r.best_params)
        else:
            R.log_params(train.sparkSession, base, experiment, run, f"Candidate_{r.name}", {"error": r.error})
    if best is None:
        raise ValueError("no candidate reached F1 > 0; nothing to retrain")

    # retrain on all rows with the best parameters (MO9), persist, register (IO10, IO11)
    all_rows = fm.transform(df).withColumn(label, F.col(label).cast("double"))
    params = {**(candidates.get(best.name, {}) if candidates else {}), **best.best_params}
    final = T.retrain(best.name, all_rows, feats, label, params)
    run = R.new_run_id()
    model_path = os.path.join(base, "models", run)
    fm.write().overwrite().save(os.path.join(model_path, "features"))
    final.write().overwrite().save(os.path.join(model_path, "classifier"))
    version = R.register_model(df.sparkSession, base, model_name, model_path, run)
    R.log_metrics(df.sparkSession, base, experiment, run, f"Final_{best.name}_FullData", {"final_f1_score": best.metrics["f1"]})
    return {"best": best.name, "f1": best.metrics["f1"], "version": version, "model_path": model_path,
            "candidates": {r.name: (r.metrics if r.ok else r.error) for r in results}}


def load_latest(spark, base: str, model_name: str = "best_model"):
    """IO11 + IO12: (feature model, classifier) of the latest registered version."""
    from pyspark.ml import PipelineModel

    from .features import FeatureModel

    found = R.latest_model_path(spark, base, model_name)
    if found is None:
        raise FileNotFoundError(f"no registered model {model_name!r} under {base}")
    _, path = found
    return FeatureModel.load(os.path.join(path, "features")), PipelineModel.load(os.path.join(path, "classifier"))


def load_scoring_model(spark, base: str, path: str | None = None, model_name: str = "best_model"):
    """IO12: the model stored at ``path`` if it exists, else the latest registered version."""
    from pyspark.ml import PipelineModel

    from ..sources.tables import path_exists
    from .features import FeatureModel

    if path and path_exists(spark, os.path.join(path, "classifier")):
        return FeatureModel.load(os.path.join(path, "features")), PipelineModel.load(os.path.join(path, "classifier"))
    return load_latest(spark, base, model_name)
