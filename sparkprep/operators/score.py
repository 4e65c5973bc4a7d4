"""Batch scoring (SC1) and scoring with drift in one run (SC2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import q
from .evaluate import positive_probability


def score(raw: DataFrame, feature_model, classifier_model, key: str, keep_raw: bool = True) -> DataFrame:
    """SC1: transform the raw rows with the fitted feature model and the
    classifier; attach ``prediction`` and ``probability_1`` to the raw row
    by key (features and raw columns come from the same row; the join is
    only needed because the feature model may dedupe)."""
    feats = feature_model.transform(raw)
    pred = positive_probability(classifier_model.transform(feats)).select(
        q(key), F.col("prediction").cast("int").alias("prediction"), F.col("p1").alias("probability_1"))
    if not keep_raw:
        return pred
    return raw.join(pred, key, "left")


def score_with_drift(raw: DataFrame, reference: DataFrame, feature_model, classifier_model, key: str,
                     drift_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """SC2: (scored rows, per-column drift, drift metrics as (metric, value))."""
    from .drift import column_drift, drift_metrics

    scored = score(raw, feature_model, classifier_model, key)
    cols = drift_cols or [c for c in reference.columns if c in set(raw.columns) and c != key]
    per_col = column_drift(reference, raw, cols)
    return scored, per_col, drift_metrics(per_col)
