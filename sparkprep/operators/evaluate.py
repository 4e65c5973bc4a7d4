"""Binary-classification metrics as queries over (label, prediction, score)
(EV1-EV6). Every metric is one aggregation; the ROC curve pre-aggregates by
distinct score and uses bucketed running sums (no single-task window)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import q
from ..functions.ordered import running_sums


def _counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = q(label).cast("int"), q(pred).cast("int")
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def _safe_div(a: Column, b: Column) -> Column:
    """0 when undefined (the zero-division default of the metric functions)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary_metrics_of_counts(c: DataFrame, *keep: str) -> DataFrame:
    """EV1 + EV2 from rows of confusion counts (tp, fp, tn, fn), with the columns ``keep``."""
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(
        *keep, "tp", "fp", "tn", "fn",
        _safe_div(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        _safe_div(F.lit(2) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """EV1 + EV2: accuracy, precision, recall, f1 of class 1, and the counts."""
    return binary_metrics_of_counts(_counts(df, label, pred))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """EV3: the zero-filled 2x2 matrix as rows (actual, predicted, count)."""
    c = _counts(df, label, pred)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(n).alias("count")) for a, p, n in cells
    ])).alias("c")).select("c.*")


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """EV5: one point per distinct score (descending threshold): threshold,
    tp, fp, tpr, fpr, plus per-score positives/negatives."""
    y = q(label).cast("int")
    per = df.groupBy(q(score).cast("double").alias("threshold")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    tot = df.agg(F.count_if(y == 1).alias("P"), F.count_if(y == 0).alias("N")).first()
    cum = running_sums(per, "threshold", {"tp": F.col("pos"), "fp": F.col("neg")}, descending=True)
    return cum.select(
        "threshold", "pos", "neg", F.col("cum_tp").alias("tp"), F.col("cum_fp").alias("fp"),
        _safe_div(F.col("cum_tp"), F.lit(tot["P"])).alias("tpr"), _safe_div(F.col("cum_fp"), F.lit(tot["N"])).alias("fpr"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """EV4: area under the ROC curve (trapezoids; tied scores count half),
    = sum over score groups of neg * (positives scored higher + pos/2) / (P*N)."""
    pts = roc_points(df, label, score)
    a = pts.agg(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)).alias("u"),
                F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(_safe_div(F.col("u"), F.col("P") * F.col("N")).alias("auc"),
                    F.col("P").alias("positives"), F.col("N").alias("negatives"))


def positive_probability(pred_df: DataFrame, prob_col: str = "probability", out: str = "p1") -> DataFrame:
    """EV6: probability of class 1 from an ML probability vector."""
    from pyspark.ml.functions import vector_to_array
    return pred_df.withColumn(out, vector_to_array(F.col(prob_col))[1])
