"""Evaluation of (label, prediction) tables by grouped counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import count_if


def confusion(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """TN, FP, FN and TP, per group if asked."""
    y, p = F.col("label"), F.col("prediction")
    return predictions.dropna(subset=["label", "prediction"]).groupBy(*by).agg(
        count_if((y == 0) & (p == 0)).alias("true_negatives"),
        count_if((y == 0) & (p == 1)).alias("false_positives"),
        count_if((y == 1) & (p == 0)).alias("false_negatives"),
        count_if((y == 1) & (p == 1)).alias("true_positives"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def report(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted averages, and accuracy.

    Rows ``0``, ``1``, ``macro avg``, ``weighted avg`` and ``accuracy`` in column ``class``."""
    c = confusion(predictions, by)
    tn, fp, fn, tp = (F.col(n) for n in ("true_negatives", "false_positives", "false_negatives", "true_positives"))

    def scores(hit: Column, wrong: Column, missed: Column) -> list[Column]:
        precision, recall = _ratio(hit, hit + wrong), _ratio(hit, hit + missed)
        return [precision, recall, _ratio(2 * precision * recall, precision + recall)]

    class0, class1 = scores(tn, fn, fp), scores(tp, fp, fn)
    n0, n1 = tn + fp, tp + fn
    total = n0 + n1
    macro = [(a + b) / 2 for a, b in zip(class0, class1)]
    weighted = [_ratio(a * n0 + b * n1, total) for a, b in zip(class0, class1)]
    accuracy = _ratio(tn + tp, total)

    def line(name: str, values: Sequence[Column], support: Column) -> Column:
        p, r, f = values
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), support.alias("support"))

    lines = F.array(line("0", class0, n0), line("1", class1, n1), line("macro avg", macro, total),
                    line("weighted avg", weighted, total), line("accuracy", [accuracy] * 3, total))
    return c.select(*by, F.explode(lines).alias("r")).select(*by, "r.*")


def summary(predictions: DataFrame) -> DataFrame:
    """One row: accuracy and the weighted averages of precision, recall and F1."""
    rows = report(predictions)

    def of(kind: str, value: str, name: str) -> Column:
        return F.max(F.when(F.col("class") == kind, F.col(value))).alias(name)

    return rows.agg(of("accuracy", "precision", "accuracy"), of("weighted avg", "precision", "precision"),
                    of("weighted avg", "recall", "recall"), of("weighted avg", "f1_score", "f1-score"))


def mean_squared_error(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (predictions.dropna(subset=["label", "prediction"]).groupBy(*by)
            .agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)).alias("mean_squared_error")))
