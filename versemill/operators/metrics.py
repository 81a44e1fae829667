"""Classification metrics. All derive from one counted table of (true, predicted).

Predictions are long tables with ``y_true`` and ``y_pred``; ``by`` names the columns that
tell models (or alphas) apart. Only the counting reads the rows; everything after it
works on at most classes x classes lines per model.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def align_truth(predictions: DataFrame, truth: DataFrame, key: str = "id", label_col: str = "label") -> DataFrame:
    """Predictions with the true label of the same key."""
    return predictions.join(truth.select(key, F.col(label_col).alias("y_true")), key)


def confusion_counts(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per ``(y_true, y_pred)`` that occurs."""
    return predictions.groupBy(*by, "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts for every pair from the union of true and predicted labels, zeros included."""
    counts = confusion_counts(predictions, by)
    # One line per class and model; the pairs asked for are the square of the classes.
    labels = counts.select(*by, F.explode(F.array_distinct(F.array("y_true", "y_pred"))).alias("y_true")).distinct()
    others = labels.withColumnRenamed("y_true", "y_pred")
    everything = labels.withColumn("_all", F.lit(0)).join(others.withColumn("_all", F.lit(0)), [*by, "_all"])
    cells = everything.select(*by, "y_true", "y_pred", F.lit(0).cast("long").alias("n"))
    return counts.unionByName(cells).groupBy(*by, "y_true", "y_pred").agg(F.sum("n").alias("n"))


def class_outcomes(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per label of the union of true and predicted: ``tp, fp, fn``."""
    right = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0))
    wrong = F.col("n") - right
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), right.alias("tp"), none.alias("fp"), wrong.alias("fn")),
        F.struct(F.col("y_pred").alias("label"), none.alias("tp"), wrong.alias("fp"), none.alias("fn")),
    )
    return (
        confusion_counts(predictions, by)
        .select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _f1() -> Column:
    return _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def f1_per_class(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F1 per label of the union; 0 where it is undefined."""
    return class_outcomes(predictions, by).select(*by, "label", _f1().alias("f1"))


def recall_per_class(predictions: DataFrame, n_classes: int, by: Sequence[str] = ()) -> DataFrame:
    """Recall for each of the classes 0..n-1, 0 where it is undefined."""
    recall = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return (
        class_outcomes(predictions, by)
        .groupBy(*by)
        .agg(F.map_from_entries(F.collect_list(F.struct("label", recall))).alias("_recall"))
        .withColumn("label", F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))))
        .select(*by, "label", F.coalesce(F.try_element_at("_recall", "label"), F.lit(0.0)).alias("recall"))
    )


def recall_matrix(predictions: DataFrame, n_classes: int, model_col: str = "model") -> DataFrame:
    """One row per model with ``recall_0 .. recall_<n-1>``."""
    long = recall_per_class(predictions, n_classes, [model_col])
    picks = [F.max(F.when(F.col("label") == c, F.col("recall"))).alias(f"recall_{c}") for c in range(n_classes)]
    return long.groupBy(model_col).agg(*picks)


def evaluate(predictions: DataFrame, by: Sequence[str] = (), classes: Sequence[int] = ()) -> DataFrame:
    """``accuracy, macro_f1`` and ``f1_<class>`` for the classes asked for.

    Macro F1 is the plain mean over the union of labels. Over that union true positives
    sum to the right rows and ``tp + fn`` to all rows, so accuracy needs no second pass.
    """
    outcomes = class_outcomes(predictions, by).withColumn("f1", _f1())
    picks = [F.max(F.when(F.col("label") == c, F.col("f1"))).alias(f"f1_{c}") for c in classes]
    return outcomes.groupBy(*by).agg(
        (F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        *picks,
    )


def prediction_registry(named: dict[str, DataFrame]) -> DataFrame:
    """Predictions of several models in one long table with a ``model`` column."""
    frames = [
        df.select(F.lit(name).alias("model"), "id", "y_true", F.col("y_pred").cast("int").alias("y_pred"))
        for name, df in named.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def metrics_long(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """One line per metric: ``by..., metric, value``."""
    values = [c for c in metrics.columns if c not in by]
    return metrics.unpivot(list(by), values, "metric", "value")


def compare_models(metrics: DataFrame, a: str, b: str, model_col: str = "model") -> DataFrame:
    """Two models side by side per metric (``metric, a, b, delta``)."""
    pick = lambda name: F.max(F.when(F.col(model_col) == name, F.col("value")))
    return (
        metrics_long(metrics.where(F.col(model_col).isin(a, b)), [model_col])
        .groupBy("metric")
        .agg(pick(a).alias("a"), pick(b).alias("b"))
        .withColumn("delta", F.col("b") - F.col("a"))
    )


def compare_with(metrics: DataFrame, baseline: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every row of ``metrics`` (one per ``by``) against one baseline row, per metric."""
    base = metrics_long(baseline, [c for c in baseline.columns if c == "model"]).select(
        "metric", F.col("value").alias("b")
    )
    return (
        metrics_long(metrics, by)
        .withColumnRenamed("value", "a")
        .join(base, "metric")
        .withColumn("delta", F.col("b") - F.col("a"))
    )


def degradation_by_class(predictions: DataFrame, large: str, small: str, model_col: str = "model") -> DataFrame:
    """F1 lost per class from one model to a smaller one, largest loss ranked first."""
    pick = lambda name: F.coalesce(F.max(F.when(F.col(model_col) == name, F.col("f1"))), F.lit(0.0))
    lost = (
        f1_per_class(predictions.where(F.col(model_col).isin(large, small)), [model_col])
        .groupBy("label")
        .agg(pick(large).alias("f1_large"), pick(small).alias("f1_small"))
        .withColumn("loss", F.round(F.col("f1_large") - F.col("f1_small"), 12))
    )
    # One line per class reaches this window.
    return lost.withColumn(
        "loss_rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("loss"), "label"))
    )
