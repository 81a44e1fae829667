"""Classifiers: neighbour vote, blend with model scores, linear model on TF-IDF."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.functions.binding import bind
from versemill.functions.vectors import argmax_class, as_doubles, blend, dot, l2_norm, softmax, uniform_scores
from versemill.operators.knn import knn_join, majority_vote
from versemill.operators.linear import LinearWeights, accuracies, fit_passes, predict
from versemill.session import stage_table

# Blend weights of the sweep, and the number of training passes.
ALPHAS = (0.0, 0.25, 0.5, 0.75, 1.0)
EPOCHS = 15


class Model(ABC):
    """M1: what every classifier offers. ``predict`` returns ``id, y_pred``."""

    @abstractmethod
    def fit(self, train: DataFrame) -> Model: ...

    @abstractmethod
    def predict(self, df: DataFrame) -> DataFrame: ...


class KNNClassifier(Model):
    """M5: majority vote over the k nearest training rows.

    The vote searches by Euclidean distance; pass ``metric="cosine"`` for cosine.
    """

    def __init__(self, k: int = 5, metric: str = "euclidean") -> None:
        self.k, self.metric = k, metric
        self.corpus: DataFrame | None = None

    def fit(self, train: DataFrame) -> KNNClassifier:
        self.corpus = train.select("id", "embedding", "label")
        return self

    def neighbors(self, queries: DataFrame, query_cols: Sequence[str] = ()) -> DataFrame:
        if self.corpus is None:
            raise RuntimeError("fit the classifier before searching")
        if "embedding" not in queries.columns:
            raise ValueError("queries need an 'embedding' column")
        return knn_join(
            queries, self.corpus, self.k, self.metric, query_cols=query_cols, corpus_cols=["label"]
        )

    def predict(self, df: DataFrame) -> DataFrame:
        votes = majority_vote(self.neighbors(df))
        return votes.withColumnRenamed("qid", "id")


class LinearTextClassifier(Model):
    """M2/M3: one-versus-rest logistic loss with an L2 penalty on TF-IDF rows.

    ``fit`` makes ``max_iter`` passes over the rows and keeps the weights after each of them
    in ``history``; ``model`` holds the last.
    """

    def __init__(self, n_features: int, max_iter: int = EPOCHS, reg_param: float = 1e-4) -> None:
        self.n_features, self.max_iter, self.reg_param = n_features, max_iter, reg_param
        self.model: LinearWeights | None = None
        self.history: list[LinearWeights] = []

    def fit(self, train: DataFrame) -> LinearTextClassifier:
        rows = stage_table(train.select("label", "term_ids", "weights"))
        self.history = fit_passes(rows, self.n_features, self.max_iter, self.reg_param)
        self.model = self.history[-1]
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise RuntimeError("fit the classifier before predicting")
        return predict(df, self.model)


def learning_curve(
    train: DataFrame,
    evaluation: DataFrame | None,
    n_features: int,
    passes: Sequence[int] = range(1, EPOCHS + 1),
) -> DataFrame:
    """``iteration, train_acc, val_acc`` after each number of passes of one fit.

    Without evaluation rows ``val_acc`` is null.
    """
    train = stage_table(train.select("label", "term_ids", "weights"))
    history = fit_passes(train, n_features, max(passes), LinearTextClassifier(n_features).reg_param)
    history = [history[n - 1] for n in passes]
    iteration = F.element_at(F.array(*[F.lit(n) for n in passes]), (F.col("place") + 1).cast("int"))
    curve = accuracies(train, history).select("place", iteration.alias("iteration"), F.col("accuracy").alias("train_acc"))
    if evaluation is None:
        return curve.select("iteration", "train_acc", F.lit(None).cast("double").alias("val_acc"))
    held = accuracies(evaluation, history).withColumnRenamed("accuracy", "val_acc")
    return curve.join(held, "place").select("iteration", "train_acc", "val_acc")


def class_centroids(train: DataFrame) -> DataFrame:
    """``label, centroid``: mean vector per class, aggregated map-side in the JVM."""
    mean = Summarizer.mean(array_to_vector(as_doubles(F.col("embedding"))))
    return train.groupBy("label").agg(vector_to_array(mean).alias("centroid"))


def centroid_scores(
    df: DataFrame, centroids: DataFrame, n_classes: int, scale: float = 10.0, metric: str = "cosine"
) -> DataFrame:
    """Adds ``scores`` by class position: ``scale`` x cosine to each class centroid, or, with
    ``metric="euclidean"``, the negative distance to it.

    Stands in for a trained network's class scores. The centroids travel as one row
    (classes x dimensions numbers); a class without a centroid scores 0 and, by distance,
    below all others.
    """
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    table = centroids.agg(
        F.map_from_entries(F.collect_list(F.struct("label", "centroid"))).alias("by_class")
    ).scalar()
    vector = as_doubles(F.col("embedding"))
    if metric == "euclidean":
        classes = F.sequence(F.lit(0), F.lit(n_classes - 1))

        def closeness(v: Column, c: Column) -> Column:
            apart = F.zip_with(F.try_element_at("_centers", c), v, lambda x, y: x - y)
            return F.coalesce(-l2_norm(apart), F.lit(float("-inf")))

        distances = bind(vector, lambda v: F.transform(classes, lambda c: closeness(v, c)))
        return df.withColumn("_centers", table).withColumn("scores", distances).drop("_centers")

    def cosines(v: Column, length: Column) -> Column:
        def cosine(center: Column) -> Column:
            return bind(
                l2_norm(center) * length,
                lambda bottom: F.when(bottom > 0, F.lit(scale) * dot(center, v) / bottom).otherwise(F.lit(0.0)),
            )

        return F.transform(
            F.sequence(F.lit(0), F.lit(n_classes - 1)),
            lambda c: F.coalesce(cosine(F.try_element_at("_centers", c)), F.lit(0.0)),
        )

    scores = bind(vector, lambda v: bind(l2_norm(v), lambda length: cosines(v, length)))
    return df.withColumn("_centers", table).withColumn("scores", scores).drop("_centers")


def model_probabilities(df: DataFrame, n_classes: int) -> DataFrame:
    """M6/M7: adds ``p_model``: softmax of ``scores`` where present, else uniform."""
    if "scores" in df.columns:
        return df.withColumn("p_model", softmax(F.col("scores")))
    if "embedding" in df.columns or "labels" in df.columns:
        return df.withColumn("p_model", uniform_scores(n_classes))
    raise ValueError("rows have neither scores nor embeddings")


def hybrid_classify(df: DataFrame, alpha: float) -> DataFrame:
    """M8: adds ``p_hybrid`` and ``y_pred`` from ``p_knn`` and ``p_model``."""
    mixed = df.withColumn("p_hybrid", blend(alpha, F.col("p_knn"), F.col("p_model")))
    return mixed.withColumn("y_pred", argmax_class(_settled(F.col("p_hybrid"))))


def alpha_sweep(df: DataFrame, alphas: Sequence[float] = ALPHAS) -> DataFrame:
    """M9: each row once per alpha with its ``y_pred``.

    Neighbours and scores are already on the row, so the sweep is a projection.
    """
    weights = F.array(*[F.lit(float(a)) for a in alphas])
    mixed = df.select("*", F.posexplode(weights).alias("alpha_pos", "alpha")).withColumn(
        "p_hybrid", blend(F.col("alpha"), F.col("p_knn"), F.col("p_model"))
    )
    return mixed.withColumn("y_pred", argmax_class(_settled(F.col("p_hybrid"))))


def _settled(scores):
    """Scores rounded far below any meaning, so equal scores tie in spite of rounding noise."""
    return F.transform(scores, lambda s: F.round(s, 12))
