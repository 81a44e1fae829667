"""Dense-vector and class-probability arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from versemill.functions.binding import bind


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return array_sum(F.zip_with(a, b, lambda x, y: x * y))


def l2_norm(vector: Column) -> Column:
    return F.sqrt(array_sum(F.transform(vector, lambda x: x * x)))


def scaled(vector: Column, divisor: Column) -> Column:
    """Every element divided by the same number."""
    return bind(divisor, lambda d: F.transform(vector, lambda x: x / d))


def softmax(scores: Column) -> Column:
    """M6: probabilities from scores; the maximum is subtracted so large scores do not overflow."""
    return bind(
        F.array_max(scores),
        lambda top: bind(
            F.transform(scores, lambda z: F.exp(z - top)),
            lambda powers: scaled(powers, array_sum(powers)),
        ),
    )


def uniform_scores(n_classes: int) -> Column:
    """M7: the same probability for every class."""
    return F.array_repeat(F.lit(1.0 / n_classes), n_classes)


def argmax_class(scores: Column) -> Column:
    """Zero-based position of the largest score; the lowest position wins a tie."""
    return bind(scores, lambda s: (F.array_position(s, F.array_max(s)) - 1).cast("int"))


def blend(alpha: Column | float, p_neighbours: Column, p_model: Column) -> Column:
    """M8: ``alpha`` weighs the neighbour vote, ``1 - alpha`` the model."""
    a = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    return F.zip_with(p_neighbours, p_model, lambda n, m: a * n + (F.lit(1.0) - a) * m)


def vote_shares(labels: Column, n_classes: int, k: int) -> Column:
    """A5: per class, the number of neighbours carrying it divided by ``k``; zeros included."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(n_classes - 1)),
        lambda c: F.size(F.filter(labels, lambda lab: lab == c)) / F.lit(float(k)),
    )
