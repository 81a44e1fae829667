"""One-versus-rest logistic loss on sparse rows, by passes over the whole table.

A pass is one aggregate: every task scores its rows with the current weights, sums the
gradients of the terms it meets, and sends one line per term; nothing per row is shuffled. The
weights (features x classes numbers, at most ``WEIGHT_BYTES``) travel with the task.

Steps are fixed: each weight moves by its gradient over a bound of its curvature, which is
summed once before the first pass, so no step length has to be tried and a pass never
overshoots. Passes are accelerated by the usual momentum. The weights after every pass are
kept, which gives the learning curve of a single run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WEIGHT_BYTES = 64 * 1024 * 1024
#: Margins are compared at this many places, so equal rows tie in spite of rounding noise.
PLACES = 9


@dataclass
class LinearWeights:
    """``coef[j, c]``: weight of feature ``j`` for class ``classes[c]``; the last line is the intercept."""

    classes: list[int]
    coef: np.ndarray

    def save(self, path: str) -> None:
        """Writes ``term_id, label, weight``, the intercept as term -1 and all of its lines."""
        term, at = np.nonzero(self.coef)
        term, at = np.concatenate([term, np.repeat(len(self.coef) - 1, len(self.classes))]), np.concatenate([at, np.arange(len(self.classes))])
        lines = sorted({(int(j), int(c)) for j, c in zip(term, at)})
        n = len(self.coef) - 1
        rows = [(-1 if j == n else j, self.classes[c], float(self.coef[j, c]), n) for j, c in lines]
        spark = SparkSession.active()
        table = spark.createDataFrame(rows, "term_id int, label int, weight double, n_features int")
        table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> LinearWeights:
        table = SparkSession.active().read.parquet(path).toArrow()  # features x classes lines at most
        term, label, weight, n = (table.column(c).to_numpy() for c in ("term_id", "label", "weight", "n_features"))
        classes = sorted(set(label.tolist()))
        coef = np.zeros((int(n[0]) + 1, len(classes)))
        coef[np.where(term < 0, n, term), np.searchsorted(classes, label)] = weight
        return cls(classes, coef)


class _Rows:
    """The stored values of a batch of sparse rows."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        ids, values = batch.column("term_ids"), batch.column("weights")
        self.n = batch.num_rows
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.term = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.value = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)

    def margins(self, coef: np.ndarray) -> np.ndarray:
        out = np.empty((self.n, coef.shape[1]))
        for c in range(coef.shape[1]):
            out[:, c] = np.bincount(self.row, self.value * coef[self.term, c], self.n) + coef[-1, c]
        return out

    def term_sums(self, per_row: np.ndarray, n_features: int) -> np.ndarray:
        """Sums over the rows of value times the row's number, for each feature and the intercept."""
        out = np.empty((n_features + 1, per_row.shape[1]))
        for c in range(per_row.shape[1]):
            out[:-1, c] = np.bincount(self.term, self.value * per_row[self.row, c], n_features)
            out[-1, c] = per_row[:, c].sum()
        return out


def _summed(rows: DataFrame, per_row: Callable[[_Rows, np.ndarray], np.ndarray], n_features: int, width: int) -> np.ndarray:
    """:meth:`_Rows.term_sums` over all ``rows`` of what ``per_row`` makes of a batch."""
    names = [f"s{c}" for c in range(width)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = _Rows(batch)
            part = held.term_sums(per_row(held, batch.column("label").to_numpy(zero_copy_only=False)), n_features)
            total = part if total is None else total + part
        if total is not None:
            met = np.flatnonzero(total.any(axis=1))
            columns = [pa.array(met.astype(np.int32)), *[pa.array(total[met, c]) for c in range(width)]]
            yield pa.RecordBatch.from_arrays(columns, ["term", *names])

    schema = T.StructType([T.StructField("term", T.IntegerType()), *[T.StructField(n, T.DoubleType()) for n in names]])
    table = rows.mapInArrow(sums, schema).groupBy("term").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((n_features + 1, width))
    if table.num_rows:
        out[table.column("term").to_numpy()] = np.column_stack([table.column(n).to_numpy() for n in names])
    return out


def fit_passes(train: DataFrame, n_features: int, passes: int, reg_param: float) -> list[LinearWeights]:
    """The weights after each of ``passes`` over ``train`` (``label, term_ids, weights``), which should be written."""
    rows = train.where("label IS NOT NULL").select(F.col("label").cast("int").alias("label"), "term_ids", "weights")
    sizes = sorted((r["label"], r["n"]) for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect())
    classes, n = [c for c, _ in sizes], sum(k for _, k in sizes)
    if not n:
        raise ValueError("there are no labelled rows to learn from")
    if (n_features + 1) * len(classes) * 8 > WEIGHT_BYTES:
        raise ValueError("weights of all features and classes exceed WEIGHT_BYTES; keep fewer features")
    penalty = np.full((n_features + 1, 1), reg_param)
    penalty[-1] = 0.0

    def reach(held: _Rows, _: np.ndarray) -> np.ndarray:
        return np.bincount(held.row, held.value, held.n)[:, None] + 1

    # Sums of |x| times its row's length bound the curvature of the loss, feature by feature.
    sizes_only = rows.withColumn("weights", F.transform("weights", F.abs))
    bound = _summed(sizes_only, reach, n_features, 1) / (4 * n) + penalty
    scale = np.divide(1.0, bound, out=np.zeros_like(bound), where=bound > 0)
    now = ahead = np.zeros((n_features + 1, len(classes)))
    done = []
    for t in range(1, passes + 1):

        def residual(held: _Rows, label: np.ndarray, coef: np.ndarray = ahead) -> np.ndarray:
            truth = label[:, None] == np.array(classes)[None, :]
            return (1 + np.tanh(held.margins(coef) / 2)) / 2 - truth

        gradient = _summed(rows, residual, n_features, len(classes)) / n + penalty * ahead
        before, now = now, ahead - scale * gradient
        ahead = now + (t - 1) / (t + 2) * (now - before)
        done.append(LinearWeights(classes, now))
    return done


def _chosen(held: _Rows, weights: LinearWeights) -> np.ndarray:
    return np.array(weights.classes)[np.round(held.margins(weights.coef), PLACES).argmax(axis=1)]


def predict(rows: DataFrame, weights: LinearWeights) -> DataFrame:
    """``id, y_pred``: the class of the largest margin, the smallest of those that tie."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(_chosen(_Rows(batch), weights).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("id"), found], ["id", "y_pred"])

    schema = T.StructType([rows.schema["id"], T.StructField("y_pred", T.IntegerType())])
    return rows.select("id", "term_ids", "weights").mapInArrow(choose, schema)


def accuracies(rows: DataFrame, history: Sequence[LinearWeights]) -> DataFrame:
    """``place, accuracy`` of each of ``history`` (from 0) over ``rows``, which are read once for many of them."""
    at_once = max(1, WEIGHT_BYTES // max(history[0].coef.nbytes, 1))
    rows = rows.where("label IS NOT NULL").select(F.col("label").cast("int").alias("label"), "term_ids", "weights")
    counted = None
    for first in range(0, len(history), at_once):
        some = history[first : first + at_once]

        def count(batches: Iterator[pa.RecordBatch], some: Sequence[LinearWeights] = some, first: int = first) -> Iterator[pa.RecordBatch]:
            right, n = np.zeros(len(some), np.int64), 0
            for batch in batches:
                held, label = _Rows(batch), batch.column("label").to_numpy(zero_copy_only=False)
                right += [int((_chosen(held, weights) == label).sum()) for weights in some]
                n += batch.num_rows
            places = np.arange(first, first + len(some))
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(right), pa.array(np.full(len(some), n))], ["place", "right", "n"])

        part = rows.mapInArrow(count, "place bigint, right bigint, n bigint")
        counted = part if counted is None else counted.unionByName(part)
    share = F.when(F.sum("n") > 0, F.sum("right") / F.sum("n"))
    return counted.groupBy("place").agg(share.alias("accuracy"))
