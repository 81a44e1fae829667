"""The linear model against plain numpy, and its weights on disk."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from versemill.operators import classify, linear

SCHEMA = "id long, label int, term_ids array<int>, weights array<double>"


def sparse_rows(rng, n, n_features, classes):
    rows = []
    for i in range(n):
        terms = sorted(rng.choice(n_features, rng.integers(0, 6), replace=False).tolist())
        rows.append((i, int(rng.choice(classes)), terms, rng.random(len(terms)).tolist()))
    return rows


def dense(rows, n_features):
    x = np.zeros((len(rows), n_features + 1))
    x[:, -1] = 1
    for i, (_, _, terms, values) in enumerate(rows):
        x[i, terms] = values
    return x


def plain_passes(x, y, classes, passes, reg):
    penalty = np.full((x.shape[1], 1), reg)
    penalty[-1] = 0
    bound = (x * x.sum(axis=1, keepdims=True)).sum(axis=0)[:, None] / (4 * len(x)) + penalty
    now = ahead = np.zeros((x.shape[1], len(classes)))
    out = []
    for t in range(1, passes + 1):
        share = 1 / (1 + np.exp(-x @ ahead))
        slope = x.T @ (share - (y[:, None] == np.array(classes))) / len(x) + penalty * ahead
        before, now = now, ahead - slope / np.where(bound > 0, bound, np.inf)
        ahead = now + (t - 1) / (t + 2) * (now - before)
        out.append(now)
    return out


def test_passes_equal_numpy(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows, classes = sparse_rows(rng, 300, 12, [0, 2, 5]), [0, 2, 5]
    extra = [(900, None, [1], [1.0]), (901, 2, None, None)]
    df = spark.createDataFrame(rows + extra, SCHEMA).repartition(5)
    got = linear.fit_passes(df, 13, 15, 1e-3)
    known = [*rows, (901, 2, [], [])]
    want = plain_passes(dense(known, 13), np.array([r[1] for r in known]), classes, 15, 1e-3)
    for g, w in zip(got, want):
        assert g.classes == classes and np.allclose(g.coef, w, atol=1e-12)
    assert not got[-1].coef[12].any()  # no row has this term
    predicted = {r["id"]: r["y_pred"] for r in linear.predict(df, got[-1]).collect()}
    margins = np.round(dense(known, 13) @ want[-1], 9)
    assert [predicted[r[0]] for r in known] == [classes[i] for i in margins.argmax(axis=1)] and len(predicted) == 302
    shares = {r["place"]: r["accuracy"] for r in linear.accuracies(df, got).collect()}
    for t, w in enumerate(want):
        right = np.array(classes)[np.round(dense(known, 13) @ w, 9).argmax(axis=1)] == [r[1] for r in known]
        assert shares[t] == pytest.approx(right.mean())
    got[-1].save(str(tmp_path / "w"))
    again = linear.LinearWeights.load(str(tmp_path / "w"))
    assert again.classes == classes and np.array_equal(again.coef, got[-1].coef)


def test_loss_falls_and_separable_classes_are_learned(spark):
    rows = [(i, i % 4, [i % 4, 4 + i % 3], [1.0, 0.5]) for i in range(240)]
    df = spark.createDataFrame(rows, SCHEMA)
    history = linear.fit_passes(df, 7, 15, 1e-4)
    x, y = dense(rows, 7), np.array([r[1] for r in rows])
    losses = [np.logaddexp(0, -np.where(y[:, None] == range(4), 1, -1) * (x @ h.coef)).mean() for h in history]
    assert all(b < a for a, b in zip(losses, losses[1:])) and losses[-1] < 0.3
    assert linear.accuracies(df, history[-1:]).first()["accuracy"] == 1.0


def test_weights_are_counted_by_parts(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 2, [i % 3], [1.0]) for i in range(30)], SCHEMA)
    history = linear.fit_passes(df, 3, 6, 1e-4)
    whole = sorted(map(tuple, linear.accuracies(df, history).collect()))
    monkeypatch.setattr(linear, "WEIGHT_BYTES", 2 * history[0].coef.nbytes)
    assert sorted(map(tuple, linear.accuracies(df, history).collect())) == whole
    monkeypatch.setattr(linear, "WEIGHT_BYTES", 10)
    with pytest.raises(ValueError, match="WEIGHT_BYTES"):
        linear.fit_passes(df, 3, 1, 1e-4)
    with pytest.raises(ValueError, match="no labelled rows"):
        linear.fit_passes(df.where("id < 0"), 3, 1, 1e-4)


def test_a_pass_shuffles_terms_not_rows(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 2, [i % 3], [1.0]) for i in range(3000)], SCHEMA).repartition(4)
    sent = []
    real = type(df).groupBy

    def watched(self, *cols):
        if cols == ("term",):
            sent.append(self.count())
        return real(self, *cols)

    monkeypatch.setattr(type(df), "groupBy", watched)
    linear.fit_passes(df, 3, 2, 1e-4)
    assert sent and max(sent) <= 4 * 4


def test_curve_of_one_fit(spark):
    df = spark.createDataFrame([(i, i % 2, [i % 2], [1.0]) for i in range(40)], SCHEMA)
    lines = classify.learning_curve(df, df.where("id < 10"), 2, passes=(1, 3)).orderBy("iteration").collect()
    assert [(r["iteration"], r["train_acc"], r["val_acc"]) for r in lines] == [(1, 1.0, 1.0), (3, 1.0, 1.0)]
    none = classify.learning_curve(df, df.where("id < 0"), 2, passes=(1,)).first()
    assert none["train_acc"] == 1.0 and none["val_acc"] is None
    assert df.select(F.max("id")).first()[0] == 39
