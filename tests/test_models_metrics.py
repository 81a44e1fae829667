"""Blending, linear model, metrics and reports."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from versemill.functions import vectors as vec
from versemill.operators import classify, metrics, report
from versemill.operators.sampling import class_sample


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def array(*values):
    return F.array(*[F.lit(float(v)) for v in values])


def test_softmax_does_not_overflow(spark):
    assert one(spark, vec.softmax(array(1000, 1000))) == [0.5, 0.5]
    assert sum(one(spark, vec.softmax(array(1, 2, 3)))) == pytest.approx(1.0)


def test_blend_ends_and_ties(spark):
    row = spark.range(1).select("id", array(0.6, 0.4).alias("p_knn"), array(0.1, 0.9).alias("p_model"))
    assert classify.hybrid_classify(row, 1.0).first()["y_pred"] == 0
    assert classify.hybrid_classify(row, 0.0).first()["y_pred"] == 1
    tie = spark.range(1).select("id", array(0.2, 0.4, 0.4).alias("p_knn"), array(0.2, 0.4, 0.4).alias("p_model"))
    assert {r["y_pred"] for r in classify.alpha_sweep(tie).collect()} == {1}
    assert classify.alpha_sweep(row).count() == 5


def test_probabilities_need_some_input(spark):
    with pytest.raises(ValueError):
        classify.model_probabilities(spark.range(1), 4)
    uniform = classify.model_probabilities(spark.range(1).withColumn("embedding", array(1)), 4)
    assert uniform.first()["p_model"] == [0.25] * 4


def test_knn_classifier_checks(spark):
    with pytest.raises(RuntimeError):
        classify.KNNClassifier().predict(spark.range(1))


def separable(spark):
    rows = [(str(i), [i % 3, 3 + i % 2], [1.0, 0.2], i % 3, "eval" if i % 5 == 0 else "train") for i in range(90)]
    return spark.createDataFrame(rows, "id string, term_ids array<int>, weights array<double>, label int, split string")


def test_linear_model_learns_saves_and_loads(spark, tmp_path):
    from versemill.sources.tables import load_model, save_model

    rows = separable(spark)
    model = classify.LinearTextClassifier(6).fit(rows.where("split = 'train'"))
    held = rows.where("split = 'eval'")
    scored = metrics.align_truth(model.predict(held), held)
    assert metrics.evaluate(scored).first()["accuracy"] > 0.9
    save_model(model.model, str(tmp_path / "m"))
    again = classify.LinearTextClassifier(6)
    again.model = load_model(str(tmp_path / "m"))
    assert again.predict(held).exceptAll(model.predict(held)).count() == 0


def test_learning_curve_without_evaluation(spark):
    rows = separable(spark)
    lines = classify.learning_curve(rows, None, 6, passes=(1, 5)).orderBy("iteration").collect()
    assert [r["iteration"] for r in lines] == [1, 5] and all(r["val_acc"] is None for r in lines)


@pytest.fixture
def predictions(spark):
    # Class 3 is predicted but never true, class 2 is true but never predicted.
    pairs = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 3), (2, 0)]
    return spark.createDataFrame([("m", i, t, p) for i, (t, p) in enumerate(pairs)], "model string, id long, y_true int, y_pred int")


def test_scores_over_the_union_of_labels(predictions):
    f1 = {r["label"]: r["f1"] for r in metrics.f1_per_class(predictions).collect()}
    assert f1 == {0: pytest.approx(4 / 6), 1: pytest.approx(0.5), 2: 0.0, 3: 0.0}
    row = metrics.evaluate(predictions, ["model"], [0, 9]).first()
    assert row["accuracy"] == pytest.approx(0.5) and row["macro_f1"] == pytest.approx((4 / 6 + 0.5) / 4)
    assert row["f1_9"] is None
    recall = {r["label"]: r["recall"] for r in metrics.recall_per_class(predictions, 5).collect()}
    assert recall == {0: pytest.approx(2 / 3), 1: 0.5, 2: 0.0, 3: 0.0, 4: 0.0}


def test_confusion_is_square(predictions):
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in metrics.confusion_matrix(predictions).collect()}
    assert len(cells) == 16 and sum(cells.values()) == 6 and cells[(0, 0)] == 2 and cells[(3, 3)] == 0


def test_best_alpha_tie_and_choice(spark):
    test = spark.createDataFrame([(0, 0.0, 0.7), (1, 0.5, 0.7), (2, 1.0, 0.6)], "alpha_pos int, alpha double, macro_f1 double")
    evaluation = test.withColumn("macro_f1", F.col("alpha"))
    assert report.best_alpha(test).first()["alpha"] == 0.0
    assert report.best_alpha(test, evaluation, "eval").first()["alpha"] == 1.0
    with pytest.raises(ValueError):
        report.best_alpha(test, None, "eval")


def test_leaderboard_keeps_registration_order_on_ties(spark):
    models = spark.createDataFrame([("b", 0.5, 0.5), ("a", 0.5, 0.5), ("c", 0.4, 0.9)], "model string, accuracy double, macro_f1 double")
    alphas = spark.createDataFrame([(0, 0.25, 0.5, 0.5)], "alpha_pos int, alpha double, accuracy double, macro_f1 double")
    order = [r["model"] for r in report.leaderboard(models, alphas, ["b", "a", "c"]).collect()]
    assert order == ["c", "b", "a", "hybrid_best_alpha_0.25"]


def test_examples_and_explanations(spark, predictions):
    texts = spark.range(6).selectExpr("id", "repeat('x', 200) as text")
    wrong = report.prediction_examples(predictions, texts, correct=False, n=2).collect()
    assert len(wrong) == 2 and {(r["total"], r["out_of"]) for r in wrong} == {(3, 6)}
    assert all(len(r["preview"]) == 153 and r["y_true"] != r["y_pred"] for r in wrong)
    vectors = spark.range(6).selectExpr("id", "array(cast(id as double), 1.0D) as embedding")
    corpus = spark.range(20).selectExpr("id", "array(cast(id as double), 2.0D) as embedding", "cast(id % 3 as int) as label")
    some = report.explain_errors(predictions, vectors, corpus, k=2).collect()
    assert {r["outcome"] for r in some if r["nid"] is not None} == {"wrong"} and len(some) == 9
    both = report.explain_errors(predictions, vectors, corpus, k=2, which="both").collect()
    assert len(both) == 12 and all(r["nid"] is not None for r in both)


def test_class_documents(spark):
    rows = spark.range(120).selectExpr("id", "cast(id % 2 as int) as label", "concat('t', id % 2) as text")
    own = {r["label"]: r for r in report.class_pseudo_document(rows, 50).collect()}
    assert own[0]["n_docs"] == 50 and set(own[0]["text"].split()) == {"t0"}
    mixed = report.class_pseudo_document(rows, 50, per_class=False, classes=[0, 1]).collect()
    assert all(r["n_docs"] == 50 and set(r["text"].split()) == {"t0", "t1"} for r in mixed)
    assert class_sample(rows, 3).count() == 6
