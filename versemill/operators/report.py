"""Reports: best alpha, leaderboard, examples with neighbours, class summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from versemill.functions.keys import DEFAULT_SEED
from versemill.functions.text import text_preview, unigrams_and_bigrams, without_stop_words, word_tokens
from versemill.operators.joins import broadcast_if_small
from versemill.operators.knn import knn_join
from versemill.operators.sampling import class_sample, sample_n, with_class_values
from versemill.session import stage_table

# Sample sizes and preview lengths of the reports.
EXAMPLES = 10
EXPLAINED = 3
EXAMPLE_PREVIEW = 150
NEIGHBOR_PREVIEW = 100
DOCS_PER_CLASS = 50
SUMMARY_SENTENCES = 5
# End of fixed values.
SENTENCE = r"[^.!?\n]+[.!?]*"


def best_alpha(test_metrics: DataFrame, eval_metrics: DataFrame | None = None, select_on: str = "test") -> DataFrame:
    """The alpha of highest macro F1, the first listed winning a tie.

    Chosen on the test metrics by default; ``select_on="eval"`` uses the evaluation ones.
    """
    if select_on not in ("test", "eval"):
        raise ValueError("select_on is 'test' or 'eval'")
    source = test_metrics if select_on == "test" else eval_metrics
    if source is None:
        raise ValueError("select_on='eval' needs eval_metrics")
    key = F.struct(F.round("macro_f1", 12), -F.col("alpha_pos"))
    return source.agg(F.max_by("alpha", key).alias("alpha"), F.max_by("macro_f1", key).alias("macro_f1"))


def leaderboard(model_metrics: DataFrame, alpha_metrics: DataFrame, positions: Sequence[str]) -> DataFrame:
    """Every model plus the hybrid at its best alpha, best macro F1 first.

    ``positions`` is the order models were registered in; it settles ties.
    """
    key = F.struct(F.round("macro_f1", 12), -F.col("alpha_pos"))
    values = [c for c in model_metrics.columns if c != "model"]
    best = alpha_metrics.agg(
        F.max_by(
            F.struct(
                F.concat(F.lit("hybrid_best_alpha_"), F.col("alpha").cast("string")).alias("model"), *values
            ),
            key,
        ).alias("row")
    ).select("row.*")
    order = F.coalesce(
        F.array_position(F.array(*[F.lit(p) for p in positions]), F.col("model")), F.lit(0)
    )
    place = F.when(order > 0, order).otherwise(F.lit(len(positions) + 1))
    # One line per model reaches this window.
    by_score = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.round("macro_f1", 12)), place)
    return (
        model_metrics.unionByName(best)
        .withColumn("position", F.row_number().over(by_score))
        .orderBy("position")
    )


def correct_rows(predictions: DataFrame) -> DataFrame:
    """rows predicted right."""
    return predictions.where(F.col("y_pred") == F.col("y_true"))


def incorrect_rows(predictions: DataFrame) -> DataFrame:
    """rows predicted wrong."""
    return predictions.where(F.col("y_pred") != F.col("y_true"))


def prediction_examples(
    predictions: DataFrame,
    texts: DataFrame | None = None,
    correct: bool = True,
    n: int = EXAMPLES,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Up to ``n`` right (or wrong) rows: id, preview, truth, prediction.

    ``total`` is the number of such rows and ``out_of`` that of all rows. Texts are joined
    to the few sampled ids only.
    """
    chosen = correct_rows(predictions) if correct else incorrect_rows(predictions)
    hit = F.col("y_pred") == F.col("y_true")
    totals = predictions.agg(
        F.struct(
            F.count_if(hit if correct else ~hit).alias("total"), F.count(F.lit(1)).alias("out_of")
        ).alias("t")
    ).scalar()
    sample = sample_n(chosen.select("id", "y_true", "y_pred"), n, seed=seed).withColumn("_t", totals)
    sample = sample.select("id", "y_true", "y_pred", "_t.total", "_t.out_of")
    if texts is None:
        return sample
    return sample.join(_previews_of(sample, texts, EXAMPLE_PREVIEW), "id", "left").select(
        "id", "preview", "y_true", "y_pred", "total", "out_of"
    )


def _previews_of(ids: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """``id, preview`` of the few ``ids`` (at most some per sampled row) that have a text.

    The ids are broadcast to the scan of the texts, which are not shuffled; an id without text
    has no row here, so callers join from the left.
    """
    few = F.broadcast(ids.select("id").distinct())
    return texts.join(few, "id", "left_semi").select("id", text_preview(F.col("text"), length).alias("preview"))


def search_report(
    queries: DataFrame, corpus: DataFrame, texts: DataFrame, k: int = 5, n: int = 1, seed: int = DEFAULT_SEED
) -> DataFrame:
    """A random query row and its neighbours with distance, preview and label."""
    picked = sample_n(queries.select("id", "embedding", "label"), n, seed=seed)
    found = knn_join(picked, corpus, k, "cosine", query_cols=["label"], corpus_cols=["label"])
    found = stage_table(found)  # n * k rows
    asked = _previews_of(found.select(F.col("qid").alias("id")), texts, NEIGHBOR_PREVIEW)
    near = _previews_of(found.select(F.col("nid").alias("id")), texts, NEIGHBOR_PREVIEW)
    with_query = found.join(asked.select(F.col("id").alias("qid"), F.col("preview").alias("q_preview")), "qid", "left")
    with_both = with_query.join(near.select(F.col("id").alias("nid"), F.col("preview").alias("n_preview")), "nid", "left")
    return with_both.select(
        "qid", "q_preview", F.col("label").alias("q_label"), "rank", "nid", "distance",
        F.col("n_preview").alias("preview"), "n_label",
    )


def explain_errors(
    predictions: DataFrame,
    vectors: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    n: int = EXPLAINED,
    which: str = "wrong",
    seed: int = DEFAULT_SEED,
    texts: DataFrame | None = None,
) -> DataFrame:
    """Up to ``n`` right and ``n`` wrong rows, with the neighbours of the wrong ones.

    ``which="both"`` looks neighbours up for the right ones as well. Only the sampled rows
    are searched. Rows without neighbours have nulls in the neighbour columns. With ``texts``
    the previews of the row and of each neighbour are added, null where there is no text.
    """
    if which not in ("wrong", "both"):
        raise ValueError("which is 'wrong' or 'both'")
    right = sample_n(correct_rows(predictions), n, seed=seed).withColumn("outcome", F.lit("right"))
    wrong = sample_n(incorrect_rows(predictions), n, seed=seed).withColumn("outcome", F.lit("wrong"))
    sample = right.unionByName(wrong).select("outcome", "id", "y_true", "y_pred")
    asked = wrong if which == "wrong" else sample
    # At most 2n sampled ids are broadcast.
    queries = vectors.select("id", "embedding").join(F.broadcast(asked.select("id")), "id")
    found = knn_join(queries, corpus, k, "cosine", corpus_cols=["label"])
    explained = sample.join(found.withColumnRenamed("qid", "id"), "id", "left").select(
        "outcome", "id", "y_true", "y_pred", "rank", "nid", "distance", "n_label"
    )
    if texts is None:
        return explained
    explained = stage_table(explained)  # 2 n k rows at most
    own = _previews_of(explained, texts, EXAMPLE_PREVIEW)
    near = _previews_of(explained.select(F.col("nid").alias("id")), texts, NEIGHBOR_PREVIEW)
    near = near.select(F.col("id").alias("nid"), F.col("preview").alias("n_preview"))
    return explained.join(own, "id", "left").join(near, "nid", "left")


def class_pseudo_document(
    train: DataFrame,
    n: int = DOCS_PER_CLASS,
    per_class: bool = True,
    classes: Sequence[int] = (),
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The texts of ``n`` sampled rows per class, joined with a space in sample order."""
    sampled = class_sample(train.select("id", "label", "text"), n, seed=seed, per_class=per_class, classes=classes)
    entry = F.struct("sample_rank", "text")
    return (
        sampled.groupBy("label")
        .agg(F.sort_array(F.collect_list(entry)).alias("_docs"))
        .select("label", F.size("_docs").alias("n_docs"), F.array_join("_docs.text", " ").alias("text"))
    )


def extractive_class_summary(
    train: DataFrame,
    rows: DataFrame,
    vocabulary: DataFrame,
    n_docs: int = DOCS_PER_CLASS,
    n_sentences: int = SUMMARY_SENTENCES,
    stop_words: Sequence[str] = (),
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The ``n_sentences`` most typical sentences of each class, in text order.

    A class is described by the mean TF-IDF weight of its terms over all its rows
    (``rows``: id, label, term_ids, weights). Sentences come from the class's sampled
    documents and score the mean class weight of their distinct terms.
    """
    sizes = F.count(F.lit(1))
    n_rows = rows.groupBy("label").agg(sizes.alias("n"))
    weights = (
        rows.select("label", F.inline(F.arrays_zip("term_ids", "weights")))
        .groupBy("label", "term_ids")
        .agg(F.sum("weights").alias("_sum"))
    )
    weights = with_class_values(weights, n_rows, "label", "n").select(
        "label", F.col("term_ids").alias("term_id"), (F.col("_sum") / F.col("n")).alias("class_weight")
    )
    terms = broadcast_if_small(vocabulary.select("term", "term_id"))
    sampled = class_sample(train.select("id", "label", "text"), n_docs, seed=seed)
    sentences = sampled.select(
        "label", "sample_rank", F.posexplode_outer(F.regexp_extract_all("text", F.lit(SENTENCE), F.lit(0))).alias("pos", "raw")
    ).select("label", "sample_rank", "pos", F.trim("raw").alias("sentence")).where(F.col("sentence") != "")
    words = without_stop_words(word_tokens(F.col("sentence")), stop_words)
    scored = (
        sentences.select(
            "label", "sample_rank", "pos", "sentence",
            F.explode_outer(F.array_distinct(unigrams_and_bigrams(words))).alias("term"),
        )
        .join(terms, "term", "left")
        .join(weights, ["label", "term_id"], "left")
        .groupBy("label", "sample_rank", "pos")
        .agg(
            F.round(F.avg(F.coalesce("class_weight", F.lit(0.0))), 9).alias("score"),
            F.first("sentence").alias("sentence"),
        )
    )
    best = Window.partitionBy("label").orderBy(F.desc("score"), "sample_rank", "pos")
    kept = scored.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= n_sentences)
    entry = F.struct("sample_rank", "pos", "sentence")
    return (
        kept.groupBy("label")
        .agg(F.sort_array(F.collect_list(entry)).alias("_s"))
        .select("label", F.size("_s").alias("n_sentences"), F.array_join("_s.sentence", " ").alias("summary"))
    )
