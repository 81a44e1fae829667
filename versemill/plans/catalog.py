"""One registered query per operator, each over the whole given tables.

Doubles are rounded to six places, so results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versemill.functions import text as tx
from versemill.functions.vectors import uniform_scores
from versemill.operators import approx, classify, cleaning, features, knn, metrics, report, sampling
from versemill.plans import setup
from versemill.plans.harmonize import ROW_KEY, clean_pool, counted_rows, encode
from versemill.plans.search import search_texts
from versemill.session import stage_table, staging_root
from versemill.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
POOL_KEY = ["src", "id"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(name: str):
    return F.round(F.col(name), 6).alias(name)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


# --- cleaning and harmonising -------------------------------------------------------


@query
def rename_filter_language(spark, sf):
    cfg = setup.DOCUMENTS
    renamed = cleaning.rename_columns(setup.documents(spark, sf), cfg.cols_map)
    kept = cleaning.filter_language(renamed, cfg.language_col, cfg.target_language)
    return kept.select("id", "label", "text", "n_chars")


@query
def normalise_and_map_labels(spark, sf):
    df = cleaning.rename_columns(setup.documents(spark, sf), setup.DOCUMENTS.cols_map)
    df = df.withColumn("label", tx.normalise_label(F.col("label")))
    return cleaning.map_genres(df, setup.GENRE_MAP, setup.LABEL2ID).select("id", "label")


@query
def clean_genius(spark, sf):
    return setup.documents(spark, sf).select("id", tx.clean_genius(F.col("text")).alias("text"))


@query
def clean_multilingual(spark, sf):
    return setup.documents(spark, sf).select("id", tx.clean_multilingual(F.col("text")).alias("text"))


@query
def drop_nulls(spark, sf):
    return cleaning.drop_nulls(setup.judged_documents(spark, sf)).select("id", "quality", "toxic", "text")


@query
def stage_audit(spark, sf):
    docs = cleaning.stage_audit(setup.judged_documents(spark, sf), setup.DOCUMENTS)
    talks = cleaning.stage_audit(setup.conversations(spark, sf), setup.CONVERSATIONS)
    return docs.unionByName(talks)


@query
def harmonize_audit(spark, sf):
    """The same counts, taken while the cleaned pool is written."""
    audit = cleaning.StageAudit()
    clean_pool(setup.raw_sources(spark, sf), setup.GENRE_MAP, setup.LABEL2ID, audit=audit)
    return audit.counts(spark)


@query
def custom_cleaner(spark, sf):
    """A caller's cleaner for a source that has none built in."""
    hidden = lambda text: F.regexp_replace(F.lower(text), "[0-9]+", "#")
    return cleaning.clean_text(setup.documents(spark, sf), "own", hidden).select("id", "text")


@query
def union_dedup_multilingual(spark, sf):
    """The pool with both cleaners on and without empty texts."""
    return clean_pool(setup.raw_sources(spark, sf), setup.GENRE_MAP, setup.LABEL2ID, apply_multilingual=True, drop_empty=True)


@query
def union_sources(spark, sf):
    parts = [cleaning.rename_columns(s.table, s.config.cols_map) for s in setup.raw_sources(spark, sf)]
    return cleaning.union_sources(parts)


@query
def union_dedup_first(spark, sf):
    return setup.pool(spark, sf)


@query
def class_counts(spark, sf):
    return sampling.class_counts(setup.key_pool(spark, sf))


@query
def min_class_count(spark, sf):
    return sampling.min_class_count(setup.key_pool(spark, sf))


@query
def distinct_labels(spark, sf):
    return sampling.distinct_labels(setup.key_pool(spark, sf))


@query
def class_rank(spark, sf):
    return sampling.class_rank(setup.pool_keys(spark, sf), key_cols=POOL_KEY)


@query
def balance_without_replacement(spark, sf):
    return sampling.balance_classes(setup.pool_keys(spark, sf), key_cols=POOL_KEY, replace=False)


@query
def balance_bootstrap(spark, sf):
    return sampling.balance_classes(setup.pool_keys(spark, sf), key_cols=POOL_KEY)


@query
def stratified_split(spark, sf):
    return sampling.stratified_split(setup.pool_keys(spark, sf), key_cols=POOL_KEY)


@query
def split_sizes(spark, sf):
    return sampling.split_sizes(setup.pool_keys(spark, sf))


@query
def sample_n(spark, sf):
    return sampling.sample_n(setup.pool_keys(spark, sf), 10, POOL_KEY)


@query
def shuffle_rows(spark, sf):
    return sampling.shuffle_rows(setup.pool_keys(spark, sf), POOL_KEY)


@query
def class_sample(spark, sf):
    return sampling.class_sample(setup.pool_keys(spark, sf), 50, key_cols=POOL_KEY)


@query
def harmonize(spark, sf):
    return setup.harmonized(spark, sf)


# --- text features ------------------------------------------------------------------


@query
def word_tokens(spark, sf):
    words = tx.word_tokens(F.col("text"))
    return tx.exploded_tokens(setup.documents(spark, sf), words, "id")


@query
def stop_word_filter(spark, sf):
    words = tx.without_stop_words(tx.word_tokens(F.col("text")), setup.STOP_WORDS)
    return tx.exploded_tokens(setup.documents(spark, sf), words, "id")


@query
def word_ngrams(spark, sf):
    """Distinct unigrams and bigrams of each document with their counts."""
    counted = features.term_frequencies(setup.documents(spark, sf), "text", setup.STOP_WORDS)
    return features.exploded_terms(counted, "id")


def _counted(spark, sf):
    counted = counted_rows(setup.pool(spark, sf), setup.DOCUMENTS.stop_words())
    vocabulary = features.fitted(features.tfidf_fit(counted.where(F.col("split") == "train")))
    return counted, vocabulary


@query
def tfidf_vocabulary(spark, sf):
    return rounded(_counted(spark, sf)[1])


@query
def tfidf_vectors(spark, sf):
    vectors = features.tfidf_transform(*_counted(spark, sf), ROW_KEY)
    return rounded(features.sparse_to_long(vectors, ROW_KEY))


@query
def encode_fixed_length(spark, sf):
    rows = tables.spread_small_scan(stage_table(setup.harmonized(spark, sf)))
    words = features.fitted(features.token_vocabulary(rows.where(F.col("split") == "train")))
    encoded = features.encode_fixed_length(rows, words, ROW_KEY)
    return encoded.select(
        *ROW_KEY,
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.array_join(F.col("attention_mask").cast("array<string>"), " ").alias("attention_mask"),
    )


@query
def hashed_text_embedding(spark, sf):
    vectors = features.hashed_text_embedding(*_counted(spark, sf), ROW_KEY)
    return rounded(vectors.select(*ROW_KEY, F.posexplode_outer("embedding").alias("pos", "value")))


@query
def score_batches(spark, sf):
    """A linear model over all vectors; its weights are the class centroids."""
    splits = setup.embedding_splits(spark, sf)
    weights = np.zeros((setup.N_LABELS, 0))
    # One row per class leaves Spark: the model's weights.
    for row in classify.class_centroids(setup.part(splits, "train")).collect():
        if not weights.shape[1]:
            weights = np.zeros((setup.N_LABELS, len(row["centroid"])))
        weights[row["label"]] = row["centroid"]

    def make_predict_fn():
        def predict(vectors: np.ndarray) -> np.ndarray:
            return vectors.astype(np.float64) @ weights.T

        return predict

    scored = features.score_batches(
        splits, make_predict_fn, ["embedding"], input_tensor_shapes=[[weights.shape[1]]]
    )
    return rounded(scored.select("id", F.posexplode_outer("scores").alias("label", "score")))


# --- neighbours ---------------------------------------------------------------------


@query
def knn_cosine(spark, sf):
    found = setup.neighbors_of(setup.embedding_splits(spark, sf), "cosine")
    return rounded(found.select("qid", "rank", "nid", "distance"))


@query
def knn_euclidean(spark, sf):
    found = setup.neighbors_of(setup.embedding_splits(spark, sf), "euclidean")
    return rounded(found.select("qid", "rank", "nid", "distance"))


@query
def knn_all_rows(spark, sf):
    """Every vector against the train split, so queries are as many as there are rows."""
    splits = setup.embedding_splits(spark, sf)
    found = knn.knn_join(splits, setup.part(splits, "train"), setup.K, "cosine")
    return rounded(found)


@query
def knn_approx(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    return rounded(approx.knn_join_approx(setup.part(splits, "test"), setup.part(splits, "train"), setup.K))


@query
def knn_with_metadata(spark, sf):
    found = setup.neighbors_of(setup.embedding_splits(spark, sf), "cosine")
    named = knn.attach_neighbor_metadata(found, setup.texts(spark, sf), cols=["text"])
    return rounded(named.select("qid", "rank", "nid", "distance", "n_label", "n_text"))


@query
def neighbor_labels(spark, sf):
    lists = knn.neighbor_lists(setup.neighbors_of(setup.embedding_splits(spark, sf), "euclidean", query_cols=()))
    return lists.select("qid", F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"))


@query
def majority_vote(spark, sf):
    return setup.knn_predictions(setup.neighbors_of(setup.embedding_splits(spark, sf), "euclidean"))


@query
def vote_distribution(spark, sf):
    lists = knn.neighbor_lists(setup.neighbors_of(setup.embedding_splits(spark, sf), "euclidean", query_cols=()))
    shares = knn.vote_distribution(lists, setup.N_LABELS, setup.K)
    return rounded(shares.select("qid", F.posexplode_outer("p_knn").alias("label", "p")))


def _per_query(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    sizes = sampling.class_counts(setup.part(splits, "train"))
    return knn.precision_recall_at_k(setup.neighbors_of(splits, "cosine"), sizes, setup.K)


@query
def precision_recall_at_k(spark, sf):
    return rounded(_per_query(spark, sf))


@query
def mean_precision_recall(spark, sf):
    return rounded(knn.mean_precision_recall(_per_query(spark, sf)))


# --- classifiers --------------------------------------------------------------------


@query
def knn_classify(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    model = classify.KNNClassifier(setup.K).fit(setup.part(splits, "train"))
    return metrics.align_truth(model.predict(setup.part(splits, "test")), setup.part(splits, "test"))


@query
def centroid_scores_softmax(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    scored = classify.model_probabilities(
        setup.model_scores(setup.part(splits, "test"), splits), setup.N_LABELS
    )
    return rounded(scored.select("id", F.posexplode_outer("p_model").alias("label", "p")))


@query
def uniform_probabilities(spark, sf):
    rows = setup.embeddings(spark, sf)
    return rounded(rows.select("id", F.posexplode_outer(uniform_scores(setup.N_LABELS)).alias("label", "p")))


@query
def hybrid_classify(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    inputs = setup.blend_inputs(splits, setup.held_out_neighbors(splits))
    return classify.hybrid_classify(inputs, 0.5).select("id", "split", "y_true", "y_pred")


def _alpha_metrics(splits, neighbors):
    by = ["split", "alpha_pos", "alpha"]
    return metrics.evaluate(setup.swept(splits, neighbors), by, range(setup.N_LABELS))


def _test_alphas(splits, neighbors):
    return _alpha_metrics(splits, neighbors).where(F.col("split") == "test").drop("split")


@query
def alpha_sweep(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    scores = _alpha_metrics(splits, setup.held_out_neighbors(splits))
    return rounded(scores.select("split", "alpha", "accuracy", "macro_f1"))


@query
def best_alpha(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    return rounded(report.best_alpha(_test_alphas(splits, setup.held_out_neighbors(splits))))


@query
def linear_tfidf_predictions(spark, sf):
    data = encode(setup.harmonized(spark, sf), setup.STOP_WORDS)
    rows = stage_table(_keyed(data.features))
    model = classify.LinearTextClassifier(features.MAX_FEATURES).fit(rows.where(F.col("split") == "train"))
    path = _own_path(spark)
    tables.save_model(model.model, path)
    model.model = tables.load_model(path)
    return metrics.align_truth(model.predict(rows.where(F.col("split") == "test")), rows).select("id", "y_true", "y_pred")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the three-part key written as one ``id``."""
    return rows.withColumn("id", F.concat_ws(":", *[F.col(c).cast("string") for c in ROW_KEY])).drop("src", "draw")


@query
def learning_curve(spark, sf):
    data = encode(setup.harmonized(spark, sf), setup.STOP_WORDS)
    rows = stage_table(_keyed(data.features))
    parts = {name: rows.where(F.col("split") == name) for name in ("train", "eval")}
    curve = classify.learning_curve(parts["train"], parts["eval"], features.MAX_FEATURES)
    return rounded(curve)


# --- metrics ------------------------------------------------------------------------


@query
def prediction_registry(spark, sf):
    return _registry(spark, sf)


def _registry(spark, sf, *names):
    """Predictions of the models named, by default of all of them."""
    splits = setup.embedding_splits(spark, sf)
    return setup.registry(spark, sf, splits, names) if names else setup.registry(spark, sf, splits)


@query
def evaluate_metrics(spark, sf):
    return rounded(metrics.evaluate(_registry(spark, sf), ["model"], range(setup.N_LABELS)))


@query
def f1_per_class(spark, sf):
    return rounded(metrics.f1_per_class(_registry(spark, sf), ["model"]))


@query
def recall_per_class(spark, sf):
    return rounded(
        metrics.recall_per_class(_registry(spark, sf), setup.N_LABELS, ["model"])
    )


@query
def recall_matrix(spark, sf):
    return rounded(metrics.recall_matrix(_registry(spark, sf), setup.N_LABELS))


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_registry(spark, sf), ["model"])


@query
def compare_models(spark, sf):
    scores = metrics.evaluate(_registry(spark, sf, "teacher", "student"), ["model"], range(setup.N_LABELS))
    return rounded(metrics.compare_models(scores, "teacher", "student"))


@query
def compare_neighbors_with_tfidf(spark, sf):
    scores = metrics.evaluate(_registry(spark, sf, "knn_embeddings", "baseline_tfidf"), ["model"], range(setup.N_LABELS))
    return rounded(metrics.compare_models(scores, "baseline_tfidf", "knn_embeddings"))


@query
def compare_alphas_with_teacher(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    alphas = _test_alphas(splits, setup.held_out_neighbors(splits)).select("alpha", "accuracy", "macro_f1")
    teacher = metrics.evaluate(setup.model_predictions(splits))
    return rounded(metrics.compare_with(alphas, teacher, ["alpha"]))


@query
def degradation_by_class(spark, sf):
    return rounded(metrics.degradation_by_class(_registry(spark, sf, "teacher", "student"), "teacher", "student"))


# --- reports ------------------------------------------------------------------------


@query
def leaderboard(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    neighbors = setup.held_out_neighbors(splits)
    models = metrics.evaluate(setup.registry(spark, sf, splits, setup.MODELS, neighbors), ["model"], range(setup.N_LABELS))
    return rounded(report.leaderboard(models, _test_alphas(splits, neighbors), setup.MODELS))


@query
def correct_incorrect_counts(spark, sf):
    predictions = stage_table(_registry(spark, sf))
    right = report.correct_rows(predictions).groupBy("model").agg(F.count(F.lit(1)).alias("n"))
    wrong = report.incorrect_rows(predictions).groupBy("model").agg(F.count(F.lit(1)).alias("n"))
    return right.select("model", F.lit("right").alias("outcome"), "n").unionByName(
        wrong.select("model", F.lit("wrong").alias("outcome"), "n")
    )


def _examples(spark, sf, correct):
    predictions = stage_table(QUERIES["majority_vote"](spark, sf))
    return report.prediction_examples(predictions, setup.texts(spark, sf), correct)


@query
def correct_examples(spark, sf):
    return _examples(spark, sf, True)


@query
def incorrect_examples(spark, sf):
    return _examples(spark, sf, False)


@query
def explain_errors(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    predictions = stage_table(setup.model_predictions(splits, "euclidean"))
    parts = setup.part(splits, "test"), setup.part(splits, "train")
    return rounded(report.explain_errors(predictions, *parts, texts=setup.texts(spark, sf)))


@query
def search_report(spark, sf):
    splits = setup.embedding_splits(spark, sf)
    queries, corpus = setup.part(splits, "eval"), setup.part(splits, "train")
    return rounded(report.search_report(queries, corpus, setup.texts(spark, sf)))


@query
def class_pseudo_document(spark, sf):
    rows = stage_table(_train_rows(spark, sf))
    return report.class_pseudo_document(rows)


def _train_rows(spark, sf):
    return _keyed(setup.harmonized(spark, sf)).where(F.col("split") == "train")


@query
def extractive_class_summary(spark, sf):
    train = tables.spread_small_scan(stage_table(_train_rows(spark, sf)))
    counted = features.term_frequencies(train, "text", setup.STOP_WORDS)
    vocabulary = features.fitted(features.tfidf_fit(counted))
    rows = stage_table(features.tfidf_transform(counted, vocabulary, ["id", "label"]))
    return report.extractive_class_summary(train, rows, vocabulary, stop_words=setup.STOP_WORDS)


@query
def text_search(spark, sf):
    """Every held-out text of the pool against its train texts."""
    pool = setup.pool(spark, sf).withColumn("id", F.concat_ws(":", F.col("src").cast("string"), F.col("id").cast("string")))
    rows = tables.spread_small_scan(stage_table(sampling.stratified_split(pool.drop("src"))))
    train, held = rows.where(F.col("split") == "train"), rows.where(F.col("split") != "train")
    found = search_texts(held.select("id", "text"), train.select("id", "text", "label"), setup.K, setup.STOP_WORDS)
    return rounded(found.select("qid", "rank", "nid", "distance", "n_label", "n_text"))


# --- persisted tables ---------------------------------------------------------------


def _own_path(spark):
    return f"{staging_root(spark)}/versemill/{uuid.uuid4().hex}"


@query
def feature_bundle(spark, sf):
    """Two versions of the features and encodings, the first without evaluation rows, read back.

    Features and encodings are made once, for all rows; both versions take theirs from them.
    """
    data = encode(setup.harmonized(spark, sf), setup.STOP_WORDS)
    path, key = _own_path(spark), list(ROW_KEY)
    features = stage_table(data.features.drop("label"), partition_by=("split",))
    tokens = stage_table(data.rows.select(*key, "split").join(data.tokens, key), partition_by=("split",))
    for without in (["eval"], []):
        wanted = ~F.col("split").isin(*without)
        rows = data.rows.where(wanted)
        tables.write_bundle(
            spark,
            path,
            {
                "terms": data.terms,
                "words": data.words,
                "features": features.where(wanted),
                "labels": rows.select(*key, "split", "label"),
                "tokens": tokens.where(wanted),
            },
        )
    out = None
    for version in tables.bundle_versions(spark, path):
        n_terms = tables.read_bundle(spark, path, "terms", version=version).count()
        for split in tables.SPLITS:
            held = {n: tables.read_bundle(spark, path, n, split, version).drop("split") for n in ("features", "labels", "tokens")}
            part = held["labels"].join(held["features"], key).join(held["tokens"], key).select(
                F.lit(version).alias("version"),
                *key,
                F.lit(split).alias("split"),
                "label",
                F.size("term_ids").alias("n_terms"),
                F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_words"),
                F.lit(n_terms).cast("long").alias("n_vocabulary"),
            )
            out = part if out is None else out.unionByName(part)
    return out


@query
def write_read_splits(spark, sf):
    path = _own_path(spark)
    tables.write_splits(setup.harmonized(spark, sf), path)
    parts = [tables.read_split(spark, path, name) for name in tables.SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def split_views(spark, sf):
    """Both forms of the test split, with the sizes of what they hold."""
    data = encode(setup.harmonized(spark, sf), setup.STOP_WORDS)
    tokens = data.rows.select(*ROW_KEY, "split", "label", "text").join(data.tokens, list(ROW_KEY))
    sparse = tables.split_view(data.features, "test", "baseline", ROW_KEY)
    dense = tables.split_view(tokens, "test", "transformer", ROW_KEY)
    return sparse.select(*ROW_KEY, "label", F.size("term_ids").alias("n_terms")).join(
        dense.select(
            *ROW_KEY,
            F.size("input_ids").alias("n_ids"),
            F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_words"),
        ),
        list(ROW_KEY),
    )


@query
def materialise_embeddings(spark, sf):
    """Vectors computed once and read back; the second call only reads."""
    path = _own_path(spark)
    compute = lambda: setup.embeddings(spark, sf)
    tables.materialise_embeddings(spark, path, compute)
    saved = tables.materialise_embeddings(spark, path, compute)
    return rounded(saved.select("id", "label", F.posexplode_outer(F.col("embedding").cast("array<double>")).alias("pos", "value")))
