"""TF-IDF, token ids and hashed embeddings on small texts worked out by hand."""

from __future__ import annotations

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from versemill.operators import features


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string")


def test_term_counts_equal_grouping(spark):
    df = features.term_frequencies(texts(spark, "aa bb aa bb aa", "", "x y z", "one"), "text")
    got = {r["id"]: {t["term"]: t["tf"] for t in r["tf"]} for r in df.collect()}
    assert got == {0: {"aa": 3, "bb": 2, "aa bb": 2, "bb aa": 2}, 1: {}, 2: {}, 3: {"one": 1}}


def test_tfidf_by_hand(spark):
    train = features.term_frequencies(texts(spark, "aa aa bb", "bb cc", "bb"), "text")
    vocabulary = features.fitted(features.tfidf_fit(train))
    idf = {r["term"]: r["idf"] for r in vocabulary.collect()}
    assert idf["bb"] == pytest.approx(math.log(4 / 4) + 1) and idf["aa"] == pytest.approx(math.log(4 / 2) + 1)
    assert [r["term"] for r in vocabulary.orderBy("term_id").collect()] == sorted(idf)
    rows = {r["id"]: r for r in features.tfidf_transform(
        features.term_frequencies(texts(spark, "aa aa bb zz", "zz", ""), "text"), vocabulary).collect()}
    raw = {"aa": (1 + math.log(2)) * idf["aa"], "aa aa": idf["aa aa"], "aa bb": idf["aa bb"], "bb": idf["bb"]}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    assert rows[0]["weights"] == pytest.approx([raw[t] / norm for t in sorted(raw)])
    assert rows[1]["term_ids"] == [] and rows[2]["weights"] == []


def test_vocabulary_cut_prefers_smaller_term(spark):
    train = features.term_frequencies(texts(spark, "cc", "bb", "aa", "dd dd"), "text")
    kept = [r["term"] for r in features.tfidf_fit(train, 3).orderBy("term_id").collect()]
    assert kept == ["aa", "bb", "dd"]


def test_all_stop_words(spark):
    df = features.term_frequencies(texts(spark, "the of", "the cat"), "text", ["the", "of"])
    assert [len(r["tf"]) for r in df.orderBy("id").collect()] == [0, 1]


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129])
def test_encoding_length(spark, n):
    train = texts(spark, "aa aa bb")
    words = features.fitted(features.token_vocabulary(train))
    row = features.encode_fixed_length(texts(spark, " ".join(["aa", "zz"] * 100)[: 3 * n]), words).first()
    want = ([2, 1] * 100)[: min(n, 128)]
    assert row["input_ids"] == want + [0] * (128 - len(want))
    assert row["attention_mask"] == [1] * len(want) + [0] * (128 - len(want))


def test_hashed_embedding_is_unit_or_zero(spark):
    df = features.term_frequencies(texts(spark, "aa bb cc", "aa bb cc", "zz"), "text")
    vocabulary = features.fitted(features.tfidf_fit(df.where("id < 2")))
    rows = {r["id"]: np.array(r["embedding"]) for r in features.hashed_text_embedding(df, vocabulary, dim=16).collect()}
    assert np.linalg.norm(rows[0]) == pytest.approx(1.0) and np.allclose(rows[0], rows[1])
    assert not rows[2].any() and len(rows[2]) == 16


def test_large_vocabulary_joins_without_broadcast(spark, monkeypatch):
    from versemill.operators import joins

    df = features.term_frequencies(texts(spark, "aa bb", "bb cc"), "text")
    vocabulary = features.fitted(features.tfidf_fit(df))
    small = {r["id"]: r["weights"] for r in features.tfidf_transform(df, vocabulary).collect()}
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (0,))
    plain = features.tfidf_transform(df, vocabulary)
    assert {r["id"]: r["weights"] for r in plain.collect()} == small


def test_score_batches(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "id long, v array<double>")

    def make():
        return lambda v: v.sum(axis=1, keepdims=True)

    out = features.score_batches(df, make, ["v"], input_tensor_shapes=[[2]], batch_size=3)
    assert {r["id"]: r["scores"] for r in out.collect()} == {i: [i + 1.0] for i in range(10)}
    assert out.select(F.size("scores")).first()[0] == 1


def test_terms_are_counted_as_numbers_many_rows_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    words = ["aa", "aab", "a_", "ä1", "b0", "zz", "été", "aa0", "𐐨x", "ﬀ"]
    rows = [[words[i] for i in rng.integers(0, len(words), n)] for n in (0, 1, 2, 30, 0, 400, 3)] + [None]
    monkeypatch.setattr(features, "WORDS_AT_ONCE", 16)
    got = features._counted_terms(pa.array(rows, pa.list_(pa.string()))).to_pylist()
    for row, terms in zip(rows, got):
        row = row or []
        wanted = collections.Counter(row + [f"{a} {b}" for a, b in zip(row, row[1:])])
        assert [(t["term"], t["tf"]) for t in terms] == sorted(wanted.items(), key=lambda x: x[0].encode())
    df = spark.createDataFrame([(1, None), (2, "Aa aa"), (3, "")], "id long, text string")
    for batched in (False, True):
        rows = features.term_frequencies(df, batched=batched).collect()
        assert {r["id"]: [tuple(t) for t in r["tf"]] for r in rows} == {1: [], 2: [("aa", 2), ("aa aa", 1)], 3: []}


def test_terms_are_hashed_once_a_term_of_the_vocabulary(spark):
    df = features.term_frequencies(texts(spark, "aa bb cc", "aa bb"), "text")
    vocabulary = features.fitted(features.tfidf_fit(df))
    plan = features.hashed_text_embedding(df, vocabulary, dim=16)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "md5" in line]
    assert lines and all("idf" in line and "tf" not in line.replace("term", "") for line in lines)
