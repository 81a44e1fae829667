"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from versemill.llm import bpe, exact, licenses, minhash, mix, quality, secrets, substring, vectors, warc
from versemill.llm.components import connected_components

PATH = public_tokenizers.path("byte_bpe_50k.json")
#: Documents' columns, and others named like the operators' own.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, label int, rank int, target double, "
    "id bigint, unit bigint, lead bigint, draws int, n_blocks int, ids binary, spans string, places string, n int, text_key int, quality_score int"
)
NEAR = " ".join(f"word{i}" for i in range(120))
TEXTS = [
    (1, "a  b\tc"), (2, "a b c"), (3, None), (4, ""), (5, " \n "), (6, "long " * 30_000), (7, NEAR), (8, NEAR + " more"),
    (9, NEAR.upper()), (2, "a b c"), (2, "other text"), (None, "a b c"), (None, None), (10, "x" * 5000), (11, 'password = "abcdefghijkl1234"'),
    (12, "MIT license. See CC-BY and the Apache License"), (13, NEAR + " more"),
]


def rows_of(texts, source="s"):
    extra = [7, 1, 2, 0.5, 3, 4, 5, 6, 7, b"x", "y", "z", 8, 9, 10]
    return [(d, t, "en", None if i % 5 == 0 else f"{source}{i % 3}", len(t or ""), *extra) for i, (d, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(TEXTS), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact(docs, empty):
    got = exact.exact_groups(docs).collect()
    assert len(got) == len(TEXTS)
    group = [r for r in got if r["text_sha256"] == hashlib.sha256(b"a b c").hexdigest()]
    assert len(group) == 4 and all(r["keep_id"] == 1 and r["group_size"] == 4 for r in group)
    assert sum(r["kept"] for r in group) == 1
    blank = [r for r in got if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert {r["keep_id"] for r in blank} == {3} and len(blank) == 3
    left = exact.drop_exact_copies(docs)
    assert left.columns == docs.columns
    want = len({re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in TEXTS})
    assert left.count() == want
    assert exact.exact_groups(empty).count() == exact.drop_exact_copies(empty).count() == 0


def test_exact_keeps_one_of_repeated_rows(spark):
    twice = spark.createDataFrame(rows_of([(1, "same"), (1, "same"), (1, "same"), (2, "same")]), SCHEMA)
    assert sum(r["kept"] for r in exact.exact_groups(twice).collect()) == 1
    assert exact.drop_exact_copies(twice).count() == 1


def test_chunks_join_to_the_text(spark):
    texts = ["", "a", "word and. " * 3000, "x" * 20_000, "é中 " * 4000]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("c", exact.content_chunks(F.col("text")))
    for r in df.collect():
        assert "".join(r["c"]) == r["text"] and all(len(c) <= exact.CHUNK_MOST for c in r["c"])


def test_colliding_chunk_identifiers_are_told_apart(spark):
    a, b = b"1" * 32, b"2" * 32
    chunks = spark.createDataFrame(
        [(1, 1, "x", [(7, a)]), (2, 2, "y", [(7, b)]), (3, 3, "x", [(7, a)])],
        "doc_id long, row long, text_sha256 string, chunks array<struct<id:long,sha:binary>>",
    )
    recipes = exact.with_recipes(chunks).collect()
    assert len({str(r["recipe"]) for r in recipes}) == 2


def test_mix(docs, empty):
    got = mix.mixed_sizes(docs, block_words=100).collect()
    assert len(got) == len(TEXTS)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    drawn = mix.mix(docs, block_words=100)
    assert drawn.columns == docs.columns
    assert drawn.count() == sum(len(r["shards"]) for r in got)
    assert mix.mixed_sizes(empty).count() == mix.mix(empty).count() == 0


def test_splitting_tree_keeps_quotas_and_is_hypergeometric(spark):
    quotas = [40, 7, 0, 3]
    start = spark.createDataFrame([(quotas,)], "quotas array<bigint>")
    means = []
    for seed in range(12):
        leaves = mix.splitting_tree(start, 5, 50, seed).orderBy("shard").collect()
        assert [sum(r["quotas"]) for r in leaves] == [10] * 5
        assert [sum(q) for q in zip(*(r["quotas"] for r in leaves))] == quotas
        assert [r["starts"] for r in leaves] == [
            [sum(x["quotas"][s] for x in leaves[:k]) for s in range(4)] for k in range(5)
        ]
        means.append(leaves[2]["quotas"][0])
    assert 6.5 < np.mean(means) < 9.5 and len(set(means)) > 1


def test_hypergeometric_quantiles(spark):
    from math import comb

    total, marked, drawn = 30, 12, 9
    us = [i / 500 + 0.001 for i in range(500)]
    df = spark.createDataFrame([(u,) for u in us], "u double")
    one = lambda n: F.lit(n).cast("long")
    got = [r[0] for r in df.select(mix.hypergeometric(one(total), one(marked), one(drawn), F.col("u"))).collect()]
    for k in range(10):
        want = comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn)
        assert abs(got.count(k) / 500 - want) < 0.006


def test_bpe(docs, empty):
    encoded = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH)
    got = encoded.select("text", "ids", "decoded").collect()
    assert len(got) == len(TEXTS) and all(r["decoded"] == (r["text"] or "") for r in got)
    assert bpe.encode_documents(empty, PATH).count() == 0


def test_near_copies(docs, empty):
    got = minhash.near_classes(docs, size=4).collect()
    assert len(got) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] not in (None, 2)}
    assert {by_id[d]["component_id"] for d in (7, 8, 9, 13)} == {7}
    assert all(by_id[d]["component_id"] == d and by_id[d]["n_shingles"] == 0 for d in (3, 4, 5))
    left = minhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.select("doc_id").collect()]
    assert 7 in ids and not {8, 9, 13} & set(ids) and {3, 4, 5} <= set(ids)
    assert minhash.drop_near_copies(empty).count() == minhash.near_classes(empty).count() == 0


@pytest.mark.parametrize("block_bytes", [minhash.BLOCK_BYTES, 60_000])
def test_near_copies_in_a_group_without_a_common_centre(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(minhash, "BLOCK_BYTES", block_bytes)
    rng = np.random.default_rng(4)
    base, texts = [f"w{i}" for i in range(200)], []
    for d in range(80):
        words = list(base)
        for at in rng.choice(200, 1 + d % 7, replace=False):
            words[at] = f"x{d}y{at}"
        texts.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    sets = {d: {tuple(t.split()[i : i + 4]) for i in range(197)} for d, t in texts}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_classes(docs, size=4).collect()}
    assert got == {d: find(d) for d in sets}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    got = {r["id"]: r["root"] for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert connected_components(links.where("a < 0")).count() == 0


def test_substrings(spark, docs, empty):
    passage = " ".join(f"p{i}" for i in range(70))
    texts = TEXTS + [(20, f"one two {passage} three"), (21, f"{passage} four"), (22, "zero " + " ".join(passage.split()[:49])), (21, f"{passage} four")]
    df = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    got = substring.dedup_substrings(df).collect()
    ids = {d: (t or "").split() for d, t in texts if d not in (None, 2)}
    keyed = {}
    for d in sorted(ids):
        for i in range(len(ids[d]) - 49):
            keyed.setdefault(tuple(ids[d][i : i + 50]), d)
    assert len(got) == len(texts)
    for r in got:
        if r["doc_id"] in ids:
            words = ids[r["doc_id"]]
            gone = {j for i in range(len(words) - 49) if keyed[tuple(words[i : i + 50])] < r["doc_id"] for j in range(i, i + 50)}
            kept = " ".join(w for j, w in enumerate(words) if j not in gone)
            assert (r["n_words"], r["n_removed"]) == (len(words), len(gone))
            assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert substring.dedup_substrings(empty).count() == 0


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(d, d % 2) for d in range(1, 14)] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    network = quality.fit_quality(docs, labels)
    got = quality.score_documents(docs, network)
    assert set(got.columns) == set(docs.columns)
    assert all(0 <= r["quality_score"] <= 1 for r in got.select("quality_score").collect())
    unlabelled = quality.fit_quality(docs, labels.where("quality = 7"))
    assert {r[0] for r in quality.score_documents(docs, unlabelled).select("quality_score").collect()} == {0.5}
    assert quality.drop_low_quality(docs, unlabelled).count() == len(TEXTS)
    assert quality.drop_low_quality(empty, quality.fit_quality(empty, labels)).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    table = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
        (7, None, 1), (8, [], 1), (9, [0.0, 0.0], 1), (10, [None, 1.0], 1), (11, [1.0, 0.1], 1), (11, [1.0, 0.1], 1), (12, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.01], 1), (13, [0.0, -1.0], 1),
    ]
    df = spark.createDataFrame(table, "vec_id bigint, embedding array<float>, label int").repartition(2).withColumns({"n": F.lit(1), "cls": F.lit(2)})
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in vectors.linked_vectors(df).collect()]
    alone = [(v, 0, v) for v in (3, 4, 5, 6, 7, 8, 9, 10, 12, 13)]
    assert sorted(got, key=str) == sorted([(v, 4, 1) for v in (1, 2, 11, 11, None)] + alone, key=str)
    assert vectors.linked_vectors(df.where("n = 0")).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame(
        [(3, "http://a/\r\nx", "same", 1), (1, "http://b/", "same", 1), (2, None, None, 1), (4, "http://c/", "", 1), (1, "http://b/", "same", 1),
         (None, "http://d/", "body\r\n\r\nWARC/1.1\r\n", 1), (7, "http://e/é", "ü" * 70_000, 1)],
        "page_id bigint, url string, html string, record int",
    ).repartition(3)
    got = warc.round_trip(pages).collect()
    assert len(got) == 7
    kinds = sorted((r["page_id"] or 0, r["type"], r["refers_to_page"]) for r in got if r["payload_bytes"] == 4)
    assert kinds == [(1, "response", None), (1, "revisit", 1), (3, "revisit", 1)]
    blank = sorted((r["page_id"], r["type"], r["refers_to_page"]) for r in got if r["payload_bytes"] == 0)
    assert blank == [(2, "response", None), (4, "revisit", 2)]
    assert {r["payload_bytes"] for r in got} == {0, 4, 18, 140_000}
    assert all(len(r["requests"]) == len(r["metadata"]) == 1 and r["digest_holds"] in (True, None) for r in got)
    assert warc.round_trip(pages.where("page_id > 100")).count() == 0
    bigger = warc.round_trip(pages, revisit_from=5).collect()
    assert {r["type"] for r in bigger} == {"response"}


def test_metadata_that_names_the_request(spark):
    records = spark.createDataFrame(
        [("c", "response", [], None), ("q", "request", ["c"], None), ("m", "metadata", ["q"], None), ("d", "response", ["z"], None), ("z", "request", [], None)],
        "record_id string, type string, concurrent_to array<string>, refers_to string",
    )
    for name, kind in (("uri", "string"), ("date", "string"), ("http_status", "int"), ("payload_bytes", "long"), ("payload_digest", "string"), ("digest_holds", "boolean")):
        records = records.withColumn(name, F.lit(None).cast(kind))
    records = records.withColumn("fields", F.create_map(F.lit("a"), F.lit("b")))
    got = {r["record_id"]: r for r in warc.assemble_captures(records).collect()}
    assert [len(got["c"][k]) for k in ("requests", "metadata")] == [1, 1]
    assert [len(got["d"][k]) for k in ("requests", "metadata")] == [1, 0]


def test_scans(docs, empty):
    found = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs).collect()}
    assert [s["kind"] for s in found[11]] == ["assign"] and found[3] == []
    marked = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert [p["label"] for p in marked[12]["places"]] == ["mit", "cc-by", "apache"]
    assert marked[3]["n_words"] == 0 and marked[6]["n_words"] == 30_000
    assert secrets.scan_secrets(empty).count() == licenses.scan_licenses(empty).count() == 0


def test_pipeline_stages_on_edge_rows(spark, docs, empty, tmp_path):
    labels = spark.createDataFrame([(d, 1) for d in range(1, 14)], "doc_id bigint, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, str(tmp_path))
            out.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
            if (name, stage) != corpus_pipeline.STAGES[-1]:
                assert out.columns == table.columns
