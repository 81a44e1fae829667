"""Repeated rows, hot and null keys, very long texts, and stages in a chain."""

from __future__ import annotations

import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from versemill.llm import bpe, licenses, minhash, mix, quality, secrets, vectors, warc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], DOCS).repartition(4)


def rows_a_partition(df):
    """Rows of the largest partition and of all, with partitions left as they were dealt."""
    counts = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    return max(counts), sum(counts)


@pytest.fixture
def as_dealt(spark):
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_mix_meets_targets_with_repeated_rows(spark):
    big = "word " * 400
    rows = [(1, big, "a")] * 50 + [(i, "word " * (i % 37 + 1), "b") for i in range(300)] + [(i, "x " * 20, "c") for i in range(60)]
    got = mix.mixed_sizes(documents(spark, rows), block_words=500).toPandas()
    assert len(got) == len(rows) and (got["taken"] <= 2 * got["size"]).all()
    for size, part in got.groupby("source_size"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= part["size"].max()
    assert got[got["doc_id"] == 1]["taken"].nunique() > 1
    drawn = mix.mix(documents(spark, rows), block_words=500)
    assert drawn.count() == got["shards"].map(len).sum()
    again = mix.mixed_sizes(documents(spark, rows), block_words=500).toPandas()
    assert sorted(zip(again["doc_id"], again["taken"])) == sorted(zip(got["doc_id"], got["taken"]))


def test_shards_of_a_mix_are_disjoint_and_shuffled(spark):
    rows = [(i, f"w{i} " * (i % 9 + 1), "ab"[i % 2]) for i in range(400)]
    docs = documents(spark, rows)
    got = mix.mixed_sizes(docs, block_words=60, blocks_per_shard=8).toPandas()
    # A pass takes a document at most once, so its draws are as many as it is taken.
    assert (got["taken"] == got["size"] * got["shards"].map(len)).all() and len({s for x in got["shards"] for s in x}) > 5
    order = [r["doc_id"] for r in mix.mix(docs, block_words=60, blocks_per_shard=8).select("doc_id").collect()]
    assert order != sorted(order) and len(order) == got["shards"].map(len).sum()


def test_revisits_are_found_and_responses_stay_spread(spark, as_dealt):
    rows = [(i, f"http://h/{i}", "same" if i % 3 == 0 else f"page {i}") for i in range(900)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(6))
    kinds = {r["page_id"]: (r["type"], r["refers_to_page"]) for r in got.collect()}
    assert kinds == {i: ("revisit", 0) if i % 3 == 0 and i else ("response", None) for i in range(900)}
    most, total = rows_a_partition(got)
    assert most < total / 2


@pytest.mark.parametrize("kind", ["all alone", "one component", "no words"])
@pytest.mark.parametrize("small", [True, False])
def test_near_classes_stay_spread(spark, as_dealt, monkeypatch, kind, small):
    if not small:
        monkeypatch.setattr(minhash, "broadcast_if_small", lambda df: df)
    base = [f"b{i}" for i in range(60)]
    texts = {
        "all alone": lambda i: " ".join(f"w{i}x{j}" for j in range(8)),
        "one component": lambda i: " ".join([*base, f"end{i % 40}"]),
        "no words": lambda i: None if i % 2 else " \n",
    }[kind]
    got = minhash.near_classes(documents(spark, [(i, texts(i), "s") for i in range(1200)]), size=4)
    ids = {r["doc_id"]: r["component_id"] for r in got.select("doc_id", "component_id").collect()}
    assert ids == {i: 0 if kind == "one component" else i for i in range(1200)}
    if small or kind != "one component":  # without broadcast, components are salted from 100,000 rows on
        most, total = rows_a_partition(got)
        assert most <= total / 2


def plain_novel_spans(text, known):
    """The rule of the scan, candidate by candidate."""
    found, done = [], -1
    words = list(secrets.SENSITIVE.finditer(text))
    runs = [(m.start(), m.end()) for m in secrets.CANDIDATE.finditer(text)]
    for word in words:
        for start, end in runs:
            # A word inside a run opens the rest of the run.
            start = max(start, word.start())
            if start < done or end - start < secrets.LEAST_NOVEL or start > word.end() + secrets.CONTEXT:
                continue
            done = end
            value = text[start:end]
            if any(a < end and start < b for a, b, _ in known) or not (re.search("[0-9]", value) and re.search("[A-Za-z]", value)):
                continue
            if secrets.novelty(value, text[max(0, start - secrets.AROUND) : start], text[end : end + secrets.AROUND]) >= secrets.NOVELTY:
                found.append((start, end, secrets.NOVEL))
    return found


def test_novel_spans_against_the_plain_rule():
    rng = np.random.default_rng(9)
    letters = np.array(list("ABCDEFGHabcdefgh0123456789+/"))
    pieces = ["session ", "bearer: ", "the key ", "cookie=", "password = ", "😀 ", "plain words here ", "\n", "api_key: 'abcdefghijkl12'", "deadbeefdeadbeef00 ", "access_key_id_access_key_id "]
    hits = 0
    for _ in range(60):
        parts = [rng.choice(pieces) if rng.random() < 0.7 else "".join(rng.choice(letters, rng.integers(10, 60))) + " " for _ in range(25)]
        text = "".join(parts)
        known = secrets.base_spans(text)
        got = secrets.novel_spans(text, known)
        assert got == plain_novel_spans(text, known)
        hits += len(got)
    assert hits > 20


def test_scan_of_a_long_text_with_many_spans():
    text = "token 0123456789abcdef01234567 " * 60_000
    start = time.time()
    known = secrets.base_spans(text)
    secrets.novel_spans(text, known)
    assert len(known) == 60_000 and time.time() - start < 30


def test_full_caches_give_the_same_ids(monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [" ".join(f"word{i * j % 977}é" for j in range(300)) for i in range(12)]
    want = bpe.Tokenizer(path).encode(texts)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 50)
    model = bpe.Tokenizer(path)
    assert [x for t in texts for x in model.encode([t])] == want
    decoder = bpe.Decoder(path)
    assert [decoder.decode(ids) for ids in want] == texts


def test_every_link_of_planted_vectors_is_found(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 64)
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(60, 32))
    rows = [c + rng.normal(size=32) * rng.choice([0.05, 0.2, 0.3]) for c in centres for _ in range(20)] + list(rng.normal(size=(800, 32)))
    labels = [None if i % 17 == 0 else i % 2 for i in range(len(rows))]
    data = [(i, [float(np.float32(x)) for x in v], lab) for i, (v, lab) in enumerate(zip(rows, labels))]
    got = {r["vec_id"]: r for r in vectors.linked_vectors(spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int").repartition(4)).collect()}
    unit = np.array([v for _, v, _ in data])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    same = np.array([-1 if x is None else x for x in labels])
    linked = (unit @ unit.T >= vectors.COSINE) & (same[:, None] == same[None]) & (same >= 0)[:, None]
    np.fill_diagonal(linked, False)
    want = linked.sum(axis=1)
    assert want.sum() > 1000
    assert [got[i]["n_links"] for i in range(len(data))] == want.tolist()
    root = np.arange(len(data))
    while True:
        new = np.minimum(root, np.where(linked, root[None], len(data)).min(axis=1))
        if (new == root).all():
            break
        root = new
    assert [got[i]["component_id"] for i in range(len(data))] == root.tolist()


def test_the_whole_pipeline_in_a_chain(spark, tmp_path):
    good, bad = "the quiet river ran past old stone walls and gardens ", "buy cheap !!! click $$$ now free win "
    rows = [(i, (good if i % 3 else bad) * 6 + " ".join(f"u{i}v{j}" for j in range(30)), f"s{i % 4}") for i in range(240)]
    rows += [(1000 + i, rows[i][1], "s0") for i in range(1, 40)]  # exact copies
    rows += [(2000 + i, rows[i][1] + " more", "s1") for i in range(1, 40)]  # near copies
    rows += [(3000, None, None), (3001, "", "s0"), (None, good * 5, "s2"), (5, "repeated id " * 9, "s1")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, int(d % 3 > 0)) for d, _, _ in rows[:240]], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in out}
    assert all(r["decoded_equal"] and r["n_tokens"] == len(r["ids"]) // 4 for r in out)
    assert not any(d is not None and d >= 1000 and d < 3000 for d in ids)
    kept = [d for d in range(240) if d % 3]
    assert len(ids & set(kept)) > 0.5 * len(kept) and not ids & {d for d in range(240) if d % 3 == 0}


def test_license_blocks_against_every_block(spark):
    rng = np.random.default_rng(2)
    filler = [f"filler{i}" for i in range(50)] + ["the", "software", "of", "any", "license"]
    texts = [None, "", "mit license"]
    for label, notice in licenses.NOTICES.items():
        words = notice.split()
        keep = rng.random(len(words)) > rng.choice([0.0, 0.05, 0.15, 0.4])
        texts.append(" ".join([*rng.choice(filler, rng.integers(0, 400)), *np.array(words)[keep], *rng.choice(filler, rng.integers(0, 60))]))
        texts.append(notice.upper() + " " + texts[-1])
    scanned = licenses.scan_licenses(documents(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    n_found = 0
    for r in scanned:
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (texts[r["doc_id"]] or "").lower())
        want = []
        for label, notice in licenses.NOTICES.items():
            told = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", notice.lower())
            for start in range(0, len(words), len(told)):
                held = len(set(told) & set(words[start : start + 2 * len(told)]))
                if held >= licenses.CONTAINMENT * len(set(told)) - 1e-9:
                    want.append((label, start, held / len(set(told))))
        got = [(b["label"], b["word"], pytest.approx(b["containment"])) for b in r["blocks"]]
        assert got == sorted(want, key=lambda b: (-b[2], b[0], b[1]))
        n_found += len(got)
    assert n_found > 20


def test_long_texts_are_pooled_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(300)] + ["Ünïcode", "x" * 700]
    long = " ".join(rng.choice(words, 4000)) + " \n " + " ".join(rng.choice(words, 4000))
    docs = documents(spark, [(1, long, "s"), (2, "short text w1 w2", "s"), (3, None, "s"), (4, "", "s"), (5, "w1", "s")])
    whole = quality.word_vectors(docs, own_words=50)
    assert len(whole.own) == 50
    batch = pa.array([long])
    figures = quality.pooled(batch, whole)
    monkeypatch.setattr(quality, "SLICE", 500)
    parts = list(quality.pieces(batch))
    assert len(parts) > 50 and b"".join(p[0].as_py() for p in parts).decode() == long
    assert np.allclose(quality.pooled(batch, whole), figures)
    total = sum(np.abs(b).sum() for b in [quality.Words(batch).beside().sum(axis=0)])
    apart = sum(quality.Words(p).beside().sum(axis=0) for p in quality.pieces(batch, overlap=True))
    assert np.isclose(np.abs(apart).sum(), total)
    assert not quality.pooled(pa.array(["", None]), whole).any()


def test_frequent_words_are_counted_over_all_documents(spark, monkeypatch):
    monkeypatch.setattr(quality, "COUNTED", 4)
    texts = [" ".join(f"w{j}" for j in range(i + 1)) for i in range(30)]
    own = quality.frequent_words(documents(spark, [(i, t, "s") for i, t in enumerate(texts)]), own_words=5)
    assert set(own.tolist()) == set(quality.Words(pa.array(["w0 w1 w2 w3 w4"])).hashes.tolist())


def test_temperature_does_not_worsen_the_loss():
    rng = np.random.default_rng(1)
    figures = rng.normal(size=(1500, 99))
    labels = (figures[:, 0] + rng.normal(size=1500) > 0).astype(int)
    none = quality.WordVectors(np.zeros(0, np.uint64), np.zeros((0, 24)), np.zeros((0, 24)))
    network = quality.fit_network(figures, labels, none)
    fresh = rng.normal(size=(3000, 99))
    truth = (fresh[:, 0] + rng.normal(size=3000) > 0).astype(int)
    logits = network.logits(fresh)
    assert quality._loss(logits / network.temperature, truth) <= quality._loss(logits, truth) + 1e-3
    share = 1 / (1 + np.exp(-logits / network.temperature))
    for low in (0.0, 0.25, 0.5, 0.75):
        inside = (share >= low) & (share < low + 0.25)
        assert abs(share[inside].mean() - truth[inside].mean()) < 0.1
