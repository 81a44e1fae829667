"""Registered training-data queries: against SQL, public libraries, or brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from compare import connect, difference
from versemill.llm import queries

SF = "/root/testdata/sf0.001"
BUILT_IN_ONLY = ("op1_mix_sources", "op4_exact_dedup", "op12_virtual_slots")


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.fixture(scope="module")
def texts(database):
    return {d: t or "" for d, t in database.execute("SELECT doc_id, text FROM documents").fetchall()}


def rows(spark, name):
    return {r[0]: r for r in queries.QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, database, name):
    assert difference(queries.QUERIES[name](spark, SF), database, queries.SQL[name]) is None


def test_one_query_an_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))


@pytest.mark.parametrize("name", BUILT_IN_ONLY)
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert node not in plan


def test_mix_reaches_its_targets(spark, database, texts):
    mixed = queries.QUERIES["op1_mix_sources"](spark, SF).toPandas()
    source = dict(database.execute("SELECT doc_id, source FROM documents").fetchall())
    mixed["source"] = mixed["doc_id"].map(source)
    sizes = {d: len(re.findall("[^\x20\x09-\x0d]+", t)) for d, t in texts.items()}
    assert dict(zip(mixed["doc_id"], mixed["size"])) == sizes
    assert ((mixed["taken"] == 0) | (mixed["taken"] % mixed["size"].clip(lower=1) == 0)).all()
    assert (mixed["taken"] <= 2 * mixed["size"]).all()
    by = mixed.groupby("source").agg(size=("size", "sum"), told=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert (by["size"] == by["told"]).all()
    # Water filling, step by step.
    names = sorted(by.index, key=lambda s: [ord(c) for c in s])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * by["size"].sum(), set(names)
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 2 * by["size"][s]}
        if not over:
            target |= {s: share * weight[s] for s in open_}
            break
        target |= {s: 2.0 * by["size"][s] for s in over}
        left -= sum(2.0 * by["size"][s] for s in over)
        open_ -= over
    for s in names:
        assert by["target"][s] == pytest.approx(target[s])
        assert abs(by["taken"][s] - by["target"][s]) <= by["most"][s] / 2 + 1
    again = queries.QUERIES["op1_mix_sources"](spark, SF).toPandas()
    assert sorted(zip(again["doc_id"], again["taken"])) == sorted(zip(mixed["doc_id"], mixed["taken"]))


def test_bpe_equals_the_tokenizers_library(spark, texts):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(spark, "op2_bpe_round_trip")
    assert set(got) == set(texts)
    for doc, text in texts.items():
        ids = model.encode(text, add_special_tokens=False).ids
        decoded = model.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        assert tuple(got[doc])[1:] == want


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.QUERIES["op7_quality_classifier"](spark, sf).toPandas()
    labels = connect(sf).execute("SELECT doc_id, quality FROM labels").df()
    both = scored.merge(labels, on="doc_id")
    held = both[both["held_out"]]
    assert scored["score"].between(0, 1).all() and (scored["predicted"] == (scored["score"] >= 0.3)).all()
    assert (held["predicted"] == held["quality"]).mean() > 0.93
    assert held[held["quality"] == 1]["predicted"].mean() > 0.97


def test_secret_spans(spark, texts):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    kinds = {
        "assign": lambda t: [m for m in assign.finditer(t) if len(m[2]) >= 12],
        "access": lambda t: [m for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18],
        "hex": lambda t: [m for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16],
    }
    got = rows(spark, "op9_secret_scan")
    for doc, text in texts.items():
        found = {kind: find(text) for kind, find in kinds.items()}
        spans = sorted((m.start(), i, m.end(), kind) for i, (kind, ms) in enumerate(found.items()) for m in ms)
        base = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert [got[doc][f"n_{k}"] for k in kinds] == [len(ms) for ms in found.values()]
        assert got[doc]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[doc]["spans"].split(","))
    assert any(r["n_assign"] + r["n_hex"] for r in got.values())


def test_license_places(spark, texts):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    got = rows(spark, "op10_license_scan")
    for doc, text in texts.items():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
        places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        r = got[doc]
        at = [i for i, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min(at, default=None), max(at, default=None))
        labels = sorted({label for _, label in places})
        assert r["base_labels"] == ",".join(labels) and set(labels) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
