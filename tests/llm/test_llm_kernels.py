"""The numpy and Python parts of the operators, without Spark."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from versemill.llm import bpe, licenses, minhash, secrets, substring, vectors, warc, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
MIXED = st.text(st.sampled_from("ab AB\t\n 09.!éß中"), max_size=40)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_bpe_on_any_text(texts):
    library = _library()
    packed = bpe.tokenizer(PATH).encode(texts)
    for text, ids in zip(texts, packed):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert bpe.tokenizer(PATH).decode(ids) == library.decode(want, skip_special_tokens=False)


_loaded = []


def _library():
    if not _loaded:
        _loaded.append(Tokenizer.from_file(PATH))
    return _loaded[0]


def test_bpe_pieces_of_long_texts(library, monkeypatch):
    text = "the quick brown fox, " * 200 + "x" * 500 + " <|endoftext|> " + "lazy dog's   \n tail " * 100
    want = library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    assert np.frombuffer(bpe.Tokenizer(PATH).encode([text])[0], "<u4").tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), MIXED), max_size=8))
def test_words_of_a_batch(texts):
    data, places = words.byte_offsets(pa.array(texts, pa.string()))
    inside = ~words.SPACE[data]
    starts, ends, begins = words.split_words(data, places, inside)
    raw = data.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(begins[:-1], begins[1:])]
    assert got == [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    hashes = words.hash_words(data, inside, starts, ends)
    flat = [w for ws in got for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"id": list(range(9)), "text": ["a" * n for n in (0, 5, 50, 0, 7, 7, 7, 90, 0)]})
    parts = list(words.slices([batch], "text", 20))
    assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(9))
    assert len(parts) > 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=30), st.integers(1, 9))
def test_last_smallest(values, width):
    if len(values) < width:
        return
    got = substring.last_smallest(np.array(values), width)
    for i in range(len(values) - width + 1):
        run = values[i : i + width]
        assert got[i] == i + max(j for j, v in enumerate(run) if v == min(run))


@settings(max_examples=100, deadline=None)
@given(MIXED, MIXED)
def test_shingle_sets(a, b):
    def exact(text):
        ws = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return {tuple(ws[i : i + 3]) for i in range(len(ws) - 2)} if len(ws) >= 3 else ({tuple(ws)} if ws else set())

    one, two = minhash.shingle_sets(pa.array([a, b]), 3)
    assert (len(one), len(two)) == (len(exact(a)), len(exact(b)))
    assert len(np.intersect1d(one, two)) == len(exact(a) & exact(b))


def test_min_max_values_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 900, dtype=np.uint64)
    one, two = np.unique(base[:800]), np.unique(base[100:])
    values = []
    for s in (one, two):
        permuted = [(s ^ x) * o for x, o in zip(minhash._XOR, minhash._ODD)]
        values.append([f(p) for p in permuted for f in (np.min, np.max)])
    agree = np.mean([a == b for a, b in zip(*values)])
    assert abs(agree - 700 / 900) < 0.1


@pytest.mark.parametrize("light", [0, 4, 1000])
def test_shared_sizes(monkeypatch, light):
    monkeypatch.setattr(minhash, "LIGHT_COLUMN", light)
    monkeypatch.setattr(minhash, "DENSE_COLUMNS", 7)
    rng = np.random.default_rng(3)
    one, two = ([np.unique(rng.integers(0, 90, n).astype(np.uint64)) for n in rng.integers(1, 60, k)] for k in (9, 14))
    want = [[len(np.intersect1d(a, b)) for b in two] for a in one]
    assert minhash.shared_sizes(one, two).tolist() == want


def test_spanning_links():
    linked = np.zeros((7, 7), bool)
    for a, b in [(0, 3), (3, 5), (5, 0), (1, 6)]:
        linked[a, b] = linked[b, a] = True
    assert sorted(minhash.spanning_links(linked)) == [(0, 3), (0, 5), (1, 6)]
    assert minhash.spanning_links(linked[:0, :0]) == []


def test_novelty_tells_random_strings_from_names():
    around = "def load_settings(path): return read_configuration_file(path)\n" * 5
    assert secrets.novelty("read_configuration_file", around, around) < 0.5
    assert secrets.novelty("q8Zr2Xv9Lk3Tn7Wd5Pb1Hs6", around, around) >= secrets.NOVELTY
    text = around + 'Authorization: Bearer "q8Zr2Xv9Lk3Tn7Wd5Pb1Hs6Yc4"'
    found = secrets.novel_spans(text, secrets.base_spans(text))
    assert [text[a:b] for a, b, _ in found] == ["q8Zr2Xv9Lk3Tn7Wd5Pb1Hs6Yc4"]


def test_hex_filter_never_loses_a_text():
    texts = ["x" * i + "0123456789abcdef" + "y" * j for i in range(9) for j in range(9)] + ["", "abc"]
    hit = secrets.texts_with_hex(*words.byte_offsets(pa.array(texts)))
    assert hit[:-2].all()


def test_notices_are_found_in_blocks():
    plain = licenses.Notices.of(licenses.NOTICES, licenses.CONTAINMENT)
    notice = re.sub("free of charge", "at no cost", licenses.NOTICES["mit"])
    filler = "lorem ipsum dolor sit amet " * 60
    for text, want in ((filler + notice + " " + filler, {"mit"}), (filler, set()), ("", set()), (notice[: len(notice) // 3], set())):
        ws, begins = words.hashed_words(pa.array([text]), alnum=True)
        found = plain.blocks(begins, *plain.numbers(ws)).get(0, [])
        assert {label for label, _, c in found if c >= licenses.CONTAINMENT} == want


def test_warc_records_with_blank_lines_inside():
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\na\r\n\r\nb\r\n\r\n"
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(block)
    content = (head.encode() + block + b"\r\n\r\n") * 2
    found = [warc.parsed(*r) for r in warc.records_of(content)]
    assert [p for _, p in found] == [b"a\r\n\r\nb\r\n\r\n"] * 2
    assert found[0][0]["payload_bytes"] == 10 and found[0][0]["http_status"] == 200
    with pytest.raises(ValueError):
        list(warc.records_of(content[:-30]))


def test_quantised_search_finds_planted_links():
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(2000, 32))
    unit[1000:] = unit[:1000] + rng.normal(size=(1000, 32)) * 0.2
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    model = vectors.fit_quantiser(unit, 20)
    radius = (2 - 2 * 0.93) ** 0.5
    own = model.lists(unit)[0]
    codes, error = model.encode(unit, own)
    links = {(a, b) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.93, 1)))}
    assert len(links) > 300
    for slack, recall in ((1.0, 1.0), (vectors.SLACK, 0.99)):
        who, where = model.probes(unit, radius * slack)
        probed = set(zip(who.tolist(), where.tolist()))
        assert sum((a, own[b]) in probed for a, b in links) >= recall * len(links)
    for a, b in list(links)[:200]:
        assert model.distances(unit[a : a + 1], own[b], codes[b : b + 1])[0, 0] <= radius + error[b] + 1e-9


def test_ascii_texts_split_into_the_same_words():
    find = bpe.tokenizer(PATH).find_words
    texts = ["".join(t) for t in itertools.product(map(chr, range(128)), " a1.'\n\x1c\x85"[:7], " s")] + ["it's  we'll\t\n x", " 'd'D 12ab", "\x1c \x1f"]
    assert all(t.isascii() and bpe.ASCII_PATTERN.findall(t) == find(t) for t in texts)


def test_words_used_lately_outlive_a_full_cache(monkeypatch):
    model = bpe.Tokenizer(PATH)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2 * bpe.WORD_BYTES)
    asked, encode = [], model.encode_words
    monkeypatch.setattr(model, "encode_words", lambda words: asked.extend(words) or encode(words))
    texts = ["again one", "again two", "again three", "again four"]
    want = [_library().encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(model.encode([t])[0], "<u4").tolist() for t in texts] == want
    assert asked.count("again") == 1 and len(model._cache) + len(model._older) <= 4
