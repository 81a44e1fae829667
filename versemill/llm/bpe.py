"""Byte-level BPE encoding and decoding by a walk over the trie of a batch's distinct words.

The last token of a byte string's encoding, together with the encoding of what stands before
that token, is the whole encoding. So it is enough to know, for each prefix of a word, the
last token of that prefix's encoding. Distinct words in sorted order are a depth-first walk of
their trie: from one word to the next only the bytes after the shared prefix are new, and the
last-token states of the shared prefix stay on the stack. The last token of a prefix is the
one token that ends there and may stand next to the last token of what precedes it; two tokens
may stand side by side when no merge across their border would have come before the merges
that built them.

Encoding needs no shuffle: tasks encode the texts they read, slice by slice. A worker remembers
encoded words up to ``CACHE_BYTES``, of which the half that was not used lately goes, and tested
pairs of tokens up to ``CACHED_PAIRS``, and then starts anew. Texts far longer than ``PIECE_CHARS`` are split into words piece by piece, between
letters and a space. A round trip encodes and decodes in the same worker, so ids and decoded
texts never wait for a second one; decoding alone loads only the bytes of the tokens.

Defined results: a null text is encoded as the empty text; empty texts have no ids; special
tokens written in a text are encoded as themselves, as the tokenizers library does by default.
Repeated rows give repeated results, other columns are carried along; a column that has the
name of the result already is replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from versemill.llm.words import byte_offsets, slices

CACHE_BYTES = 64 << 20
#: What a remembered word costs besides its characters and ids: two objects and their place.
WORD_BYTES = 220
CACHED_PAIRS = 300_000
PIECE_CHARS = 1 << 20
# Fixed value: how byte-level BPE splits a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII characters alone.
ASCII_PATTERN = re.compile(WORD_PATTERN.replace(r"[^\s\p{L}\p{N}]", "[^\\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]"), re.ASCII)


def _byte_of_character() -> dict[str, int]:
    """Vocabularies write printable bytes as themselves and the others as characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizer:
    """A byte-level BPE vocabulary: tokens are numbered bytes first, then merges as they rank."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = _byte_of_character()
        vocabulary = spec["model"]["vocab"]
        as_bytes = lambda token: bytes(map(byte_of.__getitem__, token))
        character = {b: c for c, b in byte_of.items()}
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        names = [character[b] for b in range(256)]
        number = {name: b for b, name in enumerate(names)}
        for merge in spec["model"]["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = number[left], number[right]
            self.merged[pair] = number[left + right] = len(names)
            self.parts.append(pair)
            names.append(left + right)
        self.ids = np.array([vocabulary[name] for name in names], "<u4")
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        # Tokens that encoding can never give are left out.
        sound = [True] * 256
        for token in range(256, len(names)):
            left, right = self.parts[token]
            sound.append(sound[left] and sound[right] and self._side_by_side(left, right, token))
        self.by_bytes = {as_bytes(name): token for token, name in enumerate(names) if sound[token]}
        self.size = {token: len(text) for text, token in self.by_bytes.items()}
        # Lengths of the tokens of three bytes or more by their last three, longest first.
        lengths: dict[bytes, set[int]] = {}
        for text in self.by_bytes:
            if len(text) > 2:
                lengths.setdefault(text[-3:], set()).add(len(text))
        self.lengths = {end: tuple(sorted(found, reverse=True)) for end, found in lengths.items()}
        self.find_words = regex.compile(WORD_PATTERN).findall
        self.split_specials = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.path = path
        self._pairs: dict[int, bool] = {}
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._cache_size = 0

    def _side_by_side(self, left: int, right: int, limit: int) -> bool:
        """Whether merges ranked before ``limit`` leave ``left`` and ``right`` apart.

        The merges next to the border are undone, the latest first. At each step a merge across
        the border that ranks before the one just undone would have been made instead. Of equal
        merges the one further left is made first.
        """
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < limit:
                return False
            if left < 256 and right < 256:
                return True
            if left > right:
                limit, left = left, self.parts[left][1]
            else:
                limit, right = right + 1, self.parts[right][0]

    def _may_follow(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            known = self._pairs[pair] = self._side_by_side(left, right, len(self.parts))
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Packed ids of each distinct word, by a depth-first walk over the words' trie."""
        token_of, lengths, pairs, may_follow = self.by_bytes.get, self.lengths.get, self._pairs, self._may_follow
        found: dict[str, bytes] = {}
        path, last = b"", []  # last[i]: last token of the encoding of path[:i + 1]
        for word, text in sorted(((w, w.encode()) for w in words), key=lambda x: x[1]):
            shared = 0
            for a, b in zip(path, text):
                if a != b:
                    break
                shared += 1
            del last[shared:]
            for end in range(shared + 1, len(text) + 1):
                for size in (*lengths(text[end - 3 : end], ()), 2, 1) if end > 2 else (2, 1)[2 - end :]:
                    start = end - size
                    if start < 0 or (token := token_of(text[start:end])) is None:
                        continue
                    if start:
                        allowed = pairs.get(last[start - 1] << 32 | token)
                        if not (may_follow(last[start - 1], token) if allowed is None else allowed):
                            continue
                    last.append(token)
                    break
            path = text
            tokens, end = [], len(text)
            while end:
                tokens.append(last[end - 1])
                end -= self.size[tokens[-1]]
            found[word] = self.ids[tokens[::-1]].tobytes()
        return found

    def _pieces(self, text: str) -> Iterator[list[str] | int]:
        """Words of ``text`` in order, some at a time; a special token comes as its id."""
        for part in self.split_specials.split(text) if self.split_specials else [text]:
            if part in self.specials:
                yield self.specials[part]
                continue
            find_words = ASCII_PATTERN.findall if part.isascii() else self.find_words
            start = 0
            while len(part) - start > 2 * PIECE_CHARS:
                # A word never reaches over a space between two letters.
                border = _BORDER.search(part, start + PIECE_CHARS)
                if not border:
                    break
                yield find_words(part, start, border.start() + 1)
                start = border.start() + 1
            yield find_words(part, start)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit numbers.

        The distinct words of all texts are learned in one walk, so that they share prefixes;
        where the texts are too long for that, each piece has a walk of its own.
        """
        if together := sum(map(len, texts)) <= 2 * PIECE_CHARS:
            pieces = [list(self._pieces(text)) for text in texts]
            self._learn({w for text in pieces for words in text if not isinstance(words, int) for w in words})
        else:
            pieces = map(self._pieces, texts)
        packed = []
        for text in pieces:
            parts = []
            for words in text:
                if isinstance(words, int):
                    parts.append(np.array([words], "<u4").tobytes())
                    continue
                if not together:
                    self._learn(set(words))
                parts.append(b"".join(map(self._cache.__getitem__, words)))
            packed.append(b"".join(parts))
        return packed

    def decode(self, packed: bytes) -> str:
        """The text that packed ids stand for."""
        return decoder(self.path).decode(packed)

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self._cache)
        if new and self._cache_size > CACHE_BYTES // 2:
            self._older, self._cache, self._cache_size, new = self._cache, {}, 0, words
        learned = {word: self._older[word] for word in new if word in self._older}
        learned |= self.encode_words(new.difference(learned))
        self._cache |= learned
        self._cache_size += sum(2 * len(word) + len(ids) + WORD_BYTES for word, ids in learned.items())


class Decoder:
    """The bytes of every token id of a vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        specials = {t["id"]: t["content"].encode() for t in spec.get("added_tokens") or ()}
        byte_of = _byte_of_character()
        token_bytes = {i: bytes(map(byte_of.__getitem__, name)) for name, i in spec["model"]["vocab"].items() if i not in specials}
        token_bytes |= specials
        self.sizes = np.zeros(max(token_bytes) + 1, np.int64)
        for i, text in token_bytes.items():
            self.sizes[i] = len(text)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(token_bytes.get(i, b"") for i in range(len(self.sizes))), np.uint8)

    def decode(self, packed: bytes) -> str:
        """The tokens' bytes are picked ``PIECE_CHARS`` tokens at a time."""
        ids = np.frombuffer(packed, "<u4")
        return b"".join(self._bytes(ids[at : at + PIECE_CHARS]) for at in range(0, len(ids), PIECE_CHARS)).decode("utf-8", "replace")

    def _bytes(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)  # of at least one token
        return self.data[np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + sizes, sizes)].tobytes()


_BORDER = regex.compile(r"\p{L}(?= \p{L})")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One tokenizer a Python worker."""
    return Tokenizer(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _append(batch: pa.RecordBatch, name: str, values: pa.Array, kind: pa.DataType) -> pa.RecordBatch:
    fields = [*batch.schema, pa.field(name, kind)]
    return pa.RecordBatch.from_arrays([*batch.columns, values], schema=pa.schema(fields))


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids", drop_text: bool = False) -> DataFrame:
    """``docs`` with ``out_col``: the ids of its text, packed as little-endian unsigned 32-bit numbers."""
    docs = docs.drop(out_col)
    fields = [f for f in docs.schema if not (drop_text and f.name == text_col)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        for batch in slices(batches, text_col, PIECE_CHARS):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            packed = pa.array(model.encode(texts), pa.binary())
            yield _append(batch.drop_columns([text_col]) if drop_text else batch, out_col, packed, pa.binary())

    return docs.mapInArrow(encode, T.StructType([*fields, T.StructField(out_col, T.BinaryType())]))


def decode_documents(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``out_col``: the text that the packed ids stand for, special tokens written out."""
    encoded = encoded.drop(out_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = decoder(path)
        for batch in slices(batches, ids_col):
            data, places = byte_offsets(batch.column(ids_col))
            raw = data.tobytes()
            texts = [model.decode(raw[a:b]) for a, b in zip(places[:-1], places[1:])]
            yield _append(batch, out_col, pa.array(texts, pa.string()), pa.string())

    return encoded.mapInArrow(decode, T.StructType([*encoded.schema, T.StructField(out_col, T.StringType())]))


def round_trip_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, encoded and decoded again by one worker.

    Adds ``ids`` (packed), ``n_tokens``, ``decoded_sha256`` (hex, of the decoded text in UTF-8)
    and ``decoded_equal``, whether decoding gives the text back.
    """
    added = {"ids": "binary", "n_tokens": "bigint", "decoded_sha256": "string", "decoded_equal": "boolean"}
    docs = docs.drop(*[c for c in added if c != text_col])
    fields = [f for f in docs.schema if f.name != text_col]
    kinds = [pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decode = tokenizer(path).encode, decoder(path).decode
        for batch in slices(batches, text_col, PIECE_CHARS):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            packed = encode(texts)
            hashes, equal = [], []
            for text, ids in zip(texts, packed):
                again = decode(ids)
                hashes.append(hashlib.sha256(again.encode()).hexdigest())
                equal.append(again == text)
            out = batch.drop_columns([text_col])
            for (name, kind), values in zip(zip(added, kinds), (packed, [len(ids) // 4 for ids in packed], hashes, equal)):
                out = _append(out, name, pa.array(values, kind), kind)
            yield out

    return docs.mapInArrow(both_ways, T.StructType([*fields, *T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in added.items()))]))
