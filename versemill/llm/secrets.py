"""Secret scans: fixed patterns, and strings that their surroundings do not explain.

The patterns find assignments to secret-looking names, access keys and hexadecimal strings. The
second method looks at the other long strings that follow a sensitive word. A zstandard
compressor is primed with a dictionary of common identifiers and the text around the candidate;
the candidate's novelty is the number of bytes it adds to an empty frame, by its length. Names,
paths and repeated identifiers are copied from the dictionary and cost little; a random string
cannot be copied and costs about its length.

Rows are scanned where they are read, without a shuffle. Cheap tests on whole slices (a byte
table for hexadecimal runs, substring tests for the others) choose the texts that the patterns
are run on; they never change what is found.

Defined results: a null text is empty and has no spans. Spans are code points, end exclusive;
``novel`` spans do not overlap those of the patterns. Repeated rows give repeated results,
other columns are carried along; a column that has the name of the result already is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versemill.llm.words import byte_offsets, slices

#: Kinds as listed; ties in ``start`` follow this order.
BASE_KINDS = ("assign", "access", "hex")
NOVEL = "novel"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
LEAST_NOVEL = 20
NOVELTY = 0.9
AROUND = 1024
CONTEXT = 48


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + f"|{_either_case('api')}_?{_either_case('key')}"
ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")
ASSIGN_STEMS = ("pass", "secret", "token", "api")
# Words that make a string after them worth a look.
SENSITIVE = re.compile(
    r"auth|bearer|credential|private|signature|access|session|cookie|passphrase|password|passwd|pwd|secret|token|\bkey\b|_key|apikey|-----begin", re.IGNORECASE
)
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_NOVEL},}}")
# Identifiers that code and configuration repeat.
IDENTIFIERS = (
    "access_key_id secret_access_key client_id client_secret private_key public_key api_key apikey auth_token "
    "authorization bearer basic session_token refresh_token id_token password passwd username user_name user_id "
    "account_name connection_string database_url endpoint hostname certificate signature fingerprint credential "
    "config settings environment variable request response header content_type application/json cookie session "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 00000000 ffffffff xxxxxxxx example placeholder "
)
_IS_HEX = np.zeros(256, bool)
_IS_HEX[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True


def base_spans(text: str, may_hold_hex: bool = True) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns, leftmost and non-overlapping within a kind."""
    spans = []
    lower = text.lower()
    if any(stem in lower for stem in ASSIGN_STEMS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if may_hold_hex:
        spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], BASE_KINDS.index(s[2])))


def novelty(candidate: str, before: str, after: str) -> float:
    """Bytes that ``candidate`` adds to a frame primed with identifiers and its surroundings, by its length."""
    surroundings = f"{IDENTIFIERS}\n{after}\n{before}".encode()
    dictionary = zstandard.ZstdCompressionDict(surroundings, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compress = zstandard.ZstdCompressor(level=9, dict_data=dictionary, write_content_size=False, write_dict_id=False).compress
    data = candidate.encode()
    return (len(compress(data)) - len(compress(b""))) / len(data)


def _united(spans: list[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that ``spans``, sorted by start, cover together."""
    starts, ends = [], []
    for start, end, _ in spans:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def novel_spans(text: str, known: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates after a sensitive word whose novelty is at least ``NOVELTY``."""
    found, seen = [], -1
    starts, ends = _united(known)
    for word in SENSITIVE.finditer(text):
        for m in CANDIDATE.finditer(text, max(word.start(), seen), word.end() + CONTEXT + 4 * LEAST_NOVEL):
            if m.start() > word.end() + CONTEXT:
                break
            # The search stops somewhere; the string may go on.
            start, end = m.start(), CANDIDATE.match(text, m.start()).end()
            seen = end
            value = text[start:end]
            near = bisect_right(ends, start)
            if near < len(starts) and starts[near] < end:
                continue
            if not (re.search(r"[0-9]", value) and re.search(r"[A-Za-z]", value)):
                continue
            if novelty(value, text[max(0, start - AROUND) : start], text[end : end + AROUND]) >= NOVELTY:
                found.append((start, end, NOVEL))
    return found


def texts_with_hex(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Texts that may hold a run of ``LEAST_HEX`` hexadecimal bytes: such a run fills eight aligned bytes."""
    whole = len(data) // 8 * 8
    full = np.flatnonzero(_IS_HEX[data[:whole]].reshape(-1, 8).all(axis=1)) * 8
    hit = np.zeros(len(places) - 1, bool)
    hit[np.searchsorted(places, full, "right") - 1] = True
    return hit


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def scan_secrets(docs: DataFrame, text_col: str = "text", out_col: str = "spans", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``out_col``: ``array<struct<kind, start, end>>`` by start, then kind."""
    docs = docs.drop(out_col)
    fields = [f for f in docs.schema if keep_text or f.name != text_col]
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    order = {kind: i for i, kind in enumerate((*BASE_KINDS, NOVEL))}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            hexed = texts_with_hex(*byte_offsets(batch.column(text_col)))
            rows = []
            for text, may_hold_hex in zip(batch.column(text_col).to_pylist(), hexed.tolist()):
                text = text or ""
                known = base_spans(text, may_hold_hex)
                spans = sorted(known + novel_spans(text, known), key=lambda s: (s[0], order[s[2]]))
                rows.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
            kept = batch if keep_text else batch.drop_columns([text_col])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(rows, pa.list_(_SPAN))], names=[*kept.schema.names, out_col])

    return docs.mapInArrow(scan, T.StructType([*fields, T.StructField(out_col, span)]))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    shown = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
