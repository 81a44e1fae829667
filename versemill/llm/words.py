"""Arrow batches of texts as byte arrays, and words with their hashes, for whole batches at once.

Everything here runs inside tasks, on one slice of a batch at a time: slices hold about
``SLICE_BYTES`` of text (one longer text is a slice of its own), which bounds memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words that are letters and digits: a-z, 0-9 and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_rng = np.random.default_rng(20_240_229)
_BYTE_CODE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of ``column``, or of one row."""
    for batch in batches:
        sizes = byte_offsets(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(sizes, sizes[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def byte_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all ``texts`` and the ``n + 1`` places where they start; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, ends, data = texts.buffers()
    if not len(texts) or ends is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    places = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or places[-1] == places[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def split_words(data: np.ndarray, places: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and end, and the ``n + 1`` word numbers at which texts begin.

    ``inside`` tells for each byte whether it belongs to a word; words end with their text.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(places), np.int64)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    borders = places[(places > 0) & (places < len(data))]
    opens[borders] = inside[borders]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[borders - 1] = inside[borders - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, places)


def hash_words(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    picked = np.flatnonzero(inside)
    first = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    within = np.arange(len(picked)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    summed = np.add.reduceat(_BYTE_CODE[data[picked]] * powers[within], first)
    return mixed(summed + lengths.astype(np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers so that every input bit moves every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_words(texts: pa.Array, alnum: bool = False, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all ``texts`` in a row and the ``n + 1`` places where texts begin."""
    data, places = byte_offsets(texts)
    if lower or alnum:
        data = LOWER[data]
    inside = ALNUM[data] if alnum else ~SPACE[data]
    starts, ends, begins = split_words(data, places, inside)
    return hash_words(data, inside, starts, ends), begins


def gram_hashes(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive ``words`` (also across texts; the caller cuts)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    weights = gram_weights(n, salt)
    total = words[: len(words) - n + 1] * weights[0]
    for i in range(1, n):
        total = total + words[i : len(words) - n + 1 + i] * weights[i]
    return mixed(total)


def gram_weights(n: int, salt: int = 0) -> np.ndarray:
    return mixed(_GRAM[:n] + np.uint64(salt)) | np.uint64(1)
