"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Random indexing gives every word form a fixed sparse random vector and adds up, for every word,
the vectors of its neighbours over the whole corpus; words that stand in like places get like
vectors. The ``OWN_WORDS`` most frequent words of the corpus, counted over all of it, have a
vector of their own; rarer ones share ``BUCKETS`` rows by their hash. A word has two forms: what
it reads (lower case) and what it looks like (first and last characters by kind, length), so
that words never seen before still have a vector. A document is the mean and the spread of its words' vectors with
three figures on repetition and length. A network of two layers in numpy is fitted on a bounded
sample of labelled rows, and a temperature on rows held back from it makes its probabilities
fit. Scores depend on the text alone.

Words are counted and their vectors summed in each task before they are shuffled; one table of
fixed size (``OWN_WORDS`` and twice ``BUCKETS`` rows of ``DIMENSIONS`` numbers) reaches the driver, as
does the sample. A text far longer than ``SLICE`` is read piece by piece, so memory does not
grow with it.

Defined results: a null text is empty; an empty text has all figures zero and gets the score
the network gives them; without labelled rows, or with one label only, every score is the
smoothed share of label 1. A null id is never held out. Labels without a value are not used.
Repeated rows get the same score; other columns are carried along by :func:`score_documents`,
which replaces a column that has the name of the score already.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versemill.llm.words import LOWER, SPACE, byte_offsets, hash_words, mixed, slices, split_words
from versemill.operators.features import top_terms

BUCKETS = 4096
OWN_WORDS = 20_000
DIMENSIONS = 24
SAMPLE_ROWS = 10_000
HIDDEN = 32
THRESHOLD = 0.3
SLICE = 1 << 20

_rng = np.random.default_rng(7)
#: Sparse random vectors: a few +1 and -1; a second part of the hash flips signs, so few words share one.
INDEX = _rng.choice([-1.0, 0.0, 1.0], (BUCKETS, DIMENSIONS), p=[0.1, 0.8, 0.1]).astype(np.float32)
FLIPS = _rng.choice([-1.0, 1.0], (BUCKETS, DIMENSIONS)).astype(np.float32)
#: A task's word counts are cut to their sums when it holds this many.
COUNTED = 1 << 20
#: Kinds of bytes: other, lower case, upper case, digit, beyond ASCII; marks are their own kind.
_KIND = np.arange(256, dtype=np.uint64)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[128:] = 1


def pieces(texts: pa.Array, overlap: bool = False) -> Iterator[pa.Array]:
    """``texts`` as it is, or a single long text in pieces of about ``SLICE`` bytes, cut at a space.

    With ``overlap`` a piece starts with the last word of the piece before, so that any two
    neighbouring words meet in exactly one piece.
    """
    data, _ = byte_offsets(texts)
    if len(texts) > 1 or len(data) <= 2 * SLICE:
        yield texts
        return
    start = stop = 0
    while stop < len(data):
        begin, stop = stop, len(data)
        for at in range(begin + SLICE, len(data), SLICE):
            spaces = np.flatnonzero(SPACE[data[at : at + SLICE]])
            if len(spaces):
                stop = at + int(spaces[0])
                break
        yield pa.array([data[start:stop].tobytes()], pa.binary())
        if overlap:
            inside = ~SPACE[data[start:stop]]
            last = int(np.flatnonzero(inside)[-1]) if inside.any() else 0
            before = np.flatnonzero(~inside[:last])
            start += int(before[-1]) + 1 if len(before) else 0
        else:
            start = stop


class Words:
    """The words of a slice of texts and their hashes."""

    def __init__(self, texts: pa.Array) -> None:
        data, places = byte_offsets(texts)
        inside = ~SPACE[data]
        starts, ends, self.begins = split_words(data, places, inside)
        self.counts = np.diff(self.begins)
        self.lengths = (ends - starts).astype(np.float64)
        self.hashes = hash_words(LOWER[data], inside, starts, ends)
        self._seen = data, starts, ends

    @cached_property
    def looks(self) -> np.ndarray:
        """The row of each word's looks."""
        data, starts, ends = self._seen
        looks = np.minimum(ends - starts, 12).astype(np.uint64)
        for at in (starts, ends - 1, np.maximum(ends - 2, starts), np.maximum(ends - 3, starts)):
            looks = (looks << np.uint64(8)) | _KIND[data[at]] if len(data) else looks
        return (mixed(looks) % np.uint64(BUCKETS)).astype(np.int64)

    def rows(self, own: np.ndarray) -> np.ndarray:
        """The vector row of each word: its own if it is among the sorted hashes ``own``, else a shared one."""
        shared = len(own) + (self.hashes % np.uint64(BUCKETS)).astype(np.int64)
        if not len(own):
            return shared
        at = np.minimum(np.searchsorted(own, self.hashes), len(own) - 1)
        return np.where(own[at] == self.hashes, at, shared)

    def beside(self) -> np.ndarray:
        """For each word the sum of its neighbours' random vectors, neighbours of the same text only."""
        shared = (self.hashes % np.uint64(BUCKETS)).astype(np.int64)
        turned = ((self.hashes >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)
        own = INDEX[self.looks] + INDEX[shared] * FLIPS[turned]
        total = np.zeros_like(own)
        total[1:] += own[:-1]
        total[:-1] += own[1:]
        inner = self.begins[(self.begins > 0) & (self.begins < len(own))]
        total[inner] -= own[inner - 1]
        total[inner - 1] -= own[inner]
        return total


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n``: words by hash, summed up to ``COUNTED`` different ones at a time."""

    def summed(words: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        distinct, at = np.unique(np.concatenate(words), return_inverse=True)
        return distinct, np.bincount(at, np.concatenate(times), len(distinct)).astype(np.int64)

    def batch_of(words: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
        distinct, n = summed(words, times)
        return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(n)], names=["word", "n"])

    words, times, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for batch in slices(batches, "text", SLICE):
        for texts in pieces(batch.column("text")):
            found, n = np.unique(Words(texts).hashes, return_counts=True)
            words.append(found)
            times.append(n)
            held += len(found)
            if held > 2 * COUNTED:
                one, many = summed(words, times)
                words, times, held = [one], [many], len(one)
                if held > COUNTED:
                    yield batch_of(words, times)
                    words, times, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    yield batch_of(words, times)


def frequent_words(docs: DataFrame, text_col: str = "text", own_words: int = OWN_WORDS) -> np.ndarray:
    """Sorted hashes of the most frequent words of all ``docs``; ties go to the smaller hash."""
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_count_words, "word bigint, n bigint")
    totals = counted.groupBy("word").agg(F.sum("n").alias("n_total")).where("n_total > 1")
    named = totals.select(F.lpad(F.hex("word"), 16, "0").alias("term"), "n_total")
    top = top_terms(named, own_words).select("term").toArrow()  # OWN_WORDS numbers
    return np.sort(np.array([int(word, 16) for word in top["term"].to_pylist()], np.uint64))


def _partial_vectors(own: np.ndarray):
    n_reads = len(own) + BUCKETS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_reads + BUCKETS, DIMENSIONS))
        for batch in slices(batches, "text", SLICE):
            for texts in pieces(batch.column("text"), overlap=True):
                words = Words(texts)
                rows, beside = words.rows(own), words.beside().astype(np.float64)
                for d in range(DIMENSIONS):
                    column = np.ascontiguousarray(beside[:, d])
                    total[:n_reads, d] += np.bincount(rows, column, n_reads)
                    total[n_reads:, d] += np.bincount(words.looks, column, BUCKETS)
        used = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(used), *(pa.array(total[used, d]) for d in range(DIMENSIONS))]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", *(f"v{d}" for d in range(DIMENSIONS))])

    return sums


@dataclass
class WordVectors:
    """Unit vectors: of frequent words by their sorted hashes, of shared rows, and of looks."""

    own: np.ndarray
    reads: np.ndarray
    looks: np.ndarray


def word_vectors(docs: DataFrame, text_col: str = "text", own_words: int = OWN_WORDS) -> WordVectors:
    """Vectors from the neighbours of every word in ``docs``.

    Sums of whole numbers, hence the same for any order of tasks.
    """
    own = frequent_words(docs, text_col, own_words)
    names = [f"v{d}" for d in range(DIMENSIONS)]
    partial = docs.select(F.col(text_col).alias("text")).mapInArrow(
        _partial_vectors(own), "bucket bigint, " + ", ".join(f"{n} double" for n in names)
    )
    table = partial.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    vectors = np.zeros((len(own) + 2 * BUCKETS, DIMENSIONS))
    vectors[table["bucket"].to_numpy()] = np.column_stack([table[n].to_numpy() for n in names])
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = (vectors / np.where(lengths > 0, lengths, 1)).astype(np.float32)
    return WordVectors(own, unit[:-BUCKETS], unit[-BUCKETS:])


def pooled(texts: pa.Array, vectors: WordVectors) -> np.ndarray:
    """Figures of each text: mean and spread of its word vectors, repetition, length, word length."""
    width = 2 * DIMENSIONS
    total = np.zeros((len(texts), 2 * width + 1))  # sums, sums of squares, and of word lengths
    counts, distinct = np.zeros(len(texts), np.int64), [np.zeros(0, np.uint64)] * len(texts)
    for piece in pieces(texts):
        words = Words(piece)
        full = np.flatnonzero(words.counts)
        if not len(full):
            continue
        first = words.begins[:-1][full]
        rows = np.hstack([vectors.reads[words.rows(vectors.own)], vectors.looks[words.looks]])
        total[full, :width] += np.add.reduceat(rows, first, axis=0, dtype=np.float64)
        total[full, width:-1] += np.add.reduceat(rows * rows, first, axis=0, dtype=np.float64)
        total[full, -1] += np.add.reduceat(words.lengths, first)
        counts += words.counts
        for i, a in zip(full.tolist(), first.tolist()):
            found = np.unique(words.hashes[a : a + int(words.counts[i])])
            distinct[i] = found if not len(distinct[i]) else np.union1d(distinct[i], found)
    out = np.zeros((len(texts), 2 * width + 3))
    full = np.flatnonzero(counts)
    n = counts[full][:, None]
    mean, square = total[full, :width] / n, total[full, width:-1] / n
    out[full, :width] = mean
    out[full, width : 2 * width] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[full, -3] = np.array([len(distinct[i]) for i in full]) / counts[full]
    out[full, -2] = np.log1p(counts[full])
    out[full, -1] = total[full, -1] / counts[full]
    return out


@dataclass
class Network:
    """Two layers over standardised figures; ``score`` divides the logit by the temperature."""

    vectors: WordVectors
    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float
    constant: float | None = None

    def logits(self, figures: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum((figures - self.centre) / self.scale @ w1 + b1, 0) @ w2 + b2

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return _sigmoid(self.logits(pooled(texts, self.vectors)) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def fit_network(figures: np.ndarray, labels: np.ndarray, vectors: WordVectors, seed: int = 3, epochs: int = 60) -> Network:
    """Adam on logistic loss over four fifths of the rows, temperature on the last fifth."""
    rng = np.random.default_rng(seed)
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return Network(vectors, np.zeros(1), np.ones(1), [], 1.0, float(share))
    order = rng.permutation(len(labels))
    kept_back, fitted = order[: len(order) // 5], order[len(order) // 5 :]
    centre, scale = figures[fitted].mean(axis=0), figures[fitted].std(axis=0) + 1e-3
    x, y = (figures - centre) / scale, labels.astype(float)
    n_in = x.shape[1]
    weights = [rng.normal(0, (2 / n_in) ** 0.5, (n_in, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    steps = 0
    for _ in range(epochs):
        turn = rng.permutation(fitted)
        for at in range(0, len(turn), 128):
            rows = turn[at : at + 128]
            hidden = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            error = (_sigmoid(hidden @ weights[2] + weights[3]) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (hidden > 0)
            slopes = [x[rows].T @ back + 1e-3 * weights[0], back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]
            steps += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
    network = Network(vectors, centre, scale, weights, 1.0)
    if len(kept_back):
        logits = network.logits(figures[kept_back])
        choices = np.geomspace(0.25, 8, 61)
        network.temperature = float(min(choices, key=lambda t: _loss(logits / t, y[kept_back])))
    return network


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS
) -> Network:
    """A network fitted on about ``sample_rows`` labelled rows that are not held out.

    The sample is a seeded share of the ids, so its size is bound whatever the number of labels.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col)))
    usable = usable.select(F.col(id_col).alias("doc_id"), (F.col(label_col) == 1).cast("int").alias("label"))
    share = min(1.0, sample_rows / max(usable.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = usable.where(draw).groupBy("doc_id").agg(F.max("label").alias("label"))
    vectors = word_vectors(docs, text_col)

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            rows = pooled(batch.column("text"), vectors)
            packed = pa.array([row.tobytes() for row in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), packed], names=["doc_id", "label", "figures"])

    # At most about sample_rows keys, whatever the size of the labels.
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    chosen = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")
    rows = chosen.mapInArrow(figures, "doc_id bigint, label int, figures binary").toArrow().sort_by([("doc_id", "ascending"), ("figures", "ascending")])
    width = 4 * DIMENSIONS + 3
    x = np.array([np.frombuffer(b.as_py()) for b in rows["figures"]]).reshape(-1, width)
    return fit_network(x, rows["label"].to_numpy(), vectors)


def score_documents(docs: DataFrame, network: Network, text_col: str = "text", out_col: str = "quality_score", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``out_col``, the probability of label 1."""
    docs = docs.drop(out_col)
    fields = [f for f in docs.schema if keep_text or f.name != text_col]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SLICE):
            values = pa.array(network.score(batch.column(text_col)), pa.float64())
            kept = batch if keep_text else batch.drop_columns([text_col])
            yield pa.RecordBatch.from_arrays([*kept.columns, values], names=[*kept.schema.names, out_col])

    return docs.mapInArrow(score, T.StructType([*fields, T.StructField(out_col, T.DoubleType())]))


def drop_low_quality(docs: DataFrame, network: Network, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``; all columns as they were."""
    return score_documents(docs, network, text_col, "_x_score").where(F.col("_x_score") >= threshold).drop("_x_score")
