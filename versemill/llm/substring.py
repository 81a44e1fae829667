"""Substring dedup by winnowed anchors: seeds are joined, extended both ways, and repeats removed.

A repeat is a run of at least ``window`` words that also starts in a document with a smaller id.
Seeds are short runs of ``SEED_WORDS`` words, of which winnowing keeps the one with the smallest
hash in every window (the last of equal ones). Equal windows keep equal seeds at equal places,
so a window that repeats anywhere has a seed that repeats, and windows whose seed stands in one
document only are never looked at again.

An occurrence of a seed is extended both ways over all windows that keep this seed: its reach,
up to two windows of words less the seed. Occurrences with equal seed and equal reach are one
repeat and are settled by the smallest id among them. Only the first occurrence of each reach
is then compared window by window with the other reaches of its seed. Seeds, reaches and
windows are counted by aggregates that combine before their shuffle and come back in joins
to which the hot keys, known by their counts, are broadcast; occurrences of a passage are never paired with each
other, so a passage in a third of all documents costs a row an occurrence. What is removed of
a document is the union of its repeats, its maximal repeats.

Documents with equal words are one document for the search, under the smallest of their ids.

Defined results: a null text has no words; documents shorter than a window keep all words; a
null id is larger than all others, and equal ids are not smaller than each other, so repeated
rows do not remove each other's words. Windows are judged on the input, not on what is left.
Hashes of windows are compared at 128 bits. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.llm.exact import normalised
from versemill.llm.words import SPACE, byte_offsets, gram_hashes, hash_words, mixed, slices, split_words
from versemill.operators.joins import broadcast_if_small, spread_join
from versemill.session import Staging, stage_table

WINDOW = 50
SEED_WORDS = 10
#: Texts are cut into words this many bytes at a time; a worker holds some forty times as much.
SLICE_BYTES = 2 << 20
LAST_ID = 2**63 - 1
_POWER = np.uint64(0xD1342543DE82EF95)
_POWER_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 2**64))


def last_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of its smallest, the last one of equals."""
    best, place, span = values, np.arange(len(values)), 1

    def joined(shift: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(best) - shift
        right = best[shift:] <= best[:n]
        return np.where(right, best[shift:], best[:n]), np.where(right, place[shift:], place[:n])

    while 2 * span <= width:
        best, place = joined(span)
        span *= 2
    if span < width:
        best, place = joined(width - span)
    return place


class Windows:
    """All windows of a slice of texts: the seed each keeps, and its hash."""

    def __init__(self, texts: pa.Array, window: int, seed: int) -> None:
        data, places = byte_offsets(texts)
        inside = ~SPACE[data]
        starts, ends, self.begins = split_words(data, places, inside)
        self.words = hash_words(data, inside, starts, ends)
        self.counts = np.diff(self.begins)
        self.window, self.seed = window, seed
        n = len(self.words) - window + 1
        if n > 0:
            self.grams = gram_hashes(self.words, seed)
            kept = last_smallest(self.grams, window - seed + 1)
            text = np.repeat(np.arange(len(self.counts)), self.counts)[:n]
            self.starts = np.flatnonzero(np.arange(n) + window <= self.begins[text + 1])
            self.text, self.kept = text[self.starts], kept[self.starts]
        else:
            self.grams = np.zeros(0, np.uint64)
            self.starts = self.text = self.kept = np.zeros(0, np.int64)
        # Windows that keep the same occurrence of a seed follow each other.
        new = np.ones(len(self.kept), bool)
        new[1:] = (self.kept[1:] != self.kept[:-1]) | (self.text[1:] != self.text[:-1])
        self.first = np.flatnonzero(new)
        self.upto = np.append(self.first[1:], len(self.kept))
        powers = np.cumprod(np.append(np.uint64(1), np.full(max(len(self.words) - 1, 0), _POWER)))
        self._sums = np.append(np.uint64(0), np.cumsum(self.words * powers[: len(self.words)]))
        self._back = np.cumprod(np.append(np.uint64(1), np.full(len(self.words), _POWER_BACK)))

    def run_hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of the words from ``start`` to ``stop``."""
        return mixed((self._sums[stop] - self._sums[start]) * self._back[start])

    def seeds(self) -> dict[str, np.ndarray]:
        """One row an occurrence of a seed: text number, seed hash, first window, number of windows, reach hash."""
        first, last = self.starts[self.first], self.starts[self.upto - 1]
        kept, text = self.kept[self.first], self.text[self.first]
        reach = self.run_hash(first, last + self.window) ^ mixed((kept - first).astype(np.uint64) << np.uint64(8))
        return {
            "text": text,
            "seed": self.grams[kept],
            "start": first - self.begins[text],
            "n": last - first + 1,
            "reach": reach,
        }


_SEED_ROW = "array<struct<seed:bigint,reach:bigint,start:int,n:int>>"
_SEED_ARROW = pa.struct([("seed", pa.int64()), ("reach", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def document_seeds(docs: DataFrame, id_col: str, text_col: str, window: int, seed: int) -> DataFrame:
    """``doc_id, text_key, words_sha256, n_words, seeds`` of every row."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            found = Windows(batch.column("text"), window, seed)
            rows = found.seeds()
            cuts = np.searchsorted(rows["text"], np.arange(batch.num_rows + 1))
            flat = pa.StructArray.from_arrays(
                [
                    pa.array(rows["seed"].view(np.int64)),
                    pa.array(rows["reach"].view(np.int64)),
                    pa.array(rows["start"].astype(np.int32)),
                    pa.array(rows["n"].astype(np.int32)),
                ],
                fields=list(_SEED_ARROW),
            )
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), batch.column("words_sha256"), pa.array(found.counts), lists],
                names=["doc_id", "text_key", "words_sha256", "n_words", "seeds"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        _text_key(F.col(text_col)).alias("text_key"),
        F.sha2(F.trim(normalised(F.col(text_col))), 256).alias("words_sha256"),
    )
    return rows.mapInArrow(
        mark, f"doc_id bigint, text_key bigint, words_sha256 string, n_words bigint, seeds {_SEED_ROW}"
    )


def _window_hashes(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """``unit, lead, start, w, s`` for the windows of ``open_seeds`` (first windows of seed occurrences)."""

    def list_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            found = Windows(batch.column("text"), window, seed)
            rows = found.seeds()
            opened = batch.column("open_seeds").to_pylist()
            chosen = np.zeros(len(rows["text"]), bool)
            cuts = np.searchsorted(rows["text"], np.arange(batch.num_rows + 1))
            for i, starts in enumerate(opened):
                chosen[cuts[i] : cuts[i + 1]] = np.isin(rows["start"][cuts[i] : cuts[i + 1]], starts)
            picked = np.repeat(chosen, found.upto - found.first)
            start, text = found.starts[picked], found.text[picked]
            for a in range(0, len(start), 100_000):
                s, t = start[a : a + 100_000], text[a : a + 100_000]
                of = pa.array(t)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("unit").take(of),
                        batch.column("lead").take(of),
                        pa.array((s - found.begins[t]).astype(np.int32)),
                        pa.array(found.run_hash(s, s + window).view(np.int64)),
                        pa.array(found.grams[found.kept[picked][a : a + 100_000]].view(np.int64)),
                    ],
                    names=["unit", "lead", "start", "w", "s"],
                )

    return texts.select("unit", "lead", "text", "open_seeds").mapInArrow(
        list_windows, "unit bigint, lead bigint, start int, w bigint, s bigint"
    )


def _cut_texts(texts: DataFrame, window: int) -> DataFrame:
    """``unit, n_removed, kept_sha256`` of ``texts`` (``unit, text, gone array<struct<start, n>>``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            data, places = byte_offsets(batch.column("text"))
            starts, ends, begins = split_words(data, places, ~SPACE[data])
            raw, removed, digests = data.tobytes(), [], []
            for i, runs in enumerate(batch.column("gone").to_pylist()):
                size = int(begins[i + 1] - begins[i])
                change = np.zeros(size + 1, np.int32)
                for run in runs:
                    change[run["start"]] += 1
                    change[run["start"] + run["n"] + window - 1] -= 1
                keep = np.flatnonzero(np.cumsum(change[:-1]) == 0) + begins[i]
                removed.append(size - len(keep))
                text = b" ".join([raw[a:b] for a, b in zip(starts[keep].tolist(), ends[keep].tolist())])
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("unit"), pa.array(removed, pa.int64()), pa.array(digests)], names=["unit", "n_removed", "kept_sha256"]
            )

    return texts.select("unit", "text", "gone").mapInArrow(cut, "unit bigint, n_removed bigint, kept_sha256 string")


def repeats(units: DataFrame, texts_of: Callable[[DataFrame], DataFrame], staging: Staging, window: int, seed: int) -> DataFrame:
    """``unit, start, n``: runs of ``n`` window starts that repeat in a unit with a smaller lead.

    ``units``: ``unit, lead, seeds``; ``texts_of(frame)`` joins texts to a frame with ``unit``.
    """
    seeds = units.select("unit", "lead", F.inline("seeds"))
    places = staging.table(
        spread_join(seeds, staging.table(_shared(units)), ["seed"], "n_seeds").select("unit", "lead", "seed", "reach", "start", "n")
    )
    # A reach is settled by its smallest lead.
    reaches = places.groupBy("seed", "reach").agg(F.min("lead").alias("first_lead"), F.count(F.lit(1)).alias("n_places"))
    reaches = staging.table(reaches)
    several = reaches.groupBy("seed").agg(F.count(F.lit(1)).alias("n_reaches"))
    reaches = staging.table(reaches.join(several, "seed"))
    judged = staging.table(spread_join(places, reaches, ["seed", "reach"], "n_places"))
    settled = judged.where("lead > first_lead").select("unit", "start", "n")
    # The first occurrences of reaches that share their seed with another reach.
    open_places = judged.where("lead = first_lead AND n_reaches > 1")
    opened = open_places.groupBy("unit", "lead").agg(F.collect_set("start").alias("open_seeds"))
    hashes = staging.table(_window_hashes(texts_of(staging.table(opened)), window, seed))
    firsts = hashes.groupBy("w", "s").agg(F.min("lead").alias("m"), F.max("lead").alias("l"), F.count(F.lit(1)).alias("n_windows")).where("m < l")
    found = spread_join(hashes, staging.table(firsts.drop("l")), ["w", "s"], "n_windows").where("lead > m")
    return settled.unionByName(found.select("unit", "start", F.lit(1).alias("n")))


def _shared(units: DataFrame) -> DataFrame:
    """Seeds that stand in units with different leads, and how often they stand there."""
    marks = units.select("lead", F.explode("seeds.seed").alias("seed"))
    counted = marks.groupBy("seed").agg(F.min("lead").alias("m"), F.max("lead").alias("l"), F.count(F.lit(1)).alias("n_seeds"))
    return counted.where("m < l").select("seed", "n_seeds")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs``."""
    with Staging(docs.sparkSession) as staging:
        rows = staging.table(
            document_seeds(docs, id_col, text_col, window, seed)
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("at", F.coalesce("doc_id", F.lit(LAST_ID)))
        )
        equal = staging.table(rows.groupBy("words_sha256").agg(F.min("row").alias("unit"), F.min("at").alias("lead")))
        leads = broadcast_if_small(equal.select("unit", "lead"))
        units = rows.where(F.size("seeds") > 0).join(leads, rows["row"] == leads["unit"])
        units = staging.table(units.select("unit", "lead", "doc_id", "text_key", "seeds"))
        texts = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), _text_key(F.col(text_col)).alias("text_key")
        )

        def texts_of(frame: DataFrame) -> DataFrame:
            wanted = staging.table(units.select("unit", "doc_id", "text_key").join(frame, "unit"))
            picked = broadcast_if_small(wanted).alias("w")
            same = texts["doc_id"].eqNullSafe(F.col("w.doc_id")) & (texts["text_key"] == F.col("w.text_key"))
            return staging.table(texts.join(picked, same).select("text", *[F.col(f"w.{c}") for c in frame.columns]))

        runs = repeats(units, texts_of, staging, window, seed)
        gone = staging.table(runs.groupBy("unit").agg(F.collect_list(F.struct("start", "n")).alias("gone")))
        # The text of repeated rows comes back once a row.
        cut = staging.table(_cut_texts(texts_of(gone), window)).dropDuplicates(["unit"])
        known = equal.join(cut, "unit", "left").select("words_sha256", "lead", "n_removed", "kept_sha256")
        # Rows that need nothing but their own digest: no equal words elsewhere, nothing removed.
        result = rows.select("doc_id", "at", "words_sha256", "n_words").join(known, "words_sha256", "left")
        copy = (F.col("at") > F.col("lead")) & (F.col("n_words") >= window)
        return stage_table(
            result.select(
                "doc_id",
                "n_words",
                F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "words_sha256")).alias("kept_sha256"),
            )
        )
