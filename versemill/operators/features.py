"""Text to features: TF-IDF, fixed-length token ids, hashed embeddings, batch scoring."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from versemill.functions.binding import bind
from versemill.functions.text import unigrams_and_bigrams, without_stop_words, word_tokens
from versemill.functions.vectors import l2_norm, scaled
from versemill.operators.joins import broadcast_if_small
from versemill.operators.ranks import ranked
from versemill.session import Staging, stage_table

# Feature and sequence sizes.
MAX_FEATURES = 20_000
SEQUENCE_LENGTH = 128
# End of fixed values.
PAD_ID, UNKNOWN_ID, FIRST_TOKEN_ID = 0, 1, 2
#: Words and rows whose terms are counted together.
WORDS_AT_ONCE, ROWS_AT_ONCE = 1 << 18, 1 << 12

# Task functions travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def term_frequencies(
    df: DataFrame, text_col: str = "text", stop_words: Sequence[str] = (), batched: bool = False
) -> DataFrame:
    """Adds ``tf``: the row's distinct unigrams and bigrams with their counts.

    A document is one row, so its terms are counted inside the row: sort the terms, find
    where each run starts, and take the distance to the next start. Counting by
    ``groupBy(id, term)`` would shuffle every term of the corpus instead. ``batched`` counts
    the same in Arrow batches, many rows at a time as numbers, which takes half the time.
    """
    tokens = without_stop_words(word_tokens(F.col(text_col)), stop_words)
    if batched:
        return df.withColumn("tf", arrow_udf(_counted_terms, "array<struct<term:string,tf:int>>")(tokens))
    terms = bind(tokens, unigrams_and_bigrams)
    return df.withColumn("tf", bind(F.sort_array(terms), _runs))


def _runs(terms: Column) -> Column:
    """Runs of equal neighbours in a sorted array as ``array<struct<term, tf>>``."""

    def at(i: Column) -> Column:
        return F.try_element_at(terms, i)

    def counted(starts: Column) -> Column:
        nexts = F.concat(
            F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(terms) + 1)
        )
        return F.zip_with(starts, nexts, lambda a, b: F.struct(at(a).alias("term"), (b - a).alias("tf")))

    positions = F.sequence(F.lit(1), F.greatest(F.size(terms), F.lit(1)))
    starts = F.filter(positions, lambda i: (i == 1) | (at(i) != at(F.greatest(i - 1, F.lit(1)))))
    return F.when(F.size(terms) > 0, bind(starts, counted)).otherwise(
        F.array().cast("array<struct<term:string,tf:int>>")
    )


def _counted_terms(tokens: pa.Array) -> pa.Array:
    """Per list of words its distinct words and adjacent pairs, in order, with their counts."""
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before, parts, start = np.cumsum(lengths) - lengths, [], 0
    while start < len(lengths):
        stop = int(np.searchsorted(before, before[start] + WORDS_AT_ONCE))
        stop = max(start + 1, min(stop, start + ROWS_AT_ONCE))
        parts.append(_numbered_runs(tokens.slice(start, stop - start).flatten(), lengths[start:stop]))
        start = stop
    return pa.concat_arrays(parts or [_numbered_runs(pa.array([], pa.string()), lengths)])


def _numbered_runs(words: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """Counts the terms of consecutive rows that hold so many of ``words`` each.

    A term is one number: row, place of its first word in order, place of its second word or 0.
    Sorted, equal ones follow each other. A space comes before all word characters, so the
    numbers are ordered like the terms.
    """
    coded = words.cast(pa.string()).dictionary_encode()
    by = pc.sort_indices(coded.dictionary)
    ordered, place = coded.dictionary.take(by), np.empty(len(by), np.int64)
    place[by.to_numpy()] = np.arange(len(by))
    code = place[coded.indices.to_numpy()]
    base = len(by) + 1
    row = np.repeat(np.arange(len(lengths)), lengths)
    single = (row * base + code) * base
    pair = single[:-1][row[:-1] == row[1:]] + code[1:][row[:-1] == row[1:]] + 1
    terms = np.sort(np.concatenate([single, pair]))
    starts = np.flatnonzero(np.diff(terms, prepend=-1))
    counts = np.diff(starts, append=len(terms))
    rest, second = np.divmod(terms[starts], base)
    row, first = np.divmod(rest, base)
    texts = pc.binary_join_element_wise(
        ordered.take(pa.array(first)), ordered.take(pa.array(second - 1, mask=second == 0)), " ", null_handling="skip"
    )
    entries = pa.StructArray.from_arrays([texts, pa.array(counts.astype(np.int32))], names=["term", "tf"])
    ends = np.cumsum(np.bincount(row, minlength=len(lengths)))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), entries)


def exploded_terms(counted: DataFrame, *cols: str) -> DataFrame:
    """``cols, term, tf``: one line per distinct term of a row.

    The outer form is deliberate: the plain one makes the optimizer add a filter on the
    size of ``tf`` below it, which repeats the whole counting expression.
    """
    return counted.select(*cols, F.inline_outer("tf")).where(F.col("term").isNotNull())


def top_terms(counted: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms of the corpus; ties go to the smaller term.

    No more than ``max_features`` rows are ever sorted in one place. A histogram of the
    frequencies, first in 64 steps a doubling, then exact inside one step, finds the lowest
    frequency that is kept; everything above it is. Terms of just that frequency, most of the
    corpus when it is 1, are narrowed letter by letter: a histogram of their beginnings tells
    which are kept whole, and only the one beginning in which the limit falls is looked into.
    """
    counted = stage_table(counted)
    step = F.floor(F.log2("n_total") * 64).cast("int")
    above, limit = 0, None
    # At most 64 steps a bit of a count.
    for row in sorted(counted.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        if above + row["count"] >= max_features:
            limit = row["step"]
            break
        above += row["count"]
    if limit is None:
        return counted
    downwards = Window.partitionBy(F.lit(0)).orderBy(F.desc("n_total"))
    # One line per frequency inside the step, of which there are at most the root of all words.
    frequencies = counted.where(step == limit).groupBy("n_total").count().withColumn("upto", F.sum("count").over(downwards) + above)
    last = frequencies.where(F.col("upto") >= max_features).orderBy("upto").first()
    ties, wanted = counted.where(F.col("n_total") == last["n_total"]), max_features - (last["upto"] - last["count"])
    kept = counted.where(F.col("n_total") > last["n_total"])
    n_ties, letters = last["count"], 0
    while n_ties > max_features:
        letters += 1
        start = F.substring("term", 1, letters)
        starts = ties.groupBy(start.alias("start")).count()
        upto = F.sum("count").over(Window.partitionBy(F.lit(0)).orderBy("start"))
        # One line per letter after the beginning so far.
        split = starts.withColumn("upto", upto).where(F.col("upto") >= wanted).orderBy("upto").first()
        kept = kept.unionByName(ties.where(start < split["start"]))
        ties, n_ties = ties.where(start == split["start"]), split["count"]
        wanted -= split["upto"] - split["count"]
    return kept.unionByName(ties.orderBy("term").limit(wanted))


def tfidf_fit(train: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """V4: vocabulary of ``train`` (a frame with ``tf``) with smoothed idf.

    Columns ``term_id, term, n_total, n_docs, idf``; ids follow the order of the terms.
    """
    n_rows = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = (
        exploded_terms(train)
        .groupBy("term")
        .agg(F.sum("tf").alias("n_total"), F.count(F.lit(1)).alias("n_docs"))
    )
    # At most ``max_features`` rows reach this window.
    by_term = Window.partitionBy(F.lit(0)).orderBy("term")
    return top_terms(counted, max_features).select(
        (F.row_number().over(by_term) - 1).alias("term_id"),
        "term",
        "n_total",
        "n_docs",
        (F.log((F.lit(1.0) + n_rows) / (F.lit(1.0) + F.col("n_docs"))) + 1.0).alias("idf"),
    )


def _known_terms(df: DataFrame, vocabulary: DataFrame, key_cols: Sequence[str], *also: Column) -> DataFrame:
    """Long ``(key, term, term_id, weight)`` before row scaling; unknown terms have nulls.

    ``also`` are columns computed once a term of the vocabulary.
    """
    small = broadcast_if_small(vocabulary.select("term", "term_id", "idf", *also))
    return (
        df.select(*key_cols, F.inline_outer("tf"))
        .join(small, "term", "left")
        .withColumn("weight", (F.log("tf") + 1.0) * F.col("idf"))
    )


def tfidf_transform(df: DataFrame, vocabulary: DataFrame, key_cols: Sequence[str] = ("id",)) -> DataFrame:
    """V5: ``key, term_ids, weights``, each row scaled to length one.

    Weight is ``(1 + ln tf) * idf``. A row without a known term keeps empty arrays. The
    terms of one row leave the same task, so the final grouping sends one record per row.
    """
    entry = F.when(F.col("term_id").isNotNull(), F.struct("term_id", "weight"))
    rows = _known_terms(df, vocabulary, key_cols).groupBy(*key_cols).agg(
        F.sort_array(F.collect_list(entry)).alias("_entries"),
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_length"),
    )
    return rows.select(
        *key_cols,
        F.col("_entries.term_id").alias("term_ids"),
        scaled(F.col("_entries.weight"), F.col("_length")).alias("weights"),
    )


def sparse_to_long(rows: DataFrame, key_cols: Sequence[str] = ("id",)) -> DataFrame:
    """``key, term_ids, weights`` as one line per stored value."""
    return rows.select(*key_cols, F.inline(F.arrays_zip("term_ids", "weights"))).withColumnsRenamed(
        {"term_ids": "term_id", "weights": "weight"}
    )


def token_vocabulary(
    train: DataFrame, text_col: str = "text", size: int | None = None
) -> DataFrame:
    """Word ids by frequency in ``train`` (``term, token_id``); 0 and 1 are reserved.

    All words get an id unless the caller limits their number. Ids are exact ranks over a sort
    that is dealt to all tasks by range, so neither words seen once nor any other frequency
    meet in one task.
    """
    counted = (
        train.select(F.explode_outer(word_tokens(F.col(text_col))).alias("term"))
        .where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_total"))
    )
    counted = stage_table(counted) if size is None else top_terms(counted, size)
    placed = ranked(counted, [], [-F.col("n_total"), "term"], "_place", Staging(train.sparkSession))
    return placed.select("term", (F.col("_place") + FIRST_TOKEN_ID).cast("int").alias("token_id"))


def encode_fixed_length(
    df: DataFrame,
    vocabulary: DataFrame,
    key_cols: Sequence[str] = ("id",),
    text_col: str = "text",
    length: int = SEQUENCE_LENGTH,
) -> DataFrame:
    """V6: ``key, input_ids, attention_mask`` of exactly ``length`` entries.

    Longer texts are cut to the first ``length`` words, shorter ones are padded; that is
    what the encoding does, and it is applied before words leave their row.
    """
    small = broadcast_if_small(vocabulary.select("term", "token_id"))
    kept = F.slice(word_tokens(F.col(text_col)), 1, length)
    words = df.select(*key_cols, F.posexplode_outer(kept).alias("pos", "term"))
    placed = F.when(
        F.col("pos").isNotNull(),
        F.struct("pos", F.coalesce("token_id", F.lit(UNKNOWN_ID)).alias("token_id")),
    )
    ids = F.col("_placed.token_id")
    missing = F.lit(length) - F.size(ids)
    return (
        words.join(small, "term", "left")
        .groupBy(*key_cols)
        .agg(F.sort_array(F.collect_list(placed)).alias("_placed"))
        .select(
            *key_cols,
            F.concat(ids, F.array_repeat(F.lit(PAD_ID), missing)).alias("input_ids"),
            F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), missing)).alias(
                "attention_mask"
            ),
        )
    )


def hashed_text_embedding(
    df: DataFrame, vocabulary: DataFrame, key_cols: Sequence[str] = ("id",), dim: int = 64
) -> DataFrame:
    """V8: ``key, embedding``: signed hashing of TF-IDF weights into ``dim`` buckets, length one.

    Lets text be searched without a trained model. A text without a known term is all zeros.
    """
    digest = F.md5("term")
    bucket = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % dim).cast("int")
    sign = F.when(F.conv(F.substring(digest, 9, 1), 16, 10).cast("int") < 8, 1.0).otherwise(-1.0)
    cells = (
        _known_terms(df, vocabulary, key_cols, bucket.alias("_bucket"), sign.alias("_sign"))
        .groupBy(*key_cols, "_bucket")
        .agg(F.sum(F.col("_sign") * F.col("weight")).alias("_value"))
    )
    filled = cells.groupBy(*key_cols).agg(
        F.map_from_entries(
            F.collect_list(F.when(F.col("_bucket").isNotNull(), F.struct("_bucket", "_value")))
        ).alias("_cells")
    )

    def dense(length: Column) -> Column:
        value = lambda b: F.coalesce(F.try_element_at("_cells", b), F.lit(0.0))
        return F.transform(
            F.sequence(F.lit(0), F.lit(dim - 1)),
            lambda b: F.when(length > 0, value(b) / length).otherwise(F.lit(0.0)),
        )

    return filled.select(
        *key_cols, bind(l2_norm(F.map_values("_cells")), dense).alias("embedding")
    )


def score_batches(
    df: DataFrame,
    make_predict_fn: Callable[[], Callable],
    input_cols: Sequence[str | Column],
    output_col: str = "scores",
    return_type: str = "array<double>",
    batch_size: int = 1024,
    input_tensor_shapes: Sequence[Sequence[int] | None] | None = None,
) -> DataFrame:
    """V7: a caller's model applied to Arrow batches of rows.

    ``make_predict_fn`` runs once per Python worker, so a model is loaded there and not
    shipped with every batch.
    """
    score = predict_batch_udf(
        make_predict_fn,
        return_type=_parse_type(return_type),
        batch_size=batch_size,
        input_tensor_shapes=input_tensor_shapes,
    )
    return df.withColumn(output_col, score(*input_cols))


def _parse_type(text: str):
    return T.DataType.fromDDL(text)


def fitted(table: DataFrame) -> DataFrame:
    """Persist a fitted vocabulary so the splits that use it do not refit it."""
    return stage_table(table)
