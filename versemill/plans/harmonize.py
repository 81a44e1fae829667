"""The whole preparation in one plan: several raw sources -> balanced, split, encoded data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.functions.keys import DEFAULT_SEED
from versemill.operators.cleaning import (
    StageAudit,
    TextCleaner,
    drop_nulls,
    map_genres,
    never_null,
    normalised_source,
    union_sources,
)
from versemill.operators.features import (
    MAX_FEATURES,
    SEQUENCE_LENGTH,
    encode_fixed_length,
    fitted,
    term_frequencies,
    tfidf_fit,
    tfidf_transform,
    token_vocabulary,
)
from versemill.operators.sampling import balance_classes, dedup_keep_first, stratified_split
from versemill.session import stage_table
from versemill.sources.config import SourceConfig
from versemill.sources.tables import spread_small_scan

POOL_KEY = ("src", "id")
ROW_KEY = ("src", "id", "draw")


@dataclass(frozen=True)
class RawSource:
    """A scanned table (with ``src`` and ``id``), its configuration and optional cleaner."""

    table: DataFrame
    config: SourceConfig
    cleaner: TextCleaner | None = None


@dataclass(frozen=True)
class EncodedData:
    """Split rows with their features, and the fitted vocabularies."""

    rows: DataFrame
    features: DataFrame
    tokens: DataFrame
    terms: DataFrame
    words: DataFrame


def clean_pool(
    sources: Sequence[RawSource],
    genre_map: Mapping[str, str],
    label2id: Mapping[str, int],
    apply_multilingual: bool = False,
    drop_empty: bool = False,
    keep_text: bool = True,
    audit: StageAudit | None = None,
) -> DataFrame:
    """Clean, labelled rows of all sources, one per distinct text: ``src, id, text, label``.

    ``keep_text=False`` gives keys and labels only, and no text is shuffled. An ``audit`` counts
    the rows that pass the stages of each source.

    Nulls are dropped per source while all its columns are still there; only then are the
    columns cut to the four that later steps use, so nothing else is shuffled.
    """
    frames = []
    for place, source in enumerate(sources):

        def watch(df: DataFrame, stage: str, side: str, place: int = place) -> DataFrame:
            return audit.passing(df, place, stage, side) if audit else df

        prepared = normalised_source(source.table, source.config, source.cleaner, apply_multilingual, watch)
        known = never_null(source.config, apply_multilingual)
        complete = watch(drop_nulls(watch(prepared, "drop_nulls", "n_before"), known), "drop_nulls", "n_after")
        labelled = map_genres(complete, genre_map, label2id)
        frames.append(labelled.select("src", "id", "text", "label"))
    rows = union_sources(frames)
    return dedup_keep_first(rows.where(F.col("text") != "") if drop_empty else rows, keep_text=keep_text)


def balanced_keys(
    pool: DataFrame,
    eval_split: float | None = 0.15,
    test_split: float | None = 0.15,
    seed: int = DEFAULT_SEED,
    replace: bool = True,
) -> DataFrame:
    """``src, id, draw, label, split`` of the balanced rows of a pool; no text is read."""
    keys = stage_table(pool.select("src", "id", "label"))
    drawn = stage_table(balance_classes(keys, "label", POOL_KEY, seed, replace))
    return stratified_split(drawn, "label", ROW_KEY, eval_split, test_split, seed)


def balanced_split(
    pool: DataFrame,
    eval_split: float | None = 0.15,
    test_split: float | None = 0.15,
    seed: int = DEFAULT_SEED,
    replace: bool = True,
) -> DataFrame:
    """Balanced and split rows of a pool: ``src, id, draw, label, split, text``.

    Ranks, draws and cuts work on keys and labels alone. The text joins last, so it is
    shuffled once however many steps come before.
    """
    split = balanced_keys(pool, eval_split, test_split, seed, replace)
    return split.join(pool.select("src", "id", "text"), ["src", "id"]).select(*ROW_KEY, "label", "split", "text")


def counted_rows(pool: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """The balanced rows with ``tf`` instead of their text.

    Every text is tokenised once, where it is read, however often it is drawn and however
    many steps use its terms; only its counted terms join the keys.
    """
    counted = term_frequencies(pool.select("src", "id", "text"), "text", stop_words).select("src", "id", "tf")
    return stage_table(balanced_keys(pool).join(counted, ["src", "id"]))


def harmonize(
    sources: Sequence[RawSource],
    genre_map: Mapping[str, str],
    label2id: Mapping[str, int],
    eval_split: float | None = 0.15,
    test_split: float | None = 0.15,
    seed: int = DEFAULT_SEED,
    replace: bool = True,
    apply_multilingual: bool = False,
    drop_empty: bool = False,
) -> DataFrame:
    """G9 up to the split. The cleaned texts are written once, by the dedup; all branches read them."""
    pool = clean_pool(sources, genre_map, label2id, apply_multilingual, drop_empty)
    return balanced_split(pool, eval_split, test_split, seed, replace)


def encode(
    rows: DataFrame,
    stop_words: Sequence[str] = (),
    max_features: int = MAX_FEATURES,
    vocabulary_size: int | None = None,
    length: int = SEQUENCE_LENGTH,
    key_cols: Sequence[str] = ROW_KEY,
) -> EncodedData:
    """G9 encoding: both vocabularies are fitted on the train split and applied to all rows."""
    staged = spread_small_scan(stage_table(rows, partition_by=("split",)))
    counted = term_frequencies(staged, "text", stop_words)
    terms = fitted(tfidf_fit(counted.where(F.col("split") == "train"), max_features))
    words = fitted(token_vocabulary(staged.where(F.col("split") == "train"), "text", vocabulary_size))
    return EncodedData(
        rows=staged,
        features=tfidf_transform(counted, terms, [*key_cols, "label", "split"]),
        tokens=encode_fixed_length(staged, words, key_cols, "text", length),
        terms=terms,
        words=words,
    )
