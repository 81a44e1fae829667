"""Harmonising raw sources: rename, language filter, cleaning, nulls, label mapping."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from versemill.functions.text import clean_genius, clean_multilingual, normalise_label
from versemill.sources.config import SourceConfig

# Source names that select a built-in cleaner.
TAGGED_LYRICS_SOURCE = "Genius Song Lyrics"
MULTILINGUAL_SOURCE = "Multi-Lingual Lyrics for Genre Classification"

TextCleaner = Callable[[Column], Column]


def rename_columns(df: DataFrame, cols_map: Mapping[str, str]) -> DataFrame:
    """S3: rename the mapped columns that exist; all others stay."""
    return df.withColumnsRenamed({old: new for old, new in cols_map.items() if old in df.columns})


def filter_language(df: DataFrame, language_col: str | None, target: str | None) -> DataFrame:
    """keep rows of the target language and drop the column; no setting, no filter."""
    if not (language_col and target):
        return df
    return df.where(F.col(language_col) == target).drop(language_col)


def clean_text(
    df: DataFrame,
    source_name: str,
    custom: TextCleaner | None = None,
    apply_multilingual: bool = False,
) -> DataFrame:
    """clean ``text`` with the cleaner of the source.

    The multilingual cleaner is off by default: existing results were produced without
    it, although a cleaner is defined for that source. A custom cleaner is a
    ``Column -> Column`` function, which may wrap a pandas UDF (T10).
    """
    if source_name == TAGGED_LYRICS_SOURCE:
        return df.withColumn("text", clean_genius(F.col("text")))
    if source_name == MULTILINGUAL_SOURCE:
        return df.withColumn("text", clean_multilingual(F.col("text"))) if apply_multilingual else df
    if custom is None:
        raise ValueError(f"source {source_name!r} has no built-in cleaner and none was given")
    return df.withColumn("text", custom(F.col("text")))


def never_null(config: SourceConfig, apply_multilingual: bool = False) -> tuple[str, ...]:
    """Columns that cleaning leaves without nulls: the text, where a built-in cleaner ran."""
    cleaned = config.name == TAGGED_LYRICS_SOURCE or (
        config.name == MULTILINGUAL_SOURCE and apply_multilingual
    )
    return ("text",) if cleaned else ()


def drop_nulls(df: DataFrame, known: Sequence[str] = ()) -> DataFrame:
    """drop rows with a null or NaN in any column of the source.

    ``known`` names columns that cannot be null. The filter is moved below the projection
    that computes its columns, so checking a cleaned text would clean it a second time.
    """
    return df.dropna("any", subset=[c for c in df.columns if c not in known])


def map_genres(df: DataFrame, genre_map: Mapping[str, str], label2id: Mapping[str, int]) -> DataFrame:
    """raw label -> genre -> integer id; unmapped rows are dropped.

    The two lookups are joined on the driver into one constant map, so no join runs.
    """
    ids = {raw: label2id[genre] for raw, genre in genre_map.items() if genre in label2id}
    if not ids:
        return df.where(F.lit(False)).withColumn("label", F.lit(None).cast("int"))
    lookup = F.create_map(*[F.lit(v) for v in chain.from_iterable(ids.items())])
    return (
        df.withColumn("label", F.element_at(lookup, F.col("label")).cast("int"))
        .where(F.col("label").isNotNull())
    )


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Sources stacked by column name; a column a source lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def normalised_source(
    df: DataFrame,
    config: SourceConfig,
    custom: TextCleaner | None = None,
    apply_multilingual: bool = False,
    watch: Callable[[DataFrame, str, str], DataFrame] = lambda df, stage, side: df,
) -> DataFrame:
    """S3, F1, F2, F3 of one source: everything before the null drop.

    ``watch`` sees the rows before and after the language filter.
    """
    renamed = rename_columns(df, config.cols_map)
    labelled = watch(renamed.withColumn("label", normalise_label(F.col("label"))), "filter_language", "n_before")
    kept = watch(filter_language(labelled, config.language_col, config.target_language), "filter_language", "n_after")
    return clean_text(kept, config.name, custom, apply_multilingual)


def stage_audit(df: DataFrame, config: SourceConfig, custom: TextCleaner | None = None) -> DataFrame:
    """rows before and after the language filter and the null drop, in one pass.

    Columns: ``src, stage, n_before, n_after``.
    """
    renamed = rename_columns(df, config.cols_map)
    if config.language_col and config.target_language:
        spoken = F.coalesce(F.col(config.language_col) == config.target_language, F.lit(False))
    else:
        spoken = F.lit(True)
    prepared = clean_text(
        renamed.withColumns({"_spoken": spoken, "label": normalise_label(F.col("label"))}),
        config.name,
        custom,
    )
    skipped = ("_spoken", config.language_col, *never_null(config))
    checked = [c for c in prepared.columns if c not in skipped]
    types = dict(prepared.dtypes)
    present = reduce(
        lambda a, b: a & b,
        [
            F.col(c).isNotNull() & (~F.isnan(c) if types[c] in ("double", "float") else F.lit(True))
            for c in checked
        ],
    )
    counts = prepared.groupBy("src").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if("_spoken").alias("n_language"),
        F.count_if(F.col("_spoken") & present).alias("n_complete"),
    )
    stages = F.array(
        F.struct(
            F.lit("filter_language").alias("stage"),
            F.col("n_all").alias("n_before"),
            F.col("n_language").alias("n_after"),
        ),
        F.struct(
            F.lit("drop_nulls").alias("stage"),
            F.col("n_language").alias("n_before"),
            F.col("n_complete").alias("n_after"),
        ),
    )
    return counts.select("src", F.inline(stages))


class StageAudit:
    """F6 without a pass of its own: rows are counted while they flow to wherever they are written.

    Hand it to the preparation, run that, then ask for :meth:`counts`.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[int, str, str, Observation]] = []

    def passing(self, df: DataFrame, place: int, stage: str, side: str) -> DataFrame:
        """``df``, counted as ``side`` (``n_before`` or ``n_after``) of ``stage``."""
        seen = Observation()
        self._seen.append((place, stage, side, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def counts(self, spark: SparkSession) -> DataFrame:
        """``src, stage, n_before, n_after`` of the sources in their order; waits for the first run to end."""
        lines: dict[tuple[int, str], dict[str, int]] = {}
        for place, stage, side, seen in self._seen:
            lines.setdefault((place, stage), {})[side] = seen.get["n"]
        rows = [(place, stage, n["n_before"], n["n_after"]) for (place, stage), n in lines.items()]
        return spark.createDataFrame(rows, "src int, stage string, n_before bigint, n_after bigint")
