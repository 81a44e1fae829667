"""Source configuration, null handling, label mapping, union and deduplication."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from versemill.operators import cleaning
from versemill.operators.sampling import dedup_keep_first
from versemill.plans.harmonize import RawSource, clean_pool
from versemill.sources.config import SourceConfig, load_source_config

GENRES = {"rap": "rap", "rock": "rock", "nan": "pop"}
IDS = {"rap": 0, "rock": 1, "pop": 2, "other": 3}


def write_config(tmp_path, **changes):
    body = {
        "name": "n", "csv_name": "c", "kagglehub_handle": "h", "csv_path": "", "cols_map": {"a": "text"},
        "language_col": "", "target_language": "", "vectorizer_config": {"stop_words": ["the"]},
    } | changes
    path = tmp_path / "source.json"
    path.write_text(json.dumps(body))
    return path


def test_config_reads_and_checks(tmp_path):
    config = load_source_config(write_config(tmp_path))
    assert config.csv_path is None and config.language_col is None and config.stop_words() == ["the"]
    with pytest.raises(ValueError):
        load_source_config(write_config(tmp_path, language_col="lang"))
    with pytest.raises(ValueError):
        load_source_config(write_config(tmp_path, target_language="en"))
    broken = tmp_path / "broken.json"
    broken.write_text("{}")
    with pytest.raises(ValueError):
        load_source_config(broken)


def test_rename_ignores_absent_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert cleaning.rename_columns(df, {"a": "text", "zzz": "label"}).columns == ["text", "b"]


def test_language_filter(spark):
    df = spark.createDataFrame([("x", "en"), ("y", "de"), ("z", None)], "text string, lang string")
    kept = cleaning.filter_language(df, "lang", "en")
    assert kept.columns == ["text"] and [r["text"] for r in kept.collect()] == ["x"]
    assert cleaning.filter_language(df, None, None).count() == 3


def test_unknown_source_needs_a_cleaner(spark):
    df = spark.createDataFrame([("Ab",)], "text string")
    with pytest.raises(ValueError):
        cleaning.clean_text(df, "mine")
    assert cleaning.clean_text(df, "mine", F.upper).first()["text"] == "AB"


def test_multilingual_cleaning_is_off_unless_asked(spark):
    df = spark.createDataFrame([("  Ab ",)], "text string")
    assert cleaning.clean_text(df, cleaning.MULTILINGUAL_SOURCE).first()["text"] == "  Ab "
    cleaned = cleaning.clean_text(df, cleaning.MULTILINGUAL_SOURCE, apply_multilingual=True)
    assert cleaned.first()["text"] == "ab"


@pytest.fixture
def sources(spark):
    tagged = spark.createDataFrame(
        [
            (0, 1, "Same text", " Rap ", 1.0),
            (0, 2, None, "rock", 1.0),
            (0, 3, "SAME TEXT", "rock", 1.0),
            (0, 4, "kept", "unmapped", 1.0),
            (0, 5, "no label", None, 1.0),
            (0, 6, "null elsewhere", "rap", None),
            (0, 7, "nan elsewhere", "rap", float("nan")),
        ],
        "src int, id long, text string, label string, extra double",
    )
    plain = spark.createDataFrame(
        [(1, 1, "same text", "rock", "u"), (1, 2, None, "rap", "u"), (1, 3, "Other", "ROCK", "u")],
        "src int, id long, text string, label string, note string",
    )
    return [
        RawSource(tagged, SourceConfig(cleaning.TAGGED_LYRICS_SOURCE)),
        RawSource(plain, SourceConfig(cleaning.MULTILINGUAL_SOURCE)),
    ]


def test_pool_edge_rows(sources):
    pool = {(r["src"], r["id"], r["text"], r["label"]) for r in clean_pool(sources, GENRES, IDS).collect()}
    # The null text of the tagged source survives as "", that of the other source does not;
    # the first source wins an equal text whatever its label says.
    assert pool == {(0, 1, "same text", 0), (0, 2, "", 1), (1, 3, "Other", 1)}
    without = clean_pool(sources, GENRES, IDS, drop_empty=True)
    assert without.where("text = ''").count() == 0


def test_audit_counts(sources):
    lines = {r["stage"]: (r["n_before"], r["n_after"]) for r in cleaning.stage_audit(
        sources[0].table, sources[0].config).collect()}
    assert lines == {"filter_language": (7, 7), "drop_nulls": (7, 4)}


def test_union_fills_missing_columns(sources):
    both = cleaning.union_sources([s.table for s in sources])
    assert set(both.columns) == {"src", "id", "text", "label", "extra", "note"} and both.count() == 10


def test_dedup_is_idempotent_and_handles_hot_text(spark):
    df = spark.range(3000).select(
        F.lit(0).alias("src"), "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    once = dedup_keep_first(df)
    assert once.count() == 2001 and once.where("text = 'hot'").first()["id"] == 0
    assert dedup_keep_first(once).count() == 2001
