"""Cleaning, normalising and tokenising on hand-made strings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from versemill.functions import text as tx


def apply(spark, fn, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in rows.select("i", fn(F.col("t")).alias("o")).orderBy("i").collect()]


GENIUS = {
    "[Chorus]\r\nHi": "hi",
    "[a\rb] x": "x",
    "[a\nb] x": "a\nb x",
    " Hi there ": "hi there",
    "a\x1cb\x1f": "a\x1cb",
    "a\t\tb": "a\t\tb",
    "a\n\n\n\nb": "a\n\nb",
    "a\n \n \nb": "a\n \n \nb",
    "don't STOP, now!": "don't stop now",
    "café naïve": "caf na ve",
    "İx": "i x",
    "a   b": "a b",
    "x [tag] [other] y": "x y",
    "": "",
    "smile \U0001f600 end": "smile end",
    "a\rb\r\nc": "a\nb\nc",
    " wide　": "wide",
}


def test_clean_genius(spark):
    assert dict(zip(GENIUS, apply(spark, tx.clean_genius, list(GENIUS)))) == GENIUS
    assert apply(spark, tx.clean_genius, [None]) == [""]


MULTILINGUAL = {
    "[Chorus]\r\nHi": "[chorus]\nhi",
    "  Café   olé  ": "café olé",
    "a\n\n\n\nb": "a\n\nb",
    "\x1c a　": "a",
    "A\tB": "a\tb",
}


def test_clean_multilingual(spark):
    assert dict(zip(MULTILINGUAL, apply(spark, tx.clean_multilingual, list(MULTILINGUAL)))) == MULTILINGUAL
    assert apply(spark, tx.clean_multilingual, [None]) == [""]


def test_normalise_label_keeps_null(spark):
    values = [" Rap ", "ROCK", " Pop ", None]
    assert apply(spark, tx.normalise_label, values) == ["rap", "rock", "pop", None]


@pytest.mark.parametrize("n", [100, 150])
def test_preview_always_ends_with_dots(spark, n):
    assert apply(spark, lambda c: tx.text_preview(c, n), ["x" * 200, "short"]) == ["x" * n + "...", "short..."]


def test_words_and_bigrams(spark):
    words = ["Été a I_2 don't xçy", "one", "", "a b c"]
    assert apply(spark, tx.word_tokens, words) == [["été", "i_2", "don", "xçy"], ["one"], [], []]
    grams = lambda c: tx.unigrams_and_bigrams(tx.without_stop_words(tx.word_tokens(c), ["the"]))
    assert apply(spark, grams, ["up the hill", "the", "up"]) == [["up", "hill", "up hill"], [], ["up"]]
