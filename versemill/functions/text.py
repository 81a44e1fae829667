"""Text normalisation, cleaning and tokenisation as Spark columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The cleaning rules and word pattern must match exactly.
# Unicode white space as one regex class body (ASCII controls 1c-1f included).
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# (?d): the dot stops at a line feed only, so a tag may span a carriage return.
BRACKET_TAG = r"(?d)\[.*?\]"
CARRIAGE_RETURN = r"\r\n?"
# Nested so that letters and spaces, nearly every character, are told apart first.
OUTSIDE_ALPHABET = rf"[^a-z[ \n[0-9'{WHITESPACE}]]]"
SPACE_RUN = " {2,}"
BLANK_LINE_RUN = "\n{3,}"
WHITESPACE_CHARACTERS = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
WORD = r"[\p{L}\p{N}_]{2,}"
# End of fixed values.

TAGGED_LYRICS_RULES: tuple[tuple[str, str], ...] = (
    (BRACKET_TAG, " "),
    (CARRIAGE_RETURN, "\n"),
    (OUTSIDE_ALPHABET, " "),
    (SPACE_RUN, " "),
    (BLANK_LINE_RUN, "\n\n"),
)

MULTILINGUAL_RULES: tuple[tuple[str, str], ...] = (
    (CARRIAGE_RETURN, "\n"),
    (SPACE_RUN, " "),
    (BLANK_LINE_RUN, "\n\n"),
)


def _apply_rules(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    replaced = reduce(lambda acc, rule: F.regexp_replace(acc, rule[0], rule[1]), rules, lowered)
    return strip_whitespace(replaced)


def clean_genius(text: Column) -> Column:
    """Lower, drop bracket tags, unify newlines, keep ``[a-z0-9']`` and white space."""
    return _apply_rules(text, TAGGED_LYRICS_RULES)


def clean_multilingual(text: Column) -> Column:
    """Lower, unify newlines, squeeze spaces and blank lines; letters stay."""
    return _apply_rules(text, MULTILINGUAL_RULES)


def strip_whitespace(text: Column) -> Column:
    """Unicode white space removed at both ends (``trim`` handles spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE_CHARACTERS))


def normalise_label(label: Column) -> Column:
    """text form, lower case, stripped; a null stays null."""
    return strip_whitespace(F.lower(label.cast("string")))


def text_preview(text: Column, length: int = 150) -> Column:
    """the first ``length`` characters followed by an ellipsis, for display."""
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def word_tokens(text: Column) -> Column:
    """V1: lower-cased words of two or more word characters, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def without_stop_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    """V2: tokens outside ``stop_words``; done before n-grams are formed."""
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(*sorted(set(stop_words))))


def unigrams_and_bigrams(tokens: Column) -> Column:
    """V3: all tokens followed by all adjacent pairs joined with a space."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.concat(
        tokens,
        F.zip_with(
            F.slice(tokens, F.lit(1), pairs),
            F.slice(tokens, F.lit(2), pairs),
            lambda a, b: F.concat_ws(" ", a, b),
        ),
    )


def exploded_tokens(df: DataFrame, tokens: Column, *cols: str) -> DataFrame:
    """``cols, pos, token``: one line per token, in text order from 0.

    The outer form keeps the optimizer from tokenising twice to skip empty texts early.
    """
    return df.select(*cols, F.posexplode_outer(tokens).alias("pos", "token")).where(F.col("pos").isNotNull())
