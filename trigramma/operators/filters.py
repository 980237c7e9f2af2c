"""Row filters: alphabet, number of words, stop words.

Each works on an ``ngram`` column of space-separated words, or on the three
word columns once they are split. All depend on the words alone, so they may
stand before or after counts are summed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trigramma.functions.scalar import (
    HEBREW,
    only_letters,
    words_only_letters,
)
from trigramma.operators.counts import WORDS
from trigramma.operators.joins import lookup


def filter_alphabet(df: DataFrame, letters: str = HEBREW, column: str = "ngram") -> DataFrame:
    """Keep rows of which every word is made of ``letters``."""
    if column in df.columns:
        return df.where(words_only_letters(F.col(column), letters))
    for word in WORDS:
        df = df.where(only_letters(F.col(word), letters))
    return df


def filter_arity(df: DataFrame, n: int = 3, column: str = "ngram") -> DataFrame:
    """Keep n-grams of at least ``n`` words, that is with something after word ``n - 1``."""
    text = F.rtrim(F.col(column))
    return df.where(F.substring_index(text, " ", n - 1) != text)


def filter_stopwords(df: DataFrame, stop: DataFrame | Iterable[str]) -> DataFrame:
    """Drop rows with a stop word in any of the three positions.

    ``stop`` is a list of words, which become literals of the plan, or a table with a
    ``word`` column, which is anti-joined per position whatever its size. Either way a
    NULL word is no stop word and NULL in ``stop`` stops nothing.
    """
    if isinstance(stop, DataFrame):
        for word in WORDS:
            listed = stop.select(F.col("word").alias(word)).distinct()
            df = lookup(df, listed, [word], "left_anti")
        return df
    words = stop_list(stop)
    if not words:
        return df
    for word in WORDS:
        df = df.where(no_stopword(F.col(word), words))
    return df


def stop_list(stop: Iterable[str]) -> list[str]:
    return sorted({word for word in stop if word is not None})


def no_stopword(word: Column, words: list[str]) -> Column:
    """Not one of ``words``; true for NULL."""
    return ~F.coalesce(word.isin(words), F.lit(False))
