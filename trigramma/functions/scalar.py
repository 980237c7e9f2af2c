"""Column expressions; all of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trigramma.functions import formulas

# Fixed value: the letters a Hebrew token may hold, as a character class body.
HEBREW = "א-ת"


def ieee_divide(a: Column, b: Column) -> Column:
    """Division of doubles with NaN and infinities in place of errors."""
    return formulas.ieee_divide(a, b, _case, F.try_divide, F.isnan, lambda text: F.lit(float(text)))


def _case(*branches: tuple[Column, Column]) -> Column:
    (condition, value), *rest = branches
    found = F.when(condition, value)
    for condition, value in rest:
        found = found.when(condition, value)
    return found


def round_half_up(x: Column) -> Column:
    """Nearest whole number, halves upwards, as a double.

    As a 64-bit integer would hold it: NaN is 0, and larger values are cut to its range.
    """
    return F.floor(x + 0.5).cast("double")


def floor_double(x: Column) -> Column:
    """Floor of a double as a double; NaN, infinities and values too large for a fraction stay."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def confidence(n: Column) -> Column:
    """Weight in [0.5, 1) that grows with the logarithm of a count."""
    return formulas.confidence(n, F.ln)


def interpolate(
    n1: Column, n2: Column, n3: Column, c0: Column, c1: Column, c2: Column
) -> Column:
    """P(w3 | w1, w2): trigram, bigram and unigram ratios, weighted."""
    return formulas.interpolate(n1, n2, n3, c0, c1, c2, confidence, ieee_divide)


def ngram_words(ngram: Column) -> Column:
    """Words between single spaces; trailing spaces make no words."""
    return F.split(F.rtrim(ngram), " ")


def ngram_order(words: Column) -> Column:
    """Number of words of an n-gram held as an array."""
    return F.size(words)


def phrase(*words: Column) -> Column:
    """Words joined by one space."""
    return F.concat_ws(" ", *words)


def split_phrase(text: Column, n: int = 3) -> list[Column]:
    """The first ``n`` words of a phrase, as columns w1, w2, ..."""
    words = F.split(text, " ")
    return [F.get(words, F.lit(i)).alias(f"w{i + 1}") for i in range(n)]


def only_letters(word: Column, letters: str = HEBREW) -> Column:
    """One non-empty word of nothing but ``letters`` (a character class body)."""
    return word.rlike(rf"\A[{letters}]+\z")


def words_only_letters(ngram: Column, letters: str = HEBREW) -> Column:
    """Every space-separated word of ``ngram`` is made of ``letters``.

    Character classes alone, no repeated groups: linear time and constant stack
    however long the text is. An empty word (leading or double space) fails.
    """
    text = F.rtrim(ngram)
    return text.rlike(rf"\A[{letters}][{letters} ]*\z") & ~text.contains("  ")
