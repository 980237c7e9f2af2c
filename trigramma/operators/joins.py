"""Bringing word, pair and corpus counts to every trigram.

All joins are equi-joins with a right side that is unique on the key. No side is
marked for broadcast: the word and pair tables grow with the corpus, so Spark
broadcasts them only below its size threshold and otherwise sorts and merges,
cutting up partitions that a frequent word or pair makes too large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trigramma.functions.scalar import floor_double
from trigramma.operators.counts import (
    WORDS,
    bigram_counts,
    bigrams_of_pairs,
    corpus_total,
    pair_sums,
    trigram_sums,
    unigram_counts,
    unigrams_of_pairs,
)
from trigramma.session import materialised


def lookup(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that stays even when a few keys hold most rows of ``left``.

    Adaptive skew join cuts up a hot partition of the left side, but only where
    both inputs are shuffled for the join itself. A right side fresh from a
    ``groupBy`` on the key would be used as it lies, and the hot key would then
    keep to one task. A hash of the key as leading join column makes Spark
    shuffle both sides; it also lets the sort compare one number instead of
    words that begin alike. It is one of 32 bits: it travels with every row, and does not compress.

    An inner join is asked to sort and merge: both sides grow with the corpus, and by the
    size of its compressed files Spark would take the left one for small enough to send
    to every task. Left, semi and anti joins only ever send their right side.
    """
    key = F.hash(*on)
    side = right.withColumn("_key", key)
    if how == "inner":
        side = side.hint("merge")
    joined = left.withColumn("_key", key).join(side, ["_key", *on], how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on]
    return joined.select(*left.columns, *added)


def with_counts(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` with the counts of a table made from the same rows, so that each key is there.

    As a left join, which Spark may only make by sending the right side, if that is small, or by
    sorting and merging: the trigrams, whose files look small, are never the side that is sent. Rows
    without a word have no counts and go.
    """
    for name in on:
        left = left.where(F.col(name).isNotNull())
    return lookup(left, right, on, "left")


def join_c1(trigrams: DataFrame, unigrams: DataFrame) -> DataFrame:
    """``c1``: count of the second word."""
    side = unigrams.select(F.col("w").alias("w2"), F.col("n").alias("c1"))
    return with_counts(trigrams, side, ["w2"])


def join_n1(trigrams: DataFrame, unigrams: DataFrame) -> DataFrame:
    """``n1``: count of the third word."""
    side = unigrams.select(F.col("w").alias("w3"), F.col("n").alias("n1"))
    return with_counts(trigrams, side, ["w3"])


def join_c2(trigrams: DataFrame, bigrams: DataFrame) -> DataFrame:
    """``c2``: count of the first pair."""
    side = bigrams.select(F.col("a").alias("w1"), F.col("b").alias("w2"), F.col("n").alias("c2"))
    return with_counts(trigrams, side, ["w1", "w2"])


def join_n2(trigrams: DataFrame, bigrams: DataFrame) -> DataFrame:
    """``n2``: count of the second pair."""
    side = bigrams.select(F.col("a").alias("w2"), F.col("b").alias("w3"), F.col("n").alias("n2"))
    return with_counts(trigrams, side, ["w2", "w3"])


def attach_total(trigrams: DataFrame, total: DataFrame) -> DataFrame:
    """``c0`` on every row: a scalar subquery, so no join and no extra shuffle."""
    return trigrams.withColumn("c0", total.scalar())


def pair_table(sums: DataFrame) -> DataFrame:
    """``a, b, pair_n, word_n``: a pair's count and that of its second word.

    For a trigram's first pair these are c2 and c1, for its second n2 and n1.
    The word counts are joined here, to the pairs, and not twice to the far
    larger table of trigrams.
    """
    pairs = pair_sums(sums)
    words = unigrams_of_pairs(pairs).select(F.col("w").alias("b"), F.col("n").alias("word_n"))
    counts = bigrams_of_pairs(pairs).withColumnRenamed("n", "pair_n")
    return with_counts(counts, words, ["b"])


def trigram_statistics(rows: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``w1, w2, w3, n1, n2, n3, c0, c1, c2`` for every distinct trigram.

    ``wanted``, a table of pairs ``w1, w2``, limits the rows that come out (not
    the corpus that is counted) before the joins are made. The trigram sums are
    used several times; where rows are given instead, their sums are written first.
    """
    sums = rows if "s" in rows.columns else materialised(trigram_sums(rows), "trigram_sums")
    pairs = pair_table(sums)
    first = pairs.select(
        F.col("a").alias("w1"), F.col("b").alias("w2"),
        F.col("pair_n").alias("c2"), F.col("word_n").alias("c1"),
    )
    second = pairs.select(
        F.col("a").alias("w2"), F.col("b").alias("w3"),
        F.col("pair_n").alias("n2"), F.col("word_n").alias("n1"),
    )
    kept = sums
    if wanted is not None:
        kept = lookup(sums, wanted.select("w1", "w2").distinct(), ["w1", "w2"], "left_semi")
    joined = with_counts(with_counts(kept, first, ["w1", "w2"]), second, ["w2", "w3"])
    n3 = floor_double(F.col("s") / 3).alias("n3")
    return attach_total(
        joined.select(*WORDS, "n1", "n2", n3, "c1", "c2"), corpus_total(sums)
    ).select(*WORDS, "n1", "n2", "n3", "c0", "c1", "c2")


def labelled_statistics(statistics: DataFrame) -> DataFrame:
    """Long form, four rows per trigram: ``label`` N1, N2, C1 or C2 and ``value``."""
    labels = F.expr("stack(4, 'N1', n1, 'N2', n2, 'C1', c1, 'C2', c2) AS (label, value)")
    return statistics.select(*WORDS, labels, "n3")


def pivot_statistics(labelled: DataFrame) -> DataFrame:
    """Back to one row per trigram; a missing N is 0 and a missing C is 1."""
    def value(label: str, default: float):
        found = F.max(F.when(F.col("label") == label, F.col("value")))
        return F.coalesce(found, F.lit(default)).alias(label.lower())

    return labelled.groupBy(*WORDS).agg(
        value("N1", 0.0), value("N2", 0.0), F.max("n3").alias("n3"),
        value("C1", 1.0), value("C2", 1.0),
    )
