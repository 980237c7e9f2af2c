"""Counts of words, word pairs and trigrams, and the corpus total.

The divisors are those of the definition: a word's sum is taken as it is, a
pair's is halved and a trigram's divided by three, each rounded down, and the
total is a third of all counts rounded half up. A word counts once for every
position it holds in a row.

Counts are doubles holding whole numbers, so sums below 2**53 are exact in any
order and do not depend on the partitioning. Every grouping sums on the map
side first; a key that fills a third of all rows arrives as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trigramma.functions.scalar import floor_double, phrase, round_half_up
from trigramma.session import materialised

WORDS = ("w1", "w2", "w3")


def _weight(rows: DataFrame) -> Column:
    """The count column of parsed rows (``cnt``) or of summed trigrams (``s``)."""
    return F.col("s") if "s" in rows.columns else F.col("cnt")


def trigram_sums(rows: DataFrame) -> DataFrame:
    """Distinct trigrams with the sum ``s`` of their counts over all rows."""
    return rows.groupBy(*WORDS).agg(F.sum(_weight(rows)).alias("s"))


def corpus_total(rows: DataFrame) -> DataFrame:
    """One row: ``c0``, a third of all counts, rounded half up."""
    total = F.coalesce(F.sum(_weight(rows)), F.lit(0.0))
    return rows.agg(round_half_up(total / 3).alias("c0"))


def unigram_counts(rows: DataFrame) -> DataFrame:
    """``w, n`` over all three positions."""
    words = rows.select(F.explode(F.array(*WORDS)).alias("w"), _weight(rows).alias("s"))
    return words.groupBy("w").agg(floor_double(F.sum("s")).alias("n"))


def bigram_counts(rows: DataFrame) -> DataFrame:
    """``a, b, n``: first and second pair of every row, sum halved."""
    pairs = F.array(
        F.struct(F.col("w1").alias("a"), F.col("w2").alias("b")),
        F.struct(F.col("w2").alias("a"), F.col("w3").alias("b")),
    )
    exploded = rows.select(F.inline(pairs), _weight(rows).alias("s"))
    return exploded.groupBy("a", "b").agg(floor_double(F.sum("s") / 2).alias("n"))


def trigram_counts(rows: DataFrame) -> DataFrame:
    """``w1, w2, w3, n``: the trigram's sum divided by three."""
    sums = rows if "s" in rows.columns else trigram_sums(rows)
    return sums.select(*WORDS, floor_double(F.col("s") / 3).alias("n"))


def pair_sums(sums: DataFrame) -> DataFrame:
    """``a, b`` with the sum as first pair (``head``) and as second (``tail``).

    Word counts follow from these: a trigram's first word is the ``a`` of its
    first pair, and its other two are the ``a`` and ``b`` of its second.

    Words are never NULL. The filter says so because the joins that follow
    would add it on their branches only, and the branches would then no longer
    share one shuffle.
    """
    zero = F.lit(0.0)
    pairs = F.array(
        F.struct(F.col("w1").alias("a"), F.col("w2").alias("b"), F.col("s").alias("h"), zero.alias("t")),
        F.struct(F.col("w2").alias("a"), F.col("w3").alias("b"), zero.alias("h"), F.col("s").alias("t")),
    )
    return (
        sums.select(F.inline(pairs))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("a", "b")
        .agg(F.sum("h").alias("head"), F.sum("t").alias("tail"))
    )


def unigrams_of_pairs(pairs: DataFrame) -> DataFrame:
    """The same table as ``unigram_counts``, from the smaller ``pair_sums``."""
    words = F.array(
        F.struct(F.col("a").alias("w"), (F.col("head") + F.col("tail")).alias("s")),
        F.struct(F.col("b").alias("w"), F.col("tail").alias("s")),
    )
    return pairs.select(F.inline(words)).groupBy("w").agg(floor_double(F.sum("s")).alias("n"))


def bigrams_of_pairs(pairs: DataFrame) -> DataFrame:
    """The same table as ``bigram_counts``, from ``pair_sums``."""
    return pairs.select("a", "b", floor_double((F.col("head") + F.col("tail")) / 2).alias("n"))


def expand_ngrams(rows: DataFrame) -> DataFrame:
    """Seven records per row, ``ngram, order, cnt``: its share of the total
    (order 0, no words), three words, two pairs and the trigram. Repeats stay.
    """
    w1, w2, w3 = (F.col(w) for w in WORDS)
    keys = [(), (w1,), (w2,), (w3,), (w1, w2), (w2, w3), (w1, w2, w3)]
    records = F.array(
        *[
            F.struct(F.array(*key).cast("array<string>").alias("ngram"), F.lit(len(key)).alias("order"))
            for key in keys
        ]
    )
    return rows.select(F.inline(records), _weight(rows).alias("cnt"))


def ngram_counts(rows: DataFrame) -> DataFrame:
    """Counts of all three orders in one table: ``ngram, order, n``.

    Rows are summed to distinct trigrams once, which are written; pairs follow
    from those and words from the pairs.
    """
    sums = rows if "s" in rows.columns else materialised(trigram_sums(rows), "trigram_sums")
    pairs = pair_sums(sums)
    return (
        unigrams_of_pairs(pairs)
        .select(F.array("w").alias("ngram"), F.lit(1).alias("order"), "n")
        .unionByName(
            bigrams_of_pairs(pairs).select(F.array("a", "b").alias("ngram"), F.lit(2).alias("order"), "n")
        )
        .unionByName(
            trigram_counts(sums).select(F.array(*WORDS).alias("ngram"), F.lit(3).alias("order"), "n")
        )
    )


def ngram_phrases(counts: DataFrame) -> DataFrame:
    """The mixed table with the n-gram written as a phrase."""
    return counts.withColumn("ngram", phrase(F.col("ngram")))
