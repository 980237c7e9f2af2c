"""Random corpora against the plain Python model, and what must not change it."""

from __future__ import annotations

import math
import random

import pytest

import brute
from trigramma.plans.model import kept_rows, model_of, predict_from_rows
from trigramma.operators import counts, joins
from trigramma.operators.ranking import predict, top_next_words


def corpus(seed: int, rows: int, words: int) -> list[str]:
    """Zipf-like words, some with digits, doubled spaces or a fourth word."""
    dice = random.Random(seed)
    names = ["".join(dice.choice("abc") for _ in range(dice.randint(1, 3))) for _ in range(words)] + ["x1", ""]
    lines = []
    for _ in range(rows):
        size = dice.choice([2, 3, 3, 3, 3, 3, 4])
        ngram = " ".join(names[min(int(dice.paretovariate(0.6)) - 1, len(names) - 1)] for _ in range(size))
        lines.append(f"{ngram}\t{dice.randint(1900, 2000)}\t{dice.randint(1, 9)}")
    return lines


def as_dict(model):
    return {(r.w1, r.w2, r.w3): r.asDict() for r in model.collect()}


def frame(spark, lines, parts=4):
    return spark.createDataFrame([(line,) for line in lines], "value string").repartition(parts)


@pytest.mark.parametrize("seed, rows, words", [(1, 300, 10), (2, 3000, 40), (3, 5, 4)])
def test_against_brute_force(spark, seed, rows, words):
    lines = corpus(seed, rows, words)
    expected = brute.model(brute.kept(lines, "a-z", {"ab"}))
    found = as_dict(model_of(kept_rows(frame(spark, lines), ["ab"], "a-z")))
    assert set(found) == set(expected)
    for key, values in expected.items():
        for name, value in values.items():
            other = found[key][name]
            assert (math.isnan(value) and math.isnan(other)) or math.isclose(value, other, abs_tol=1e-12)


def test_partitions_order_and_years_do_not_matter(spark):
    lines = corpus(4, 500, 20)
    split = []
    for line in lines:
        ngram, _, count = line.split("\t")
        split += [f"{ngram}\t1900\t{int(count) - 1}", f"{ngram}\t2001\t1"]
    random.Random(0).shuffle(split)
    models = [
        as_dict(model_of(kept_rows(frame(spark, some, parts), [], "a-z"), "null"))
        for some, parts in ((lines, 1), (lines, 13), (split, 5))
    ]
    assert models[0] == models[1] == models[2]


def test_count_paths_agree(spark):
    """Words and pairs counted from rows, from trigram sums and from pairs."""
    rows = kept_rows(frame(spark, corpus(5, 2000, 30)), [], "a-z").cache()
    sums = counts.trigram_sums(rows)
    pairs = counts.pair_sums(sums)
    words = [set(map(tuple, t.collect())) for t in
             (counts.unigram_counts(rows), counts.unigram_counts(sums), counts.unigrams_of_pairs(pairs))]
    assert words[0] == words[1] == words[2]
    couples = [set(map(tuple, t.collect())) for t in
               (counts.bigram_counts(rows), counts.bigram_counts(sums), counts.bigrams_of_pairs(pairs))]
    assert couples[0] == couples[1] == couples[2]
    expanded = counts.expand_ngrams(rows).groupBy("order").count().collect()
    kept = rows.count()
    assert {r["order"]: r["count"] for r in expanded} == {0: kept, 1: 3 * kept, 2: 2 * kept, 3: kept}


def test_long_form_and_back(spark):
    sums = counts.trigram_sums(kept_rows(frame(spark, corpus(6, 1000, 20)), [], "a-z")).cache()
    statistics = joins.trigram_statistics(sums)
    long = joins.labelled_statistics(statistics)
    assert long.count() == 4 * sums.count()
    columns = ["w1", "w2", "w3", "n1", "n2", "n3", "c1", "c2"]
    back = joins.pivot_statistics(long).select(columns)
    assert set(map(tuple, back.collect())) == set(map(tuple, statistics.select(columns).collect()))


def test_one_join_at_a_time_gives_the_same_statistics(spark):
    sums = counts.trigram_sums(kept_rows(frame(spark, corpus(7, 1000, 20)), [], "a-z")).cache()
    words, pairs = counts.unigram_counts(sums), counts.bigram_counts(sums)
    single = counts.trigram_counts(sums).withColumnRenamed("n", "n3")
    for step, table in ((joins.join_c1, words), (joins.join_n1, words), (joins.join_c2, pairs), (joins.join_n2, pairs)):
        single = step(single, table)
    single = joins.attach_total(single, counts.corpus_total(sums))
    columns = ["w1", "w2", "w3", "n1", "n2", "n3", "c0", "c1", "c2"]
    fused = joins.trigram_statistics(sums).select(columns)
    assert set(map(tuple, single.select(columns).collect())) == set(map(tuple, fused.collect()))


def test_predict_equals_top_words_of_the_pairs(spark):
    rows = kept_rows(frame(spark, corpus(8, 2000, 20)), [], "a-z").cache()
    asked = rows.select("w1", "w2").limit(40)
    asked = spark.createDataFrame(asked.union(asked).collect(), "w1 string, w2 string")
    pairs = {(r.w1, r.w2) for r in asked.collect()}
    whole = model_of(rows)
    expected = {tuple(r) for r in top_next_words(whole, 3).collect() if (r.w1, r.w2) in pairs}
    assert {tuple(r) for r in predict(whole, asked, 3).collect()} == expected
    assert {tuple(r) for r in predict_from_rows(rows, asked, 3).collect()} == expected
