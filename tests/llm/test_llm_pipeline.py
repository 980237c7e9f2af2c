"""Mixing, and the stages one after another, each against plain Python on its own input."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from odd_tables import ROWS, SF
from test_llm_near import brute_runs, reach
from trigramma.llm import language_id, mixing
from trigramma.llm.queries import TARGETS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_round(weights):
    """Earliest deadline first over one round, by the definition of release and deadline."""
    total, placed, order = sum(weights), [0] * len(weights), []
    for slot in range(total):
        ready = [
            (-(-(n + 1) * total // w), i) for i, (n, w) in enumerate(zip(placed, weights)) if n * total // w <= slot
        ]
        due, best = min(ready)
        assert due > slot
        order.append(best)
        placed[best] += 1
    return order


@pytest.mark.parametrize("weights", [[1], [3, 1, 1], [5, 3, 2, 7, 1], [50, 1, 1, 1, 1, 1, 1], [1] * 9, [13, 8, 5, 3, 2, 1, 1]])
def test_round_is_fair(spark, weights):
    df = spark.createDataFrame([(f"s{i:02}", w) for i, w in enumerate(weights)], "source string, weight long")
    rows = mixing.timetable(df).orderBy("slot").collect()
    order = [int(r.source[1:]) for r in rows]
    assert order == brute_round(weights)
    placed = [0] * len(weights)
    for slot, best in enumerate(order, 1):
        placed[best] += 1
        assert all(abs(n * sum(weights) - w * slot) < sum(weights) for n, w in zip(placed, weights))
    assert placed == weights
    assert all(r.turn == sum(x.source == r.source for x in rows[: r.slot]) for r in rows)


def test_mix_keeps_all_and_follows_the_targets(spark):
    rows = [(i, "x", ("big", "mid", "low", None)[min(i % 7, 3)], i) for i in range(7000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, weight int")
    found = mixing.mix_sources(df, {"big": 4, "mid": 2}, block=10).orderBy("mix_position").collect()
    assert sorted(r.doc_id for r in found) == list(range(7000))
    assert len({r.mix_position for r in found}) == 7000
    blocks = [found[i : i + 10] for i in range(0, 2000, 10)]
    seen = Counter()
    for k, block in enumerate(blocks, 1):
        assert len({r.source for r in block}) == 1
        seen[block[0].source] += 1
        assert all(abs(seen[s] - w * k / 8) < 1 for s, w in (("big", 4), ("mid", 2), ("low", 1), (None, 1)))


@pytest.mark.parametrize("stretch", [7, 50])
def test_stretches_make_one_round(spark, monkeypatch, stretch):
    weights = [5, 3, 2, 7, 1, 1, 1, 3, 13]
    df = spark.createDataFrame([(f"s{i:02}", w) for i, w in enumerate(weights)], "source string, weight long")
    monkeypatch.setattr(mixing, "STRETCH", stretch)
    rows = mixing.timetable(df).orderBy("slot").collect()
    assert [int(r.source[1:]) for r in rows] == brute_round(weights)
    assert all(r.turn == sum(x.source == r.source for x in rows[: r.slot]) for r in rows)


def test_any_number_of_sources(spark):
    name = F.when(F.col("doc_id") < 3, F.lit("big")).otherwise(F.concat(F.lit("h"), F.col("doc_id").cast("string")))
    docs = spark.range(200_003).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).withColumn("source", name)
    found = mixing.mix_sources(docs, {"big": 5}, block=1).select("source", "mix_position").toPandas()
    assert len(found) == 200_003 and found["mix_position"].nunique() == 200_003
    places = sorted(found.loc[found["source"] == "big", "mix_position"])
    # Three of its five blocks of a round of 200,005 slots, each between release and deadline.
    assert all(k * 40_001 <= at < (k + 1) * 40_001 for k, at in enumerate(places))


def test_rows_without_id_are_spread(spark):
    docs = spark.range(3000).select(
        F.lit(None).cast("bigint").alias("doc_id"), F.col("id").cast("string").alias("text"),
        F.lit("a").alias("source"), F.lit(7).alias("mix_position"),
    )
    found = mixing.mix_sources(docs, {}, block=4).toPandas()
    assert sorted(found["mix_position"]) == list(range(3000))
    weights = spark.createDataFrame([("a", 1)], "source string, weight long")
    ranks = mixing.numbered_rows(docs, weights).select("row.text", "rank").toPandas().sort_values("rank")
    # In the order of their hashes, not of the rows that came.
    assert list(ranks["rank"]) == list(range(3000)) and list(ranks["text"]) != sorted(ranks["text"], key=int)


def test_mixing_odd_rows(spark, odd, none):
    found = mixing.mix_sources(odd, {"a": 2, "unheard of": 3}, block=2)
    assert found.columns == [*odd.columns, "mix_block", "mix_slot", "mix_position"]
    rows = found.collect()
    assert len(rows) == len(ROWS) and len({r.mix_position for r in rows}) == len(ROWS)
    assert mixing.mix_sources(none, {}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(odd, {"a": 0})


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = {r.doc_id: r for r in out.collect()}
        before = {r.doc_id: r for r in docs.collect()}
        assert out.columns[:5] == COLUMNS and rows and set(rows) <= set(before)
        outs[name] = (before, rows)
        docs = spark.createDataFrame(list(rows.values()), out.schema)

    before, rows = outs["language"]
    found = language_id.predict_language(spark.createDataFrame(list(before.values()), "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    assert set(rows) == {r.doc_id for r in found.collect() if r.lang_pred != "und" and r.score >= 0.5}
    assert all(rows[i] == before[i] for i in rows)

    before, rows = outs["lines"]
    want = brute_lines(sorted((i, r.text) for i, r in before.items()))
    assert {i: r.text for i, r in rows.items()} == want and any(rows[i].text != before[i].text for i in rows)
    small = sorted((i, r.text) for i, r in before.items() if len(r.text) < 1500)[:60]
    assert {w[0]: w[3] for w in brute_runs(small)} == brute_lines(small)

    before, rows = outs["near_duplicates"]
    ids = sorted(before)
    links = similar([before[i].text for i in ids])
    assert set(rows) == {ids[min(reach(links, k))] for k in range(len(ids))}

    before, rows = outs["benchmark"]
    bench = [t.text for t in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(before) - set(rows) == {i for i, r in before.items() if touched(r.text, bench)}
    assert all(rows[i] == before[i] for i in rows)

    before, rows = outs["mixing"]
    assert set(rows) == set(before)
    assert all(tuple(rows[i])[:5] == tuple(before[i]) for i in rows)
    sources = defaultdict(list)
    for r in rows.values():
        sources[r.source].append(r.mix_block)
    for blocks in sources.values():
        assert sorted(blocks) == sorted(i // mixing.BLOCK for i in range(len(blocks)))
    assert set(TARGETS) <= set(sources)


def brute_lines(rows):
    """Texts without the runs of lines that occurred before, by all pairs of neighbouring lines seen so far."""
    seen, out = set(), {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        solid = [k for k, x in enumerate(lines) if x.strip()]
        gone = set()
        for a, b in zip(solid, solid[1:]):
            said = tuple(lines[a : b + 1])
            if said in seen:
                gone |= set(range(a, b + 1))
            seen.add(said)
        out[doc_id] = text and "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def similar(texts):
    """Links of the stage: five words, four fifths."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return [
        {j for j, b in enumerate(sets) if i != j and a and b and 100 * len(a & b) >= 80 * len(a | b)} for i, a in enumerate(sets)
    ]


def touched(text, items):
    import re

    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    words = cut(text)
    for item in items:
        gold = cut(item)
        size = min(10, len(gold))
        windows = {tuple(gold[k : k + size]) for k in range(len(gold) - size + 1)} if gold else set()
        if any(tuple(words[k : k + size]) in windows for k in range(len(words) - size + 1)):
            return True
    return False


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*COLUMNS, "mix_block", "mix_slot", "mix_position"]
    assert 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_odd_rows_pass_every_stage(spark, odd, none):
    for rows in (odd, none):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == rows.count()
