"""Near duplicates and passages, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from odd_tables import ROWS, wide, SCHEMA
from trigramma.llm import decontaminate, jaccard_join, line_dedup
from trigramma.llm import common
from trigramma.llm.common import connected_components


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def brute_links(texts):
    sets = [shingles(t) for t in texts]
    links = [set() for _ in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= 85 * (len(a) + len(b) - both):
                links[i].add(j)
                links[j].add(i)
    return sets, links


def reach(links, i):
    seen, waiting = {i}, [i]
    while waiting:
        for j in links[waiting.pop()] - seen:
            seen.add(j)
            waiting.append(j)
    return seen


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(map(tuple, jaccard_join.near_duplicates(df).collect()), key=repr)
    sets, links = brute_links([t for _, t in rows])
    want = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in reach(links, i) if rows[j][0] is not None]
        want.append((doc_id, len(sets[i]), min(ids, default=None), len(links[i])))
    assert found == sorted(want, key=repr)


def test_links_of_odd_rows(spark, odd):
    check(spark, [r[:2] for r in ROWS])
    wide_found = jaccard_join.near_duplicates(odd)
    assert wide_found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert wide_found.count() == len(ROWS)


def test_links_of_near_copies_and_shared_passages(spark, monkeypatch):
    """Copies with edits near the threshold, and a passage that unrelated texts share; small tiles."""
    monkeypatch.setattr(jaccard_join, "TILE", 7)
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for base in range(25):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.choice([3, 20, 80, 200]))]
        if base % 3 == 0:
            at = rnd.randrange(len(words))
            words = words[:at] + passage + words[at:]
        for _ in range(rnd.choice([1, 2, 12])):
            copy = list(words)
            for _ in range(rnd.randrange(0, 1 + len(words) // 25)):
                copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    check(spark, rows)


def test_links_of_five_words_at_four_fifths(spark):
    """Texts with edits on both sides of the threshold, each group against brute force."""
    rnd = random.Random(8)
    rows = []
    for _ in range(40):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.choice([3, 5, 60, 150]))]
        for _ in range(3):
            copy = list(words)
            for _ in range(rnd.randrange(0, 1 + len(words) // 30)):
                copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    cut = [t.split() for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in cut]
    links = [{j for j, b in enumerate(sets) if i != j and 100 * len(a & b) >= 80 * len(a | b)} for i, a in enumerate(sets)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(map(tuple, jaccard_join.near_duplicates(df, 5, 80).collect()))
    assert found == [(i, len(sets[i]), min(reach(links, i)), len(links[i])) for i in range(len(rows))]
    kept = {r.doc_id for r in jaccard_join.keep_one(df, 5, 80).collect()}
    assert kept == {min(reach(links, i)) for i in range(len(rows))}
    _, strict = brute_links([t for _, t in rows])
    assert kept < {min(reach(strict, i)) for i in range(len(rows))}


def test_chains_of_links_are_one_component(spark):
    """Each text is like the next one only; ids are dealt so that the smallest neighbours form pairs."""
    words = [f"w{i}" for i in range(200)]
    order = [0, 9, 3, 7, 1, 8, 2, 6, 4, 5]
    check(spark, [(i, " ".join(words[6 * k : 6 * k + 100])) for k, i in enumerate(order)])


def test_one_of_each_group_stays(spark, odd):
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([1, 4, 5, 6, 7, 9, 10, 11, 13, None, None], key=repr)


def test_empty_tables(spark, none):
    assert jaccard_join.near_duplicates(none).count() == 0
    assert jaccard_join.keep_one(none).count() == 0
    assert line_dedup.line_dedup_report(none).count() == 0
    assert line_dedup.dedup_lines(none).columns == none.columns
    bench = spark.createDataFrame([(1, "a b c")], "item_id int, text string")
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.drop_contaminated(none, bench.limit(0)).count() == 0


def test_search_finds_what_overlap_says():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[: rnd.integers(80, 101)], rnd.integers(0, 2**63, rnd.integers(0, 20)).astype(np.uint64)])) for _ in range(40)]
    index = jaccard_join.Index(sets)
    for q in sets:
        want = [i for i, s in enumerate(sets) if (k := len(np.intersect1d(q, s))) * 100 >= 85 * (len(q) + len(s) - k)]
        assert index.search(q) == want


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a int, b int")).collect()))
    links = [set() for _ in range(500)]
    for a, b in edges:
        links[a].add(b)
        links[b].add(a)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {n: min(reach(links, n)) for n in nodes}


@pytest.mark.parametrize("most", [3, 500_000])
def test_components_of_names_by_steps_and_in_a_task(spark, monkeypatch, most):
    """Names of two numbers, some below zero; a star, a chain in odd order and pairs; repeats and loops."""
    monkeypatch.setattr(common, "EDGES", most)
    rnd = random.Random(4)
    names = [(rnd.randrange(-5, 5) << 58, rnd.randrange(-(2**62), 2**62)) for _ in range(60)]
    edges = [(0, i) for i in range(1, 20)] + [(i, i + 1) for i in range(20, 45)] + [(50, 51), (51, 50), (51, 50), (55, 55)]
    rows = [(*names[a], *names[b]) for a, b in edges]
    frame = spark.createDataFrame(rows, "p long, q long, r long, s long").selectExpr(
        "struct(p AS s1, q AS s2) AS a", "struct(r AS s1, s AS s2) AS b"
    )
    found = {tuple(node): tuple(root) for node, root in connected_components(frame).collect()}
    links = [set() for _ in names]
    for a, b in edges:
        links[a].add(b)
        links[b].add(a)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {names[n]: min(names[m] for m in reach(links, n)) for n in nodes}


def test_components_of_a_small_graph_take_few_jobs(spark):
    """The driver keeps a record of every job and plan; steps took some ten jobs each, and a chain several steps."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a int, b int")
    spark.sparkContext.setJobGroup("small components", "")
    try:
        assert connected_components(edges).where("root = 0").count() == 301
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("small components")) <= 10
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_decontamination_against_brute_force(spark, odd):
    import re

    rnd = random.Random(9)
    vocabulary = [f"v{i}" for i in range(40)]
    items = [" ".join(rnd.choices(vocabulary, k=k)) for k in (1, 3, 9, 10, 11, 14, 30, 30, 60)] + [None, "", "..", "a a a a a a a a a a a a"]
    texts = [t for _, t, *_ in ROWS] + ["", "A a, a. a a a a a a a a a a a a a"]
    for _ in range(60):
        words = rnd.choices(vocabulary, k=rnd.randrange(0, 60))
        for item in rnd.sample(items, 3):
            part = (item or "").split()
            at, size = rnd.randrange(len(words) + 1), rnd.randrange(1, 13)
            start = rnd.randrange(max(1, len(part) - size + 1))
            words[at:at] = part[start : start + size]
        texts.append(", ".join(words).upper())
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    want = {}
    for i, text in enumerate(texts):
        words, spots, ids = cut(text), set(), set()
        for j, item in enumerate(items):
            gold = cut(item)
            size = min(10, len(gold))
            windows = {tuple(gold[k : k + size]) for k in range(len(gold) - size + 1)} if gold else set()
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    spots.update(range(k, k + size))
                    ids.add(j)
        want[i] = (len(words), len(spots), len(ids), bool(spots))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)] + [(None, "x y", 1), (3, items[3], 1)], "item_id int, text string, pos int")
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, bench).collect()}
    assert found == want
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert kept == {i for i, w in want.items() if not w[3]}
    assert decontaminate.drop_contaminated(odd, bench.limit(0)).count() == len(ROWS)


def test_rows_without_an_id_are_decontaminated_by_their_text(spark):
    item = " ".join(f"g{i}" for i in range(12))
    texts = [(None, f"a {item} b"), (None, "a b c"), (None, None), (1, item), (2, "a b"), (None, f"a {item} b")]
    docs = spark.createDataFrame([(*r, "x") for r in texts], "doc_id bigint, text string, name string")
    bench = spark.createDataFrame([(7, item)], "item_id int, text string")
    found = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, bench).collect()}
    assert found == {(None, 14, 12, 1, True), (None, 3, 0, 0, False), (None, 0, 0, 0, False), (1, 12, 12, 1, True), (2, 2, 0, 0, False)}
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.select("doc_id", "text").collect())) == [
        "Row(doc_id=2, text='a b')", "Row(doc_id=None, text='a b c')", "Row(doc_id=None, text=None)"
    ]


def brute_runs(rows):
    """What is left of each text, and runs and lines that go: every place against every one before it."""
    lines = [(i, n) for i, (_, text) in enumerate(rows) for n in range(len((text or "").split("\n")))]
    cut = [(text or "").split("\n") for _, text in rows]
    gone = [set() for _ in rows]
    for at, (i, n) in enumerate(lines):
        for j, m in lines[:at]:
            same = 0
            while n + same < len(cut[i]) and m + same < len(cut[j]) and cut[i][n + same] == cut[j][m + same]:
                same += 1
            solid = [k for k in range(n, n + same) if cut[i][k].strip()]
            if len(solid) > 1:
                gone[i] |= set(range(solid[0], solid[-1] + 1))
    return sorted(
        (doc_id, sum(k - 1 not in gone[i] for k in gone[i]), len(gone[i]),
         text and "\n".join(x for k, x in enumerate(cut[i]) if k not in gone[i]))
        for i, (doc_id, text) in enumerate(rows)
    )


def test_line_dedup_against_brute_force(spark, odd):
    """Passages of two lines and more, whole and in parts, in foreign lines; blank lines; repeats inside a text."""
    rnd = random.Random(4)
    passages = [[f"passage {p} line {i}" if i % 4 != 2 else "" for i in range(k)] for p, k in enumerate((2, 2, 4, 5, 10))]
    rows = [(1, None), (2, ""), (3, "x\n\n"), (4, "x\n\n"), (5, "r\nr\nr\nr"), (6, "\n\ny\n")]
    for i in range(10, 40):
        lines = [f"line {rnd.randrange(60)}" for _ in range(rnd.randrange(0, 10))]
        for p in rnd.sample(passages, 2):
            at, start = rnd.randrange(len(lines) + 1), rnd.randrange(len(p) - 1)
            lines[at:at] = p[start : start + rnd.randrange(2, 11)]
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(wide([(*r, "en", "a") for r in rows]), SCHEMA)
    want = brute_runs(rows)
    assert sorted(map(tuple, line_dedup.line_dedup_report(df).collect())) == want
    assert sum(w[1] for w in want) > 30 and sum(w[2] for w in want) > 100
    found = line_dedup.dedup_lines(df)
    assert found.columns == df.columns
    got = found.collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(w[0], w[3]) for w in want]
    assert all(r.text is None or r.n_chars == len(r.text) for r in got)
    again = line_dedup.dedup_lines(odd)
    assert again.columns == odd.columns and again.count() == len(ROWS)


def test_lines_count_as_seen_by_their_bytes(spark, monkeypatch):
    """Also where the rolling hash of all lines is the same."""
    from pyspark.sql import functions as F

    class Same:
        def __getattr__(self, name):
            return (lambda *columns: F.lit(7).cast("long")) if name == "xxhash64" else getattr(F, name)

    rows = [(1, "a\nb\nc"), (2, "d\ne\nf"), (3, "a\nb\nx"), (4, "b\nc\nd\ne")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(line_dedup, "F", Same())
    assert sorted(map(tuple, line_dedup.line_dedup_report(df).collect())) == brute_runs(rows)


@pytest.mark.parametrize("few", [0, 3])
def test_many_repeated_lines_move_no_texts(spark, monkeypatch, few):
    """Beyond the number of keys or rows that are sent to the texts: same result, and windows do not carry their text's lines."""
    passage = [f"shared line {i} " + "x" * 200 for i in range(6)]
    rows = [(i, "\n".join([f"own {i} {k} " + "y" * 200 for k in range(40)] + passage[i % 4 :])) for i in range(30)]
    rows += [(30, None), (31, ""), (32, "a\nb\na\nb")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(common, "FEW", few)
    met = []
    monkeypatch.setattr(line_dedup, "meet", lambda left, right, on: met.append(left) or common.meet(left, right, on))
    want = brute_runs(rows)
    assert sorted(map(tuple, line_dedup.line_dedup_report(df).collect())) == want
    assert sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect()) == [(w[0], w[3]) for w in want]
    assert "lines" not in met[0].columns and not any("array" in kind for _, kind in met[0].dtypes)
    # A row of a few numbers and a digest, whatever the length of the texts.
    sizes = [sum(len(v) if isinstance(v, (bytes, bytearray, str)) else 8 for v in r) for r in met[0].collect()]
    assert len(sizes) > 1200 and max(sizes) < 100


def test_shingles_met_by_chance_break_up_a_cluster(spark, monkeypatch):
    """Sets in a ring, each with passages of the next one and the one before and some words of its own, do not stay together."""
    rnd = random.Random(9)
    passages = [[f"w{i}x{k}" for k in range(24)] for i in range(60)]
    texts = [" ".join(passages[i] + [f"own{i}x{k}" for k in range(12)] + passages[(i + 1) % 60]) for i in range(60)]
    # Real near copies among them, by one word at the end.
    texts += [texts[i] + " more" for i in range(0, 60, 12)]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(jaccard_join, "WIDER", 0.0)
    monkeypatch.setattr(jaccard_join, "TILE", 8)
    met = []
    links = jaccard_join._cluster_links
    monkeypatch.setattr(jaccard_join, "_cluster_links", lambda members, percent: met.append(members.count()) or links(members, percent))
    _, near = brute_links(texts)
    got = {r.doc_id: r.n_links for r in jaccard_join.near_duplicates(df).collect()}
    assert got == {i: len(near[i]) for i in range(len(texts))} and sum(got.values()) == 10
    assert met == [10]
