"""Search, chat windows and Merkle proofs: odd rows, small units, plain-Python versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from odd_tables import ROWS, SF
from trigramma.llm import chat_format, lexical_search, merkle
from trigramma.llm.common import numbered
from trigramma.llm.queries import TOKENIZER

# --- search -------------------------------------------------------------------


def terms(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_search(rows, items, k=10):
    docs = [(i, Counter(terms(t))) for i, t in rows]
    n, total = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, count in docs:
            score = 0
            for t in wanted & set(count):
                m = 10 + (90 * sum(count.values()) * n) // total
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += weight * ((10**9 * count[t]) // (1000 * count[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, rows, items, **bounds):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    found = lexical_search.search(docs, asked, **bounds)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("bounds", [{}, {"block_chars": 2_000}, {"item_terms": 15, "k": 3}])
def test_search_against_brute_force(spark, bounds):
    dice = random.Random(5)
    # Some words are in nearly all documents, most are rare.
    word = lambda: f"w{int(400 * dice.random() ** 4)}"
    rows = [(i, " ".join(word() for _ in range(dice.randint(1, 60)))) for i in range(900)]
    rows += [(i + 900, rows[i][1]) for i in range(0, 900, 7)] + [(5, "w1 w2"), (None, "w1 w2 w399"), (None, None), (2000, "")]
    items = [(j, " ".join(word() for _ in range(dice.randint(1, 12)))) for j in range(12)]
    items += [(3, "w0 w7"), (None, "w5 W6,w5"), (50, None), (51, "?!"), (52, "nowhere")]
    assert searched(spark, rows, items, **bounds) == brute_search(rows, items, bounds.get("k", 10))


def test_search_odd_rows(spark, odd, none):
    items = [(1, "the Quick brown fox"), (2, "a B"), (3, None), (4, "two"), (5, "le chien"), (6, "the17 quick34")]
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, doc_id string")
    found = sorted(map(tuple, lexical_search.search(odd, asked).collect()), key=repr)
    assert found == brute_search([r[:2] for r in ROWS], items)
    assert lexical_search.search(none, asked).count() == lexical_search.search(odd, asked.limit(0)).count() == 0


def test_search_skips_ranges_that_cannot_win(monkeypatch):
    """Once ten good documents are known, only ranges with a chance are looked into."""
    offered = []
    monkeypatch.setattr(lexical_search.Best, "offer", lambda self, s, p, own=lexical_search.Best.offer: (offered.append(p), own(self, s, p)))
    import numpy as np

    weights = np.array([5000, 10], np.int64)
    found = [np.array([0] * 3 if i < 20 else [1], np.int64) for i in range(64 * 50)]
    block = lexical_search.Block(found, [3 if i < 20 else 1 for i in range(len(found))], weights, len(found), 4000)
    best = lexical_search.Best(10)
    best.ids = list(range(len(found)))
    block.search(np.array([0, 1]), best)
    best.settle()
    assert [r[2] for r in best.rows] == list(range(10))
    assert max(offered) < 64


# --- chat ---------------------------------------------------------------------

TALK = "conv_id bigint, turn bigint, role string, text string, window int, `long` string, stretch string"
STRINGS = (*chat_format.CONTROL, chat_format.START, chat_format.END)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*STRINGS, "\\", "<", "[", "|", "\n", "<\\", "<\\|im_end|>"]), st.text(max_size=4))).map("".join))
def test_escapes_are_reversible_and_leave_no_control_string(text):
    assert chat_format.unescape(chat_format.escape(text)) == text
    assert not any(c in chat_format.escape(text) for c in STRINGS)
    assert chat_format.unhead(chat_format.head(text)) == text and "\n" not in chat_format.head(text)
    assert chat_format.parsed(chat_format.formatted(text, text) * 2) == [(text, text)] * 2


def test_tokens_are_those_of_the_vocabulary():
    text = "Hello there, how are you? 1234 " * 3
    assert chat_format.count_tokens(chat_format.formatted("user", text), TOKENIZER) == 3 + len(
        chat_format._encoding(TOKENIZER).encode_ordinary("user\n" + text)
    )
    assert chat_format.count_tokens(chat_format.formatted("user", "a" * 300_000), TOKENIZER) > 1000


def brute_windows(said, budget, history, turns):
    """Windows of one conversation, by the definition; ``said`` are roles and texts in order."""
    made = [chat_format.formatted(*s) for s in said]
    size = [chat_format.count_tokens(m, TOKENIZER) for m in made]
    lead = 1 if said and said[0][0] == "system" else 0
    spans, start = [], 0
    for i in range(len(said)):
        room = budget - (size[0] if spans and lead else 0)
        if i > start and sum(size[start : i + 1]) > room:
            spans.append((start, i))
            start = i
    spans.append((start, len(said)))
    out = []
    for a, b in spans:
        room = budget - (size[0] if a and lead else 0) - sum(size[a:b])
        first = a
        while first > lead and a - first < turns and sum(size[first - 1 : a]) <= min(history, room):
            first -= 1
        old = ([0] if lead and a else []) + list(range(first, a))
        out.append((len(old), "".join(made[i] for i in [*old, *range(a, b)]), [said[i] for i in range(a, b)]))
    return out


def conversation(dice, turns, system):
    roles = (["system"] if system else []) + [("user", "assistant", "tool")[i % 3] for i in range(turns)]
    words = lambda: " ".join(dice.choice(["red", "fox", "</s>", "[INST]", "über", "\\<s>", "\n"]) for _ in range(dice.randint(0, 30)))
    return [(r, words()) for r in roles]


@pytest.mark.parametrize("stretch", [10_000, 16])
def test_windows_against_brute_force(spark, stretch):
    dice = random.Random(3)
    talks = {i: conversation(dice, dice.randint(1, 60), i % 2) for i in range(12)}
    rows = [(i, t, r, x, 1, "y", "z") for i, said in talks.items() for t, (r, x) in enumerate(said)]
    frame = spark.createDataFrame(rows, TALK).repartition(5)
    found = chat_format.format_chat(frame, TOKENIZER, 120, 40, 3, stretch).collect()
    for i, said in talks.items():
        got = sorted((r for r in found if r.conv_id == i), key=lambda r: (r.stretch, r.window))
        assert all(r.n_tokens <= 120 or r.n_turns == 1 for r in got)
        new = [chat_format.parsed(r.text)[r.n_repeated :] for r in got]
        assert [turn for some in new for turn in some] == said
        learned = [chat_format.unescape(r.text[s.start : s.end]) for r in got for s in r.loss]
        assert learned == [x for r, x in said if r == "assistant"]
        # Every later window opens with the system turn and repeats what comes right before.
        for r, before in zip(got[1:], got):
            turns = chat_format.parsed(r.text)
            old = turns[: r.n_repeated]
            if said[0][0] == "system":
                assert old[0] == said[0]
                old = old[1:]
            done = sum(len(n) for n in new[: got.index(r)])
            assert old == said[done - len(old) : done] and len(old) <= 3
        if stretch >= len(said):
            assert [(r.n_repeated, r.text) for r in got] == [w[:2] for w in brute_windows(said, 120, 40, 3)]
            assert not got[0].long
        else:
            assert got[-1].long and {r.stretch for r in got} == set(range(-(-len(said) // stretch)))


def digests(said):
    turns = "".join(f"{r or ''}\n{x or ''}\n" for r, x in said)
    learned = "".join(x or "" for r, x in said if r == "assistant")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(said), sha(turns), len(learned), sha(learned)


@pytest.mark.parametrize("stretch", [10_000, 7])
def test_read_back_of_all_conversations(spark, stretch):
    talk = spark.read.parquet(f"{SF}/conversations.parquet")
    odd = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (-8, 0, None, None),
           (-9, None, "assistant", ""), (-9, 3, "user", "x" * 200_000), (-9, 4, "a\\n\nb", "y"), (None, 1, "user", "lost"), (None, 2, "assistant", "<|im_end|>")]
    rows = talk.unionByName(spark.createDataFrame(odd, talk.schema))
    windows = chat_format.format_chat(rows, TOKENIZER, 300, 60, 2, stretch)
    found = {r.conv_id: tuple(r)[1:5] for r in chat_format.read_back(windows).collect()}
    said = defaultdict(list)
    for r in sorted(rows.collect(), key=lambda r: (str(r.conv_id), r.turn is not None, r.turn or 0)):
        said[r.conv_id].append((r.role, r.text))
    assert found == {i: digests(s) for i, s in said.items()}
    sizes = windows.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n"))
    assert {r.conv_id: r.n for r in sizes.collect()} == {r.conv_id: r.formatted_chars for r in chat_format.read_back(windows).collect()}


def test_repeated_turns_and_no_rows(spark):
    rows = [(1, 0, "user", "again", 1, "y", "z")] * 30 + [(1, 1, "assistant", "well", 1, "y", "z")] * 3
    frame = spark.createDataFrame(rows, TALK)
    for stretch in (10_000, 5):
        windows = chat_format.format_chat(frame, TOKENIZER, 50, 20, 2, stretch)
        assert [r.n_turns for r in chat_format.read_back(windows).collect()] == [33]
    assert chat_format.read_back(chat_format.format_chat(frame.limit(0), TOKENIZER)).count() == 0


# --- Merkle -------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(nodes):
    """Root of ordered nodes, and the digests left and right of each on its way up."""
    sides, where, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for leaf, at in enumerate(where):
            run = at // 3 * 3
            sides[leaf].append(("".join(level[run:at]), "".join(level[at + 1 : run + 3])))
        where = [at // 3 for at in where]
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], sides


def brute_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(field, r)))
    sources = defaultdict(list)
    for r in rows:
        sources[r[1]].append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = brute_tree([leaf(r) for r in sources[s]])
    root, upper = brute_tree([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, upper):
        for r, sides in zip(sources[s], trees[s][1]):
            path = sides + above
            tampered = r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf((*r[:4], r[4].replace("\n", "")) if tampered else r)
            for left, right in path:
                node = sha(left + node + right)
            out.append((r[0], leaf(r), trees[s][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def proved(docs):
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = merkle.manifest(docs, F.replace(F.col("text"), F.lit("\n"), F.lit("")), even)
    return sorted((tuple(r)[:7] for r in found.collect()), key=repr)


MERKLE = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def test_manifest_against_brute_force_over_several_blocks(spark):
    """One source holds most rows and needs two groups of levels; others are a run, or one leaf."""
    sizes = {"big": merkle.BLOCK * 2 + 5, "Zeta": 1, "übrig": 3, "": 4, None: 10, "nine": 9, "ten": 28, "two": 2, "27": 27}
    sizes |= {"less": merkle.BLOCK - 1, "whole": merkle.BLOCK, "more": merkle.BLOCK + 1}
    rows, at = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            at += 1
            rows.append((at * 7919 % 100_003, s, None if at % 3 else "en", at, f"text\n{at}" if at % 5 else "flat"))
    assert proved(spark.createDataFrame(rows, MERKLE).repartition(7)) == brute_manifest(rows)


@pytest.mark.parametrize("n", [1, 4])
def test_manifest_of_one_source(spark, n):
    rows = [(i, "a", "en", 1, "x\ny") for i in range(n)]
    assert proved(spark.createDataFrame(rows, MERKLE)) == brute_manifest(rows)


def test_manifest_of_odd_rows(spark, odd, none):
    assert proved(odd) == brute_manifest([(r[0], r[3], r[2], None if r[1] is None else len(r[1]), r[1]) for r in ROWS])
    assert proved(none) == []


def test_numbers_within_groups_of_any_size(spark, conf):
    conf(shuffle__partitions="6", adaptive__coalescePartitions__enabled="false")
    rows = spark.range(0, 5000, 1, 9).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 40)) AS g", "id * 31 % 5003 AS o")
    seen = defaultdict(list)
    for r in numbered(rows, "g", ["o"]).collect():
        seen[r.g].append((r.o, r.pos))
    for found in seen.values():
        assert [p for _, p in sorted(found)] == list(range(len(found)))
