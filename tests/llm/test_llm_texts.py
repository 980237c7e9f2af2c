"""Scores and extraction of texts: odd rows, brute force, held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from odd_tables import ROWS
from trigramma.llm import html_text, language_id, quality, secret_scan, toxicity, url_filter
from trigramma.llm.queries import URL_RULES

DOCS = "/root/testdata/sf0.01/documents.parquet"
LABELS = "/root/testdata/sf0.01/labels.parquet"


# --- quality ------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    words = text.encode().split()
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if line.strip(" \t\n\r\x0b\x0c"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_counts_of_odd_rows(spark, odd, none):
    found = quality.judge_quality(odd).collect()
    assert len(found) == len(ROWS)
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert got == sorted(brute_counts(r[1]) for r in ROWS)
    assert all(r.perplexity is None for r in found if r.word_chars == 0 and r.doc_id in (4, 5, None))
    assert quality.judge_quality(none).count() == 0


def test_counts_of_the_corpus(spark):
    docs = spark.read.parquet(DOCS)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.judge_quality(docs).collect():
        want = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def brute_model(grams, size=quality.ORDER, symbols=quality.SYMBOLS):
    """Modified Kneser-Ney straight from its definition."""
    counts = {size: grams}
    for n in range(size - 1, 0, -1):
        follow = Counter()
        for g in counts[n + 1]:
            follow[g[1:]] += 1
        counts[n] = follow
    discounts, contexts = {}, {}
    for n, found in counts.items():
        of = Counter(found.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] + of[2] else None
        discounts[n] = [0.0] + [
            max(0.0, k - (k + 1) * y * of[k + 1] / of[k]) if y is not None and of[k] else k / 2 for k in (1, 2, 3)
        ]
        contexts[n] = defaultdict(list)
        for g, c in found.items():
            contexts[n][g[:-1]].append(c)

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / symbols
        below = p(g[1:])
        seen = contexts[n].get(g[:-1])
        if not seen:
            return below
        d = discounts[n]
        taken = sum(d[min(c, 3)] for c in seen)
        c = counts[n].get(g, 0)
        return ((c - d[min(c, 3)] if c else 0) + taken * below) / sum(seen)

    return p


def test_model_against_its_definition(spark):
    texts = ["the cat sat on the mat. the rat!", "a cat, a hat; a bat", "zzz", "", "the the the 12 12"]
    table = quality.symbol_table()
    symbols = [[0] * 3 + [int(table[ord(c)]) for c in t] for t in texts]
    grams = Counter(tuple(s[i : i + 4]) for s in symbols for i in range(len(s) - 3))
    p = brute_model(grams)
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts + [None])], "doc_id int, text string, lang string")
    model = quality.kneser_ney(quality.count_grams(df))
    asked = texts + ["unseen words, xylophone 7 é"]
    held = quality.load_models(model, ["en"])["en"]
    for text in asked:
        s = [0] * 3 + [int(table[ord(c)]) for c in text]
        want = [math.log(p(tuple(s[i : i + 4]))) for i in range(len(s) - 3)]
        assert np.allclose(held.logs(quality.packed([text], table)[0]), want, rtol=1e-5)
    # Probabilities after a context add up to one.
    for context in [(20, 8, 5), (0, 0, 0), (39, 39, 39)]:
        assert sum(p((*context, z)) for z in range(quality.SYMBOLS)) == pytest.approx(1)


def test_languages_that_take_turns_score_the_same(spark, monkeypatch):
    docs = spark.read.parquet(DOCS).limit(200)
    whole = {r.doc_id: r.perplexity for r in quality.judge_quality(docs).collect()}
    monkeypatch.setattr(quality, "MODEL_BYTES", 1)
    assert whole == {r.doc_id: r.perplexity for r in quality.judge_quality(docs).collect()}


def test_characters_are_not_folded(spark):
    """N-grams of any script, case and plane, against plain Python; letters ten code points apart differ."""
    texts = ["北京 天气", "Abc abc ABC", "абвг клмн", "0123 4567 \U0001f600\U0001f60a", "\u00a0 \t\n", "", None] * 2
    df = spark.createDataFrame([(t, "x" if i % 2 else None) for i, t in enumerate(texts)], "text string, lang string")
    want = Counter()
    for i, t in enumerate(texts):
        points = [0, 0, 0, *map(ord, t or "")]
        want.update(("x" if i % 2 else "", *points[k : k + 4]) for k in range(len(points) - 3))
    got = {
        (r.lang, r.context >> 42, r.context >> 21 & 0x1FFFFF, r.context & 0x1FFFFF, r.last): r.n
        for r in quality.count_grams(df).collect()
    }
    assert got == want
    # The same pattern of letters, told apart by their code points alone.
    letters = ["абвгде" * 20] * 8 + ["клмноп" * 20]
    docs = spark.createDataFrame([(i, t, "ru") for i, t in enumerate(letters)], "doc_id bigint, text string, lang string")
    found = {r.doc_id: r.perplexity for r in quality.judge_quality(docs).collect()}
    assert found[8] > 1.01 * found[0]


@pytest.mark.parametrize("grams", [0, 100, 3_000])
def test_rare_ngrams_beyond_what_tasks_hold_score_the_same(spark, monkeypatch, grams):
    docs = spark.read.parquet(DOCS).limit(60)
    whole = {r.doc_id: (r.perplexity, r.kept) for r in quality.judge_quality(docs).collect()}
    monkeypatch.setattr(quality, "MODEL_BYTES", grams * quality.GRAM_BYTES)
    monkeypatch.setattr(quality, "HELD", 50)
    assert whole == {r.doc_id: (r.perplexity, r.kept) for r in quality.judge_quality(docs).collect()}


def test_good_documents_are_kept(spark):
    labels = spark.read.parquet(LABELS).where("quality = 1")
    found = quality.judge_quality(spark.read.parquet(DOCS)).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept for r in found) >= 0.98 * len(found)


# --- language -----------------------------------------------------------------


def test_forward_backward_against_brute_force():
    rnd = np.random.default_rng(1)
    counts, moves = np.array([33, 0, 70, 1]), rnd.normal(size=(3, 3))
    evidence = rnd.normal(size=(counts.sum(), 3)) * 3
    found = language_id.marginal_sums(evidence, counts, moves, each=True)
    at = 0
    for n in counts:
        ahead, now = [], np.ones(3) / 3
        for t in range(n):
            now = (now @ np.exp(moves)) * np.exp(evidence[at + t])
            now /= now.sum()
            ahead.append(now)
        back = np.ones(3)
        for t in reversed(range(n)):
            both = ahead[t] * back
            assert np.allclose(found[at + t], both / both.sum())
            back = np.exp(moves) @ (np.exp(evidence[at + t]) * back)
            back /= back.sum()
        at += n
    sums = language_id.marginal_sums(evidence, counts, moves)
    ends = np.cumsum(counts)
    assert np.allclose(sums, [found[e - c : e].sum(axis=0) for e, c in zip(ends, counts)])


def test_pictures_are_no_letters(spark):
    texts = ["\U0001F600\U0001F680 \U0001F600", "ab\U0001F600c", "\U00010400\U00020000", "12"]
    words = language_id.cut_words(texts, language_id._tables())
    assert words.counts.tolist() == [0, 2, 1, 0]
    assert len(words.letters) == 4 + 3 + 4


def test_words_are_runs_of_letters():
    tables = language_id._tables()
    words = language_id.cut_words(["Hello, wörld 12 foo", "", "x", "1 2", "Été"], tables)
    assert words.counts.tolist() == [3, 0, 1, 0, 1]
    spelled = ["".join(chr(c - 3) for c in part if c > 2) for part in np.split(words.letters, words.starts[1:])]
    assert spelled == ["hello", "wörld", "foo", "x", "été"]


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(DOCS)
    found = language_id.predict_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    tested = [r for r in found if r.held_out and r.lang]
    assert sum(r.lang_pred == r.lang for r in tested) >= 0.98 * len(tested)


def test_code_switched_words_get_their_language(spark):
    rows = spark.read.parquet(DOCS).where("text is not null").orderBy("doc_id").collect()
    by = defaultdict(list)
    for r in rows:
        by[r.lang].append(r.text[:1500])
    field = language_id.fit([t for v in by.values() for t in v[:40]], [k for k, v in by.items() for _ in v[:40]])
    mixed = " ".join(" ".join(by[lang][60].split()[:20]) for lang in ("en", "fr", "en"))
    words = language_id.cut_words([mixed], language_id._tables())
    near = language_id.marginal_sums(field.evidence(words), words.counts, field.moves, each=True).argmax(axis=1)
    names = [field.langs[i] for i in near]
    assert names[3:17].count("en") >= 12 and names[23:37].count("fr") >= 12 and names[43:57].count("en") >= 12


def test_language_of_odd_rows(spark, odd, none):
    found = {(r.doc_id, r.lang_pred, r.score == 0) for r in language_id.predict_language(odd).collect()}
    assert {x for x in found if x[1] == "und"} == {(4, "und", True), (5, "und", True), (6, "und", True), (10, "und", True), (None, "und", True)}
    assert language_id.predict_language(none).count() == 0
    assert {r.lang_pred for r in language_id.predict_language(odd.withColumn("lang", odd.lang.substr(9, 1)).where("lang <> ''")).collect()} <= {"und"}
    kept = language_id.keep_determined(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 7, 8, 9}
    assert language_id.keep_determined(none).count() == 0


# --- toxicity -----------------------------------------------------------------


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def test_automaton_against_edit_distance():
    rnd = random.Random(3)
    spelled = {"moron": False, "idiot": False, "disgusting": False, "scum": False, "lowei": True}
    entries = {w: toxicity.Entry(stem, 1.0, 0 if stem else toxicity.errors_allowed(w)) for w, stem in spelled.items()}
    automaton = toxicity.Automaton(entries)
    for _ in range(5000):
        word = list(rnd.choice(list(spelled)))
        for _ in range(rnd.randint(0, 3)):
            i, kind = rnd.randint(0, len(word)), rnd.random()
            if kind < 0.33:
                word.insert(i, rnd.choice("abmorniz"))
            elif i < len(word):
                word[i : i + 1] = [] if kind < 0.66 else [rnd.choice("abmorniz")]
        word = "".join(word)
        errors = [distance(word, w) for w, stem in spelled.items() if not stem and distance(word, w) <= entries[w].errors]
        errors += [0 for w, stem in spelled.items() if stem and word.startswith(w)]
        found = automaton.match(word)
        assert (found and found[1]) == min(errors, default=None)


def test_quotation_weighs_less_than_abuse():
    entries = {w: toxicity.Entry(False, 6.0, toxicity.errors_allowed(w)) for w in ("moron", "idiot")}
    matcher = toxicity.Matcher(toxicity.Model(entries, frozenset(["oron"]), toxicity.PRIOR))
    quoted = matcher.score('she wrote that he said "you are a moron" to them last week')
    assert quoted < matcher.score("go away you moron") < matcher.score("you moron you idiot")
    assert matcher.score("you m0ron") == matcher.score("you moron") > matcher.score("you morron") > matcher.score("oron")
    assert matcher.score(None) == matcher.score("") == matcher.score("plain words") < 0.5


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    toxic, clean = [r for r in found if r.toxic == 1], [r for r in found if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, toxic int")
    found = toxicity.score_toxicity(odd, labels).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert toxicity.score_toxicity(none, labels).count() == 0
    assert toxicity.score_toxicity(odd, labels.limit(0)).where("predicted = 0").count() == len(ROWS)


# --- pages --------------------------------------------------------------------

PAGES = [
    (None, ""),
    ("", ""),
    ("plain &lt;text&gt; only", "plain <text> only"),
    ("<p>one &amp; two<p>three\n\t four</p>", "one & two\nthree four"),
    (
        '<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href="/">Home</a></nav>'
        '<div id="cookie-banner">We use cookies, as everyone does, to know you better.</div>'
        '<div class="content"><h2>Title</h2><p>The first paragraph, with commas, is long enough to be one.</p>'
        '<div class="related"><p>Other things, that you may like, are here, and here, and here.</p></div>'
        "<p>Short.</p><ul><li>one<li>two</ul><form><input name=q><p>Ask, and write, and wait for it to come.</p></form></div>"
        '<div class="comments"><p>I am a reader, and I have thoughts, long ones, on this.</p></div>'
        "<aside>Sidebar</aside><script>var x = '<p>no</p>';</script><footer>&copy; me</footer></body></html>",
        "Title\nThe first paragraph, with commas, is long enough to be one.\nShort.\none\ntwo",
    ),
    (
        "<body><div><a href=1>menu, one, two</a> <a href=2>menu, three, four</a></div><div>"
        "<section><p>Part one of the story, as it was told to me.</p></section>"
        "<section><p>Part two of the story, as I remember it now.</p></section></div>",
        "Part one of the story, as it was told to me.\nPart two of the story, as I remember it now.",
    ),
    ("<article><p>cut off in the middle of a sentence, and then <b>bold <i", "cut off in the middle of a sentence, and then bold"),
]


def test_pages(spark):
    rows = [(i, "u", html, 1) for i, (html, _) in enumerate(PAGES)] + [(0, None, None, 2)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text int")
    found = sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract_text(df).collect())
    assert found == sorted([(i, want, len(want)) for i, (_, want) in enumerate(PAGES)] + [(0, "", 0)])
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_deep_and_broken_pages_end():
    assert html_text.main_text("<div>" * 3000 + "x") == "x"
    assert html_text.main_text("<" * 5000) == "<" * 5000
    assert html_text.main_text("</p></div>" * 1000) == ""


def test_pages_of_the_table(spark):
    import html as entities

    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1].replace("<br>", " ")
        parts = (" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        assert html_text.main_text(r.html) == "\n".join(p for p in parts if p)


PROSE = "A paragraph of the story, long enough, with commas, to count as one that somebody wrote."


@pytest.mark.parametrize(
    "page, want",
    [
        # Title and a short section stay with the long one.
        (f"<article><h1>Title</h1><section>{f'<p>{PROSE}</p>' * 10}</section><section><p>{PROSE}</p></section></article>",
         "\n".join(["Title"] + [PROSE] * 11)),
        (f"<div class='content has-sidebar'><article><p>{PROSE}</p></article></div><div>Copyright, all rights reserved, 2024.</div>", PROSE),
        # Names that only contain a word are names of something else.
        (f"<article><p>{PROSE}</p><p class='share-price'>12 points</p><div class='notice-of-meeting'>On Monday.</div></article>",
         f"{PROSE}\n12 points\nOn Monday."),
        # Without elements made for it, the article is where the points are.
        (f"<div>Buy this.</div><div class=post><h2>Head</h2><p>{PROSE}</p><p>{PROSE}</p><ul><li>one</ul></div><div>(c) me</div>",
         f"Head\n{PROSE}\n{PROSE}\none"),
        (f"<body><h1>Head</h1><section><p>{PROSE}</p></section><section><p>Short.</p></section><div class='comment-list'><p>{PROSE}</p></div>",
         f"Head\n{PROSE}\nShort."),
        # A lowered part that holds the article stays; readers' comments that are longer than it do not.
        (f"<div class=widget><p>{PROSE}</p><p>{PROSE}</p></div><footer>{PROSE}</footer>", f"{PROSE}\n{PROSE}"),
        (f"<article><p>{PROSE}</p><div class=comments>{f'<p>{PROSE}</p>' * 5}</div></article>", PROSE),
    ],
)
def test_scoring_finds_the_whole_article(page, want):
    assert html_text.main_text(page) == want


def test_scoring_decides_on_the_table(monkeypatch):
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist()
    found = [html_text.main_text(p) for p in pages]
    monkeypatch.setattr(html_text, "LEFT_OUT_WORDS", frozenset())
    assert sum(html_text.main_text(p) != f for p, f in zip(pages, found)) <= 0.02 * len(pages)
    monkeypatch.undo()
    monkeypatch.setattr(html_text, "main_nodes", lambda root: [root])
    assert sum(html_text.main_text(p) != f for p, f in zip(pages, found)) > 0.9 * len(pages)


# --- urls ---------------------------------------------------------------------


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(30_000).selectExpr("concat('k', id) AS key", "id % 7 = 0 AS listed")
    one, many = url_filter.build_cascade(keys, bits_per_key=4, hashes=2), url_filter.build_cascade(keys, max_bytes=8)
    # What does not fit is split, and still looked up in cascades, not by a join.
    assert len(one.parts) == 1 and len(many.parts) > 1 and all(part.levels for part in many.parts)
    with_null = keys.select("key").unionByName(keys.sparkSession.sql("SELECT CAST(NULL AS string) AS key"))
    assert many.mark(with_null, "key", "found").count() == 30_001
    assert "Join" not in many.mark(keys, "key", "found")._jdf.queryExecution().optimizedPlan().toString()
    for cascade in (one, many):
        marked = cascade.mark(keys, "key", "found")
        assert marked.where("found <> listed").count() == 0 and marked.count() == 30_000
    assert len(one.parts[0].levels) > 2
    empty = url_filter.build_cascade(keys.where("not listed"))
    assert empty.mark(keys, "key", "found").where("found").count() == 0
    every = url_filter.build_cascade(keys.where("listed"))
    assert every.mark(keys.where("listed"), "key", "found").where("not found").count() == 0


def test_odd_urls(spark):
    urls = [None, "", "no scheme/de/", "http://A.COM/de/x?y", "x://a.com?/de/", "x://a.com#", "https://b.example.org/es/1", "x://example.org/en/15", "x://notexample.org/es/", "x://com/fr/", "x:///p", "a://b://c.com/de/", "x://a.com/en/"]
    df = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)] + [(3, urls[3], "k")], "page_id int, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, URL_RULES).collect()}
    assert found[0] == found[1] == found[2] == ("", "", None, "allow")
    assert found[3] == ("a.com", "/de/x", "com/de/", "block")
    assert found[4] == ("a.com", "", None, "block") and found[5] == ("a.com", "", None, "block")
    assert found[6] == ("b.example.org", "/es/1", "example.org/es/", "block")
    assert found[7] == ("example.org", "/en/15", "example.org/en/1", "block")
    assert found[8] == ("notexample.org", "/es/", "org/", "allow")
    assert found[9] == ("com", "/fr/", "com/fr/", "allow") and found[10][:2] == ("", "/p")
    assert found[11][:2] == ("b:", "//c.com/de/") and found[12] == ("a.com", "/en/", None, "block")
    assert url_filter.judge_urls(df.limit(0), URL_RULES).count() == 0


# --- secrets ------------------------------------------------------------------

ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def brute_base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    written = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return [sum(k == j for _, k, _ in spans) for j in range(3)], written


def test_base_spans(spark, odd, none):
    rnd = random.Random(4)
    pieces = [
        "password: hunter22", "passwd='abc'", "TOKEN = ", "api_key=", "ApiKey\"  :  \"", "secret", "token: token = abcdefgh",
        "AKIA" + "A1" * 8, "AKIAAKIA" + "Z" * 14, "AKIASHORT", "0123456789abcdef" * 2, "deadbeef" * 3, "deadbeef", "é𝔘ñ", " ", "\n", "x",
        "ſecret=abcdefgh", "toKen=abcdefgh", "=", "f" * 23, "f" * 24,
    ]
    texts = ["".join(rnd.choices(pieces, k=rnd.randrange(0, 15))) for _ in range(400)] + [r[1] for r in ROWS]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, least string")
    for r in secret_scan.find_secrets(df).collect():
        counts, written = brute_base(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == [s for s in written.split(",") if s]
    assert secret_scan.find_secrets(odd).count() == len(ROWS)
    assert secret_scan.find_secrets(none).count() == 0


def brute_score(token):
    """The battery in plain Python."""
    bare = token.translate(str.maketrans({"-": "+", "_": "/", "=": None}))
    if re.fullmatch("[a-z]+|[A-Z][a-z]+|[A-Z]+", bare):
        bare = bare.lower()
    low, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    up = low.upper()
    options = [digits, low, digits + low[:6], digits + up[:6], up + "234567", digits + low, digits + up, up + low + digits + "+/"]
    letters = next(o for o in options if set(bare) <= set(o))
    n, m = len(bare), len(letters)
    free = m - 1
    squares = sum(c * c for c in Counter(bare).values())
    chi = (((m / n * squares - n) / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    sides = [letters.index(c) >= m // 2 for c in bare]
    high = sum(sides)
    both = 2 * high * (n - high)
    spread = both * (both - n) / (n * n * (n - 1))
    found = 1 + sum(a != b for a, b in zip(sides, sides[1:]))
    runs = (found - both / n - 1) / math.sqrt(spread) if spread > 0 else math.sqrt(n)
    at = np.array([letters.index(c) for c in bare], float)
    r = np.corrcoef(at[:-1], at[1:])[0, 1] if at[:-1].std() and at[1:].std() else 1.0
    total = max(chi, 0) ** 2 + runs**2 + r * r * (n - 1)
    z = ((total / 3) ** (1 / 3) - (1 - 2 / 27)) / (2 / 27) ** 0.5
    return 1 / (1 + math.exp(min(1.5976 * z + 0.07056 * z**3, 600)))


def test_battery_against_plain_python(spark):
    rnd = random.Random(6)
    alphabets = ["0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ab", "a1"]
    tokens = ["".join(rnd.choices(rnd.choice(alphabets), k=rnd.randrange(20, 120))) for _ in range(150)] + ["a" * 30, "0" * 20 + "1" * 20]
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    for r in df.select("token", secret_scan.randomness(df.token).alias("score")).collect():
        want = brute_score(r.token)
        assert r.score == pytest.approx(want, rel=1e-9)


def brute_ordinary(token):
    pieces = re.split("[/+_=-]+", re.sub("(?<=[a-z]{2})(?=[A-Z][a-z]{2})", "/", token))
    return all(re.fullmatch("[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}|", piece) for piece in pieces)


def brute_random(texts):
    """Random spans of all texts in plain Python: the step-up over sorted bins."""
    tested = []
    for i, text in enumerate(texts):
        for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text or ""):
            if not brute_ordinary(m[0]):
                group = sum(len(m[0]) >= end for end in (32, 48, 96))
                tested.append((i, m.start(), m.end(), group, min(40, math.floor(-4 * math.log10(brute_score(m[0]))))))
    first = {}
    for group in {t[3] for t in tested}:
        bins = [t[4] for t in tested if t[3] == group]
        held = [b for b in range(12) if 10 ** (-b / 4) <= 0.05 * sum(x >= b for x in bins) / len(bins)]
        first[group] = min(held, default=12)
    spans = {}
    for i, start, end, group, found in tested:
        if found < first[group]:
            spans.setdefault(i, []).append((start, 3, end))
    return spans


BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PLAIN = [
    "/usr/local/share/applications/system", "process_user_request_data_from_queue", "-" * 40, "=" * 25,
    "getUserAccountBalanceFromCache", "2024-01-31/daily-report/final", "AbstractSingletonProxyFactoryBean", "=-" * 15,
    "0" * 30, "ab" * 20 + "1", "x1" * 30,
]


def random_spans(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    found = secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    return {r.doc_id: [s for s in r.spans.split(",") if s.startswith("random")] for r in found}


def test_random_tokens_are_found_in_small_and_large_tables(spark):
    rnd = random.Random(8)
    secret = lambda n=40: "".join(rnd.choices(BASE64, k=n))
    alone = [f"the key {secret()} end" for _ in range(10)]
    few = random_spans(spark, alone)
    assert sum(map(len, few.values())) >= 9
    # The same texts among many others: what is clearly random stays found.
    many = random_spans(spark, alone + [f"see {rnd.choice(PLAIN)} and {secret(24)}" for _ in range(400)])
    assert sum(few[i] != many[i] for i in range(10)) <= 1
    assert sum(map(len, many.values())) >= 370
    assert len(random_spans(spark, alone[:1])[0]) == 1


def test_words_names_paths_and_rulers_are_not_random(spark):
    syllables = ["tion", "ing", "er", "en", "th", "and", "schaft", "ment", "un", "ver"]
    rnd = random.Random(9)
    texts = [f"{a} {rnd.choice(PLAIN)} {''.join(rnd.choices(syllables, k=9))}" for a in PLAIN for _ in range(4)]
    assert sum(map(len, random_spans(spark, texts).values())) == 0


def test_random_spans_against_plain_python(spark):
    rnd = random.Random(10)
    pieces = PLAIN + ["".join(rnd.choices(a, k=k)) for a in (BASE64, BASE64[:40], "0123456789", BASE64[26:62]) for k in (20, 25, 33, 50, 120)]
    pieces += ["".join(rnd.choices("aabbbbccdefghiJK12", k=24)) for _ in range(30)]
    texts = [" ".join(rnd.choices(pieces, k=3)) for _ in range(200)] + [None, "", "x" * 50_000 + "1", "\n"]
    want = brute_random(texts)
    assert sum(map(len, want.values())) > 50
    found = random_spans(spark, texts)
    for i, text in enumerate(texts):
        base = [tuple(map(int, s.split(":")[1:])) for s in brute_base(text)[1].split(",") if s]
        new = [(a, e) for a, _, e in want.get(i, []) if not any(x < e and a < y for x, y in base)]
        assert found[i] == [f"random:{a}:{e}" for a, e in new]



def likelihood(evidence, counts, gold, moves):
    """Log-likelihood of ``gold``, over all ways to label each text."""
    from itertools import product

    total, at = 0.0, 0
    langs = range(len(moves))
    for n in counts:
        def weight(path):
            start = sum(math.exp(moves[i][path[0]]) for i in langs)
            steps = sum(moves[a][b] for a, b in zip(path, path[1:]))
            return start * math.exp(steps + sum(evidence[at + k][y] for k, y in enumerate(path)))

        if n:
            total += math.log(weight(gold[at : at + n]) / sum(weight(p) for p in product(langs, repeat=n)))
        at += n
    return total


def test_slopes_are_those_of_the_likelihood():
    dice = np.random.default_rng(4)
    counts = np.array([3, 1, 0, 6])
    evidence, moves = dice.normal(size=(10, 3)), dice.normal(size=(3, 3))
    gold = dice.integers(0, 3, 10)
    words, pairs = language_id.slopes(evidence, counts, gold, moves)
    for found, place in ((words, evidence), (pairs, moves)):
        for at in np.ndindex(place.shape):
            kept, values = place[at], []
            for step in (1e-5, -1e-5):
                place[at] = kept + step
                values.append(likelihood(evidence, counts, gold, moves))
            place[at] = kept
            assert found[at] == pytest.approx((values[0] - values[1]) / 2e-5, abs=1e-6)


def test_rows_without_id_are_kept_by_their_own_text(spark):
    by = {"en": "the cat sat on the mat and looked at the dog", "fr": "le chat est sur la table et regarde le chien"}
    rows = [(i, by[k] * 3, k) for i, k in enumerate(["en", "fr"] * 10)]
    rows += [(None, by["en"] * 2, "en"), (None, "12 34 !!", "en"), (None, None, None)]
    kept = language_id.keep_determined(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert [r.text for r in kept.collect() if r.doc_id is None] == [by["en"] * 2]


def test_the_field_is_fitted_in_a_task_not_in_the_driver(spark, monkeypatch):
    def here(*args):
        raise AssertionError("fitted in the driver")

    monkeypatch.setattr(language_id, "fit", here)
    rows = [(i, f"the white house {i}" if i % 2 else f"la maison blanche {i}", "en" if i % 2 else "fr") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    field = language_id.learn(docs)
    assert field.langs == ["en", "fr"] and field.grams.any()
    assert language_id.learn(docs.where("doc_id < 0")) is None
