"""Odd tables: nulls in any column, empty and very long texts, repeats, clashing names."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
WORDS = "the quick brown fox jumps over a lazy dog while many small birds sing in old green trees".split()
LONG = " ".join(f"{w}{i % 97}" for i in range(12_000) for w in WORDS[i % 17 : i % 17 + 1])
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " hash int, name string, s1 string, words string, `_removed_id` int, `rank` string"
)
ROWS = [
    (1, " ".join(WORDS * 4), "en", "a"),
    (2, " ".join(WORDS * 4), "en", "a"),
    (2, " ".join(WORDS * 4), "en", "a"),
    (3, " ".join(WORDS * 4 + ["extra"]), None, "b"),
    (4, "", "en", None),
    (5, None, "fr", "b"),
    (6, " \t\n ", None, "b"),
    (7, LONG, "en", "c"),
    (8, LONG + " tail", "en", "c"),
    (9, "le renard brun saute par dessus le chien paresseux " * 9, "fr", "a"),
    (10, "12 34 !!", "en", "a"),
    (None, "nobody owns this text at all but it has enough words to count", "en", "a"),
    (None, None, None, None),
    (11, "one two", "en", "a"),
    (12, "One  TWO", "en", "a"),
    (13, "a b a b a b a b a b a b a b a b a b a b", "en", "b"),
]


def wide(rows):
    return [(*r, None if r[1] is None else len(r[1]), 1, "x", "y", "z", 5, "k") for r in rows]
