"""Benchmark passages in training text, found by winnowing.

Of every ``WINDOW - K + 1`` neighbouring word k-grams the one with the smallest
hash is a fingerprint. Two texts that share ``WINDOW`` words in a row therefore
share a fingerprint of that span, at the same place in it. Fingerprints of
documents and items are joined, and every meeting is extended along its
diagonal by comparing the words themselves. Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trigramma.llm.common import ascii_lower, rows_with, whole_rows
from trigramma.session import materialised, run_folder, scratch_path

WINDOW = 10
K = 5

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _once(df: DataFrame, value: Column, name: str, *keep: str) -> DataFrame:
    """``keep`` and ``value``, worked out once per row.

    A value named inside a lambda would otherwise be worked out again for every element;
    Catalyst does not move expressions through a generator.
    """
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def with_words(texts: DataFrame, key: str) -> DataFrame:
    """``key, words``: runs of letters, digits and non-ASCII characters, A-Z lower-cased.

    A null text has none.
    """
    cut = F.split(ascii_lower(F.coalesce("text", F.lit(""))), SEPARATORS)
    parts = _once(texts, cut, "parts", key)
    # Only the first and the last part can be empty.
    first = F.when(F.get("parts", F.lit(0)) == "", 2).otherwise(1)
    last = F.size("parts") - F.when(F.element_at("parts", -1) == "", 1).otherwise(0)
    return _once(parts, F.slice("parts", first, F.greatest(last - first + 1, F.lit(0))), "words", key)


def _prints(texts: DataFrame, key: str, k: int, window: int) -> DataFrame:
    """``key, hash, pos`` of the smallest k-gram of every ``window`` ones; the last wins a tie.

    Hashes leave their low bits to a gram's place in the window (counted from its end),
    so that one comparison decides both. A text of fewer grams is one window.
    """
    bits = window.bit_length()
    hashed = _once(texts, F.transform("words", lambda w: F.xxhash64(w)), "hashed", key)
    hashed = hashed.where(F.size("hashed") >= k)
    at = F.sequence(F.lit(0), F.size("hashed") - k)
    gram = lambda i: F.shiftleft(F.xxhash64(*[F.get("hashed", i + j) for j in range(k)]), bits)
    grams = _once(hashed, F.transform(at, gram), "grams", key)
    starts = F.sequence(F.lit(0), F.greatest(F.size("grams") - window, F.lit(0)))

    def smallest(i: Column) -> Column:
        # Beyond the end there is no gram: null, which least() passes over.
        there = [F.get("grams", i + j) + F.lit(window - 1 - j) for j in range(window)]
        best = F.least(*there) if window > 1 else there[0]
        return i + F.lit(window - 1) - best.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")

    chosen = F.array_distinct(F.transform(starts, smallest))
    return grams.select(
        key,
        F.inline(F.transform(chosen, lambda p: F.struct(F.get("grams", p).alias("hash"), p.alias("pos")))),
    )


def find_hits(documents: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """``doc_id, item_id, spots``: words of a document inside an occurrence of an item's window.

    ``documents(doc_id, text)`` and ``items(item_id, text)``. An item shorter than
    a window is one window, looked up by all its words at once: it has one gram, and
    documents are printed once more, unwinnowed, for each such length there is (at most
    ``window - 1``). ``spots`` are word positions from 0; a document has a row for every
    item and diagonal.
    """
    size = F.least(F.size("words"), F.lit(window))
    items = with_words(items.where(F.col("item_id").isNotNull()), "item_id")
    items = materialised(items.where(F.size("words") > 0).withColumn("win", size), "items")
    worded = with_words(documents, "doc_id")
    lengths = sorted(row.win for row in items.select("win").distinct().collect())
    meetings = None
    for length in lengths:
        # A gram per window of a short item; k-grams winnowed for the others.
        gram, span = (k, window - k + 1) if length >= window else (length, 1)
        some = items.where(F.col("win") == length)
        theirs = _prints(some, "item_id", gram, span).withColumnRenamed("pos", "ipos")
        met = _prints(worded, "doc_id", gram, span).join(theirs, "hash").select(
            "doc_id", "item_id", (F.col("pos") - F.col("ipos")).alias("diagonal")
        )
        meetings = met if meetings is None else meetings.unionByName(met)
    if meetings is None:
        return documents.select("doc_id", F.lit(None).alias("item_id"), F.lit(None).cast("array<int>").alias("spots")).limit(0)
    meetings = materialised(meetings.distinct(), "meetings")

    # Only texts that have meetings are dealt out, and their words cut afterwards.
    met = documents.join(meetings.select("doc_id").distinct(), "doc_id", "left_semi")
    lined = (
        with_words(met, "doc_id").join(meetings, "doc_id")
        .join(items.select("item_id", F.col("words").alias("iwords"), "win"), "item_id")
    )
    low = F.greatest(F.lit(0), -F.col("diagonal"))
    high = F.least(F.size("iwords"), F.size("words") - F.col("diagonal")) - F.col("win")
    starts = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    same = F.filter(
        starts,
        lambda s: F.slice("words", F.col("diagonal") + s + 1, F.col("win"))
        == F.slice("iwords", s + 1, F.col("win")),
    )
    spots = F.flatten(F.transform(
        same,
        lambda s: F.sequence(F.col("diagonal") + s, F.col("diagonal") + s + F.col("win") - 1),
    ))
    return lined.select("doc_id", "item_id", F.array_distinct(spots).alias("spots")).where(F.size("spots") > 0)


def _key() -> Column:
    """What tells documents apart: ``doc_id``, and where there is none the text."""
    return F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.sha2("text", 256))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Null and empty texts have no words, so nothing is hit. Rows that repeat a
    ``doc_id`` are versions of one document: each keeps its own ``n_words``, and a word
    position hit in any version counts for all of them; rows without ``doc_id`` are judged by
    their own text. Rows of the benchmark that
    repeat an item are one item; null items and items without words have no window. An
    empty table on either side leaves all documents clean. Extra columns are not read.
    """
    docs = documents.select(_key().alias("key"), "doc_id", "text")
    hits = find_hits(docs.select(F.col("key").alias("doc_id"), "text"), benchmark.select("item_id", "text"))
    spots = F.size(F.array_distinct(F.flatten(F.collect_list("spots")))).cast("long")
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    per_doc = hits.groupBy(F.col("doc_id").alias("key")).agg(
        spots.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
    )
    sizes = with_words(docs.select(F.struct("key", "doc_id").alias("id"), "text"), "id").select(
        "id.*", F.size("words").cast("long").alias("n_words")
    )
    return sizes.join(materialised(per_doc, "hits"), "key", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a word inside a benchmark window; see ``contamination`` for rows without ``doc_id``."""
    docs = documents.select(_key().alias("doc_id"), "text")
    path = scratch_path(documents.sparkSession, "hits")
    with run_folder(documents.sparkSession, "meetings"):
        find_hits(docs, benchmark.select("item_id", "text")).select("doc_id").distinct().write.parquet(path)
    found = documents.sparkSession.read.parquet(path)
    rows = whole_rows(documents, "doc_id", "text").select("row", _key().alias("doc_id"))
    return rows_with(rows, found, "left_anti").select("row.*")
