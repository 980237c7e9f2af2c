"""Passages of several lines that repeat across documents, found by content-defined chunks.

A rolling hash runs over the hashes of every two neighbouring lines that are not blank. It does not depend on
where a passage stands or on what is around it, so hashes that are met twice anywhere mark the
shared lines, and the places where marks begin and end are the boundaries of chunks: each is the
longest run of lines that occurred before, whatever its length from two lines on. (Boundaries
set by the hash value alone, one in three lines, leave the ends of most passages in chunks
with foreign lines; measured, they found half of the repeated lines.) Two lines
count as seen before only if their bytes are, which go by their SHA-256: texts stay where they
are, and what moves of a line is a few numbers and 32 bytes. Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trigramma.llm import common
from trigramma.llm.common import meet, rows_with, whole_rows
from trigramma.operators.joins import lookup
from trigramma.session import materialised, run_folder, scratch_path


def _once(df: DataFrame, value: Column, name: str, *keep: str) -> DataFrame:
    """``keep`` and ``value``, worked out once per row: nothing moves through a generator."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def _text_of(first: Column, last: Column) -> Column:
    return F.array_join(F.slice("lines", first, last - first + 1), "\n")


def _windows(texts: DataFrame, *keep: str) -> DataFrame:
    """``keep, first, last, key, said``: every line that is not blank, to the next one that is not.

    Any run of lines that has two and more of them, and begins and ends with one, is made of
    such windows: it occurred before if, and only if, they did in a row. ``key`` is the rolling
    hash of the two lines; blank lines between do not enter it. ``said`` is the SHA-256 of the
    window's bytes: a window never carries lines, of which its text may have any number.
    """
    lines = _once(texts.where("text is not null"), F.split("text", "\n"), "lines", *keep)
    numbers = F.sequence(F.lit(1), F.size("lines"))
    solid = F.transform(
        F.filter(numbers, lambda i: F.get("lines", i - 1).rlike(r"\S")),
        lambda i: F.struct(i.alias("at"), F.xxhash64(F.get("lines", i - 1)).alias("hash")),
    )
    solid = _once(lines, solid, "solid", *keep, "lines")
    ends = F.transform(
        F.slice("solid", 1, F.greatest(F.size("solid") - 1, F.lit(0))),
        lambda a, k: F.struct(
            a["at"].alias("first"), F.get("solid", k + 1)["at"].alias("last"),
            F.xxhash64(a["hash"], F.get("solid", k + 1)["hash"]).alias("key"),
        ),
    )
    windows = solid.select(*keep, "lines", F.inline(ends))
    said = F.unhex(F.sha2(_text_of(F.col("first"), F.col("last")), 256)).alias("said")
    return windows.select(*keep, "first", "last", "key", said)


def repeated_lines(documents: DataFrame) -> DataFrame:
    """``doc_id, version, removed``: the lines of each text in runs that occurred before.

    Before is in a smaller ``doc_id`` (null is smallest), in a version of the same with a
    smaller hash, or further up. Rows with the same id and text are one text.
    """
    texts = documents.select("doc_id", F.xxhash64("text").alias("version"), "text")
    windows = _windows(texts, "doc_id", "version")
    keys = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    marked = meet(windows, materialised(keys, "window_keys"), "key")
    place = F.struct("doc_id", "version", "first")
    found = materialised(marked.select("doc_id", "version", "first", "last", "said"), "windows")
    # A passage that many documents share is summed up per task.
    firsts = found.groupBy("said").agg(F.min(place).alias("place"))
    again = lookup(found, materialised(firsts, "window_firsts"), ["said"]).where(~place.eqNullSafe(F.col("place")))
    removed = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last")))))
    return again.groupBy("doc_id", "version").agg(removed.alias("removed"))


def _id(doc_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit(""))


def _parted(documents: DataFrame) -> DataFrame:
    """``row, removed, lines, kept`` of every row; the last three are null where no line goes.

    Rows stay where they are and of those that lose lines only these are shuffled, unless very many
    do: then each row is shuffled once.
    """
    spark = documents.sparkSession
    key = lambda version: F.concat_ws(":", version.cast("string"), _id(F.col("doc_id")))
    path = scratch_path(spark, "removed")
    # Whatever else is written on the way goes.
    with run_folder(spark, "lines"):
        found = repeated_lines(documents.select("doc_id", "text"))
        found.select(key(F.col("version")).alias("key"), "removed").write.parquet(path)
    removed = spark.read.parquet(path)
    rows = whole_rows(documents, "doc_id", "text").select("row", key(F.xxhash64("text")).alias("key"))
    if removed.count() <= common.FEW:
        by_id, ids = rows.withColumnRenamed("key", "doc_id"), removed.select(F.col("key").alias("doc_id"))
        some = lookup(rows_with(by_id, ids).withColumnRenamed("doc_id", "key"), removed, ["key"])
        every = some.unionByName(rows_with(by_id, ids, "left_anti").select("row"), allowMissingColumns=True)
    else:
        every = lookup(rows, removed, ["key"], "left")
    changed = F.col("removed").isNotNull()
    lines = _once(every, F.when(changed, F.split("row.text", "\n")), "lines", "row", "removed")
    kept = F.when(changed, F.array_except(F.sequence(F.lit(1), F.size("lines")), "removed"))
    return _once(lines, kept, "kept", "row", "removed", "lines")


def _kept_text() -> Column:
    return F.array_join(F.transform("kept", lambda i: F.get("lines", i - 1)), "\n")


def dedup_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with all its columns, every run of lines that occurred before taken out of ``text``.

    A run has two and more lines that are not blank, and the blank ones between; its first
    occurrence stays, and so does the first of every line. Lines that repeat alone are not touched. ``n_chars`` is counted anew where the
    table has it. Every document stays, maybe with an empty text; a null text stays null, and very long texts
    are texts like any other. Versions of one ``doc_id`` are texts of their own, and rows that repeat id and text lose the same
    lines. An empty table gives an empty result.
    """
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in documents.columns:
        row = row.withField("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    parted = _parted(documents).select("row", "removed", _kept_text().alias("text"))
    return parted.select(F.when(F.col("removed").isNull(), F.col("row")).otherwise(row).alias("row")).select("row.*")


def line_dedup_report(documents: DataFrame) -> DataFrame:
    """Per row of ``documents(doc_id, text)``: ``doc_id, n_removed_chunks, n_removed_lines, text``.

    A chunk is a run of neighbouring lines that go; ``text`` is what is left. See ``dedup_lines`` for nulls
    and repeated rows.
    """
    opens = F.filter("removed", lambda i, k: (k == 0) | (i - F.get("removed", k - 1) > 1))
    unchanged = F.col("removed").isNull()
    return _parted(documents.select("doc_id", "text")).select(
        "row.doc_id", F.when(unchanged, F.lit(0)).otherwise(F.size(opens)).cast("long").alias("n_removed_chunks"),
        F.when(unchanged, F.lit(0)).otherwise(F.size("removed")).cast("long").alias("n_removed_lines"),
        F.when(unchanged, F.col("row.text")).otherwise(_kept_text()).alias("text"),
    )
