"""The best documents of every search item, by a hybrid of term- and document-at-a-time.

A first pass counts documents, words and the documents of every term. In a second, every
task indexes its documents block by block, for the terms of the items alone, and searches
each block for each item:

1. The item's short lists are summed up term by term into accumulators, which are then one
   more list: ascending documents, each with a partial score, and a bound for every range
   of documents.
2. This list and the long ones are walked document range by document range. A range whose
   bounds do not reach the item's worst kept score is skipped in all lists; within a range
   the lists are added from the largest bound on, until no document can get there.

A task carries the best documents of every item from block to block, so that later blocks
start with a high threshold, and sends no more than those on; the best of all tasks are
the answer. No text and no list is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trigramma.llm.common import LOWER, UPPER
from trigramma.llm.decontaminate import with_words
from trigramma.llm.texts import raw
from trigramma.session import materialised

TOP = 10
# The constants of the score.
UNIT, SATURATION, FLAT, SLOPE = 1_000_000_000, 8, 10, 90
# Distinct terms of items that a task holds at once, some 100 bytes each. Items beyond are searched
# in further passes over the documents, each with its share of the items.
ITEM_TERMS = 1_000_000
# Characters of an index block (or one longer text), documents of a range, and the largest
# share of a block's documents in a short list.
BLOCK_CHARS = 8_000_000
RANGE = 64
SHORT = 1 / 16

# Bytes: A-Z in lower case, whatever else of ASCII is no letter and no digit as white space.
_KEPT = set(b"0123456789" + LOWER.encode() + UPPER.encode()) | set(range(128, 256))
_FOLD = bytes(ord(chr(b).lower()) if b < 128 else b for b in range(256))
FOLDED = bytes(_FOLD[b] if b in _KEPT else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return raw(text or "").translate(FOLDED).split()


class Block:
    """Inverted lists of a run of documents, for the terms of the items.

    A posting is a place in the run with the term's part of the score; ``cells`` are the
    stretches of a list in one range of documents, with their largest part.
    """

    def __init__(self, found: list[np.ndarray], sizes: list[int], weights: np.ndarray, n: int, total: int):
        self.count = len(found)
        lengths = np.fromiter(map(len, found), np.int64, self.count)
        term = np.concatenate(found) if found else np.empty(0, np.int64)
        keys, tf = np.unique(term * self.count + np.repeat(np.arange(self.count), lengths), return_counts=True)
        term, self.doc = keys // max(self.count, 1), keys % max(self.count, 1)
        m = FLAT + (SLOPE * np.array(sizes, np.int64) * n) // max(total, 1)
        self.part = weights[term] * ((UNIT * tf) // (1000 * tf + SATURATION * m[self.doc]))
        numbers = np.arange(len(weights) + 1)
        self.starts = np.searchsorted(term, numbers)
        cell = term * (self.count // RANGE + 1) + self.doc // RANGE
        self.cell_at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.empty(0, np.int64)
        self.cell_range = self.doc[self.cell_at] // RANGE
        self.cell_max = np.maximum.reduceat(self.part, self.cell_at) if len(cell) else np.empty(0, np.int64)
        self.cell_starts = np.searchsorted(term[self.cell_at], numbers)
        self.cell_end = np.append(self.cell_at[1:], len(cell))
        self.ranges = -(-self.count // RANGE)

    def accumulated(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term at a time: the documents of some lists, ascending, with their summed parts."""
        spans = [slice(self.starts[t], self.starts[t + 1]) for t in terms]
        doc = np.concatenate([self.doc[s] for s in spans]) if spans else np.empty(0, np.int64)
        part = np.concatenate([self.part[s] for s in spans]) if spans else np.empty(0, np.int64)
        if not len(doc):
            return doc, part
        order = np.argsort(doc, kind="stable")
        doc, part = doc[order], part[order]
        at = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        return doc[at], np.add.reduceat(part, at)

    def search(self, terms: np.ndarray, best: "Best") -> None:
        """Offer ``best`` every document that may belong to it."""
        lengths = self.starts[terms + 1] - self.starts[terms]
        short = lengths <= SHORT * self.count
        docs, sums = self.accumulated(terms[short & (lengths > 0)])
        bounds = np.zeros(self.ranges, np.int64)
        edges = np.searchsorted(docs, np.arange(self.ranges + 1) * RANGE)
        filled = np.flatnonzero(edges[1:] > edges[:-1])
        if len(filled):
            bounds[filled] += np.maximum.reduceat(sums, edges[filled])
        cells: dict[int, list[int]] = {}
        for t in terms[~short]:
            own = range(self.cell_starts[t], self.cell_starts[t + 1])
            bounds[self.cell_range[own.start : own.stop]] += self.cell_max[own.start : own.stop]
            for at, r in zip(own, self.cell_range[own.start : own.stop].tolist()):
                cells.setdefault(r, []).append(at)
        for r in np.flatnonzero(bounds >= best.least).tolist():
            # The threshold has risen since the ranges were listed.
            left = int(bounds[r])
            if left < best.least:
                continue
            scores = np.zeros(RANGE, np.int64)
            if edges[r + 1] > edges[r]:
                some = slice(edges[r], edges[r + 1])
                scores[docs[some] - r * RANGE] = sums[some]
                left -= int(sums[some].max())
            for at in sorted(cells.get(r, ()), key=lambda c: -self.cell_max[c]):
                if left + int(scores.max()) < best.least:
                    break
                some = slice(self.cell_at[at], self.cell_end[at])
                scores[self.doc[some] - r * RANGE] += self.part[some]
                left -= int(self.cell_max[at])
            else:
                for place in np.flatnonzero(scores >= best.least).tolist():
                    best.offer(int(scores[place]), r * RANGE + place)


class Best:
    """The ``k`` best documents of an item so far: high scores, then small ids; no id is the last."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1
        self.ids: list = []

    def offer(self, score: int, place: int) -> None:
        doc = self.ids[place]
        self.rows.append((-score, doc is None, 0 if doc is None else doc))
        if len(self.rows) > 4 * self.k or score > self.least:
            self.settle()

    def settle(self) -> None:
        self.rows = sorted(self.rows)[: self.k]
        if len(self.rows) == self.k:
            self.least = max(1, -self.rows[-1][0])


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[str | None]]]:
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            ids.append(doc)
            texts.append(text)
            held += len(text or "") + 1
            if held >= limit:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _searched(batches, asked, k: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The best rows of a task: ``item`` (a number), ``doc_id``, ``score``."""
    vocabulary, weights, items, n, total, kind = asked.value
    best = [Best(k) for _ in items]
    for ids, texts in _blocks(batches, limit):
        found, sizes = [], []
        for text in texts:
            terms = terms_of(text)
            sizes.append(len(terms))
            known = [vocabulary[t] for t in terms if t in vocabulary]
            found.append(np.array(known, np.int64))
        block = Block(found, sizes, weights, n, total)
        for terms, kept in zip(items, best):
            kept.ids = ids
            block.search(terms, kept)
            kept.settle()
    rows = [(i, None if none else doc, -score) for i, kept in enumerate(best) for score, none, doc in kept.rows]
    columns = zip(*rows) if rows else [()] * 3
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int32(), kind, pa.int64()))], ["item", "doc_id", "score"]
    )


def collection_counts(documents: DataFrame) -> DataFrame:
    """``term, df, words``: documents with each term; the empty term stands for all of them.

    Its ``df`` is the number of documents that have a term, its ``words`` the terms of all of them
    with repeats (0 elsewhere). Counted per task before the shuffle.
    """
    worded = with_words(documents, "doc_id").where(F.size("words") > 0)
    zero = F.lit(0).cast("long")
    whole = F.struct(F.lit("").alias("term"), F.size("words").cast("long").alias("n"))
    each = F.transform(F.array_distinct("words"), lambda w: F.struct(w.alias("term"), zero.alias("n")))
    rows = worded.select(F.inline(F.concat(F.array(whole), each)))
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("words"))


def search(
    documents: DataFrame, items: DataFrame, k: int = TOP, item_terms: int = ITEM_TERMS, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best of ``documents(doc_id, text)`` per item.

    ``items(item_id, text)``. Scores are those of the module's constants, in whole numbers; equal scores go by
    ascending ``doc_id``, rows without one last. Null and empty texts have no terms: they
    are found by nothing, ask for nothing and do not count. Rows that repeat a ``doc_id`` are documents of their
    own; rows that repeat an ``item_id`` (null is one, too) are one item with the terms of all. Items
    without a hit have no row; an empty table gives none. Very long texts are an index block
    of their own. Extra columns are not read.
    """
    spark = documents.sparkSession
    docs, items = documents.select("doc_id", "text"), items.select("item_id", "text")
    asked = materialised(
        with_words(items, "item_id").select("item_id", F.explode("words").alias("term")).distinct(), "asked"
    )
    counted = collection_counts(docs)
    wanted = asked.select("term").unionByName(spark.createDataFrame([("",)], "term string")).distinct()
    known = materialised(counted.join(wanted, "term", "left_semi"), "term_counts")
    kinds = items.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    schema = f"item int, doc_id {kinds[1].simpleString()}, score long"
    whole = known.where("term = ''").first()
    passes = max(1, -(-asked.count() // item_terms)) if whole else 0
    hits = spark.createDataFrame([], f"item_id {kinds[0].simpleString()}, {schema}").drop("item")
    for number in range(passes):
        some = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number)
        held, names = _held(some.join(known, "term"), whole.df, whole.words, docs)
        shared = spark.sparkContext.broadcast(held)
        found = docs.mapInArrow(
            lambda batches, shared=shared: _searched(batches, shared, k, block_chars), schema
        )
        listed = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {kinds[0].simpleString()}")
        # One row per item of this pass, bounded by item_terms.
        hits = hits.unionByName(found.join(F.broadcast(listed), "item").drop("item"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _held(pairs: DataFrame, n: int, total: int, docs: DataFrame):
    """What a task needs to search for the items of a pass, and the items' ids by number."""
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n + 2.0) / (2.0 * F.col("df") + 1.0)))
    rows = pairs.select("item_id", "term", weight.cast("long").alias("w")).collect()
    vocabulary: dict[bytes, int] = {}
    weights: list[int] = []
    terms: dict[object, list[int]] = {}
    for row in rows:
        word = raw(row.term)
        if word not in vocabulary:
            vocabulary[word] = len(weights)
            weights.append(row.w)
        terms.setdefault(row.item_id, []).append(vocabulary[word])
    kind = docs.limit(0).toArrow().schema.field("doc_id").type
    held = vocabulary, np.array(weights, np.int64), [np.array(sorted(t)) for t in terms.values()], n, total, kind
    return held, list(terms)
