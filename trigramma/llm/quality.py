"""Rules on counts of a text, and bands of perplexity under its language's model.

The model is a modified Kneser-Ney model of characters: every code point is a symbol of its
own, none are folded, so it grows with the scripts and the texts of the corpus. Spark counts the
``ORDER``-grams of all texts per language and makes the model of them in shuffles. Tasks hold its most frequent
n-grams, up to ``MODEL_BYTES``, as sorted arrays of hashes and look a whole batch up by binary search; n-grams beyond
them, rare ones, meet the rest of the model in a join. The bands follow from the perplexities of all documents of
the language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trigramma.llm.texts import SPACES, chained, mixed, parts, raw, word_hashes
from trigramma.operators.joins import lookup
from trigramma.session import materialised

# Code points. A context, the symbols before the last one, is one number of ``BITS`` a symbol.
SYMBOLS = 0x110000
BITS = 21
ORDER = 4
# Bytes of model broadcast, and of an n-gram there; n-grams beyond them are joined.
MODEL_BYTES = 128 << 20
GRAM_BYTES = 16
# Different n-grams that a counting task holds before it hands them on.
HELD = 1 << 20
# Logarithms are summed up as whole numbers, so that the order of the terms does not matter.
UNIT = 1 << 24
# Bands reach this many interquartile ranges beyond the quartiles.
REACH = 3.0
MARKS = "#*$%&|<>"


def symbol_table() -> np.ndarray:
    """Symbol of every code point: each is its own. Code point 0 also stands before a text."""
    return np.arange(SYMBOLS, dtype=np.uint64)


def packed(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at every character, as its context and its last symbol, and the length of each text.

    Before a text there are ``ORDER - 1`` symbols 0.
    """
    lead = "\0" * (ORDER - 1)
    points = np.frombuffer("".join(lead + t for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = table[points]
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + ORDER - 1) - lengths
    places = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    contexts = np.zeros(len(places), np.uint64)
    for i in range(ORDER - 1, 0, -1):
        contexts = (contexts << np.uint64(BITS)) | symbols[places - i]
    return np.stack([contexts, symbols[places]]), lengths


def gram_keys(grams: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every n-gram."""
    return mixed(mixed(grams[0]) + grams[1])


def _summed(grams: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams, and how often each is there."""
    if n is None:
        _, first, n = np.unique(gram_keys(grams), return_index=True, return_counts=True)
    else:
        _, first, back = np.unique(gram_keys(grams), return_index=True, return_inverse=True)
        sums = np.zeros(len(first), np.int64)
        np.add.at(sums, back, n)
        n = sums
    return grams[:, first], n


def count_grams(documents: DataFrame) -> DataFrame:
    """``lang, context, last, n``: all n-grams of ``documents(text, lang)``; a null language is one of its own."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbol_table()
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = np.array([x or "" for x in batch["lang"].to_pylist()], object)
            texts = batch["text"].to_pylist()
            for lang in sorted(set(langs)):
                for part in parts([texts[i] for i in np.flatnonzero(langs == lang)]):
                    grams, n = _summed(packed(part, table)[0])
                    if lang in held:
                        grams, n = _summed(np.hstack([held[lang][0], grams]), np.hstack([held[lang][1], n]))
                    held[lang] = grams, n
                    if sum(len(n) for _, n in held.values()) > HELD:
                        yield from _flushed(held)
        yield from _flushed(held)

    def _flushed(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, (grams, n) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), *[pa.array(x.astype(np.int64)) for x in grams], pa.array(n, pa.int64())],
                ["lang", "context", "last", "n"],
            )
        held.clear()

    rows = documents.select("text", "lang").mapInArrow(counted, "lang string, context long, last long, n long")
    return rows.groupBy("lang", "context", "last").agg(F.sum("n").alias("n"))


def _ending(size: int) -> Column:
    """The context of an n-gram's last ``size`` symbols."""
    return F.col("context").bitwiseAND(F.lit((1 << BITS * (size - 1)) - 1))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``lang, size, context, last, n, p, rest``: interpolated probabilities of all n-grams of each size.

    ``rest`` is the weight that an n-gram, as a context, leaves to the next lower size.
    Below the highest size counts are numbers of different preceding symbols.
    """
    tables = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):
        tables[size] = tables[size + 1].groupBy("lang", _ending(size).alias("context"), "last").agg(
            F.count(F.lit(1)).alias("n")
        )
    lower = None
    model = None
    for size in range(1, ORDER + 1):
        grams = tables[size]
        seen = [F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in range(1, 5)]
        share = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

        def saved(k: int) -> Column:
            """Discount of a count of ``k``; half the count where too few counts are there to tell."""
            d = k - (k + 1) * share * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
            return F.when(d.isNull(), F.lit(k / 2)).otherwise(F.greatest(F.lit(0.0), d)).alias(f"d{k}")

        discounts = grams.groupBy("lang").agg(*seen).select("lang", *map(saved, range(1, 4)))
        discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        taken = grams.join(F.broadcast(discounts), "lang").withColumn("d", discount)
        contexts = taken.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("rest")
        )
        joined = taken.join(contexts, ["lang", "context"])
        own = (F.col("n") - F.col("d")) / F.col("total")
        if lower is None:
            rows = joined.select("lang", "context", "last", "n", (own + F.col("rest") / SYMBOLS).alias("p"))
        else:
            below = lower.select("lang", F.col("context").alias("low"), "last", F.col("p").alias("low_p"))
            rows = joined.withColumn("low", _ending(size - 1)).join(below, ["lang", "low", "last"]).select(
                "lang", "context", "last", "n", (own + F.col("rest") * F.col("low_p")).alias("p")
            )
        lower = materialised(rows, "kneser_ney")
        # The weight belongs to the context, an n-gram one smaller; size 0 is the empty one.
        rests = contexts.select(
            "lang", F.lit(size - 1).alias("size"), F.shiftright("context", BITS).alias("context"),
            F.col("context").bitwiseAND(F.lit((1 << BITS) - 1)).alias("last"), F.lit(None).cast("long").alias("n"),
            F.lit(None).cast("double").alias("p"), "rest",
        )
        probs = lower.select(
            "lang", F.lit(size).alias("size"), "context", "last", "n", "p", F.lit(None).cast("double").alias("rest")
        )
        both = probs.unionByName(rests)
        model = both if model is None else model.unionByName(both)
    return model.groupBy("lang", "size", "context", "last").agg(*[F.max(c).alias(c) for c in ("n", "p", "rest")])


class Lookup:
    """A language's model as sorted arrays: hash of the n-gram, logarithm of p in units, weight as context."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.sizes = rows

    def find(self, grams: np.ndarray, size: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
        """Where each n-gram is, and whether it is there at all."""
        keys, wanted = self.sizes[size][0], gram_keys(grams)
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def logs(self, grams: np.ndarray, size: int = ORDER) -> np.ndarray:
        """Natural logarithm of the probability of each n-gram's last symbol, of a model that is here as a whole."""
        if size == 0:
            weight = self.sizes[0][2][0] if len(self.sizes[0][0]) else 1.0
            return np.full(grams.shape[1], np.log(weight / SYMBOLS))
        at, known = self.find(grams, size)
        known &= self.sizes[size][1][at] <= 0 if len(self.sizes[size][0]) else known
        out = np.empty(len(known))
        out[known] = self.sizes[size][1][at[known]] / UNIT
        if not known.all():
            contexts, last = grams[:, ~known]
            weight = np.zeros(len(last))
            if size > 1:
                before = np.stack([contexts >> np.uint64(BITS), contexts & np.uint64((1 << BITS) - 1)])
                at, met = self.find(before, size - 1)
                w = self.sizes[size - 1][2]
                met &= w[at] > 0 if len(w) else met
                weight[met] = np.log(w[at[met]])
            mask = np.uint64((1 << BITS * max(size - 2, 0)) - 1)
            out[~known] = weight + self.logs(np.stack([contexts & mask, last]), size - 1)
        return out


def _units() -> Column:
    """The logarithm of ``p`` in units; a number above 0 where there is no ``p``."""
    return F.coalesce(F.round(F.log("p") * UNIT), F.lit(1.0)).cast("long")


def load_models(model: DataFrame, langs: list[str]) -> dict[str, Lookup]:
    """Models of some languages, or what ``model`` has of them, on the driver: its rows have to fit there."""
    rows = model.where(F.col("lang").isin(langs)).select(
        "lang", "size", "context", "last", _units().alias("log"), F.coalesce("rest", F.lit(0.0)).alias("rest")
    ).toArrow()
    names = rows["lang"].combine_chunks().dictionary_encode()
    of, size = names.indices.to_numpy(zero_copy_only=False), rows["size"].to_numpy()
    numbers = {x: i for i, x in enumerate(names.dictionary.to_pylist())}
    keys = gram_keys(np.stack([rows[c].to_numpy().astype(np.uint64) for c in ("context", "last")]))
    logs, rest = rows["log"].to_numpy().astype(np.int32), rows["rest"].to_numpy().astype(np.float32)
    found = {}
    for x in langs:
        mine = [np.flatnonzero((of == numbers.get(x, -1)) & (size == s)) for s in range(ORDER + 1)]
        ordered = [at[np.argsort(keys[at])] for at in mine]
        found[x] = Lookup([(keys[at], logs[at], rest[at]) for at in ordered])
    return found


def _counts(text: str, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    repeats = 0
    if len(words) > 3:
        windows = chained([hashes[i : len(hashes) - 2 + i] for i in range(3)])
        _, back, times = np.unique(windows, return_inverse=True, return_counts=True)
        hit = np.zeros(len(words), bool)
        twice = np.flatnonzero(times[back] > 1)
        for i in range(3):
            hit[twice + i] = True
        repeats = int(hit.sum())
    return (
        len(text) - sum(map(text.count, SPACES)), sum(map(text.count, MARKS)), len(lines) - len(set(lines)), repeats,
    )


def _head(model: DataFrame) -> DataFrame | None:
    """The most frequent n-grams of the highest size, ``MODEL_BYTES`` of them at most; None where all of them fit."""
    step = F.floor(F.log2("n") * 16)
    steps = model.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    room = MODEL_BYTES // GRAM_BYTES
    least = None
    for row in steps:
        room -= row["count"]
        if room < 0:
            return model.where(F.lit(False) if least is None else step >= least)
        least = row["step"]
    return None


def score(documents: DataFrame, model: DataFrame) -> DataFrame:
    """Counts of every text, and the mean log-probability of its characters (null without any).

    ``model`` is the model of the texts themselves, so that it has all of their n-grams. Texts stay where they
    are; of n-grams that tasks do not hold, each text's different ones are shuffled.
    """
    whole = model.where(F.col("size") == ORDER).select("lang", "size", "context", "last", "n", "p", "rest")
    head = _head(whole)
    some = whole if head is None else head
    langs = [row.lang for row in some.select("lang").distinct().collect()]
    held = documents.sparkSession.sparkContext.broadcast(load_models(some, langs))
    kind = documents.schema["doc_id"].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "log_sum"]
    tail = pa.list_(pa.struct([(c, pa.int64()) for c in ("context", "last", "n")]))
    fields = (
        f"doc_id {kind}, lang string, {', '.join(f'{c} long' for c in counts)},"
        " tail array<struct<context: long, last: long, n: long>>"
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, none, table = held.value, Lookup([(np.empty(0, np.uint64),) * 3] * (ORDER + 1)), symbol_table()
        for batch in batches:
            all_langs = np.array([x or "" for x in batch["lang"].to_pylist()], object)
            done = 0
            for part in parts(batch["text"].to_pylist()):
                words = [raw(t).split() for t in part]
                hashes = word_hashes([w for some in words for w in some])
                ends = np.cumsum([len(w) for w in words])
                rows = [
                    (len(some), *_counts(text, some, hashes[end - len(some) : end]), len(text))
                    for text, some, end in zip(part, words, ends)
                ]
                langs = all_langs[done : done + len(part)]
                sums, tails = np.zeros(len(part), np.int64), [[] for _ in part]
                for lang in set(langs):
                    mine = np.flatnonzero(langs == lang)
                    grams, lengths = packed([part[i] for i in mine], table)
                    _, first, back = np.unique(gram_keys(grams), return_index=True, return_inverse=True)
                    own = models.get(lang, none)
                    at, known = own.find(grams[:, first])
                    logs = np.zeros(len(first), np.int64)
                    logs[known] = own.sizes[ORDER][1][at[known]]
                    upto = np.concatenate([[0], np.cumsum(logs[back])])
                    ends = np.cumsum(lengths)
                    sums[mine] = upto[ends] - upto[ends - lengths]
                    if not known.all():
                        text = np.repeat(np.arange(len(mine)), lengths)
                        rare = ~known[back]
                        pairs, n = np.unique(text[rare] * len(first) + back[rare], return_counts=True)
                        for pair, times in zip(pairs.tolist(), n.tolist()):
                            context, last = grams[:, first[pair % len(first)]].tolist()
                            tails[mine[pair // len(first)]].append({"context": context, "last": last, "n": times})
                values = [pa.array([r[k] for r in rows], pa.int64()) for k in range(6)]
                ids, named = (batch[c].slice(done, len(part)) for c in ("doc_id", "lang"))
                yield pa.RecordBatch.from_arrays(
                    [ids, named, *values, pa.array(sums, pa.int64()), pa.array(tails, tail)],
                    ["doc_id", "lang", *counts, "tail"],
                )
                done += len(part)

    docs = documents.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"))
    found = docs.mapInArrow(scored, fields)
    if head is not None:
        found = materialised(found.withColumn("row", F.monotonically_increasing_id()), "partly")
        rare = found.select("row", "lang", F.inline("tail"))
        logs = whole.select("lang", "context", "last", _units().alias("log"))
        rest = lookup(rare, logs, ["lang", "context", "last"]).groupBy("row").agg(
            F.sum(F.col("n") * F.col("log")).alias("more")
        )
        found = lookup(found, rest, ["row"], "left").withColumn("log_sum", F.col("log_sum") + F.coalesce("more", F.lit(0)))
    mean = F.when(F.col("n_chars") > 0, F.col("log_sum") / F.col("n_chars") / UNIT)
    return found.select("doc_id", "lang", *counts[:5], mean.alias("log_p"))


def _quantile(part: Column, total: Column, at: float) -> Column:
    return F.min(F.when(part >= total * at, F.col("bin")))


def bands(scores: DataFrame) -> DataFrame:
    """``lang, low, high`` in hundredths of the logarithm of the perplexity.

    From an exact histogram per language, so that no task sees a language whole.
    """
    bins = scores.where("bin is not null").groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("lang").orderBy("bin")
    ranked = bins.withColumn("part", F.sum("n").over(upto)).withColumn(
        "total", F.sum("n").over(Window.partitionBy("lang"))
    )
    part, total = F.col("part"), F.col("total")
    quartiles = ranked.groupBy("lang").agg(
        _quantile(part, total, 0.25).alias("q1"), _quantile(part, total, 0.75).alias("q3")
    )
    # A quartile is known to a hundredth only.
    reach = REACH * (F.col("q3") - F.col("q1") + 1)
    return quartiles.select("lang", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))


def judge_quality(documents: DataFrame) -> DataFrame:
    """Counts and verdict for every row of ``documents(doc_id, text, lang)``.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (a null text counts as
    empty); ``base_failed`` if it has fewer than 50 words or more than half of them
    in repeated windows; ``perplexity`` per character under the model of its language
    (null for an empty text); ``kept`` unless the base failed or the perplexity is outside
    the language's band. A null language is one language of its own. Repeated rows are
    judged, and counted, one by one. An empty table gives an empty result; extra columns
    are not read.
    """
    docs = documents.select("doc_id", "text", "lang")
    model = materialised(kneser_ney(materialised(count_grams(docs), "grams")), "model")
    scores = materialised(
        score(docs, model).withColumn("bin", F.round(-100 * F.col("log_p")).cast("int")), "scores"
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = scores.join(bands(scores), "lang", "left").withColumn("base_failed", failed)
    inside = F.coalesce(F.col("bin").between(F.col("low"), F.col("high")), F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), F.exp(-F.col("log_p")).alias("perplexity"),
    )
