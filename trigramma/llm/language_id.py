"""Language of text, word by word: a linear-chain conditional random field.

A word is described by the n-grams of its letters (with marks for its ends, so that
affixes are n-grams too) and by its entry in a lexicon of frequent words. Weights and
transitions between languages are learned together, from labelled texts of which pieces
are strung together as code-switched text would be. Forward-backward then gives every
word its probability of each language, and a document the language with the most words.

The field is fitted in one task from whole texts of a bounded number of labelled rows; every whole
text is labelled in the tasks, a batch at a time.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trigramma.llm.common import rows_with, whole_rows
from trigramma.llm.texts import mixed, parts, sliced
from trigramma.session import materialised

# Bound of what is learned from: whole texts per language.
SAMPLE_TEXTS = 150
LEXICON = 400
ORDERS = (2, 3, 4)
# Weights of all n-grams and languages together, in bytes: what every task receives.
WEIGHT_BYTES = 32 << 20
UNDETERMINED = "und"
# Characters that a task labels at once, or one longer text.
PART = 250_000
BLOCK = 32


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point of the basic plane is a letter, and its lower case."""
    points = range(65536)
    lower = np.array([ord(c) if len(c := chr(p).lower()) == 1 else p for p in points], np.uint32)
    return np.array([chr(p).isalpha() for p in points]), lower


@dataclass
class Words:
    """Words of a batch: letters between marks, the place of each word, words per text."""

    letters: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    counts: np.ndarray


def cut_words(texts: list[str], tables: tuple[np.ndarray, np.ndarray]) -> Words:
    """Runs of letters of every text, lower-cased, each as mark, letters, mark."""
    is_letter, lower = tables
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = np.minimum(points, 65535)
    letter = is_letter[plain]
    if (far := points > 65535).any():
        distinct, which = np.unique(points[far], return_inverse=True)
        letter[far] = np.array([chr(p).isalpha() for p in distinct])[which]
    edge = np.diff(np.concatenate([[False], letter]).astype(np.int8), append=0)
    begin = np.flatnonzero(edge[: len(points)] == 1)
    # The end of a word is the last letter before a gap; the text ends with a line feed.
    end = np.flatnonzero(letter & ~np.append(letter[1:], False)) + 1 if len(points) else begin
    lengths = end - begin
    word = np.repeat(np.arange(len(begin)), lengths)
    held = np.zeros(int(lengths.sum()) + 2 * len(begin), np.uint32)
    low = np.where(points < 65536, lower[plain], points)[letter]
    held[np.arange(len(low)) + 2 * word + 1] = low.astype(np.uint32) + np.uint32(3)
    starts = np.cumsum(lengths + 2) - lengths - 2
    held[starts] = 1
    held[starts + lengths + 1] = 2
    text_ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.empty(0, np.int64)
    counts = np.diff(np.concatenate([[0], np.searchsorted(begin, text_ends)]))
    return Words(held, np.repeat(np.arange(len(begin)), lengths + 2), starts, counts)


def gram_buckets(words: Words, order: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram from every place on; ``2^bits`` where it leaves its word."""
    reach = max(len(words.letters) - order + 1, 0)
    total = np.full(reach, order, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(order):
            total = total * np.uint32(0x9E3779B1) + words.letters[i : i + reach]
        total = (total ^ (total >> np.uint32(15))) * np.uint32(0x85EBCA77)
    buckets = np.full(len(words.letters), 1 << bits, np.int32)
    inside = words.owner[:reach] == words.owner[order - 1 :]
    buckets[:reach][inside] = (total >> np.uint32(32 - bits))[inside]
    return buckets


def word_keys(words: Words) -> np.ndarray:
    """A 64-bit hash of every word."""
    if not len(words.starts):
        return np.empty(0, np.uint64)
    place = (np.arange(len(words.letters)) - words.starts[words.owner]).astype(np.uint64)
    with np.errstate(over="ignore"):
        coded = mixed(words.letters.astype(np.uint64) + place * np.uint64(0x9E3779B97F4A7C15))
        return np.add.reduceat(coded, words.starts)


@dataclass
class Field:
    """Learned weights; all that tasks need."""

    langs: list[str]
    bits: int
    grams: np.ndarray  # (orders, buckets and one for nothing, languages)
    lexicon: np.ndarray  # sorted word hashes
    lexical: np.ndarray  # (1 + lexicon, languages); the first row is for other words
    moves: np.ndarray  # (languages, languages), from and to

    def lexical_rows(self, words: Words) -> np.ndarray:
        keys = word_keys(words)
        at = np.minimum(np.searchsorted(self.lexicon, keys), max(len(self.lexicon) - 1, 0))
        return np.where(self.lexicon[at] == keys, at + 1, 0) if len(self.lexicon) else np.zeros(len(keys), np.int64)

    def evidence(self, words: Words) -> np.ndarray:
        """Weights of all features of every word, summed up per language."""
        out = self.lexical[self.lexical_rows(words)].astype(np.float32)
        if len(words.starts):
            for k, order in enumerate(ORDERS):
                rows = self.grams[k].take(gram_buckets(words, order, self.bits), axis=0)
                out += np.add.reduceat(rows, words.starts, axis=0)
        return out


def marginal_sums(
    evidence: np.ndarray, counts: np.ndarray, moves: np.ndarray, each: bool = False, kind: type = np.float64,
    messages: bool = False,
) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """Sum over the words of every text of their probabilities of each language.

    Forward-backward over blocks of words, all blocks of a batch side by side: first the
    product of each block's steps, then the messages between the blocks of a text, then the
    words inside the blocks. With ``each`` the probabilities of every word instead; with ``messages`` what
    comes to every word from before (its own evidence included) and from behind.
    """
    langs = moves.shape[0]
    step = np.exp(moves - moves.max()).astype(kind)
    lots = -(-counts // BLOCK)
    first = np.cumsum(lots) - lots
    total = int(lots.sum())
    if not total:
        none = np.zeros((0, langs))
        return (none, none) if messages else none if each else np.zeros((len(counts), langs))
    texts = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(texts)) - np.repeat(np.cumsum(counts) - counts, counts)
    row, column = first[texts] + place // BLOCK, place % BLOCK
    factor = np.ones((total, BLOCK, langs), kind)
    factor[row, column] = np.exp(np.maximum(evidence - evidence.max(axis=1, keepdims=True), -60))
    there = np.zeros((total, BLOCK), bool)
    there[row, column] = True

    product = np.broadcast_to(np.eye(langs, dtype=kind), (total, langs, langs)).copy()
    for t in range(BLOCK):
        moved = (product.reshape(-1, langs) @ step).reshape(total, langs, langs) * factor[:, t, None, :]
        moved /= moved.max(axis=(1, 2), keepdims=True)
        product = np.where(there[:, t, None, None], moved, product)
    enter, leave = np.empty((total, langs), kind), np.empty((total, langs), kind)
    now = np.full((len(counts), langs), 1 / langs, kind)
    for k in range(int(lots.max())):
        on = np.flatnonzero(lots > k)
        enter[first[on] + k] = now[on]
        now[on] = np.einsum("ni,nij->nj", now[on], product[first[on] + k])
        now[on] /= now[on].sum(axis=1, keepdims=True)
    now = np.full((len(counts), langs), 1 / langs, kind)
    for k in range(int(lots.max()) - 1, -1, -1):
        on = np.flatnonzero(lots > k)
        leave[first[on] + k] = now[on]
        now[on] = np.einsum("nij,nj->ni", product[first[on] + k], now[on])
        now[on] /= now[on].sum(axis=1, keepdims=True)
    forward = np.empty((total, BLOCK, langs), kind)
    ahead = enter
    for t in range(BLOCK):
        moved = (ahead @ step) * factor[:, t]
        ahead = np.where(there[:, t, None], moved / moved.sum(axis=1, keepdims=True), ahead)
        forward[:, t] = ahead
    back = leave
    sums = np.zeros((total, langs))
    behind = np.empty_like(forward) if messages else None
    for t in range(BLOCK - 1, -1, -1):
        if messages:
            behind[:, t] = back
        both = forward[:, t] * back
        both /= both.sum(axis=1, keepdims=True)
        both[~there[:, t]] = 0
        sums += both
        if each:
            forward[:, t] = both
        moved = (factor[:, t] * back) @ step.T
        back = np.where(there[:, t, None], moved / moved.sum(axis=1, keepdims=True), back)
    if messages:
        return forward[row, column], behind[row, column]
    if each:
        return forward[row, column]
    out = np.zeros((len(counts), langs))
    np.add.at(out, np.repeat(np.arange(len(counts)), lots), sums)
    return out


def slopes(
    evidence: np.ndarray, counts: np.ndarray, gold: np.ndarray, moves: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """How the log-likelihood of ``gold`` changes with every word's evidence, and with the moves.

    What was seen less what is expected. Expected moves are the probabilities of pairs of neighbours, from the
    messages before the first and behind the second. Before its first word a text is in any language,
    as ``marginal_sums`` has it; that move is seen in part only, and counted by its probability.
    """
    before, behind = marginal_sums(evidence, counts, moves, messages=True)
    seen = before * behind
    error = -seen / seen.sum(axis=1, keepdims=True)
    error[np.arange(len(gold)), gold] += 1
    step = np.exp(moves - moves.max())
    own = np.exp(np.maximum(evidence - evidence.max(axis=1, keepdims=True), -60)) * behind
    ends = np.cumsum(counts)
    inner = np.ones(len(gold), bool)
    inner[ends[counts > 0] - 1] = False
    at = np.flatnonzero(inner)
    pairs = before[at, :, None] * step[None] * own[at + 1, None, :]
    first = (ends - counts)[counts > 0]
    opened = step[None] * own[first, None, :]
    moved = np.zeros_like(moves)
    for joint in (pairs, opened):
        moved -= (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    np.add.at(moved, (gold[at], gold[at + 1]), 1)
    moved += (step / step.sum(axis=0)) * np.bincount(gold[first], minlength=len(moves))
    return error, moved


def fit(texts: list[str], labels: list[str], seed: int = 7, epochs: int = 8) -> Field:
    """A field from labelled texts, in any order of the rows the same."""
    langs = sorted(set(labels))
    size = len(langs)
    bits = 18
    while len(ORDERS) * size * 4 << bits > WEIGHT_BYTES and bits > 10:
        bits -= 1
    order = sorted(range(len(texts)), key=lambda i: (labels[i], texts[i]))
    texts, labels = [texts[i] for i in order], [labels[i] for i in order]
    tables = _tables()
    words = cut_words(texts, tables)
    keys = word_keys(words)
    ends = np.cumsum(words.counts)
    lexicon: set[int] = set()
    for lang in langs:
        seen: Counter[int] = Counter()
        for i in (i for i, x in enumerate(labels) if x == lang):
            seen.update(set(keys[ends[i] - words.counts[i] : ends[i]].tolist()))
        lexicon.update(k for k, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:LEXICON])
    field = Field(
        langs, bits, np.zeros((len(ORDERS), (1 << bits) + 1, size), np.float32), np.array(sorted(lexicon), np.uint64),
        np.zeros((1 + len(lexicon), size), np.float32), np.zeros((size, size)),
    )
    if size < 2 or not len(keys):
        return field
    # The words are strung together in pieces of 3 to 30, mostly several of one text.
    random = np.random.default_rng(seed)
    pieces = []
    for i in range(len(texts)):
        at, stop = ends[i] - words.counts[i], ends[i]
        while at < stop:
            upto = min(stop, at + int(random.integers(3, 31)))
            pieces.append((at, upto, langs.index(labels[i])))
            at = upto
    random.shuffle(pieces)
    truth = np.concatenate([np.full(b - a, k) for a, b, k in pieces])
    chain = np.concatenate([np.arange(a, b) for a, b, _ in pieces])
    rows = field.lexical_rows(words)
    buckets = []
    for n in ORDERS:
        found = gram_buckets(words, n, bits)
        inside = found < 1 << bits
        buckets.append((found[inside], words.owner[inside]))
    length = 60
    lines = np.array_split(np.arange(len(chain)), max(1, len(chain) // length))
    batches = []
    for some in np.array_split(np.arange(len(lines)), min(len(lines), 12)):
        held = np.concatenate([lines[i] for i in some])
        used = chain[held]
        local = np.full(len(rows), -1)
        local[used] = np.arange(len(used))
        features = []
        for found, owner in buckets:
            mine = local[owner]
            features.append((found[mine >= 0], mine[mine >= 0]))
        batches.append((np.array([len(lines[i]) for i in some]), truth[held], rows[used], features))
    squares = [np.full_like(x, 1e-6) for x in (field.grams, field.lexical, field.moves)]
    for _ in range(epochs):
        for counts, gold, lexical, features in batches:
            evidence = field.lexical[lexical].astype(np.float64)
            for k, (found, owner) in enumerate(features):
                for j in range(size):
                    evidence[:, j] += np.bincount(owner, field.grams[k][found, j], len(gold))
            error, moved = slopes(evidence, counts, gold, field.moves)
            turns = [np.zeros_like(field.grams), np.zeros_like(field.lexical), moved / len(gold)]
            for j in range(size):
                turns[1][:, j] = np.bincount(lexical, error[:, j], len(field.lexical)) / len(gold)
                for k, (found, owner) in enumerate(features):
                    turns[0][k, :, j] = np.bincount(found, error[owner, j], (1 << bits) + 1) / len(gold)
            for weight, square, slope in zip((field.grams, field.lexical, field.moves), squares, turns):
                square += slope**2
                weight += (0.2 * slope / np.sqrt(square)).astype(weight.dtype)
    return field


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def learn(documents: DataFrame) -> Field | None:
    """The field of the labelled rows of ``documents(doc_id, text, lang)``; None without any."""
    return _unpacked(learn_packed(documents))


def learn_packed(documents: DataFrame) -> bytes | None:
    """What ``learn`` finds, packed: most weights are zeros, so that it takes a fraction of their bytes.

    At most ``SAMPLE_TEXTS`` rows per language, those of the smallest hash of the id; their texts are whole.
    One task fits it: the driver passes it on as it is, and keeps nothing of what a fit holds on the way.
    """
    rows = documents.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text"))
    chosen = (
        rows.select("doc_id", "lang", "text")
        .withColumn("rank", rank).where(F.col("rank") <= SAMPLE_TEXTS)
        .select("text", "lang")
    )
    found = chosen.repartition(1).mapInArrow(_fitted, "field binary").collect()
    return bytes(found[0].field) if found else None


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for batch in batches:
        texts += batch["text"].to_pylist()
        labels += batch["lang"].to_pylist()
    if texts:
        packed = zlib.compress(pickle.dumps(fit(texts, labels)), 1)
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["field"])


def _unpacked(packed: bytes | None) -> Field | None:
    return None if packed is None else pickle.loads(zlib.decompress(packed))


def label(documents: DataFrame, packed: bytes | None, keep: str = "doc_id") -> DataFrame:
    """``keep, lang_pred, score`` for ``documents(keep, text)``, by the field that ``learn_packed`` found."""
    kind = documents.schema[keep].dataType.simpleString()
    names = [keep, "lang_pred", "score"]
    held = documents.sparkSession.sparkContext.broadcast(packed)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables()
        known = _unpacked(held.value)
        for batch in sliced(batches):
            best, scores = [], []
            for part in parts(batch["text"].to_pylist(), PART):
                words = cut_words(part, tables)
                if known is None:
                    best += [UNDETERMINED] * len(part)
                    scores += [0.0] * len(part)
                    continue
                sums = marginal_sums(known.evidence(words), words.counts, known.moves, kind=np.float32)
                for total, count in zip(sums, words.counts):
                    top = int(total.argmax())
                    best.append(known.langs[top] if count else UNDETERMINED)
                    scores.append(float(min(1.0, total[top] / count)) if count else 0.0)
            yield pa.RecordBatch.from_arrays([batch[keep], pa.array(best, pa.string()), pa.array(scores, pa.float64())], names)

    return documents.select(keep, "text").mapInArrow(labelled, f"{keep} {kind}, lang_pred string, score double")


def predict_language(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``documents(doc_id, text, lang)``.

    ``score`` is the share of the words that are of the predicted language, by expectation.
    Null texts and texts without a letter are ``und`` with score 0, as is every text where
    no row can be learned from. Rows of a null ``lang`` are not learned from; a null
    ``doc_id`` counts as empty text in the split. Ties go to the language that sorts first.
    Repeated rows are labelled one by one; an empty table gives an empty result; extra
    columns are not read.
    """
    docs = documents.select("doc_id", "text", "lang")
    found = label(docs, learn_packed(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_determined(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents of which most words are of one language; all their columns.

    A document is rejected if it has no letter, or if no language has ``least`` of its words.
    Null texts have none, so they go. Rows that repeat a ``doc_id`` stay if one of them does; rows without an id are
    judged by their own text. An empty table gives an empty result.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.sha2("text", 256))
    docs = documents.select("doc_id", "text", "lang")
    found = label(docs.select(key.alias("doc_id"), "text"), learn_packed(docs))
    good = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)
    # Fewer than those that stay. A row without id and text has no key, and goes.
    verdicts = found.groupBy("doc_id").agg(F.max(good).alias("good"))
    rejected = materialised(verdicts.where(~F.col("good") | F.col("doc_id").isNull()).select("doc_id"), "rejected")
    rows = whole_rows(documents, "doc_id", "text").select("row", key.alias("doc_id"))
    return rows_with(rows, rejected, "left_anti").select("row.*")
