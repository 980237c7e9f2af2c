"""Toxic documents: a learned lexicon, matched with spelling errors, weighed in context.

The lexicon (words, and stems that carry many endings) is learned from labelled rows. It
is kept as a trie, and run against the Levenshtein automaton of each of its entries at
once: the set of trie nodes and errors that a spelling can have reached is one state of a
deterministic automaton, made when first needed. A match counts by the other matches near
it, and less where quotation marks or words of reporting frame it. A logistic regression
on what a document gathers gives its score.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bound of what is learned from: rows per label, whole texts of each.
SAMPLE_ROWS = 3_000
# Words on either side that are the context of a match.
REACH = 8
# An entry is this many times as frequent in toxic rows, beyond what chance explains (as a
# logarithm of the likelihood ratio, since some hundred thousand words are tried).
RATIO = 20.0
EVIDENCE = 12.0
# An entry that this many ordinary words resemble is matched without errors.
NEIGHBOURS = 2
# What a spelling error leaves of a match.
DOUBT = 0.6

QUOTES = frozenset("\"“”„«»‘‚›‹")
# Words that report what others say, in the languages of the corpus.
REPORTING = frozenset(
    "said says say wrote writes called calls quote quoted quotes term word phrase insult insults"
    " sagte sagt schrieb nannte zitat wort begriff beleidigung"
    " dit disait écrit appelé citation mot terme insulte"
    " dijo dice escribió llamó cita palabra término insulto".split()
)
ADDRESS = frozenset("you your yours you're ur du dich dir dein deine euch tu toi te ton ta vous tú ti usted vosotros".split())
# Digits and marks that stand for letters.
LOOKALIKES = str.maketrans("013457@$", "oieastas")
STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "@$") + "“”„«»‘’‚›‹…¿¡"

# Means of the prior of the weights: constant, strongest window; matches and spelling
# errors outside it; quoted matches, matches near an address.
PRIOR = np.array([-3.0, 1.5, 1.5, 1.0, -0.5, 0.5])


@dataclass(frozen=True)
class Entry:
    stem: bool
    weight: float
    errors: int


def errors_allowed(entry: str) -> int:
    """One error from 5 letters on, two from 9 on."""
    return 0 if len(entry) < 5 else 1 if len(entry) < 9 else 2


class Automaton:
    """Spellings within the allowed errors of an entry; a stem also takes any ending.

    ``match`` gives the weight and the errors of the best match of a word, or None.
    """

    def __init__(self, entries: dict[str, Entry]):
        # A trie for each number of allowed errors; nodes are numbers.
        self.next: list[dict[str, int]] = [{}]
        self.ends: dict[int, tuple[str, Entry]] = {}
        roots: dict[int, int] = {}
        for spelling in sorted(entries):
            entry = entries[spelling]
            if entry.errors not in roots:
                roots[entry.errors] = self._node()
            at = roots[entry.errors]
            for letter in spelling:
                if letter not in self.next[at]:
                    self.next[at][letter] = self._node()
                at = self.next[at][letter]
            self.ends[at] = (spelling, entry)
        start = self._closed({(root, allowed): allowed for allowed, root in roots.items()})
        self.alphabet = frozenset("".join(entries))
        self.numbers: dict[frozenset, int] = {frozenset(): 0, start: 1}
        self.states = [frozenset(), start]
        self.moves: list[dict[str, int]] = [{}, {}]
        self.found = [None, self._best(start, False)]
        self.caught = [None, self._best(start, True)]

    def _node(self) -> int:
        self.next.append({})
        return len(self.next) - 1

    def _closed(self, left: dict[tuple[int, int], int]) -> frozenset:
        """With the nodes reached by leaving letters out. Keys: node, errors allowed; values: left."""
        waiting = list(left.items())
        while waiting:
            (node, allowed), rest = waiting.pop()
            if rest:
                for child in self.next[node].values():
                    if left.get((child, allowed), -1) < rest - 1:
                        left[child, allowed] = rest - 1
                        waiting.append(((child, allowed), rest - 1))
        return frozenset((node, allowed, rest) for (node, allowed), rest in left.items())

    def _best(self, state: frozenset, stems: bool) -> tuple[float, int] | None:
        ends = [
            (self.ends[node][1].weight * DOUBT ** (allowed - rest), allowed - rest)
            for node, allowed, rest in state
            if node in self.ends and (not stems or self.ends[node][1].stem)
        ]
        return max(ends, key=lambda x: (x[0], -x[1]), default=None)

    def _step(self, number: int, letter: str) -> int:
        left: dict[tuple[int, int], int] = {}

        def reach(node: int, allowed: int, rest: int) -> None:
            if left.get((node, allowed), -1) < rest:
                left[node, allowed] = rest

        for node, allowed, rest in self.states[number]:
            child = self.next[node].get(letter)
            if child is not None:
                reach(child, allowed, rest)
            if rest:
                reach(node, allowed, rest - 1)
                for other in self.next[node].values():
                    reach(other, allowed, rest - 1)
        state = self._closed(left)
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            self.found.append(self._best(state, False))
            self.caught.append(self._best(state, True))
        return self.numbers[state]

    def run(self, word: str) -> tuple[int, tuple[float, int] | None]:
        """The state after a word (0 if none is left), and the best stem on the way."""
        at, best = 1, None
        for letter in word:
            # Letters of no entry all do the same.
            if letter not in self.alphabet:
                letter = ""
            after = self.moves[at].get(letter)
            if after is None:
                after = self.moves[at][letter] = self._step(at, letter)
            at = after
            if at == 0:
                break
            stem = self.caught[at]
            if stem is not None and (best is None or stem > best):
                best = stem
        return at, best

    def match(self, word: str) -> tuple[float, int] | None:
        at, best = self.run(word)
        end = self.found[at]
        return end if best is None or (end is not None and end > best) else best

    def misspelled(self, word: str) -> list[str]:
        """Entries that a word matches with errors."""
        return [
            self.ends[node][0] for node, allowed, rest in self.states[self.run(word)[0]]
            if rest < allowed and node in self.ends
        ]


def cores(token: str) -> list[str]:
    """Spellings that a token, split off at white space and in lower case, may stand for."""
    core = token.strip(STRIP)
    plain = core.translate(LOOKALIKES)
    return [core] if plain == core or not any(c.isalpha() for c in core) else [core, plain]


@dataclass
class Model:
    entries: dict[str, Entry]
    ordinary: frozenset
    weights: np.ndarray

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    """Scores texts; remembers the tokens it has seen."""

    def __init__(self, model: Model, room: int = 500_000):
        self.model, self.room = model, room
        self.automaton = Automaton(model.entries)
        self.known: dict[str, tuple[float, int] | None] = {}

    def _hit(self, token: str) -> tuple[float, int] | None:
        """Best match of a token; words that are ordinary are no misspellings."""
        best = None
        for core in cores(token):
            found = self.automaton.match(core)
            if found and (not found[1] or core not in self.model.ordinary) and (best is None or found > best):
                best = found
        return best

    def hit(self, token: str) -> tuple[float, int] | None:
        known = self.known
        if token not in known:
            if len(known) >= self.room:
                known.clear()
            known[token] = self._hit(token)
        return known[token]

    def features(self, text: str | None) -> np.ndarray:
        tokens = (text or "").lower().split()
        hits = {t: found for t in set(tokens) if (found := self.hit(t))}
        out = np.zeros(len(PRIOR))
        out[0] = 1
        if not hits:
            return out
        places = [i for i, t in enumerate(tokens) if t in hits]
        # For each match: its strength in its context, and what it adds elsewhere.
        strength: list[float] = []
        kinds: list[tuple[float, float, float, float]] = []
        for i in places:
            before = tokens[max(0, i - REACH) : i]
            after = tokens[i + 1 : i + 1 + REACH]
            opened = sum(c in QUOTES for t in before for c in t) % 2 == 1 or tokens[i][0] in QUOTES
            closed = any(c in QUOTES for t in after for c in t) or tokens[i][-1] in QUOTES
            reported = any(t.strip(STRIP) in REPORTING for t in before[-4:])
            framed = (opened and closed) or reported
            addressed = any(t.strip(STRIP) in ADDRESS for t in before + after)
            weight, errors = hits[tokens[i]]
            strength.append(weight * (0.3 if framed else 1.0))
            kinds.append((
                weight * (not framed and not errors), weight * (not framed and errors > 0),
                weight * framed, weight * addressed,
            ))
        windows = [_around(places, k) for k in range(len(places))]
        near = [
            sum(s * 0.9 ** abs(p - places[k]) for s, p in zip(strength[lo:hi], places[lo:hi]))
            for k, (lo, hi) in enumerate(windows)
        ]
        best = max(range(len(near)), key=near.__getitem__)
        lo, hi = windows[best]
        rest = kinds[:lo] + kinds[hi:]
        exact, wrong = (sum(k[i] for k in rest) for i in (0, 1))
        quoted, addressed = (sum(k[i] for k in kinds) for i in (2, 3))
        out[1:] = math.log1p(near[best]), math.log1p(exact), math.log1p(wrong), math.log1p(quoted), math.log1p(addressed)
        return out

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.model.weights, -30, 30))))


def _around(places: list[int], k: int) -> tuple[int, int]:
    """Range of the matches at most ``REACH`` words from the ``k``-th."""
    lo = hi = k
    while lo and places[k] - places[lo - 1] <= REACH:
        lo -= 1
    while hi < len(places) and places[hi] - places[k] <= REACH:
        hi += 1
    return lo, hi


def learn_lexicon(texts: list[str], toxic: list[int]) -> tuple[dict[str, Entry], frozenset]:
    """Entries, and the ordinary words that are not taken for their misspellings.

    Words and stems that are much more frequent in toxic rows, by weight: the logarithm of
    how much more. A stem has at least four endings, and a longer one weighs more than those
    it begins with, or is left out.
    """
    size = (sum(1 - y for y in toxic) or 1, sum(toxic) or 1)
    share = size[1] / sum(size)
    # Fewer rows cannot be evidence enough. What is counted is kept small: first all of the
    # toxic rows, then only what might become an entry.
    least = EVIDENCE / -math.log(share) if share < 1 else 1

    def rows(label: int) -> Iterator[set[str]]:
        for text, y in zip(texts, toxic):
            if y == label:
                yield {c for t in set(text.lower().split()) if len(c := t.strip(STRIP)) > 2 and c.isalpha()}

    def keys(words: set[str]) -> Iterator[str]:
        """Words, and stems with a mark behind."""
        yield from words
        yield from {w[:n] + "*" for w in words for n in range(4, min(len(w), 9))}

    counted: Counter[str] = Counter()
    for words in rows(1):
        counted.update(keys(words))
    found = {key: n for key, n in counted.items() if n >= least}
    longer: Counter[str] = Counter()
    for key, n in counted.items():
        if key[-1] == "*":
            longer[key[:-2] + "*"] = max(longer[key[:-2] + "*"], n)
    # A stem that nearly always goes on with the same letter is only a part of one.
    found = {key: n for key, n in found.items() if key[-1] != "*" or longer[key] < 0.95 * n}
    del counted, longer
    endings: dict[str, set[str]] = {key: set() for key in found if key[-1] == "*"}
    for words in rows(1):
        for word in words:
            for n in range(4, min(len(word), 9)):
                known = endings.get(word[:n] + "*")
                if known is not None and len(known) < 4:
                    known.add(word)
    clean: Counter[str] = Counter()
    ordinary: set[str] = set()
    for words in rows(0):
        clean.update(key for key in keys(words) if key in found)
        ordinary |= words
    able: dict[tuple[str, bool], float] = {}
    for key, n in found.items():
        stem = key[-1] == "*"
        ratio = ((n + 0.5) / (size[1] + 1)) / ((clean[key] + 0.5) / (size[0] + 1))
        if ratio < RATIO or (stem and len(endings[key]) < 4):
            continue
        part = n / (n + clean[key])
        evidence = n * math.log(part / share)
        if clean[key]:
            evidence += clean[key] * math.log((1 - part) / (1 - share))
        if evidence >= EVIDENCE:
            able[key.rstrip("*"), stem] = min(math.log(ratio), 6.0)
    entries: dict[str, Entry] = {}
    # Stems before words, short before long.
    for (spelling, stem), weight in sorted(able.items(), key=lambda x: (not x[0][1], len(x[0][0]), x[0])):
        within = [e.weight for n in range(4, len(spelling) + 1) if (e := entries.get(spelling[:n])) and e.stem]
        if not within or weight > max(within) + 0.5:
            entries[spelling] = Entry(stem, weight, 0 if stem else errors_allowed(spelling))
    automaton = Automaton(entries)
    alike: dict[str, set[str]] = defaultdict(set)
    for word in ordinary:
        for spelling in automaton.misspelled(word):
            alike[spelling].add(word)
    for spelling, words in alike.items():
        if len(words) > NEIGHBOURS:
            entries[spelling] = Entry(entries[spelling].stem, entries[spelling].weight, 0)
    return entries, frozenset(w for s, words in alike.items() for w in words if entries[s].errors)


def fit(texts: list[str], toxic: list[int]) -> Model:
    """A model from labelled texts, in any order of the rows the same."""
    order = sorted(range(len(texts)), key=lambda i: (toxic[i], texts[i]))
    texts, toxic = [texts[i] for i in order], [toxic[i] for i in order]
    # Copies repeat what is chance: of texts with the same smallest hash of a word one is learned from.
    first: dict[tuple[int, int], int] = {}
    for i, (text, label) in enumerate(zip(texts, toxic)):
        least = min((zlib.crc32(w.encode("utf-8", "replace")) for w in set(text.lower().split())), default=0)
        first.setdefault((label, least), i)
    entries, ordinary = learn_lexicon([texts[i] for i in first.values()], [toxic[i] for i in first.values()])
    matcher = Matcher(Model(entries, ordinary, PRIOR))
    x = np.array([matcher.features(t) for t in texts]).reshape(-1, len(PRIOR))
    y = np.array(toxic, float)
    # Newton steps on the likelihood and the prior, halved until they gain; both labels
    # weigh the same.
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y) if len(y) else y

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(share @ (np.logaddexp(0, z) - y * z)) + 0.5 * float(((w - PRIOR) ** 2).sum())

    free = np.ones(len(PRIOR), bool)
    while True:
        weights = np.where(free, PRIOR, 0.0)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            slope = (x.T @ (share * (y - p)) - (weights - PRIOR))[free]
            bend = ((x.T * (share * p * (1 - p))) @ x + np.eye(len(PRIOR)))[np.ix_(free, free)]
            step = np.zeros(len(PRIOR))
            step[free] = np.linalg.solve(bend, slope)
            for _ in range(20):
                if loss(weights + step) <= loss(weights):
                    weights = weights + step
                    break
                step = step / 2
        # A match never speaks against toxicity: what would is left out.
        wrong = free & (PRIOR > 0) & (weights < 0)
        if not wrong.any():
            break
        free &= ~wrong
    return Model(entries, ordinary, weights)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def learn(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled rows outside the fold: ``SAMPLE_ROWS`` of each label at most.

    The rows are those of the smallest hash of the id. A document labelled both ways
    counts as toxic.
    """
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    first = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        some = rows.where(F.col("toxic") == value).orderBy(*first).limit(SAMPLE_ROWS)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most two times SAMPLE_ROWS ids are broadcast.
    texts = documents.select("doc_id", "text").where("text is not null")
    found = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic").toArrow()
    return fit(found["text"].to_pylist(), found["toxic"].to_pylist())


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``documents(doc_id, text)``.

    Null and empty texts get the score of a text without a match. Null labels are not
    learned from, and without any labelled row the prior decides; a null ``doc_id`` counts
    as empty text in the split. Repeated rows are scored one by one. An empty table gives
    an empty result; extra columns are not read.
    """
    docs = documents.select("doc_id", "text")
    held = documents.sparkSession.sparkContext.broadcast(learn(docs, labels.select("doc_id", "toxic")))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = held.value.matcher()
        for batch in batches:
            scores = pa.array([matcher.score(t) for t in batch["text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], scores], ["doc_id", "score"])

    found = docs.mapInArrow(scored, f"doc_id {kind}, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
