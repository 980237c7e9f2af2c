"""The whole model, from count lines or running text to probabilities."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trigramma.functions.scalar import HEBREW, ieee_divide, interpolate, only_letters
from trigramma.functions.stopwords import HEBREW_STOPWORDS
from trigramma.operators.counts import WORDS, trigram_sums
from trigramma.operators.filters import filter_alphabet, filter_arity, filter_stopwords, no_stopword, stop_list
from trigramma.operators.joins import trigram_statistics
from trigramma.operators.ranking import rank_model, top_next_words
from trigramma.sources.readers import parse_ngrams, to_trigram, trigrams_of_words
from trigramma.session import materialised, run_folder
from trigramma.sources.writers import stage_record, write_ranked_text, write_stage

COUNTS = ("n1", "n2", "n3", "c0", "c1", "c2")


class RunCounts:
    """Records that a run passes on, counted by the run itself.

    ``get`` waits for the run to have read its lines; ``lines, bad lines, kept rows,
    trigrams``. Give a new one to every run. A run that goes on from a finished stage reads no
    lines; it has the counts that the stage was written with.
    """

    def __init__(self):
        self.names = ("lines", "bad lines", "kept rows", "trigrams")
        self.seen: dict[str, Observation] = {}
        self.used: list[str] = []
        self.kept: dict[str, int] | None = None

    def count(self, df: DataFrame, *names: str, bad: str | None = None) -> DataFrame:
        """``df`` with its rows counted under ``names``, those of one place in one pass."""
        self.used += names
        place = Observation()
        self.seen |= dict.fromkeys(names, place)
        which = {name: F.count_if(F.col(bad).isNull()) if name == "bad lines" else F.count(F.lit(1)) for name in names}
        return df.observe(place, *[asked.alias(name) for name, asked in which.items()])

    def get(self) -> dict[str, int]:
        if self.kept is None:
            # Only what is counted somewhere in the plan will ever come.
            self.kept = {name: self.seen[name].get[name] for name in self.names if name in self.used}
        return self.kept

    def restore(self, kept: dict[str, int]) -> None:
        """The counts of the run that wrote a stage, in place of those of a run that reads it."""
        missing = [name for name in self.used if name not in kept]
        if missing:
            raise ValueError(f"the stage was written without counting {', '.join(missing)}")
        self.kept = kept


def kept_rows(
    lines: DataFrame,
    stop: DataFrame | Iterable[str] = HEBREW_STOPWORDS,
    letters: str = HEBREW,
    on_bad: str = "fail",
    seen: RunCounts | None = None,
) -> DataFrame:
    """Count lines that pass all filters, as ``w1, w2, w3, cnt``."""
    if seen:
        # Bad lines are counted before they go.
        parsed = seen.count(
            parse_ngrams(lines, "fail" if on_bad == "fail" else "quarantine"), "lines", "bad lines", bad="cnt"
        )
        if on_bad != "fail":
            parsed = parsed.where(F.col("cnt").isNotNull()).drop("bad_record")
    else:
        parsed = parse_ngrams(lines, on_bad)
        if on_bad == "quarantine":
            parsed = parsed.where(F.col("bad_record").isNull()).drop("bad_record")
    rows = kept_ngrams(parsed, stop, letters)
    return seen.count(rows, "kept rows") if seen else rows


def kept_ngrams(
    parsed: DataFrame, stop: DataFrame | Iterable[str] = HEBREW_STOPWORDS, letters: str = HEBREW
) -> DataFrame:
    """Parsed lines ``ngram, cnt`` that pass all filters, as ``w1, w2, w3, cnt``."""
    return filter_stopwords(to_trigram(filter_arity(filter_alphabet(parsed, letters))), stop)


def kept_text_rows(
    texts: DataFrame, stop: DataFrame | Iterable[str] = HEBREW_STOPWORDS, letters: str = HEBREW
) -> DataFrame:
    """Trigrams of a ``text`` column that pass the filters.

    The alphabet and a list of stop words are asked of the words of a text, a stop table of the trigrams.
    """
    listed = [] if isinstance(stop, DataFrame) else stop_list(stop)

    def wanted(word: Column) -> Column:
        kept = only_letters(word, letters)
        return kept & no_stopword(word, listed) if listed else kept

    rows = trigrams_of_words(texts.select("text"), wanted)
    return filter_stopwords(rows, stop) if isinstance(stop, DataFrame) else rows


def add_probability(statistics: DataFrame, undefined: str = "nan") -> DataFrame:
    """Statistics with ``p``; an undefined value stays NaN, becomes NULL or is dropped.

    Dropping tests the first ratio on its own as well: its two counts are known
    after one join, and rare pairs, whose count is rounded down to 0, then go
    before the second.
    """
    if undefined not in ("nan", "null", "drop"):
        raise ValueError(f"undefined is nan, null or drop, not {undefined!r}")
    if undefined == "drop":
        statistics = statistics.where(~F.isnan(ieee_divide(F.col("n3"), F.col("c2"))))
    model = statistics.withColumn("p", interpolate(*[F.col(c) for c in COUNTS]))
    if undefined == "drop":
        return model.where(~F.isnan("p"))
    if undefined == "null":
        return model.withColumn("p", F.nanvl("p", F.lit(None).cast("double")))
    return model


def model_of(
    rows: DataFrame,
    undefined: str = "nan",
    wanted: DataFrame | None = None,
    stage_dir: str | None = None,
    stage_key: str | None = None,
    seen: RunCounts | None = None,
) -> DataFrame:
    """Kept rows to ``w1, w2, w3``, their statistics and ``p``.

    The corpus is read once. Its trigram sums feed the pair and word counts,
    the total and the joins, so they are written to the shared folder first: a
    lost executor then costs no second reading of the corpus, and the joins are
    planned with the real size of the table. The rest is one lazy plan.

    With ``stage_dir`` the sums and the statistics are kept there under their
    own names. A second start with the same ``stage_key``, the caller's name for the input
    and its filters, goes on from the stages that are complete, and ``seen`` then has the counts of the
    run that wrote them; a start with another key, or without one, fails where anything exists.
    """
    sums = trigram_sums(rows)
    if seen:
        sums = seen.count(sums, "trigrams")
    if stage_dir:
        path = f"{stage_dir}/trigram_sums"
        sums = write_stage(sums, path, stage_key, seen.get if seen else None)
        if seen:
            seen.restore(stage_record(sums.sparkSession, path)["facts"])
    else:
        sums = materialised(sums, "trigram_sums")
    statistics = trigram_statistics(sums, wanted)
    if stage_dir:
        statistics = write_stage(statistics, f"{stage_dir}/trigram_statistics", stage_key)
    return add_probability(statistics, undefined)


def build_model(
    lines: DataFrame,
    stop: DataFrame | Iterable[str] = HEBREW_STOPWORDS,
    letters: str = HEBREW,
    order: str | None = "documented",
    on_bad: str = "fail",
    undefined: str = "nan",
    stage_dir: str | None = None,
    stage_key: str | None = None,
    seen: RunCounts | None = None,
) -> DataFrame:
    """Count lines to the ranked table ``w1, w2, w3, p``; ``order=None`` leaves it unsorted."""
    rows = kept_rows(lines, stop, letters, on_bad, seen)
    model = model_of(rows, undefined, None, stage_dir, stage_key, seen).select("w1", "w2", "w3", "p")
    return model if order is None else rank_model(model, order)


def write_model_text(
    lines: DataFrame,
    path: str,
    stop: DataFrame | Iterable[str] = HEBREW_STOPWORDS,
    letters: str = HEBREW,
    order: str = "documented",
    on_bad: str = "fail",
    undefined: str = "nan",
    seen: RunCounts | None = None,
) -> None:
    """Count lines to ranked text files in ``path``; the tables written on the way are gone afterwards."""
    with run_folder(lines.sparkSession, "model"):
        model = build_model(lines, stop, letters, order, on_bad, undefined, seen=seen)
        write_ranked_text(model, path, order=order)


def predict_from_rows(rows: DataFrame, pairs: DataFrame, k: int = 5) -> DataFrame:
    """The best ``k`` next words of the given pairs, straight from kept rows.

    The whole corpus is counted, but only trigrams of the pairs go into the
    joins. To ask a finished model, use ``predict``.
    """
    return top_next_words(model_of(rows, "drop", wanted=pairs), k)


def stage_row_counts(rows: DataFrame) -> DataFrame:
    """Records each stage passes on, as ``stage, records``, from one reading of the corpus.

    Every kept row makes seven records, three words, two pairs, a trigram and
    its share of the total; every distinct trigram asks for four statistics.
    """
    one = F.count(F.lit(1))
    sums = materialised(rows.groupBy(*WORDS).agg(one.alias("kept")), "trigram_sums")
    totals = sums.agg(F.coalesce(F.sum("kept"), F.lit(0)).alias("kept"), one.alias("trigrams"))
    # Only numbers are asked for, so pairs and words are looked at without their sums. A word is one of a whole pair.
    w1, w2, w3 = map(F.col, WORDS)
    pairs = F.array(F.struct(w1.alias("a"), w2.alias("b")), F.struct(w2.alias("a"), w3.alias("b")))
    words = F.array(F.when(w2.isNotNull(), w1), F.when(w1.isNotNull() | w3.isNotNull(), w2), F.when(w2.isNotNull(), w3))
    distinct = {
        "unigrams": sums.select(F.explode(words).alias("w")).where(F.col("w").isNotNull()),
        "bigrams": sums.select(F.inline(pairs)).where(F.col("a").isNotNull() & F.col("b").isNotNull()),
    }
    for name, keys in distinct.items():
        totals = totals.withColumn(name, keys.distinct().agg(one).scalar())
    return totals.selectExpr(
        "stack(7, 'kept rows', kept, 'count records', 7 * kept, 'unigrams', unigrams,"
        " 'bigrams', bigrams, 'trigrams', trigrams,"
        " 'join records', unigrams + bigrams + 4 * trigrams,"
        " 'statistics records', 4 * trigrams) AS (stage, records)"
    )
