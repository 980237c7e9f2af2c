"""

The test tables hold running text in Latin letters, so the queries use the
letters a-z and a short stop list in place of the Hebrew defaults, and give
every occurrence the count 1. Undefined probabilities are NULL here, and
probabilities are rounded to twelve places, so that both engines can be
compared by value.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trigramma.functions.scalar import (
    confidence,
    ieee_divide,
    ngram_order,
    ngram_words,
    phrase,
    split_phrase,
)
from trigramma.functions.sql import register_functions
from trigramma.operators import counts, joins, ranking
from trigramma.operators.filters import filter_alphabet, filter_arity, filter_stopwords
from trigramma.plans import model as plans
from trigramma.session import materialised, scratch_path
from trigramma.sources import readers, writers

# The text operators and their pipeline are an addition that may be absent.
try:
    import corpus_pipeline as _pipeline
    from trigramma.llm import oracle as _llm_oracle
    from trigramma.llm import queries as _llm_queries
except ImportError:
    _pipeline = _llm_oracle = _llm_queries = None

LETTERS = "a-z"
STOP = ("the", "of", "and", "de", "der", "la")
WORDS = ["w1", "w2", "w3"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """All trigrams of the documents, unfiltered."""
    texts = _table(spark, sf_dir, "documents").select("text", *keep)
    return readers.trigrams_from_text(readers.spread(texts), "text", *keep)


def _kept(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    texts = readers.spread(_table(spark, sf_dir, table).select("text"))
    return plans.kept_text_rows(texts, STOP, LETTERS)


def _sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram sums, written once for the queries that use them more than once."""
    return materialised(counts.trigram_sums(_kept(spark, sf_dir)), "trigram_sums")


def _n3(sums: DataFrame) -> DataFrame:
    return counts.trigram_counts(sums).withColumnRenamed("n", "n3")


def _model(spark: SparkSession, sf_dir: str, table: str = "documents", undefined: str = "nan") -> DataFrame:
    return plans.model_of(_kept(spark, sf_dir, table), undefined)


def _phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clauses of all conversations: n-grams of any number of words."""
    talk = readers.spread(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    return talk.select("conv_id", "turn", F.explode(F.split("text", r"[.,\n]+ *")).alias("ngram"))


def _count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count lines ``w1 w2 w3<TAB>year<TAB>count`` made of the documents' trigrams."""
    rows = _raw(spark, sf_dir, "doc_id")
    fields = [
        phrase(F.col("w1"), F.col("w2"), F.col("w3")),
        (F.col("doc_id") % 10 + 2000).cast("string"),
        (F.col("doc_id") % 9 + 1).cast("string"),
    ]
    return rows.select(F.concat_ws("\t", *fields).alias("value"))


def _bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation clauses as lines; those of the assistant lack a number."""
    talk = readers.spread(_table(spark, sf_dir, "conversations").select("role", "text"))
    clause = talk.select("role", F.explode(F.split("text", r"[.,\n]+ *")).alias("ngram"))
    third = F.when(F.col("role") == "assistant", F.lit("12x")).otherwise(F.lit("12"))
    return clause.select(F.concat_ws("\t", "ngram", F.lit("2000"), third).alias("value"))


def _shown(model: DataFrame) -> DataFrame:
    """NaN as NULL and twelve places, in the one column that is not a whole number."""
    return model.withColumn("p", F.round(F.when(~F.isnan("p"), F.col("p")), 12))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word pairs that open a kept trigram of the benchmark texts."""
    return _kept(spark, sf_dir, "benchmark").select("w1", "w2")


# --- sources, parsing, filters ------------------------------------------------


def parse_ngrams(spark, sf_dir):
    return readers.parse_ngrams(_count_lines(spark, sf_dir))


def parse_ngrams_drop(spark, sf_dir):
    return readers.parse_ngrams(_bad_lines(spark, sf_dir), "drop")


def parse_ngrams_quarantine(spark, sf_dir):
    return readers.parse_ngrams(_bad_lines(spark, sf_dir), "quarantine")


def trigrams_from_text(spark, sf_dir):
    return _raw(spark, sf_dir, "doc_id")


def filter_alphabet_phrases(spark, sf_dir):
    return filter_alphabet(_phrases(spark, sf_dir), LETTERS)


def filter_alphabet_words(spark, sf_dir):
    return filter_alphabet(_raw(spark, sf_dir, "doc_id"), LETTERS)


def filter_arity_phrases(spark, sf_dir):
    return filter_arity(_phrases(spark, sf_dir))


def ngram_orders(spark, sf_dir):
    return _phrases(spark, sf_dir).withColumn("order", ngram_order(ngram_words(F.col("ngram"))))


def filter_stopwords_list(spark, sf_dir):
    return filter_stopwords(_raw(spark, sf_dir, "doc_id"), STOP)


def filter_stopwords_table(spark, sf_dir):
    words = F.explode(F.split("text", r"\s+")).alias("word")
    stop = _table(spark, sf_dir, "benchmark").select(words).distinct()
    return filter_stopwords(_raw(spark, sf_dir, "doc_id"), stop)


def filter_stopwords_file(spark, sf_dir):
    """The words of the benchmark as a file: as they come, with blanks and carriage returns."""
    path = scratch_path(spark, "stopwords")
    words = F.explode(F.split("text", r"\s+")).alias("word")
    lines = _table(spark, sf_dir, "benchmark").select(words).select(F.concat(F.lit("  "), "word", F.lit("\t\r")))
    lines.write.text(path)
    return filter_stopwords(_raw(spark, sf_dir, "doc_id"), readers.read_stopwords(spark, path))


def to_trigram(spark, sf_dir):
    return readers.to_trigram(filter_arity(_phrases(spark, sf_dir)))


def phrase_round_trip(spark, sf_dir):
    phrases = _kept(spark, sf_dir).select(phrase(*map(F.col, WORDS)).alias("phrase"))
    return phrases.select("phrase", *split_phrase(F.col("phrase")))


# --- counts -------------------------------------------------------------------


def expand_ngrams(spark, sf_dir):
    return counts.ngram_phrases(counts.expand_ngrams(_kept(spark, sf_dir)))


def ngram_counts(spark, sf_dir):
    return counts.ngram_phrases(counts.ngram_counts(_kept(spark, sf_dir)))


def odd_counts(spark, sf_dir):
    """Counts that are no ordinary numbers, by what becomes of them in word and pair counts."""
    rows = _raw(spark, sf_dir, "doc_id")
    kept = filter_stopwords(filter_alphabet(rows, LETTERS), STOP)
    odd = (
        F.when(F.col("doc_id") % 50 == 1, "NaN").when(F.col("doc_id") % 50 == 2, "Infinity")
        .when(F.col("doc_id") % 50 == 3, "3e19").otherwise("1")
    )
    lines = kept.select(F.concat_ws("\t", phrase(*map(F.col, WORDS)), F.lit("2000"), odd).alias("value"))
    read = readers.to_trigram(readers.parse_ngrams(lines))
    sums = materialised(counts.trigram_sums(read), "trigram_sums")
    n = F.col("n")
    shown = (
        F.when(F.isnan(n), "nan").when(n == float("inf"), "inf").when(n >= 9e18, "large")
        .otherwise(n.cast("bigint").cast("string"))
    )
    words = counts.unigram_counts(sums).select(F.col("w").alias("ngram"), shown.alias("n"))
    pairs = counts.bigram_counts(sums).select(phrase(F.col("a"), F.col("b")).alias("ngram"), shown.alias("n"))
    return words.unionByName(pairs)


def corpus_total(spark, sf_dir):
    return counts.corpus_total(_kept(spark, sf_dir))


def unigram_counts(spark, sf_dir):
    return counts.unigram_counts(_kept(spark, sf_dir))


def bigram_counts(spark, sf_dir):
    return counts.bigram_counts(_kept(spark, sf_dir))


def trigram_counts(spark, sf_dir):
    return counts.trigram_counts(_kept(spark, sf_dir))


def trigram_sums(spark, sf_dir):
    return counts.trigram_sums(_kept(spark, sf_dir))


def stage_row_counts(spark, sf_dir):
    return plans.stage_row_counts(_kept(spark, sf_dir))


# --- joins --------------------------------------------------------------------


def join_c1(spark, sf_dir):
    sums = _sums(spark, sf_dir)
    return joins.join_c1(_n3(sums), counts.unigram_counts(sums))


def join_n1(spark, sf_dir):
    sums = _sums(spark, sf_dir)
    return joins.join_n1(_n3(sums), counts.unigram_counts(sums))


def join_c2(spark, sf_dir):
    sums = _sums(spark, sf_dir)
    return joins.join_c2(_n3(sums), counts.bigram_counts(sums))


def join_n2(spark, sf_dir):
    sums = _sums(spark, sf_dir)
    return joins.join_n2(_n3(sums), counts.bigram_counts(sums))


def attach_total(spark, sf_dir):
    sums = _sums(spark, sf_dir)
    return joins.attach_total(_n3(sums), counts.corpus_total(sums))


def trigram_statistics(spark, sf_dir):
    return joins.trigram_statistics(_sums(spark, sf_dir))


def labelled_statistics(spark, sf_dir):
    return joins.labelled_statistics(joins.trigram_statistics(_sums(spark, sf_dir)))


def pivot_statistics(spark, sf_dir):
    """The long form without its N1 and C1 rows, so the defaults come into play."""
    long = joins.labelled_statistics(joins.trigram_statistics(_sums(spark, sf_dir)))
    some = long.where(F.col("label").isin("N2", "C2") | (F.col("n3") > 0))
    return joins.pivot_statistics(some)


# --- functions ----------------------------------------------------------------


def confidence_weights(spark, sf_dir):
    words = counts.unigram_counts(_kept(spark, sf_dir))
    return words.withColumn("k", F.round(confidence(F.col("n")), 12))


def ieee_division(spark, sf_dir):
    """n3 / c2 for every trigram, the undefined ones marked."""
    statistics = joins.trigram_statistics(_sums(spark, sf_dir))
    ratio = ieee_divide(F.col("n3"), F.col("c2"))
    return statistics.select(
        *WORDS, F.isnan(ratio).alias("undefined"), F.round(F.nanvl(ratio, F.lit(-1.0)), 12).alias("ratio")
    )


def sql_functions(spark, sf_dir):
    register_functions(spark)
    joins.trigram_statistics(_sums(spark, sf_dir)).createOrReplaceTempView("trigram_statistics")
    return _shown(
        spark.sql(
            "SELECT w1, w2, w3, round(confidence(n2), 12) AS k2, round(confidence(n3), 12) AS k3,"
            " interpolate(n1, n2, n3, c0, c1, c2) AS p FROM trigram_statistics"
        )
    )


# --- models, orders, lookups --------------------------------------------------


def trigram_probability(spark, sf_dir):
    return _shown(_model(spark, sf_dir))


def defined_probability(spark, sf_dir):
    return _shown(_model(spark, sf_dir, undefined="drop")).select(*WORDS, "p")


def conversation_model(spark, sf_dir):
    return _shown(_model(spark, sf_dir, "conversations")).select(*WORDS, "p")


def count_line_model(spark, sf_dir):
    return _shown(plans.build_model(_count_lines(spark, sf_dir), STOP, LETTERS, order=None))


def _ranked(spark, sf_dir, order):
    ranked = ranking.rank_model(_model(spark, sf_dir).select(*WORDS, "p"), order)
    return _shown(ranking.with_position(ranked))


def rank_documented(spark, sf_dir):
    return _ranked(spark, sf_dir, "documented")


def rank_legacy(spark, sf_dir):
    return _ranked(spark, sf_dir, "legacy")


def cluster_by_pair(spark, sf_dir):
    """Rows of every pair, and the number of partitions they lie in."""
    clustered = ranking.cluster_by_pair(_model(spark, sf_dir).select(*WORDS, "p"))
    # A row per pair and partition is written: counted where the rows lie, without a shuffle.
    placed = clustered.withColumn("part", F.spark_partition_id()).groupBy("w1", "w2", "part").count()
    return materialised(placed, "clustered").groupBy("w1", "w2").agg(
        F.sum("count").alias("n_rows"), F.count(F.lit(1)).alias("n_partitions")
    )


def _predicted(best):
    return _shown(best).select(*WORDS, "p", F.col("rank").cast("bigint").alias("rank"))


def top_next_words(spark, sf_dir):
    return _predicted(ranking.top_next_words(_model(spark, sf_dir, undefined="drop"), 5))


def top_many_words(spark, sf_dir):
    """Beyond the number of ranks that Spark limits before a shuffle by itself."""
    return _predicted(ranking.top_next_words(_model(spark, sf_dir, undefined="drop"), 1001))


def stage_then_predict(spark, sf_dir):
    """A model staged once under a name and laid out by pairs, then asked; only zones with a pair are read."""
    path, pairs = scratch_path(spark, "model"), _pairs(spark, sf_dir)
    writers.write_stage(_model(spark, sf_dir, undefined="drop"), path, by=["w1", "w2"])
    return _predicted(ranking.predict(readers.read_zones(spark, path, pairs), pairs, 3))


def _lines_some_bad(spark, sf_dir):
    """Count lines; every tenth document's lack a number."""
    rows = _raw(spark, sf_dir, "doc_id")
    count = F.when(F.col("doc_id") % 10 == 3, "12x").otherwise("1")
    return rows.select(F.concat_ws("\t", phrase(*map(F.col, WORDS)), F.lit("2000"), count).alias("value"))


def _counts_table(spark, seen):
    return spark.createDataFrame(sorted(seen.get().items()), "stage string, records bigint")


def run_counts(spark, sf_dir):
    """What a run itself counts."""
    seen = plans.RunCounts()
    plans.build_model(_lines_some_bad(spark, sf_dir), STOP, LETTERS, order=None, on_bad="drop", seen=seen)
    return _counts_table(spark, seen)


def run_counts_restart(spark, sf_dir):
    """The counts of a run of which the second start finds all stages finished."""
    folder = scratch_path(spark, "stages")
    for _ in range(2):
        seen = plans.RunCounts()
        plans.build_model(
            _lines_some_bad(spark, sf_dir), STOP, LETTERS, order=None, on_bad="drop", stage_dir=folder,
            stage_key="documents, every tenth without numbers", seen=seen,
        )
    return _counts_table(spark, seen)


def restarted_model(spark, sf_dir):
    """A model of the second start with the same stages."""
    folder = scratch_path(spark, "stages")
    plans.model_of(_kept(spark, sf_dir), stage_dir=folder, stage_key="documents")
    return _shown(plans.model_of(_kept(spark, sf_dir), stage_dir=folder, stage_key="documents"))


def predict(spark, sf_dir):
    model = _model(spark, sf_dir, undefined="drop")
    return _predicted(ranking.predict(model, _pairs(spark, sf_dir), 3))


def predict_from_rows(spark, sf_dir):
    return _predicted(plans.predict_from_rows(_kept(spark, sf_dir), _pairs(spark, sf_dir), 3))


# --- written tables and files -------------------------------------------------


def stage_round_trip(spark, sf_dir):
    path = scratch_path(spark, "statistics")
    writers.write_stage(joins.trigram_statistics(_sums(spark, sf_dir)), path)
    return readers.read_stage(spark, path)


def sequence_file_round_trip(spark, sf_dir):
    path = scratch_path(spark, "conversation-lines")
    rows = _kept(spark, sf_dir, "conversations")
    lines = rows.select(F.concat_ws("\t", phrase(*map(F.col, WORDS)), F.lit("2000"), F.lit("3")).alias("value"))
    writers.write_ngram_seq(lines, path)
    return readers.parse_ngrams(readers.read_ngram_seq(spark, path))


def sequence_file_model(spark, sf_dir):
    """A model of a SequenceFile that is converted once and read twice."""
    lines, stage = scratch_path(spark, "conversation-lines"), scratch_path(spark, "parsed")
    rows = _kept(spark, sf_dir, "conversations")
    writers.write_ngram_seq(
        rows.select(F.concat_ws("\t", phrase(*map(F.col, WORDS)), F.lit("2000"), F.lit("1")).alias("value")), lines
    )
    readers.convert_ngram_seq(spark, lines, stage, "conversations")
    parsed = readers.convert_ngram_seq(spark, lines, stage, "conversations")
    return _shown(plans.model_of(plans.kept_ngrams(parsed, STOP, LETTERS))).select(*WORDS, "p")


def model_text_files(spark, sf_dir):
    """A ranked model as files, of a run that clears its tables."""
    path = scratch_path(spark, "ranked")
    plans.write_model_text(_count_lines(spark, sf_dir), path, STOP, LETTERS)
    fields = F.split("value", "\t")
    lines = readers.read_ngram_text(spark, path).select(
        fields[0].alias("phrase"), fields[1].cast("double").alias("p")
    )
    return _shown(lines.select(*split_phrase(F.col("phrase")), "p"))


def text_round_trip(spark, sf_dir):
    path = scratch_path(spark, "ranked")
    # Lines hold the words and p: only these are written and sorted.
    writers.write_ranked_text(ranking.rank_model(_model(spark, sf_dir).select(*WORDS, "p")), path)
    fields = F.split("value", "\t")
    lines = readers.read_ngram_text(spark, path).select(
        fields[0].alias("phrase"), fields[1].cast("double").alias("p")
    )
    return _shown(lines.select(*split_phrase(F.col("phrase")), "p"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the five best next words of every word pair of the documents."""
    return top_next_words(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        parse_ngrams, parse_ngrams_drop, parse_ngrams_quarantine, trigrams_from_text,
        filter_alphabet_phrases, filter_alphabet_words, filter_arity_phrases, ngram_orders,
        filter_stopwords_list, filter_stopwords_table, filter_stopwords_file, to_trigram, phrase_round_trip,
        expand_ngrams, ngram_counts, corpus_total, unigram_counts, bigram_counts,
        trigram_counts, trigram_sums, stage_row_counts, odd_counts, run_counts, run_counts_restart,
        join_c1, join_n1, join_c2, join_n2, attach_total,
        trigram_statistics, labelled_statistics, pivot_statistics,
        confidence_weights, ieee_division, sql_functions,
        trigram_probability, defined_probability, conversation_model, count_line_model,
        rank_documented, rank_legacy, cluster_by_pair, top_next_words, top_many_words,
        predict, predict_from_rows, stage_then_predict, restarted_model,
        stage_round_trip, sequence_file_round_trip, sequence_file_model, text_round_trip, model_text_files,
    )
    named = {query.__name__: query for query in listed}
    if _llm_queries:
        named |= _llm_queries.queries() | {"pipeline": _pipeline.run}
    return named


# --- the same in SQL ----------------------------------------------------------

_STOP_SQL = "(" + ", ".join(f"'{word}'" for word in STOP) + ")"


def _raw_sql(table: str = "documents", keep: str = "") -> str:
    """Common table expression ``raw``: every trigram of a text table."""
    return f"""tok AS (SELECT {keep} regexp_split_to_array(text, '\\s+') AS t FROM {table}),
pos AS (SELECT {keep} t, unnest(range(1, len(t) - 1)) AS i FROM tok),
raw AS (SELECT {keep} t[i] AS w1, t[i+1] AS w2, t[i+2] AS w3, 1.0::DOUBLE AS cnt FROM pos)"""


def _good(letters: bool = True, stop: bool = True) -> str:
    tests = []
    for word in WORDS:
        if letters:
            tests.append(f"regexp_full_match({word}, '[a-z]+')")
        if stop:
            tests.append(f"{word} NOT IN {_STOP_SQL}")
    return " AND ".join(tests)


def _tri_sql(table: str = "documents") -> str:
    return f"{_raw_sql(table)}, tri AS (SELECT * FROM raw WHERE {_good()})"


_COUNTS_SQL = """
t3 AS (SELECT w1, w2, w3, sum(cnt) AS s FROM tri GROUP BY ALL),
uni AS (SELECT w, floor(sum(s)) AS n FROM (SELECT w1 AS w, s FROM t3 UNION ALL SELECT w2, s FROM t3
        UNION ALL SELECT w3, s FROM t3) GROUP BY w),
bi AS (SELECT a, b, floor(sum(s) / 2) AS n FROM (SELECT w1 AS a, w2 AS b, s FROM t3
       UNION ALL SELECT w2, w3, s FROM t3) GROUP BY a, b),
total AS (SELECT floor(coalesce(sum(s), 0) / 3 + 0.5) AS c0 FROM t3)"""

_STATS_SQL = """
stats AS (SELECT t3.w1, t3.w2, t3.w3, u3.n AS n1, b2.n AS n2, floor(t3.s / 3) AS n3,
                 (SELECT c0 FROM total) AS c0, u2.n AS c1, b1.n AS c2
          FROM t3 JOIN uni u2 ON u2.w = t3.w2 JOIN uni u3 ON u3.w = t3.w3
          JOIN bi b1 ON b1.a = t3.w1 AND b1.b = t3.w2
          JOIN bi b2 ON b2.a = t3.w2 AND b2.b = t3.w3)"""

_MODEL_SQL = """
k AS (SELECT *, (ln(n2 + 1) + 1) / (ln(n2 + 1) + 2) AS k2, (ln(n3 + 1) + 1) / (ln(n3 + 1) + 2) AS k3 FROM stats),
model AS (SELECT w1, w2, w3, n1, n2, n3, c0, c1, c2, k2, k3,
                 k3 * (n3 / c2) + (1 - k3) * k2 * (n2 / c1) + (1 - k3) * (1 - k2) * (n1 / c0) AS p FROM k)"""

_P = "CASE WHEN NOT isnan(p) THEN round(p, 12) END AS p"

_PHRASES_SQL = """phrases AS (SELECT conv_id, turn,
    unnest(regexp_split_to_array(text, '[.,\\n]+ *')) AS ngram FROM conversations)"""

_BAD_SQL = """clauses AS (SELECT role, unnest(regexp_split_to_array(text, '[.,\\n]+ *')) AS ngram
                          FROM conversations)"""


def oracle_sql() -> dict[str, str]:
    named = _own_sql()
    if _llm_oracle:
        named |= _llm_oracle.oracle_sql()
        if _pipeline.ORACLE_SQL:
            named["pipeline"] = _pipeline.ORACLE_SQL
    return named


def _own_sql() -> dict[str, str]:
    tri = f"WITH {_tri_sql()}"
    counted = f"{tri}, {_COUNTS_SQL}"
    stats = f"{counted}, {_STATS_SQL}"
    model = f"{stats}, {_MODEL_SQL}"
    talk = f"WITH {_tri_sql('conversations')}, {_COUNTS_SQL}, {_STATS_SQL}, {_MODEL_SQL}"
    by_doc = f"WITH {_raw_sql(keep='doc_id,')}"
    lines = f"""{by_doc}, tri AS (SELECT w1, w2, w3, (doc_id % 9 + 1)::DOUBLE AS cnt FROM raw WHERE {_good()}),
        {_COUNTS_SQL}, {_STATS_SQL}, {_MODEL_SQL}"""
    words = "len(string_split(rtrim(ngram, ' '), ' '))"
    long = """long AS (SELECT w1, w2, w3, 'N1' AS label, n1 AS value, n3 FROM stats
        UNION ALL SELECT w1, w2, w3, 'N2', n2, n3 FROM stats
        UNION ALL SELECT w1, w2, w3, 'C1', c1, n3 FROM stats
        UNION ALL SELECT w1, w2, w3, 'C2', c2, n3 FROM stats)"""

    def ranked(order: str) -> str:
        return f"{model} SELECT w1, w2, w3, {_P}, row_number() OVER (ORDER BY {order}) AS position FROM model"

    return {
        "parse_ngrams": f"""{by_doc} SELECT w1 || ' ' || w2 || ' ' || w3 AS ngram,
            (doc_id % 9 + 1)::DOUBLE AS cnt FROM raw""",
        "parse_ngrams_drop": f"WITH {_BAD_SQL} SELECT ngram, 12.0::DOUBLE AS cnt FROM clauses WHERE role <> 'assistant'",
        "parse_ngrams_quarantine": f"""WITH {_BAD_SQL} SELECT ngram,
            CASE WHEN role <> 'assistant' THEN 12.0::DOUBLE END AS cnt,
            CASE WHEN role = 'assistant' THEN ngram || chr(9) || '2000' || chr(9) || '12x' END AS bad_record
            FROM clauses""",
        "trigrams_from_text": f"{by_doc} SELECT doc_id, w1, w2, w3, cnt FROM raw",
        "filter_alphabet_phrases": f"""WITH {_PHRASES_SQL} SELECT * FROM phrases
            WHERE regexp_full_match(ngram, '[a-z]+( [a-z]+)* *')""",
        "filter_alphabet_words": f"{by_doc} SELECT doc_id, w1, w2, w3, cnt FROM raw WHERE {_good(stop=False)}",
        "filter_arity_phrases": f"WITH {_PHRASES_SQL} SELECT * FROM phrases WHERE {words} > 2",
        "ngram_orders": f"""WITH {_PHRASES_SQL} SELECT *, {words}::INTEGER AS "order" FROM phrases""",
        "filter_stopwords_list": f"{by_doc} SELECT doc_id, w1, w2, w3, cnt FROM raw WHERE {_good(letters=False)}",
        **dict.fromkeys(("filter_stopwords_table", "filter_stopwords_file"), f"""{by_doc},
            stop AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM benchmark)
            SELECT doc_id, w1, w2, w3, cnt FROM raw
            ANTI JOIN stop s1 ON s1.word = w1 ANTI JOIN stop s2 ON s2.word = w2 ANTI JOIN stop s3 ON s3.word = w3"""),
        "to_trigram": f"""WITH {_PHRASES_SQL},
            parts AS (SELECT conv_id, turn, string_split(rtrim(ngram, ' '), ' ') AS t FROM phrases)
            SELECT t[1] AS w1, t[2] AS w2, t[3] AS w3, conv_id, turn FROM parts WHERE len(t) > 2""",
        "phrase_round_trip": f"{tri} SELECT w1 || ' ' || w2 || ' ' || w3 AS phrase, w1, w2, w3 FROM tri",
        "expand_ngrams": f"""{tri} SELECT '' AS ngram, 0 AS "order", cnt FROM tri
            UNION ALL SELECT w1, 1, cnt FROM tri UNION ALL SELECT w2, 1, cnt FROM tri
            UNION ALL SELECT w3, 1, cnt FROM tri UNION ALL SELECT w1 || ' ' || w2, 2, cnt FROM tri
            UNION ALL SELECT w2 || ' ' || w3, 2, cnt FROM tri
            UNION ALL SELECT w1 || ' ' || w2 || ' ' || w3, 3, cnt FROM tri""",
        "ngram_counts": f"""{counted} SELECT w AS ngram, 1 AS "order", n FROM uni
            UNION ALL SELECT a || ' ' || b, 2, n FROM bi
            UNION ALL SELECT w1 || ' ' || w2 || ' ' || w3, 3, floor(s / 3) FROM t3""",
        "corpus_total": f"{counted} SELECT c0 FROM total",
        "unigram_counts": f"{counted} SELECT w, n FROM uni",
        "bigram_counts": f"{counted} SELECT a, b, n FROM bi",
        "trigram_counts": f"{counted} SELECT w1, w2, w3, floor(s / 3) AS n FROM t3",
        "trigram_sums": f"{counted} SELECT w1, w2, w3, s FROM t3",
        "stage_row_counts": f"""{counted}, n AS (SELECT (SELECT count(*) FROM tri) AS kept,
            (SELECT count(*) FROM uni) AS u, (SELECT count(*) FROM bi) AS b, (SELECT count(*) FROM t3) AS t)
            SELECT 'kept rows' AS stage, kept AS records FROM n UNION ALL SELECT 'count records', 7 * kept FROM n
            UNION ALL SELECT 'unigrams', u FROM n UNION ALL SELECT 'bigrams', b FROM n
            UNION ALL SELECT 'trigrams', t FROM n UNION ALL SELECT 'join records', u + b + 4 * t FROM n
            UNION ALL SELECT 'statistics records', 4 * t FROM n""",
        "join_c1": f"{stats} SELECT w1, w2, w3, n3, c1 FROM stats",
        "join_n1": f"{stats} SELECT w1, w2, w3, n3, n1 FROM stats",
        "join_c2": f"{stats} SELECT w1, w2, w3, n3, c2 FROM stats",
        "join_n2": f"{stats} SELECT w1, w2, w3, n3, n2 FROM stats",
        "attach_total": f"{stats} SELECT w1, w2, w3, n3, c0 FROM stats",
        "trigram_statistics": f"{stats} SELECT * FROM stats",
        "labelled_statistics": f"{stats}, {long} SELECT * FROM long",
        "pivot_statistics": f"""{stats}, {long} SELECT w1, w2, w3,
            coalesce(max(value) FILTER (label = 'N1'), 0.0::DOUBLE) AS n1,
            coalesce(max(value) FILTER (label = 'N2'), 0.0::DOUBLE) AS n2, max(n3) AS n3,
            coalesce(max(value) FILTER (label = 'C1'), 1.0::DOUBLE) AS c1,
            coalesce(max(value) FILTER (label = 'C2'), 1.0::DOUBLE) AS c2
            FROM long WHERE label IN ('N2', 'C2') OR n3 > 0 GROUP BY w1, w2, w3""",
        "confidence_weights": f"""{counted}
            SELECT w, n, round((ln(n + 1) + 1) / (ln(n + 1) + 2), 12) AS k FROM uni""",
        "ieee_division": f"""{stats} SELECT w1, w2, w3, isnan(n3 / c2) AS undefined,
            CASE WHEN isnan(n3 / c2) THEN -1.0::DOUBLE ELSE round(n3 / c2, 12) END AS ratio FROM stats""",
        "sql_functions": f"""{model} SELECT w1, w2, w3, round(k2, 12) AS k2, round(k3, 12) AS k3, {_P}
            FROM model""",
        **dict.fromkeys(("trigram_probability", "restarted_model"), f"{model} SELECT w1, w2, w3, n1, n2, n3, c0, c1, c2, {_P} FROM model"),
        "defined_probability": f"{model} SELECT w1, w2, w3, round(p, 12) AS p FROM model WHERE NOT isnan(p)",
        **dict.fromkeys(("conversation_model", "sequence_file_model"), f"{talk} SELECT w1, w2, w3, {_P} FROM model"),
        **dict.fromkeys(("count_line_model", "model_text_files"), f"{lines} SELECT w1, w2, w3, {_P} FROM model"),
        "rank_documented": ranked("w1, w2, p DESC, w3"),
        "rank_legacy": ranked("w1, w2 DESC, p, w3"),
        "cluster_by_pair": f"{model} SELECT w1, w2, count(*) AS n_rows, 1::BIGINT AS n_partitions FROM model GROUP BY w1, w2",
        **{name: f"""{model}, best AS (SELECT w1, w2, w3, p,
            row_number() OVER (PARTITION BY w1, w2 ORDER BY p DESC, w3) AS rank FROM model WHERE NOT isnan(p))
            SELECT w1, w2, w3, round(p, 12) AS p, rank FROM best WHERE rank <= {k}"""
           for name, k in (("top_next_words", 5), ("top_many_words", 1001))},
        "odd_counts": f"""{by_doc}, tri AS (SELECT w1, w2, w3, CASE doc_id % 50 WHEN 1 THEN 'NaN'::DOUBLE
                WHEN 2 THEN 'Infinity'::DOUBLE WHEN 3 THEN 3e19 ELSE 1 END AS cnt FROM raw WHERE {_good()}),
            {_COUNTS_SQL}, every AS (SELECT w AS ngram, n FROM uni UNION ALL SELECT a || ' ' || b, n FROM bi)
            SELECT ngram, CASE WHEN isnan(n) THEN 'nan' WHEN isinf(n) THEN 'inf' WHEN n >= 9e18 THEN 'large'
                ELSE n::BIGINT::VARCHAR END AS n FROM every""",
        **dict.fromkeys(("run_counts", "run_counts_restart"), f"""{by_doc}, good AS (SELECT * FROM raw WHERE doc_id % 10 <> 3 AND {_good()})
            SELECT 'lines' AS stage, count(*) AS records FROM raw
            UNION ALL SELECT 'bad lines', count(*) FROM raw WHERE doc_id % 10 = 3
            UNION ALL SELECT 'kept rows', count(*) FROM good
            UNION ALL SELECT 'trigrams', count(*) FROM (SELECT DISTINCT w1, w2, w3 FROM good)"""),
        **dict.fromkeys(("predict", "predict_from_rows", "stage_then_predict"), f"""{model}, btok AS (SELECT regexp_split_to_array(text, '\\s+') AS t FROM benchmark),
            bpos AS (SELECT t, unnest(range(1, len(t) - 1)) AS i FROM btok),
            braw AS (SELECT t[i] AS w1, t[i+1] AS w2, t[i+2] AS w3 FROM bpos),
            asked AS (SELECT DISTINCT w1, w2 FROM braw WHERE {_good()}),
            best AS (SELECT w1, w2, w3, p, row_number() OVER (PARTITION BY w1, w2 ORDER BY p DESC, w3) AS rank
                     FROM model SEMI JOIN asked USING (w1, w2) WHERE NOT isnan(p))
            SELECT w1, w2, w3, round(p, 12) AS p, rank FROM best WHERE rank <= 3"""),
        "stage_round_trip": f"{stats} SELECT * FROM stats",
        "sequence_file_round_trip": f"""WITH {_tri_sql('conversations')}
            SELECT w1 || ' ' || w2 || ' ' || w3 AS ngram, 3.0::DOUBLE AS cnt FROM tri""",
        "text_round_trip": f"{model} SELECT w1, w2, w3, {_P} FROM model",
    }
