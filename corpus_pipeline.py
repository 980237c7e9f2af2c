"""Documents to a training mix: ``run(spark, sf_dir)`` applies STAGES in order.

A stage is ``(name, function)``; its function takes ``(spark, docs, sf_dir)``. What it returns
is written as Parquet and read again as the documents of the next. All but the last return
the columns of documents.

1. Language: documents without a letter, or of which no language has half of the words, go.
2. Lines: passages of several lines that occurred before are taken out; documents stay.
3. Near duplicates: of every group linked by similarity, four fifths of the runs of five words,
   the smallest ``doc_id`` stays.
4. Benchmark: documents with a word inside a benchmark window go.
5. Mixing: what is left is put in the order of the target weights.

Rows that repeat a ``doc_id`` are versions of one document; see the operators for the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trigramma.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing
from trigramma.llm.common import table
from trigramma.llm.queries import TARGETS
from trigramma.session import scratch_path

# Words of a shingle, and the similarity of near duplicates.
WORDS, PERCENT = 5, 80


def determined_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; see ``keep_determined`` for odd rows."""
    return language_id.keep_determined(docs)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that occurred before; see ``dedup_lines`` for odd rows."""
    return line_dedup.dedup_lines(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates; see ``keep_one`` for odd rows."""
    return jaccard_join.keep_one(docs, WORDS, PERCENT)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window; see ``drop_contaminated`` for odd rows."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix; see ``mix_sources`` for odd rows."""
    return mixing.mix_sources(docs, TARGETS)


STAGES = [
    ("language", determined_language),
    ("lines", unique_lines),
    ("near_duplicates", one_of_each_group),
    ("benchmark", clean_of_benchmark),
    ("mixing", mixed),
]

# The language model of the first stage cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
