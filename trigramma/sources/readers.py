"""Corpus inputs: count files, stop words, stage tables and running text."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trigramma.functions.scalar import ngram_words

# Lines handed from Python to Spark as one row.
BATCH = 1000


def read_ngram_seq(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a SequenceFile of (LongWritable, Text), a folder or a glob.

    Spark has no DataFrame reader for the format, so this is the one place
    where rows pass through Python; they return in batches, and everything
    after is DataFrame code.
    """

    size = BATCH

    # Defined here so that it travels with the task: executors need not have
    # this package installed.
    def batches(records: Iterator[tuple[int, str]]) -> Iterator[tuple[list[str]]]:
        lines = (line for _, line in records)
        while batch := list(islice(lines, size)):
            yield (batch,)

    records = spark.sparkContext.sequenceFile(
        path, "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text"
    )
    batched = spark.createDataFrame(
        records.mapPartitions(batches), "lines array<string>", verifySchema=False
    )
    return batched.select(F.explode("lines").alias("value"))


def read_ngram_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines of plain or compressed text files."""
    return spark.read.text(path)


def parse_ngrams(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """``value`` lines to ``ngram`` and ``cnt``: TAB fields 0 and 2.

    ``on_bad`` says what a line without a numeric third field does: ``fail``
    the job, whether or not a later filter would drop the line; ``drop`` it; or
    ``quarantine`` it, which keeps it with its text in ``bad_record``.

    Anything that reads as a double is a count, also ``NaN``, ``Infinity``, negative and
    very large ones; they take part in all sums as doubles do, and floors leave them be.

    The two fields leave through ``inline``, below which Catalyst moves no later
    filter, so a line is cut up once and its count is looked at first.
    """
    ngram = F.substring_index("value", "\t", 1)
    # A line of fewer fields has nothing behind its second TAB. (All fields as an array take Spark several times as long.)
    third = F.substring_index(F.substring_index("value", "\t", 3), "\t", -1)
    cnt = F.when(F.substring_index("value", "\t", 2) != F.col("value"), third).try_cast("double")
    record = F.inline(F.array(F.struct(ngram.alias("ngram"), cnt.alias("cnt"))))
    if on_bad == "quarantine":
        bad = F.when(F.col("cnt").isNull(), F.col("value")).alias("bad_record")
        return lines.select("value", record).select("ngram", "cnt", bad)
    if on_bad == "drop":
        return lines.select(record).where(F.col("cnt").isNotNull())
    if on_bad == "fail":
        message = F.concat(F.lit("no numeric count for n-gram: "), F.col("ngram"))
        stop = F.raise_error(message).cast("boolean")
        return lines.select(record).where(F.when(F.col("cnt").isNull(), stop).otherwise(True))
    raise ValueError(f"on_bad is fail, drop or quarantine, not {on_bad!r}")


def to_trigram(ngrams: DataFrame) -> DataFrame:
    """``ngram`` to its first three words ``w1``, ``w2``, ``w3``; keeps the rest.

    The word array goes through ``explode`` so that filters on the words use
    the one array and do not split the n-gram again.
    """
    rest = [c for c in ngrams.columns if c != "ngram"]
    split = ngrams.select(*rest, F.explode(F.array(ngram_words(F.col("ngram")))).alias("words"))
    first = [F.get("words", F.lit(i)).alias(f"w{i + 1}") for i in range(3)]
    return split.select(*first, *rest)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, trimmed, without repeats, as column ``word``."""
    lines = spark.read.text(path)
    return lines.select(F.regexp_replace("value", r"\A[\x00-\x20]+|[\x00-\x20]+\z", "").alias("word")).distinct()


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stage table written by ``write_stage``."""
    return spark.read.parquet(path)


# Zones, at most, of which the borders are compared with every key that is asked for.
ZONES = 100_000


def read_zones(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The part of a stage laid out ``by`` some columns that may hold ``keys``.

    ``keys`` has those columns. A first small job finds the zones whose borders take in a key, and
    only their files are in the scan; within them the smallest and the largest key leave out row groups. Beyond
    ``ZONES`` zones, or where nothing is known of them, all of the stage is read.
    """
    from trigramma.sources.writers import stage_record

    record = stage_record(spark, path) or {}
    stage = spark.read.parquet(path) if not record else spark.read.schema(record["schema"]).parquet(path)
    by = record.get("by")
    if not by:
        return stage
    borders = spark.read.parquet(f"{path}/_zones")
    rows = stage.drop("zone")
    # Keys become ranges of neighbours in the order of the zones: one row per zone and side, no pairs.
    asked = keys.select(F.struct(*by).alias("low")).where(" AND ".join(f"low.`{c}` IS NOT NULL" for c in by)).distinct()
    zones = borders.count()
    if zones > ZONES:
        return rows
    listed = borders.select(F.array_sort(F.collect_list(F.struct("low", "high", "zone"))).alias("zones"))
    found = asked.withColumn("zones", listed.scalar()).select(
        "low",
        F.explode(F.transform(
            F.filter("zones", lambda z: (z["low"] <= F.col("low")) & (F.col("low") <= z["high"])), lambda z: z["zone"]
        )).alias("zone"),
    )
    seen = found.agg(
        F.collect_set("zone").alias("zones"), F.min(f"low.{by[0]}").alias("least"), F.max(f"low.{by[0]}").alias("most")
    ).first()
    return stage.where(F.col("zone").isin(seen.zones) & F.col(by[0]).between(seen.least, seen.most)).drop("zone")


def convert_ngram_seq(spark: SparkSession, path: str, stage: str, key: str, on_bad: str = "fail") -> DataFrame:
    """Parsed lines of a SequenceFile, ``ngram, cnt``, as a stage that is made once.

    Lines pass through Python when the stage is written; whoever comes with the same ``key``, the
    caller's name for the files and their state, reads the parsed columns.
    """
    from trigramma.sources.writers import write_stage

    return write_stage(parse_ngrams(read_ngram_seq(spark, path), on_bad), stage, key)


# Bytes of a table's files that a task gets, at most, of a scan that is dealt out.
DEALT = 32 << 20


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a small scan over all cores.

    An input of one file or row group would leave a single task to do the work. One that fills
    a split per core (``spark.sql.files.maxPartitionBytes``), or whose files keep the cores busy as they
    lie, keeps its own splits and is not shuffled. What is dealt out goes to more tasks the larger
    it is, so that no task's share, nor what it sums up before a shuffle, grows with the table.
    """
    spark = scan.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    # Of the files: splits are cut from them, however few columns are read.
    held = int(str(scan._jdf.queryExecution().optimizedPlan().collectLeaves().head().stats().sizeInBytes()))
    if held >= cores * split or _busy(scan, cores):
        return scan
    return scan.repartition(cores * max(1, -(-held // (cores * DEALT))))


def _busy(scan: DataFrame, cores: int) -> bool:
    """Whether a scan's own files make tasks for all cores, and a last round of tasks that is nearly full."""
    if len(scan.inputFiles()) < cores:
        return False
    splits = scan.rdd.getNumPartitions()
    return 4 * cores * -(-splits // cores) <= 5 * splits


def trigrams_from_text(df: DataFrame, text: str | Column = "text", *keep: str) -> DataFrame:
    """Every three neighbouring words of a text as ``w1, w2, w3`` with ``cnt`` 1.

    Words stand between runs of white space. The word array is zipped with
    itself shifted by one and two, so a text yields one row per position; the
    last two positions, which lack a third word, fall out. (A filter on the
    number of words would split every text twice.)
    """
    rows = _neighbours(df.select(*keep, _words_of(text).alias("words")), *keep)
    return rows.where(F.col("w3").isNotNull()).select(*keep, "w1", "w2", "w3", F.lit(1.0).alias("cnt"))


def trigrams_of_words(df: DataFrame, wanted: Callable[[Column], Column], text: str = "text") -> DataFrame:
    """Those of ``trigrams_from_text`` of which all three words are ``wanted``.

    A word is looked at once, where it stands in its text, and not in each of its three trigrams.
    """
    words = F.transform(_words_of(text), lambda word: F.when(wanted(word), word))
    rows = _neighbours(df.select(words.alias("words")))
    for name in ("w1", "w2", "w3"):
        rows = rows.where(F.col(name).isNotNull())
    return rows.select("w1", "w2", "w3", F.lit(1.0).alias("cnt"))


def _words_of(text: str | Column) -> Column:
    return F.split(text, r"\s+")


def _neighbours(words: DataFrame, *keep: str) -> DataFrame:
    """One row per place in ``words``, the last two of them short of words."""
    shifted = F.arrays_zip(
        F.col("words").alias("w1"),
        F.slice("words", F.lit(2), F.size("words")).alias("w2"),
        F.slice("words", F.lit(3), F.size("words")).alias("w3"),
    )
    return words.select(*keep, F.inline(shifted))
