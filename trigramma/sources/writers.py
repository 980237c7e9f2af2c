"""Stage tables and the final text output."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trigramma.functions.scalar import phrase
from trigramma.operators.ranking import sort_columns
from trigramma.session import clear, discard, hadoop, materialised

# What a stage is, in a file of its folder that Parquet readers pass over.
RECORD = "_stage.json"


def write_stage(
    df: DataFrame, path: str, key: str | None = None, facts: Callable[[], dict] | None = None, by: list[str] | None = None
) -> DataFrame:
    """Write a stage as parquet and read it back.

    A stage is there whole or not at all: it is written beside ``path`` and renamed when it is complete,
    together with a record of its ``key``, of ``facts()``, asked for after the writing, and of ``by``. A run
    that is killed leaves nothing that reads as a stage; the next one with its key clears what lies there.
    (Renaming a folder is one step on HDFS and local disks; object stores copy, and need a committer.)

    With ``key`` a stage that has been written under the same key is read instead. Any other path that
    exists, without a key or with another one, is an error and stays as it is.

    ``by`` lays the stage out for lookups: rows sorted by these columns over all files, each file a
    ``zone`` of neighbouring rows, and the zones' borders in the record's table; see ``read_zones``.
    """
    spark = df.sparkSession
    if key is not None and (record := stage_record(spark, path)):
        if record["key"] != key:
            raise ValueError(f"{path} holds the stage of {record['key']!r}, not of {key!r}")
        return spark.read.schema(record["schema"]).parquet(path)
    files, there = hadoop(spark, path)
    if files.exists(there):
        raise FileExistsError(f"{path} exists" + ("" if key is None else f" and is no stage of {key!r}"))
    name = uuid.uuid4().hex if key is None else hashlib.sha256(key.encode()).hexdigest()[:32]
    beside = f"{path}.unfinished-{name}"
    clear(spark, beside)
    try:
        schema = _write(df, beside, by)
        record = {"key": key, "facts": facts() if facts else {}, "by": by, "schema": schema}
        _put(spark, f"{beside}/{RECORD}", json.dumps(record))
        files.mkdirs(there.getParent())
        # Renaming onto a folder would move into it.
        if files.exists(there) or not files.rename(hadoop(spark, beside)[1], there):
            raise FileExistsError(f"{path} was written by another run meanwhile")
    except BaseException:
        clear(spark, beside)
        raise
    return spark.read.schema(schema).parquet(path)


def _write(df: DataFrame, path: str, by: list[str] | None) -> str:
    """Write the rows, and the zones' borders if there are zones; the schema they are read with."""
    if not by:
        df.write.parquet(path)
        return _ddl(df)
    spark = df.sparkSession
    # All columns take part, so that rows of one hot key may lie in several zones.
    order = [*by, *[c for c in df.columns if c not in by]]
    # The borders are sampled, so what the rows come from would run twice.
    rows = materialised(df, "unzoned")
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.withColumn("zone", F.spark_partition_id()).write.partitionBy("zone").parquet(path)
    discard(rows)
    zoned = spark.read.schema(f"{_ddl(df)}, zone int").parquet(path)
    borders = zoned.groupBy("zone").agg(F.min(F.struct(*by)).alias("low"), F.max(F.struct(*by)).alias("high"))
    borders.coalesce(1).write.parquet(f"{path}/_zones")
    return f"{_ddl(df)}, zone int"


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _put(spark: SparkSession, path: str, text: str) -> None:
    files, there = hadoop(spark, path)
    out = files.create(there, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def stage_record(spark: SparkSession, path: str) -> dict | None:
    """The record of a stage, ``key, facts, by, schema``; None where there is no whole stage."""
    files, there = hadoop(spark, f"{path}/{RECORD}")
    if not files.exists(there):
        return None
    jvm = spark.sparkContext._jvm
    stream = files.open(there)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def ranked_lines(model: DataFrame) -> DataFrame:
    """``w1 w2 w3<TAB>p`` lines in the order of the input."""
    key = phrase(F.col("w1"), F.col("w2"), F.col("w3"))
    return model.select(F.concat_ws("\t", key, F.col("p").cast("string")).alias("value"))


def write_ranked_text(
    model: DataFrame, path: str, single_file: bool = False, order: str = "documented"
) -> None:
    """Write a ranked model as text files whose names follow the order.

    ``single_file`` sends everything through one task, which sorts it in ``order``; it is
    meant for exports known to be small.
    """
    if single_file:
        model = model.repartition(1).sortWithinPartitions(*sort_columns(order))
    ranked_lines(model).write.mode("errorifexists").text(path)


def write_ngram_seq(lines: DataFrame, path: str) -> None:
    """Write ``value`` lines as a SequenceFile of (LongWritable, Text).

    The keys are row numbers with gaps; readers ignore them. Numbers above the
    int range make Hadoop choose LongWritable.
    """
    keyed = lines.select((F.monotonically_increasing_id() + F.lit(1 << 32)).alias("key"), "value")
    keyed.rdd.map(tuple).saveAsSequenceFile(path)
