"""Orders of the finished model, best next words and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trigramma.operators.joins import lookup
from trigramma.session import materialised


def sort_columns(order: str = "documented") -> list[Column]:
    """``documented``: pairs ascending, best word first. ``legacy``: w1
    ascending, w2 descending, best word last. The third word breaks ties, NaN is
    the largest probability in both."""
    if order == "documented":
        return [F.asc("w1"), F.asc("w2"), F.desc("p"), F.asc("w3")]
    if order == "legacy":
        return [F.asc("w1"), F.desc("w2"), F.asc("p"), F.asc("w3")]
    raise ValueError(f"order is documented or legacy, not {order!r}")


def rank_model(model: DataFrame, order: str = "documented", written: bool = False) -> DataFrame:
    """The model in a global order.

    A range partitioning on all four sort columns; as they are unique together,
    the rows of one frequent pair may be cut over several partitions. Spark samples the rows
    for the borders before it sorts them, so the model is written first: the joins it comes from are made once. Borders
    from counts that are known earlier would not do, for they say nothing of ``p`` and could not
    cut a pair. ``written`` says that ``model`` is a table as it is.
    """
    columns = sort_columns(order)
    rows = model if written else materialised(model, "unranked")
    return rows.orderBy(*columns)


def with_position(ranked: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of a sorted table from 1, without one task seeing them all.

    The sort is written once, each row with its partition and its place there. A row's number is its place
    in its partition plus the rows of the partitions before; only the
    partition sizes, one number each, meet in a single task.
    """
    row_id = F.monotonically_increasing_id().alias("_row_id")
    fixed = materialised(ranked.select("*", row_id), "ranked")
    placed = fixed.select(
        *ranked.columns,
        F.shiftright(F.col("_row_id"), 33).alias("part"),
        F.col("_row_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    )
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    # One row per partition of the sort: bounded by spark.sql.shuffle.partitions.
    return placed.join(F.broadcast(starts), "part").select(
        *ranked.columns, (F.col("start") + F.col("place") + 1).alias(name)
    )


def cluster_by_pair(model: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows of a word pair together in one partition, sorted best word first.

    A pair is never cut, whatever the size of a partition ought to be; a pair with a
    large share of the rows fills the one task it is in.
    """
    sizes = [] if partitions is None else [partitions]
    return model.repartition(*sizes, "w1", "w2").sortWithinPartitions(*sort_columns())


# Ranks up to which Spark limits a window before its shuffle, by default.
LIMITED = 1000
PARTS = 64


def top_next_words(model: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most probable third words of every pair, ``rank`` from 1.

    Undefined probabilities (NaN or NULL) take the last ranks and are then left
    out; an infinite one is the first. The rank limit is applied in every task before
    the shuffle, so a pair sends at most ``k`` rows per task. Spark does so for ``k`` up
    to 1000; beyond, pairs are first cut into parts by their third word, which send at
    most ``k`` rows each. A model made with ``undefined="drop"`` sheds the undefined
    rows earlier, before its joins.
    """
    defined = F.nanvl("p", F.lit(None).cast("double"))
    order = [defined.desc_nulls_last(), F.asc("w3")]
    # The sorts before and after the shuffle compare a number first, not words that begin alike.
    pair = [F.hash("w1", "w2"), F.col("w1"), F.col("w2")]
    if k > LIMITED:
        part = F.pmod(F.xxhash64("w3"), F.lit(PARTS))
        parts = Window.partitionBy(*pair, part).orderBy(*order)
        ranked = model.withColumn("rank", F.row_number().over(parts))
        model = ranked.where(F.col("rank") <= k).drop("rank")
    best = Window.partitionBy(*pair).orderBy(*order)
    return (
        model.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .where(defined.isNotNull())
    )


def predict(model: DataFrame, pairs: DataFrame, k: int = 5) -> DataFrame:
    """The best ``k`` next words for each pair of a table ``w1, w2``.

    Pairs are made distinct, so a repeated pair multiplies nothing. Spark
    broadcasts the table if it is small enough and shuffles it otherwise.
    """
    asked = pairs.select("w1", "w2").distinct()
    return top_next_words(lookup(model, asked, ["w1", "w2"], "left_semi"), k)
