"""Helpers shared by the operators: ASCII folding, shared tables, components.

Operators select the columns they use by name before anything else, so further
columns of a table, whatever they are called, never meet their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trigramma.operators.joins import lookup
from trigramma.session import discard, materialised

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_rows(df: DataFrame, *names: str) -> DataFrame:
    """The rows as one column ``row``, so that no name of theirs meets another, and some ``names``."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *[df[n] for n in names])


# Ids (some 50 bytes each in a task) up to which the rows they pick are not shuffled.
FEW = 500_000


def rows_with(df: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``doc_id`` is (or, ``left_anti``, is not) among ``ids(doc_id)``; null is like null.

    ``ids`` is a written table: it is counted, and goes to the rows if it is small; a larger one
    meets them in a shuffle.
    """
    listed = ids.select(F.col("doc_id").alias("id"))
    if listed.count() <= FEW:
        listed = F.broadcast(listed)
    rows = whole_rows(df, "doc_id")
    return rows.join(listed, F.col("doc_id").eqNullSafe(F.col("id")), how).select("row.*")


def meet(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Rows of ``left`` with those of ``right``, a written table unique on ``on``, whose key is not null.

    A small table goes to the rows, which stay where they are; a larger one meets them in a shuffle.
    """
    if right.count() <= FEW:
        return left.join(F.broadcast(right), on)
    return lookup(left, right, [on])


# Edges (some 200 bytes each in a task) up to which a task settles them without further steps.
EDGES = 500_000


def _ranks(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct value is met, in ascending order, and every value's number in that order.

    Values are numbers, strings or structs of them, which go by their fields.
    """
    key = np.zeros(len(values), np.int64)
    for field in values.flatten() if pa.types.is_struct(values.type) else [values]:
        rank = pc.rank(field, tiebreaker="dense").to_numpy().astype(np.int64)
        key = np.unique(key * (len(values) + 1) + rank, return_inverse=True)[1]
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    return first, number


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, root`` of the edges ``a, b`` of one task: roots that an edge joins go to the smaller one."""
    held = list(batches)
    if not sum(batch.num_rows for batch in held):
        return
    nodes = pa.concat_arrays([batch[side] for side in ("a", "b") for batch in held])
    first, number = _ranks(nodes)
    a, b = number[: len(number) // 2], number[len(number) // 2 :]
    root = np.arange(len(first))
    while (root[a] != root[b]).any():
        one, other = root[a], root[b]
        low = np.minimum(one, other)
        np.minimum.at(root, one, low)
        np.minimum.at(root, other, low)
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(first)), nodes.take(pa.array(first[root]))], ["node", "root"])


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest node.

    Alternating large-star and small-star steps. A step replaces every edge by one
    to the smallest neighbour, so the number of edges never grows past the input's
    and a hub of any degree only meets its minimum, in as many tasks as it takes. Each
    step is written to the shared folder. Up to ``EDGES`` edges, all there are or what steps have left,
    are settled by one task: a step is a plan of a dozen shuffles, of which the driver
    keeps a record. ``a`` and ``b`` are numbers, strings or structs of them, alike and not null.
    """
    pairs = edges.select("a", "b").where("a <> b")
    pairs = materialised(
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc"
    )
    kind = pairs.schema["a"].dataType.simpleString()
    for _ in range(rounds):
        if pairs.count() <= EDGES:
            settled = pairs.coalesce(1).mapInArrow(_settled, f"node {kind}, root {kind}")
            done, pairs = pairs, materialised(settled, "cc")
            discard(done)
            return pairs
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours of u move to u's minimum.
        large = (
            lookup(both, low, ["u"]).where("v > u")
            .select(F.col("m").alias("a"), F.col("v").alias("b"))
            .where("a <> b").distinct()
        )
        # Small star: u and its smaller neighbours move to the smallest of them.
        small_low = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = lookup(large, small_low, ["b"])
        step = (
            moved.select(F.col("m").alias("a"), F.col("a").alias("b"))
            .unionByName(moved.select(F.col("m").alias("a"), "b"))
            .where("a <> b").distinct()
        )
        step = materialised(step, "cc")
        # Done when every node has one parent and no parent has one of its own.
        many = step.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("b")
        chained = step.join(step.select(F.col("b").alias("a")), "a", "left_semi").select("b")
        done, pairs = pairs, step
        discard(done)
        if many.unionByName(chained).isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} steps")
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        pairs.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "pos") -> DataFrame:
    """Rows numbered from 0 within ``group`` by ``order``, however many rows a group has.

    The rows are sorted over all tasks and written; a row's number is its place within its
    partition's rows of the group plus the group's rows in the partitions before. Null comes first.
    """
    sort = [group, *order]
    fixed = materialised(
        rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    fixed = fixed.withColumn("_part", F.shiftright("_at", 33))
    sizes = fixed.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sizes.select(
        F.col("_part").alias("_p"), F.col(group).alias("_g"), F.sum("_size").over(before).alias("_carried")
    ).where("_carried > 0")
    inside = F.row_number().over(Window.partitionBy("_part", group).orderBy("_at"))
    # A partition goes on with one group of those before at most: a row per partition, no more.
    found = fixed.withColumn("_place", inside).join(
        F.broadcast(carried), (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")), "left"
    )
    number = F.col("_place") - 1 + F.coalesce("_carried", F.lit(0))
    return found.select(*rows.columns, number.cast("long").alias(name))
