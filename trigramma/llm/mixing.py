"""An order of documents in which every source has its target weight at any time.

Sources are cut into blocks of documents, and time into slots of one block. Under Pfair
scheduling the k-th block of a source of weight w (of all weights' sum Q) is released at
slot floor(k Q / w) and due by slot ceil((k + 1) Q / w); in each slot the released block
that is due first is placed. As one block fits a slot and weights add up to the whole,
every block is placed between its release and its deadline, so a source is never a block
or more ahead or behind. The order repeats every Q slots, so only one round is worked out.
Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trigramma.llm.common import numbered, whole_rows
from trigramma.operators.joins import lookup
from trigramma.session import materialised, scratch_path

BLOCK = 64
# Parts a source is numbered in, as hexadecimal digits of a hash.
DIGITS = 4
# Slots worked out in one row, and up to which the round goes to the documents; a longer
# round is worked out in as many stretches as it takes, and joined.
STRETCH = 100_000
# Slots after which the order so far is copied, not after each.
CHUNK = 1_000


def _with(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def edf_stretch(classes: Column, total: int, first: int, last: int) -> Column:
    """``of, n`` for each slot from ``first`` to ``last``: the n-th block of a class, earliest deadline first.

    A class ``(weight, size, done, next)`` is all sources of a weight. Their k-th blocks have one release
    and one deadline, and ties go by name, so they are placed in turn: the n-th block of the class
    is the (n div size)-th of its (n mod size)-th source. ``next`` lists the sources from the first block
    that is not done on.
    """

    def place(state: Column, slot: Column) -> Column:
        def due(c: Column, i: Column) -> Column:
            n = F.get(state["placed"], i)
            k = F.floor(n / c["size"])
            source = F.get(c["next"], F.pmod(n - c["done"], c["size"]).cast("int"))["source"]
            deadline = F.ceil((k + 1) * total / c["weight"]).alias("due")
            # Released by now: its deadline; else none.
            return F.when(
                k * total < (slot + 1) * c["weight"],
                F.struct(deadline, source.alias("source"), i.alias("of"), n.alias("n")),
            )

        return _with(F.array_min(F.transform(classes, due)), lambda best: F.struct(
            F.transform(state["placed"], lambda n, i: F.when(i == best["of"], n + 1).otherwise(n)).alias("placed"),
            F.concat(state["order"], F.array(F.struct(best["of"].alias("of"), best["n"].alias("n")))).alias("order"),
        ))

    empty = F.array().cast("array<struct<of:int,n:bigint>>").alias("order")

    def chunk(state: Column, start: Column) -> Column:
        slots = F.sequence(start, F.least(start + CHUNK - 1, F.lit(last).cast("long")))
        done = F.aggregate(slots, F.struct(state["placed"].alias("placed"), empty), place)
        return _with(done, lambda d: F.struct(
            d["placed"].alias("placed"), F.concat(state["order"], d["order"]).alias("order")
        ))

    starts = F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"), F.lit(CHUNK).cast("long"))
    return F.aggregate(starts, F.struct(F.transform(classes, lambda c: c["done"]).alias("placed"), empty), chunk)["order"]


def timetable(sources: DataFrame) -> DataFrame:
    """``source, weight, total, turn, slot``: the slots of a round for ``sources(source, weight)``.

    Sources are ordered by name, null first. A round has as many slots as the weights' sum; it is worked
    out by classes of equal weight, ``STRETCH`` slots at a time. Between stretches the driver holds one
    number for every weight there is; names come to the slots by a join.
    """
    spark = sources.sparkSession
    rows = sources.select("source", F.col("weight").cast("long").alias("weight"))
    members = materialised(numbered(rows, "weight", ["source"], "place"), "members")
    sizes = {r["weight"]: r["size"] for r in members.groupBy("weight").agg(F.count(F.lit(1)).alias("size")).collect()}
    weights = sorted(sizes)
    total = sum(w * size for w, size in sizes.items())
    if not total:
        return members.select(
            "source", "weight", F.lit(0).cast("long").alias("total"), F.col("place").alias("turn"), F.col("place").alias("slot")
        )
    done = dict.fromkeys(weights, 0)
    path = scratch_path(spark, "timetable")
    for first in range(0, total, STRETCH):
        state = [
            F.struct(*[F.lit(v).cast("long").alias(k) for k, v in (("weight", w), ("size", sizes[w]), ("done", done[w]))])
            for w in weights
        ]
        known = spark.range(1).select(F.inline(F.array(*state)))
        ahead = F.pmod(F.col("place") - F.col("done"), F.col("size"))
        # At most STRETCH sources of a weight, and a row for every weight.
        coming = members.join(F.broadcast(known), "weight").withColumn("ahead", ahead).where(F.col("ahead") < STRETCH)
        classes = coming.groupBy("weight", "size", "done").agg(
            F.array_sort(F.collect_list(F.struct("ahead", "source"))).alias("next")
        ).agg(F.array_sort(F.collect_list(F.struct("weight", "size", "done", "next"))).alias("classes"))
        order = edf_stretch(F.col("classes"), total, first, min(first + STRETCH, total) - 1)
        slots = classes.select(F.posexplode(order).alias("slot", "block")).select(
            (F.col("slot") + F.lit(first).cast("long")).alias("slot"),
            F.get(F.array(*[F.lit(w).cast("long") for w in weights]), F.col("block.of")).alias("weight"),
            F.col("block.n").alias("n"),
        )
        slots.write.parquet(f"{path}/first={first}")
        written = spark.read.schema(slots.schema).parquet(f"{path}/first={first}")
        done |= {r["weight"]: r["n"] + 1 for r in written.groupBy("weight").agg(F.max("n").alias("n")).collect()}
    slots = spark.read.schema(slots.schema).parquet(path)
    size = F.get(F.array(*[F.lit(sizes[w]).cast("long") for w in weights]), F.array_position(
        F.array(*[F.lit(w).cast("long") for w in weights]), F.col("weight")).cast("int") - 1)
    slots = slots.withColumn("size", size).select(
        "weight", "slot", (F.col("n") % F.col("size")).alias("place"), F.floor(F.col("n") / F.col("size")).alias("turn")
    )
    named = lookup(slots, members, ["weight", "place"], "left")
    return named.select("source", "weight", F.lit(total).cast("long").alias("total"), "turn", "slot")


def _name(source: Column) -> Column:
    """A name that is never null, so that joins and numbering share a shuffle."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def numbered_rows(documents: DataFrame, weights: DataFrame) -> DataFrame:
    """``row, name, weight, rank``: every row, numbered from 0 within its source in the order of a hash.

    A source is numbered in 65,536 parts side by side, each from where the part before
    ends, so that no task sees a large source whole. The hash is one of ``doc_id``, and of the whole row where
    there is none. ``weights(source, weight)`` has a row for every source.
    """
    rows = whole_rows(documents, "doc_id", "source")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.xxhash64("row").cast("string"))))
    keyed = rows.withColumns({"key": key, "name": _name(F.col("source"))}).withColumn("part", F.substring("key", 1, DIGITS))
    sizes = keyed.groupBy("name", "part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    weighed = weights.select(_name(F.col("source")).alias("name"), "weight")
    starts = materialised(sizes.select("name", "part", start).join(weighed, "name"), "part_starts")
    inside = Window.partitionBy("name", "part").orderBy("key", "doc_id", F.xxhash64("row"))
    joined = keyed.join(starts.hint("merge"), ["name", "part"])
    return joined.select("row", "name", "weight", (F.col("start") + F.row_number().over(inside) - 1).alias("rank"))


def mix_sources(documents: DataFrame, targets: dict[str, int], default: int = 1, block: int = BLOCK) -> DataFrame:
    """``documents`` with all its columns, and ``mix_block, mix_slot, mix_position``.

    Sorted by ``mix_position`` the table is the mix: blocks of ``block`` documents of a source,
    each source as often as its target weight (``default`` for those not named). No document is
    left out or repeated: where a source has run out, its slots stay empty and positions skip
    them, and the others keep their proportions among each other.

    A null source is a source of its own; documents without an id are placed by a hash of their row,
    repeated rows follow each other, and a null text is a text like any other. A target of 0 or
    less is an error, as documents would have to go. Columns of the three names are replaced. An empty table gives an empty result.
    """
    if min([default, *targets.values()]) < 1:
        raise ValueError("weights are whole numbers from 1 on")
    spark = documents.sparkSession
    documents = documents.drop("mix_block", "mix_slot", "mix_position")
    wanted = [F.struct(F.lit(k).alias("name"), F.lit(w).cast("long").alias("target")) for k, w in sorted(targets.items())]
    named = spark.range(1).select(F.inline(F.array(*wanted).cast("array<struct<name:string,target:bigint>>")))
    sources = documents.select("source").distinct()
    weights = materialised(sources.join(named, F.col("source") == F.col("name"), "left").select(
        "source", F.coalesce("target", F.lit(default)).cast("long").alias("weight")
    ), "weights")
    turns = materialised(
        timetable(weights).select(_name(F.col("source")).alias("name"), "turn", "total", "slot"), "timetable"
    )
    ranked = numbered_rows(documents, weights).withColumn("block", F.floor(F.col("rank") / block))
    ranked = ranked.withColumn("turn", F.col("block") % F.col("weight"))
    if turns.count() <= STRETCH:
        placed = ranked.join(F.broadcast(turns), ["name", "turn"])
    else:
        placed = lookup(ranked, turns, ["name", "turn"])
    slot = F.floor(F.col("block") / F.col("weight")) * F.col("total") + F.col("slot")
    return placed.select(
        "row.*", F.col("block").alias("mix_block"), slot.alias("mix_slot"),
        (slot * block + F.col("rank") % block).alias("mix_position"),
    )
