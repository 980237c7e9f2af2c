"""A Merkle tree over a dataset: a leaf per row, a subtree per source, and a proof per row.

Nodes of a subtree are numbered, and every three neighbours (a run; the last may be shorter) become
one node of the next level, until one is left. Levels are made with window functions:
at level ``l`` the first rows of the nodes lie ``3^l`` rows apart, so siblings are lags and leads
by fixed offsets, masked by a node's slot in its run and by the length of the run; the
first child of a run hashes the parent.

A window holds a block of ``3^7`` neighbouring rows of a source, which cuts no run, so a source of any
size is spread over many tasks. Blocks are the rows of the next group of seven levels. The subtrees of
all sources are the rows of one more tree. Paths come down the same way, block by block,
and no text is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trigramma.llm.common import numbered
from trigramma.session import materialised

ARITY = 3
LEVELS = 7
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIDES = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of strings one after another."""
    return F.sha2(F.concat(*parts), 256)


def leaf(**changed: Column) -> Column:
    """The digest of a row: every field as its number of UTF-8 bytes, a colon and its value, ``-`` for null."""
    fields = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        fields.append(F.coalesce(sized, F.lit("-")))
    return digest(*fields)


def source_key(source: Column) -> Column:
    """A source as a key that is never null and sorts as the source does, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def climb(nodes: DataFrame, sides: bool) -> DataFrame:
    """Seven levels over ``nodes(tree, pos, node, …)``: adds ``block``, ``place``, ``top`` and, if asked for, ``sides``.

    ``top`` is the block's node of the seventh level, on its first row; for a tree of one block,
    of the level where one node is left. ``sides`` has, for every level there is, the
    digests to the left and to the right of the row's node in its run.
    """
    here = Window.partitionBy("tree", "block").orderBy("place")
    rows = nodes.withColumn("block", F.expr(f"pos div {BLOCK}")).withColumn("place", (F.col("pos") % BLOCK).cast("int"))
    rows = rows.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("tree", "block")))
    rows = rows.withColumn("top", F.col("node"))
    none = F.lit("")
    names = []
    for level in range(LEVELS):
        step = ARITY**level
        slot = F.expr(f"place div {step} % {ARITY}")
        # A block that is not the first of its tree has neighbours; in the first one a level is made
        # while there is more than one node.
        going = (F.col("block") > 0) | (F.col("size") > step)
        shifted = {}
        for k in range(1, ARITY):
            shifted[f"_b{k}"] = F.lag("top", k * step).over(here)
            shifted[f"_a{k}"] = F.lead("top", k * step).over(here)
        rows = rows.withColumns(shifted)
        first = F.col("place") % step == 0
        left = [F.when(slot >= k, F.col(f"_b{k}")).otherwise(none) for k in range(ARITY - 1, 0, -1)]
        right = [F.when(slot + k < ARITY, F.coalesce(f"_a{k}", none)).otherwise(none) for k in range(1, ARITY)]
        parent = F.when(~going, F.col("top")).when(slot == 0, digest(F.col("top"), *right))
        added = {"top": F.when(first, parent)}
        if sides:
            beside = F.struct(F.concat(*left).alias("left"), F.concat(*right).alias("right"))
            added["_beside"] = F.when(first & going, beside)
        rows = rows.withColumns(added).drop(*shifted)
        if sides:
            # A node's sides, from its first row to all its rows.
            names.append(f"_side{level}")
            rows = rows.withColumn(names[-1], F.last("_beside", ignorenulls=True).over(here)).drop("_beside")
    if sides:
        rows = rows.withColumn("sides", F.array_compact(F.array(*names))).drop(*names)
    return rows.drop("size")


def _tops(nodes: DataFrame) -> DataFrame:
    made = climb(nodes.select("tree", "pos", "node"), False).where("place = 0")
    return materialised(made.select("tree", F.col("block").alias("pos"), F.col("top").alias("node")), "merkle_nodes")


def roots(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The one node left of every tree, ``tree, node``, and the tables of nodes on the way there.

    A loop for every seven levels of the largest tree: three for a thousand million rows.
    """
    tables = [nodes]
    while True:
        tops = _tops(tables[-1])
        if (tops.agg(F.max("pos")).first()[0] or 0) == 0:
            return tops.select("tree", "node"), tables
        tables.append(tops)


def paths(tables: list[DataFrame], above: DataFrame) -> DataFrame:
    """Rows of the lowest table with ``path``: all sides from the row up, then those of ``above(tree, path, …)``."""
    rest = [c for c in above.columns if c not in ("tree", "path")]
    upper = above.select(F.col("tree").alias("_tree"), F.lit(0).cast("long").alias("_pos"), F.col("path").alias("_path"), *rest)
    for number, nodes in reversed(list(enumerate(tables))):
        made = climb(nodes, True)
        joined = made.join(upper, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_pos")))
        path = F.concat("sides", "_path").alias("path")
        if number == 0:
            return joined.select(*nodes.columns, path, *rest)
        upper = materialised(
            joined.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), path.alias("_path"), *rest),
            "merkle_paths",
        )
    raise ValueError("no table of nodes")


def manifest(documents: DataFrame, changed: Column | None = None, when: Column | None = None) -> DataFrame:
    """Per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, and ``source, path``.

    ``documents(doc_id, source, lang, n_chars, text)``. ``path`` is the proof itself, digests left and
    right of the row's node from its run up to the root. ``folded_root`` is worked out from the path and the row
    as it is found: with ``changed`` in place of its text where ``when`` holds. ``verified`` says
    whether this is the root.

    Rows of a source go by ``doc_id``, null first, equal ones by their leaves; rows that are
    equal altogether are leaves side by side. A null source is a source, the first one; any field
    may be null, and texts may be empty or very long. An empty table has no rows. Extra
    columns are not read.
    """
    now = leaf() if changed is None else F.when(F.coalesce(when, F.lit(False)), leaf(text=changed)).otherwise(leaf())
    rows = documents.select(source_key(F.col("source")).alias("tree"), "source", "doc_id", leaf().alias("node"), now.alias("found"))
    leaves = materialised(numbered(rows, "tree", ["doc_id", "node"]), "leaves")
    subroots, tables = roots(leaves)
    subroots = materialised(subroots.withColumnRenamed("tree", "key").withColumn("tree", F.lit("")), "subroots")
    listed = materialised(numbered(subroots, "tree", ["key"]), "subroots")
    whole, upper = roots(listed)
    above = paths(upper, whole.select("tree", F.array().cast(SIDES).alias("path"), F.col("node").alias("root")))
    above = materialised(
        above.select(F.col("key").alias("tree"), "path", F.col("node").alias("subroot"), "root"), "subroot_paths"
    )
    folded = F.aggregate("path", F.col("found"), lambda node, side: digest(side["left"], node, side["right"]))
    beside = F.transform("path", lambda side: F.concat(side["left"], side["right"]))
    proved = paths(tables, above).withColumn("folded_root", folded)
    return proved.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", F.sha2(F.array_join(beside, ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "source", "path",
    )
