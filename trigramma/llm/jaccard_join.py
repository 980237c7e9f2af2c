"""Near duplicates: all links between sets of word shingles, by T-occurrence search.

1. Every text becomes the set of its distinct shingles, as 64-bit hashes; equal sets
   are one class, named by a 128-bit hash, and only classes go on.
2. A set of ``n`` shingles shares at least ``T = ceil(percent n / 100)`` with any partner. The
   inverted lists of its smallest ``n - T + t`` hashes must therefore hold every partner
   at least ``t`` times. Of these lists the ``n - T + 1`` shortest must hold it at least
   once: short lists decide who can meet whom, the long ones are left for probing.
   Classes that meet in short lists form clusters. Most sets drop out with a small ``t``;
   the others are sifted once more with a large one, and large clusters, among themselves, by
   all their hashes.
3. A cluster is cut into tiles, and a task gets two tiles: for each set of the one it
   merges the short lists of the other's inverted index on a heap and probes the long
   ones by binary search (DivideSkip), and keeps the sets that reach the required overlap.

Shingles of many documents (a licence, a menu) are long lists, so that they do not tie
together documents that share nothing else; no list, cluster or document is cut short.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trigramma.llm.common import connected_components, rows_with
from trigramma.llm.texts import chained, name_of, parts, raw, sliced, word_hashes
from trigramma.operators.joins import lookup
from trigramma.session import materialised, run_folder, scratch_path

# Words of a shingle and similarity of a link, as op2_jaccard_join has them.
SHINGLE = 4
PERCENT = 85
# Share of a set's lists looked at beyond those that must be, to tell long from short: for
# all sets, and for those in clusters.
SPARE = 0.05
WIDER = 0.35
# Of all lists of a set, all but one of those that must hold a partner.
WHOLE = 1 - 1e-9
# Sets of a tile, of which one counts once more for every so many shingles (8 bytes each). A cluster's sets
# go to a task for every tile the cluster has, so tiles are as large as a task's memory may well hold.
TILE = 2048
LONG = 512
# Rows of names (some 60 bytes each) up to which the texts they ask for are not shuffled.
FEW = 500_000
# Names that a task remembers, to leave out copies.
NAMES = 100_000
# Weight of a probe against a step of the heap, in the choice of the number of long lists.
MU = 0.01


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text.

    Words are runs of anything but ASCII white space, A-Z lower-cased: what ``split``
    and ``lower`` do on bytes. Texts are worked on a megabyte at a time.
    """
    for part in parts(texts):
        words = [raw(t).lower().split() for t in part]
        counts = np.array([len(w) for w in words])
        hashed = word_hashes([w for some in words for w in some])
        hashed = np.append(hashed, np.zeros(size, np.uint64))
        whole = chained([hashed[i : len(hashed) - size + i] for i in range(size)])
        for start, count in zip(np.cumsum(counts) - counts, counts):
            if count >= size:
                yield np.unique(whole[start : start + count - size + 1])
            elif count:
                yield chained([hashed[start + i : start + i + 1] for i in range(count)])
            else:
                yield np.empty(0, np.uint64)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Smallest overlap of a set of ``n`` with any partner."""
    return -(-percent * n // 100)


def looked_at(n: int, percent: int = PERCENT) -> int:
    """How many lists of a set are looked at."""
    return n - least_overlap(n, percent) + 1 + int(SPARE * n)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Name and size of every text's set."""
    for batch in sliced(batches):
        names, sizes = [], []
        for s in shingle_sets(batch["text"].to_pylist(), size):
            names.append(name_of(s))
            sizes.append(len(s))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(sizes, pa.int64()), *[pa.array([n[i] for n in names], pa.int64()) for i in range(2)]],
            ["doc_id", "n", "s1", "s2"],
        )


def _heads(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Half a name of every set, and the hashes of the lists to be looked at.

    Of copies that lie close together only the first has them.
    """
    seen: set[tuple[int, int]] = set()
    for batch in sliced(batches):
        names, heads = [], []
        for s in shingle_sets(batch["text"].to_pylist(), size):
            name = name_of(s)
            if len(s) and name not in seen:
                # A copy, which does not hold the rest of the set.
                heads.append(s[: looked_at(len(s), percent)].view(np.int64).copy())
                names.append(name[0])
            if len(seen) >= NAMES:
                seen.clear()
            seen.add(name)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), _lists(heads)], ["s1", "heads"])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _arrays(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        sets = list(shingle_sets(batch["text"].to_pylist(), size))
        # A row repeating the doc_id may have another text.
        right = pa.array([
            name_of(s) == (a, b) for s, a, b in zip(sets, batch["s1"].to_pylist(), batch["s2"].to_pylist())
        ], pa.bool_())
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [batch[n] for n in names] + [_lists([s.view(np.int64) for s in sets])], [*names, "shingles"]
        ).filter(right)


def _named(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        sets = [s for s in shingle_sets(batch["text"].to_pylist(), size) if len(s)]
        names = [name_of(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n[i] for n in names], pa.int64()) for i in range(2)]
            + [_lists([s.view(np.int64) for s in sets])],
            ["s1", "s2", "shingles"],
        )


class Index:
    """Inverted lists of a tile: shingle hash to the ascending places of the sets that have it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        hashes = np.concatenate(sets)
        places = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((places, hashes))
        self.places = places[order]
        self.hashes, self.starts = np.unique(hashes[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(hashes))
        # List and place as one ascending number, to probe many lists at once.
        lists = np.repeat(np.arange(len(self.hashes)), self.ends - self.starts)
        self.keys = lists * len(sets) + self.places

    def lists(self, query: np.ndarray) -> np.ndarray:
        """The numbers of the lists of a set's shingles, shortest first."""
        at = np.searchsorted(self.hashes, query)
        at = at[at < len(self.hashes)] if len(at) and at[-1] >= len(self.hashes) else at
        at = at[self.hashes[at] == query[: len(at)]]
        return at[np.argsort(self.ends[at] - self.starts[at], kind="stable")]

    def places_of(self, number: int) -> np.ndarray:
        return self.places[self.starts[number] : self.ends[number]]

    def search(self, query: np.ndarray, percent: int = PERCENT) -> list[int]:
        """Places of the sets whose similarity to ``query`` is ``percent`` or more (DivideSkip)."""
        needed = least_overlap(len(query), percent)
        lists = self.lists(query)
        if len(lists) < needed or not len(lists):
            return []
        longest = self.ends[lists[-1]] - self.starts[lists[-1]]
        skipped = min(needed - 1, int(needed / (MU * log2(longest + 1) + 1)))
        short, long = lists[: len(lists) - skipped], lists[len(lists) - skipped :]
        places, counts = [], []
        for place, run in groupby(heapq.merge(*[self.places_of(i).tolist() for i in short])):
            count = sum(1 for _ in run)
            if count >= needed - skipped:
                places.append(place)
                counts.append(count)
        at, count = np.array(places, np.int64), np.array(counts, np.int64)
        total = self.sizes[at] + len(query)
        goal = -(-percent * total // (100 + percent))
        left = len(long)
        while left and len(at):
            # As many lists at a time as make a few thousand probes; then those that cannot
            # reach their goal any more go.
            some = long[len(long) - left :][: max(1, 4096 // len(at))]
            if len(some) == 1:
                probed = self.places_of(some[0])
                found = np.searchsorted(probed, at)
                count = count + (probed[np.minimum(found, len(probed) - 1)] == at)
            else:
                wanted = (some * len(self.sizes))[:, None] + at
                found = np.searchsorted(self.keys, wanted)
                count = count + (self.keys[np.minimum(found, len(self.keys) - 1)] == wanted).sum(axis=0)
            left -= len(some)
            able = count + left >= goal
            at, count, total, goal = at[able], count[able], total[able], goal[able]
        return at[100 * count >= percent * (total - count)].tolist()


def _tile_links(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the two tiles of a task (or inside the one it has).

    A row for every set with its number of links, each counted with the documents of the
    other class; and rows of links that tie together all sets that the links tie together
    (a spanning forest).
    """
    frame = frame.drop_duplicates(["s1", "s2"], ignore_index=True)
    sets = [np.asarray(x, np.int64).view(np.uint64) for x in frame.shingles]
    names, copies = list(zip(frame.s1, frame.s2)), frame.copies.to_numpy()
    first = np.flatnonzero(frame.tile == frame.low)
    second = np.flatnonzero(frame.tile == frame.high)
    counts = np.zeros(len(sets), np.int64)
    above = list(range(len(sets)))

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    rows: list[tuple] = []
    index = Index([sets[i] for i in second]) if len(first) and len(second) else None
    same = frame.low.iat[0] == frame.high.iat[0]
    for q in first if index else ():
        for place in index.search(sets[q], percent):
            p = int(second[place])
            # Inside one tile either side finds the other.
            if same and p <= q:
                continue
            counts[q] += copies[p]
            counts[p] += copies[q]
            if top(q) != top(p):
                above[top(q)] = top(p)
                rows.append((*names[q], *names[p], 0))
    rows += [(*names[i], None, None, int(counts[i])) for i in np.flatnonzero(counts)]
    # Nullable integers from the start: names do not fit a double.
    columns = zip(*rows) if rows else [()] * 5
    return pd.DataFrame({n: pd.array(c, "Int64") for n, c in zip(("s1", "s2", "o1", "o2", "n_links"), columns)})


def near_duplicates(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row of ``documents(doc_id, text)``.

    Texts are linked whose sets of shingles of ``size`` words are ``percent`` or more alike.
    ``component_id`` is the smallest ``doc_id`` that links lead to, ``n_links`` the number
    of other rows linked directly. Null texts and texts without words are sets without
    shingles: linked with nothing, their component is their own ``doc_id``. Rows that
    repeat a ``doc_id`` are judged one by one. A null ``doc_id`` takes part in links, but
    never names a component with another member; alone its component is null. Ties do
    not arise: a component has one smallest id. An empty table gives an empty result.
    Extra columns are not read.
    """
    docs = documents.select("doc_id", "text")
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = materialised(docs.mapInArrow(partial(_sets, size=size), f"doc_id {kind}, n long, s1 long, s2 long"), "sets")
    path = scratch_path(spark, "classes")
    # Whatever else is written on the way goes.
    with run_folder(spark, "links"):
        _facts(docs, sets, size, percent).write.parquet(path)
    with_words = sets.where("n > 0").join(spark.read.parquet(path), ["s1", "s2"])
    return with_words.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links").unionByName(
        sets.where("n = 0").select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
        )
    )


def _facts(docs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """``s1, s2, component_id, n_links`` of every class."""
    linked = class_links(docs, sets, size, percent)
    edges = linked.where("other is not null").select(F.col("name").alias("a"), F.col("other").alias("b"))
    roots = materialised(
        connected_components(edges).select(F.col("node.*"), F.col("root.s1").alias("r1"), F.col("root.s2").alias("r2")),
        "roots",
    )
    classes = _classes(sets).join(roots, ["s1", "s2"], "left").select(
        "s1", "s2", "least", "copies", F.coalesce("r1", "s1").alias("r1"), F.coalesce("r2", "s2").alias("r2")
    )
    smallest = classes.groupBy("r1", "r2").agg(F.min("least").alias("component_id"))
    degree = linked.groupBy("name").agg(F.sum("n_links").alias("n_links")).select("name.*", "n_links")
    return (
        lookup(classes, smallest, ["r1", "r2"]).join(degree, ["s1", "s2"], "left")
        .select("s1", "s2", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )


def keep_one(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of every group of linked ones, with all its columns.

    The smallest ``doc_id`` stays; of rows that repeat it, one. Documents without words or
    without an id are linked with nothing that could take their place, and stay, unless a
    document with an id stands for their group. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    stay = F.col("component_id").eqNullSafe(F.col("doc_id"))
    path = scratch_path(spark, "gone")
    with run_folder(spark, "near"):
        found = near_duplicates(documents, size, percent)
        stays = found.groupBy("doc_id").agg(F.count_if(stay).alias("rows"))
        # Few beside those that stay: ids of which all rows go, or all but one of several.
        stays.where("rows = 0 or (rows > 1 and doc_id is not null)").write.parquet(path)
    gone = spark.read.parquet(path)
    several = rows_with(documents, gone.where("rows > 1"))
    return rows_with(documents, gone, "left_anti").unionByName(several.dropDuplicates(["doc_id"]))


def _classes(sets: DataFrame) -> DataFrame:
    """Equal sets as one class; counted per task before the shuffle, however many copies there are."""
    return sets.where("n > 0").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("least"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")
    )


def _shared(postings: DataFrame) -> DataFrame:
    """``s1, hash, length`` of the postings in lists that two different sets are in.

    Half of a name tells the sets of a list apart. Copies come once per task, and add to
    the length of their lists alone.
    """
    # The postings are made and shuffled once: a list lies together, and is told what it is on the spot.
    of = Window.partitionBy("hash")
    lists = postings.select(
        "s1", "hash", F.min("s1").over(of).alias("low"), F.max("s1").over(of).alias("high"),
        F.count(F.lit(1)).over(of).alias("length"),
    )
    return lists.where("low <> high").groupBy("s1", "hash").agg(F.max("length").alias("length"))


def _short(shared: DataFrame, classes: DataFrame, spare: float, percent: int) -> DataFrame:
    """``hash, name`` of the shared lists of each class that are short.

    Of the lists looked at all but ``t - 1`` are short, with ``t = 1 + floor(spare n)``. A partner
    has ``percent`` as many shingles at least, so its ``t`` is the one to go by. Lists that only one
    set has are shorter than the shared ones: the longest are all shared, if so many are.
    """
    rows = shared.join(classes.select("s1", "s2", "n"), "s1")
    ordered = Window.partitionBy("s1", "s2").orderBy(F.col("length").desc(), F.col("hash").desc())
    left = F.floor(F.ceil(F.col("n") * percent / 100) * spare)
    return (
        rows.withColumn("place", F.row_number().over(ordered)).where(F.col("place") > left)
        .select("hash", F.struct("s1", "s2").alias("name"))
    )


def _clusters(short: DataFrame, classes: DataFrame) -> DataFrame:
    """``s1, s2, root, size`` of the classes that meet in short lists; the size is in sets as tiles count them."""
    short = materialised(short, "short")
    met = short.select("name", F.min("name").over(Window.partitionBy("hash")).alias("head")).where("name <> head")
    found = connected_components(met.select(F.col("head").alias("a"), F.col("name").alias("b")))
    found = found.select("node.*", "root").join(classes.select("s1", "s2", "n"), ["s1", "s2"])
    sizes = found.groupBy("root").agg(F.sum(1 + F.floor(F.col("n") / LONG)).alias("size"))
    # A large cluster is cut up, not met in one task.
    return materialised(lookup(found.drop("n"), sizes, ["root"]).select("s1", "s2", "root", "size"), "clusters")


def class_links(docs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """``name, other, n_links``: partial counts of links, and links that span the components."""
    classes = materialised(_classes(sets), "classes")
    heads = docs.select("text").mapInArrow(partial(_heads, size=size, percent=percent), "s1 long, heads array<long>")
    first = _shared(heads.select("s1", F.explode("heads").alias("hash")))
    members = _members(docs, classes, _clusters(_short(first, classes, SPARE, percent), classes), size)
    n = F.size("shingles")
    wide = F.slice("shingles", 1, (n - F.ceil(n * percent / 100) + 1 + F.floor(n * WIDER)).cast("int"))
    again = _shared(members.select("s1", F.explode(wide).alias("hash")))
    clusters = _broken_up(members, classes, _clusters(_short(again, classes, WIDER, percent), classes), percent)
    return _cluster_links(members.join(clusters, ["s1", "s2"]), percent)


def _broken_up(members: DataFrame, classes: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """``clusters``, those of more than a tile sifted by all of their hashes, as long as that drops a tenth.

    In a large corpus shingles met by chance tie together sets that are not alike, and a cluster
    costs the square of its tiles. All lists of a set must hold a partner ``T`` times, so the
    ``n - T + 1`` shortest of them hold it.
    """
    done, large = clusters.where(F.col("size") <= TILE), clusters.where(F.col("size") > TILE)
    sets = large.count()
    while sets:
        hashes = members.join(large, ["s1", "s2"], "left_semi").select("s1", F.explode("shingles").alias("hash"))
        found = _clusters(_short(_shared(hashes), classes, WHOLE, percent), classes)
        done, large = done.unionByName(found.where(F.col("size") <= TILE)), found.where(F.col("size") > TILE)
        before, sets = sets, large.count()
        if 10 * sets > 9 * before:
            break
    return done.unionByName(large)


def _members(docs: DataFrame, classes: DataFrame, clusters: DataFrame, size: int) -> DataFrame:
    """``s1, s2, copies, shingles`` of all classes in clusters.

    A class comes again for every row that repeats its ``doc_id`` and its text.
    """
    asked = materialised(
        classes.join(clusters, ["s1", "s2"], "left_semi").select("least", "s1", "s2", "copies"), "asked"
    )
    by_id = asked.where("least is not null").withColumnRenamed("least", "doc_id")
    # Few names go to the texts, which then stay where they are; many meet them in a shuffle.
    if asked.count() <= FEW:
        by_id = F.broadcast(by_id)
    kept = "s1 long, s2 long, copies long, shingles array<long>"
    found = docs.join(by_id, "doc_id").select("text", "s1", "s2", "copies").mapInArrow(
        partial(_arrays, size=size), kept
    )
    # Classes of which no member has an id are looked up by name.
    nameless = docs.where("doc_id is null").select("text").mapInArrow(
        partial(_named, size=size), "s1 long, s2 long, shingles array<long>"
    )
    unnamed = asked.where("least is null").drop("least")
    rest = nameless.dropDuplicates(["s1", "s2"]).join(unnamed, ["s1", "s2"]).select(*found.columns)
    return materialised(found.unionByName(rest), "members")


def _cluster_links(members: DataFrame, percent: int) -> DataFrame:
    """Every set of a cluster against every other, tile by tile."""
    # A tile is a residue of the name's hash, so that no task sees a whole cluster to number it.
    tiled = members.withColumn("tiles", F.ceil(F.col("size") / TILE).cast("int")).withColumn(
        "tile", F.pmod(F.xxhash64("s1", "s2"), F.col("tiles")).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("with")
    pairs = tiled.select("*", others).select(
        "s1", "s2", "root", "tile", "copies", "shingles",
        F.least("tile", "with").alias("low"), F.greatest("tile", "with").alias("high"),
    )
    links = pairs.groupBy("root", "low", "high").applyInPandas(
        lambda frame: _tile_links(frame, percent), "s1 long, s2 long, o1 long, o2 long, n_links long"
    )
    other = F.when(F.col("o1").isNotNull(), F.struct(F.col("o1").alias("s1"), F.col("o2").alias("s2"))).alias("other")
    return materialised(links.select(F.struct("s1", "s2").alias("name"), other, "n_links"), "links")
