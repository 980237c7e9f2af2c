"""URL rules and exact host lists held in a cascade of Bloom filters.

The first level of a cascade holds the listed keys. Keys of the universe that
are not listed but pass it go into the second level, listed keys that pass that
one into the third, and so on until no key passes wrongly. Walking the levels
then answers membership exactly for every key of the universe, without a join.
All of it is DataFrame code: bits are set by ``bitmap_construct_agg`` and read
with ``substring``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trigramma.llm.common import ascii_lower
from trigramma.session import materialised

# Bits of one bitmap as Spark's bitmap functions make them.
WORD = 32_768


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both are empty where the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"\A([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _positions(key: Column, level: int, hashes: int, words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 64 + j)), F.lit(words * WORD)) for j in range(hashes)]


def _bit(bitmaps: Column, position: Column) -> Column:
    """Whether the bit at ``position`` is set in an array of bitmaps."""
    bitmap = F.get(bitmaps, F.floor(position / WORD).cast("int"))
    inside = (position % WORD).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(inside / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.expr("true") & (
        F.call_function("shiftrightunsigned", byte.cast("int"), inside % 8).bitwiseAND(F.lit(1)) == 1
    )


@dataclass(frozen=True)
class Cascade:
    """Levels as one-row tables of an array of bitmaps."""

    levels: list[tuple[DataFrame, int]]
    hashes: int

    def passes(self, key: Column, level: int) -> Column:
        bitmaps, words = self.levels[level]
        found = F.lit(True)
        for position in _positions(key, level, self.hashes, words):
            found = found & _bit(bitmaps.scalar(), position)
        return found

    def contains(self, key: Column) -> Column:
        """Exact for keys of the universe the cascade was built over."""
        if not self.levels:
            return F.lit(False)
        # In a level but not in the next one: an even level means listed.
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            answer = F.when(self.passes(key, level), answer).otherwise(F.lit(level % 2 == 1))
        return answer

    def mark(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with a boolean column."""
        return df.withColumn(name, self.contains(F.col(key)))


@dataclass(frozen=True)
class SplitCascade:
    """A cascade for every part of the keys, probed one after the other by the rows of its part."""

    parts: list[Cascade]

    def mark(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with a boolean column; with several parts ``df`` is read once for each."""
        if len(self.parts) == 1:
            return self.parts[0].mark(df, key, name)
        part = part_of(F.col(key), len(self.parts))
        marked = [cascade.mark(df.where(part == i), key, name) for i, cascade in enumerate(self.parts)]
        return reduce(DataFrame.unionByName, marked)


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("part")), F.lit(parts))


def build_cascade(
    keys: DataFrame, bits_per_key: int = 12, hashes: int = 4, max_bytes: int = 64 << 20
) -> SplitCascade:
    """A cascade over ``keys(key, listed)``: the whole universe, distinct keys.

    Every task receives the bits of a cascade, so they are held to about ``max_bytes`` (a bitmap
    of ``WORD`` bits for each level at least): a universe that is expected to need more is split by a hash of the
    keys into as many parts as it takes, each with a cascade of its own. ``keys`` is a written
    table, read once for a part and level. Null keys are not part of the universe.
    """
    keys = keys.where(F.col("key").isNotNull())
    sizes = keys.agg(F.count_if("listed").alias("listed"), F.count_if(~F.col("listed")).alias("others")).first()
    # Levels hold, in turns, what is left of the others and of the listed after so many filters.
    wrong = (1 - math.exp(-hashes / bits_per_key)) ** hashes
    bits = (sizes.listed + wrong * sizes.others) / (1 - wrong) * bits_per_key if sizes.listed else 0
    parts = max(1, math.ceil(bits / max(8 * max_bytes, WORD)))
    part = part_of(F.col("key"), parts)
    several = [keys.where(part == i) for i in range(parts)] if parts > 1 else [keys]
    return SplitCascade([_levels(some, bits_per_key, hashes) for some in several])


def _levels(keys: DataFrame, bits_per_key: int, hashes: int) -> Cascade:
    """The levels of one cascade, each sized by a count of what it holds."""
    inside, outside = keys.where("listed").select("key"), keys.where(~F.col("listed")).select("key")
    levels: list[tuple[DataFrame, int]] = []
    while (count := inside.count()) > 0:
        words = -(-count * bits_per_key // WORD)
        level = len(levels)
        bits = inside.select(
            F.explode(F.array(*_positions(F.col("key"), level, hashes, words))).alias("bit")
        )
        maps = bits.groupBy(F.floor(F.col("bit") / WORD).cast("int").alias("word")).agg(
            F.call_function("bitmap_construct_agg", F.col("bit") % WORD).alias("bits")
        )
        empty = keys.sparkSession.range(words).select(
            F.col("id").cast("int").alias("word"), F.unhex(F.repeat(F.lit("00"), WORD // 8)).alias("zero")
        )
        full = empty.join(maps, "word", "left").select("word", F.coalesce("bits", "zero").alias("bits"))
        row = full.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("all"))
        levels.append((materialised(row.select(F.col("all.bits").alias("bits")), "cascade"), words))
        wrong = Cascade(levels, hashes).passes(F.col("key"), level)
        inside, outside = materialised(outside.where(wrong), "cascade"), inside
    return Cascade(levels, hashes)


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``.

    A url with a fitting rule gets the longest rule's verdict. The rules also say
    which hosts are trusted: a host of which they block more pages than they allow
    is listed, and its remaining pages are blocked; all others are allowed. The
    list is held in a cascade over all hosts of the table.

    Null urls and urls without ``://`` have an empty host and path, which is a host
    like any other. Repeated rows are judged one by one and count each. An empty
    table gives an empty result. Extra columns are not read.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    votes = F.sum(F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", -1).otherwise(0))
    hosts = ruled.groupBy(F.col("host").alias("key")).agg((votes > 0).alias("listed"))
    cascade = build_cascade(materialised(hosts, "hosts"))
    marked = cascade.mark(ruled, "host", "_listed")
    judged = F.coalesce("ruled", F.when(F.col("_listed"), "block").otherwise("allow"))
    return marked.select("page_id", "host", "path", "rule", judged.alias("verdict"))
