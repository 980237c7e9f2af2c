"""Secrets in text: known shapes, and tokens that pass a battery of randomness tests.

The alphabet of a long token is inferred from its characters, and three tests ask whether
they were drawn from it at random: chi-squared for uniformity, runs above and below the
middle of the alphabet, and the serial correlation of neighbours. Their combined
probability is that of random characters looking as uneven. Tokens made of words (paths,
names, rulers) are left out; of the others those are put aside as not random that
Benjamini and Hochberg's procedure rejects, in every band of lengths over all of the
corpus, and those below a fixed probability in any case. What stays is random.
Everything is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trigramma.session import materialised

KINDS = ("assign", "access", "hex", "random")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Shapes. Runs are taken whole, so a least length may be part of the expression, but where a
# match that is too short hides what stands inside it.
ASSIGN = (
    "(" + "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
LEAST_VALUE = 6

DIGITS = "0123456789"
LOW = "abcdefghijklmnopqrstuvwxyz"
UP = LOW.upper()
# Ends of the bands of lengths.
BANDS = (32, 48, 96)
# Probabilities are counted in this many bins a power of ten, down to the last bin.
BINS = 4
LAST = 40
# Of the tokens put aside as not random, the share that may be random.
FALSE_SHARE = 0.05
# Tokens from this bin on (a probability of 0.001 and less) never count as random.
HOPELESS = 12


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _count(text: Column, part: Column | str) -> Column:
    """How often a short text occurs in another."""
    part = F.lit(part) if isinstance(part, str) else part
    return (F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)


def is_word(token: Column) -> Column:
    """Letters alone, in the case of a word: these cannot be told from words."""
    return token.rlike(r"\A([a-z]+|[A-Z][a-z]+|[A-Z]+)\z")


def plain(token: Column) -> Column:
    """Without padding, both base-64 alphabets as one, letters of words in lower case."""
    bare = F.translate(token, "-_=", "+/")
    return F.when(is_word(bare), F.lower(bare)).otherwise(bare)


def alphabet(token: Column) -> Column:
    """The smallest known alphabet that a plain token is written in."""
    return (
        F.when(token.rlike(r"\A[0-9]+\z"), DIGITS)
        .when(token.rlike(r"\A[a-z]+\z"), LOW)
        .when(token.rlike(r"\A[0-9a-f]+\z"), DIGITS + LOW[:6])
        .when(token.rlike(r"\A[0-9A-F]+\z"), DIGITS + UP[:6])
        .when(token.rlike(r"\A[A-Z2-7]+\z"), UP + "234567")
        .when(token.rlike(r"\A[0-9a-z]+\z"), DIGITS + LOW)
        .when(token.rlike(r"\A[0-9A-Z]+\z"), DIGITS + UP)
        .otherwise(UP + LOW + DIGITS + "+/")
    )


def chi_squared(token: Column, letters: Column) -> Column:
    """Standard score of the unevenness of the characters (Wilson and Hilferty's cube root)."""
    n, m = F.length(token), F.length(letters)
    counts = F.transform(F.split(letters, ""), lambda c: F.when(c == "", 0.0).otherwise(_count(token, F.when(c == "", "?").otherwise(c))))
    squares = F.aggregate(counts, F.lit(0.0), lambda total, c: total + c * c)
    free = m - 1
    return (F.pow((m / n * squares - n) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))


def runs(token: Column, letters: Column) -> Column:
    """Standard score of the number of runs in the lower and the upper half of the alphabet."""
    half = F.floor(F.length(letters) / 2).cast("int")
    # Characters of the upper half become 1, all others 0.
    upper = F.substring(letters, half + 1, F.length(letters))
    marked = F.aggregate(F.split(upper, ""), token, lambda t, c: F.replace(t, F.when(c == "", "\x01").otherwise(c), F.lit("\x01")))
    sides = F.regexp_replace(marked, "[^\x01]", "0")

    def score(bits: Column) -> Column:
        # As doubles: products of three lengths pass an integer's range.
        n = F.length(bits).cast("double")
        low = _count(bits, "0")
        high = n - low
        found = 1 + _count(bits, "0\x01") + _count(bits, "\x010")
        both = 2 * low * high
        spread = both * (both - n) / (n * n * (n - 1))
        # All on one side has no spread: as far off as can be told.
        return F.when(spread > 0, (found - both / n - 1) / F.sqrt(spread)).otherwise(F.sqrt(n))

    return _let(sides, score)


def serial(token: Column, letters: Column) -> Column:
    """Standard score of the correlation of neighbouring characters' places in the alphabet."""
    places = F.transform(F.split(token, ""), lambda c: F.instr(letters, c).cast("double"))
    start = F.struct(*[F.lit(x).alias(n) for n, x in (("last", -1.0), ("xy", 0.0), ("x", 0.0), ("y", 0.0), ("xx", 0.0), ("yy", 0.0))])

    def step(s: Column, v: Column) -> Column:
        pair = s["last"] >= 0
        add = lambda name, value: F.when(pair, s[name] + value).otherwise(s[name]).alias(name)
        return F.struct(
            v.alias("last"), add("xy", s["last"] * v), add("x", s["last"]), add("y", v),
            add("xx", s["last"] * s["last"]), add("yy", v * v),
        )

    def score(s: Column) -> Column:
        n = F.length(token) - 1
        below = (n * s["xx"] - s["x"] * s["x"]) * (n * s["yy"] - s["y"] * s["y"])
        r = (n * s["xy"] - s["x"] * s["y"]) / F.sqrt(below)
        return F.when(below > 0, r).otherwise(1.0) * F.sqrt(n)

    return _let(F.aggregate(places, start, step), score)


def is_ordinary(token: Column) -> Column:
    """Made of words: pieces between separators or humps are letters in the case of a word, or few digits."""
    humps = F.regexp_replace(token, "(?<=[a-z]{2})(?=[A-Z][a-z]{2})", "/")
    rest = F.regexp_replace(humps, "(?<![A-Za-z0-9])(?:[A-Z]?[a-z]++|[A-Z]++|[0-9]{1,4})(?![A-Za-z0-9])", "")
    return ~rest.rlike("[A-Za-z0-9]")


def randomness(token: Column) -> Column:
    """Probability that random characters look as uneven as a token's."""

    def combined(token: Column) -> Column:
        def of(letters: Column) -> Column:
            # Squares of three standard scores: chi-squared with three degrees of freedom.
            total = (
                F.pow(F.greatest(chi_squared(token, letters), F.lit(0.0)), F.lit(2))
                + F.pow(runs(token, letters), F.lit(2)) + F.pow(serial(token, letters), F.lit(2))
            )
            z = (F.pow(total / 3, F.lit(1 / 3)) - (1 - 2 / 27)) / (2 / 27) ** 0.5
            return _let(z, lambda z: 1 / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(600.0)))))

        return _let(alphabet(token), of)

    return _let(plain(token), combined)


def binned(p: Column) -> Column:
    """Bin ``b`` holds probabilities of at most ``10 ** (-b / BINS)``; the higher, the less random."""
    return F.least(F.floor(-BINS * F.log10(p)), F.lit(LAST)).cast("int")


def band(token: Column) -> Column:
    n = F.length(token)
    return sum(((n >= end).cast("int") for end in BANDS[1:]), (n >= BANDS[0]).cast("int"))


def thresholds(texts: DataFrame) -> DataFrame:
    """``band, rejected``: the bin from which tokens of a band of lengths are not random.

    Benjamini and Hochberg's step-up over the counts of the bins: the lowest bin whose
    probability is at most ``FALSE_SHARE`` times the share of the band's tokens that lie in it or
    beyond. It holds for one token as for any number; no band goes beyond ``HOPELESS``.
    """
    tokens = texts.select(F.explode(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).alias("token"))
    tested = tokens.where(~is_ordinary(F.col("token")))
    scored = tested.select(band(F.col("token")).alias("band"), binned(randomness(F.col("token"))).alias("bin"))
    counts = scored.groupBy("band", "bin").agg(F.count(F.lit(1)).alias("n"))
    # A row per band and bin, 164 at most.
    beyond = Window.partitionBy("band").orderBy(F.col("bin").desc())
    shares = counts.select(
        "band", "bin", F.sum("n").over(beyond).alias("k"), F.sum("n").over(Window.partitionBy("band")).alias("m")
    )
    # The least bin of which the step holds; those between two counted bins hold what the higher one does.
    reached = F.ceil(-BINS * F.log10(FALSE_SHARE * F.col("k") / F.col("m"))).cast("int")
    least = F.min(F.when(reached <= F.col("bin"), F.greatest(reached, F.lit(0))))
    return shares.groupBy("band").agg(F.least(F.coalesce(least, F.lit(HOPELESS)), F.lit(HOPELESS)).alias("rejected"))


def _spans(pieces: str, found: str, kind: int, good: Callable[[Column], Column] | None = None) -> Column:
    """``(start, kind, end)`` of matches, from the lengths of what is between them and theirs."""
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("spans")
    )

    def step(s: Column, i: Column) -> Column:
        begin = s["at"] + F.length(F.get(pieces, i))
        end = begin + F.length(F.get(found, i))
        span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        spans = F.concat(s["spans"], span)
        return F.struct(end.alias("at"), (spans if good is None else F.when(good(i), spans).otherwise(s["spans"])).alias("spans"))

    every = F.when(F.size(found) > 0, F.sequence(F.lit(0), F.size(found) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(every, start, step)["spans"]


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def find_secrets(documents: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` for ``documents(doc_id, text)``.

    A span is ``kind:start:end`` in code points, end exclusive. Random tokens that overlap a
    span of another kind are not listed again. Base spans depend on the text alone. So does a
    random span whose probability is above ``FALSE_SHARE`` or at most 0.001; between them it depends
    on how many tokens of its band of lengths are put aside over the corpus. Lower-case words
    without a separator cannot be told from random letters and are never listed. A null or empty
    text has no spans, and the hash of nothing; very long texts and tokens are tested whole.
    Repeated rows are searched, and counted for the thresholds, one by one. A
    tie in the start is listed in the order of the kinds. An empty table gives an empty
    result; extra columns are not read.
    """
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bands = thresholds(docs).groupBy().agg(
        F.map_from_entries(F.collect_list(F.struct("band", "rejected"))).alias("rejected")
    )
    rejected = materialised(bands, "bands").scalar()
    shapes = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, TOKEN)))
    found = docs.select("doc_id", "text", rejected.alias("rejected")).select("doc_id", "text", "rejected", F.inline(F.array(F.struct(
        *[F.regexp_extract_all("text", F.lit(r), F.lit(0)).alias(k) for k, r in shapes.items()],
        F.transform(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), F.length).alias("values"),
    ))))
    # A text is cut only at shapes it has.
    none = F.array().cast("array<string>")
    cut = found.select("doc_id", "rejected", *KINDS, "values", F.inline(F.array(F.struct(
        *[F.when(F.size(k) > 0, F.split("text", r)).otherwise(none).alias(f"{k}_cut") for k, r in shapes.items()]
    ))))
    good = lambda i: ~is_ordinary(F.get("random", i)) & (
        binned(randomness(F.get("random", i))) < F.element_at("rejected", band(F.get("random", i)))
    )
    spans = cut.select("doc_id", F.inline(F.array(F.struct(
        _spans("assign_cut", "assign", 0, lambda i: F.get("values", i) >= LEAST_VALUE).alias("assign"),
        _spans("access_cut", "access", 1).alias("access"),
        _spans("hex_cut", "hex", 2).alias("hex"),
        _spans("random_cut", "random", 3, good).alias("random"),
    ))))
    based = spans.select("doc_id", "assign", "access", "hex", F.inline(F.array(F.struct(
        F.concat("assign", "access", "hex").alias("base"), F.col("random").alias("all")
    ))))
    new = F.filter("all", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    listed = based.select("doc_id", "assign", "access", "hex", "base", F.explode(F.array(new)).alias("random"))
    return listed.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "random")).alias("spans"),
    )
