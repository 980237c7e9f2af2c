"""Conversations as training windows of a token budget, with a loss mask.

A window is the conversation's system turn, some turns repeated from before, and new turns: a
run of neighbouring turns chosen by the prefix sums of their tokens, as many as the budget
takes. Only what assistants say in new turns is under the loss mask, so all they say is
learned once. No turn is cut or left out; a turn larger than the budget is in a window of its own.

Turns go to the tasks once, by conversation. A conversation of very many turns is cut into
stretches first, at fixed numbers of turns, and each stretch also gets the system turn and
the turns that it may repeat.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trigramma.llm.common import numbered
from trigramma.operators.joins import lookup
from trigramma.session import materialised

# Marks of the template. What a role says stands between a line with the role and the end mark.
START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates, besides those marks, that a text must not bring in.
CONTROL = (
    "<|im_sep|>", "<|endoftext|>", "<|startoftext|>", "<|begin_of_text|>", "<|end_of_text|>", "<|eot_id|>",
    "<|start_header_id|>", "<|end_header_id|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>",
    "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
# A control string is told by its first character and its rest; between the two go the backslashes.
_RESTS = "|".join(re.escape(c[1:]) for c in sorted({START, END, *CONTROL}, key=lambda c: (-len(c), c)))
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_RESTS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_RESTS})")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)

# Tokens of a window, tokens and turns of what is repeated in it.
BUDGET, HISTORY, TURNS = 2048, 256, 4
# Turns of a stretch, and of long conversations that all tasks may know.
STRETCH = 4096
FEW = 500_000
# Characters that are counted at once; a longer turn is counted in pieces of so many.
PIECE = 50_000
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

WINDOWS = (
    "long boolean, stretch long, window long, n_repeated int, n_turns int, n_tokens long, text string,"
    " loss array<struct<start:int,end:int>>"
)


def escape(text: str) -> str:
    """One more backslash after the first character of every control string, escaped ones included."""
    return _PLAIN.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def head(role: str | None) -> str:
    """A role on one line."""
    return escape((role or "").replace("\\", "\\\\").replace("\n", "\\n"))


def unhead(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def formatted(role: str | None, text: str | None) -> str:
    return f"{START}{head(role)}\n{escape(text or '')}{END}\n"


def parsed(window: str) -> list[tuple[str, str]]:
    """The turns of a formatted window: roles and texts."""
    return [(unhead(role), unescape(text)) for role, text in _TURN.findall(window)]


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(turn: str, path: str) -> int:
    """Tokens of a formatted turn: its two marks are one each, the rest is of the vocabulary in ``path``."""
    coder = _encoding(path)
    inside = turn[len(START) : -len(END) - 1]
    # The marks, and the line end after them.
    return 3 + sum(len(coder.encode_ordinary(inside[i : i + PIECE])) for i in range(0, len(inside), PIECE))


class Writer:
    """Windows of one stretch of a conversation, turn by turn."""

    def __init__(self, budget: int, history: int, turns: int):
        self.budget, self.history, self.turns = budget, history, turns
        # The system turn where it is to be repeated, and turns that may be: formatted, with their tokens.
        self.system: list[tuple[str, int]] = []
        self.recent: list[tuple[str, int]] = []
        self.new: list[tuple[str, int, bool]] = []
        self.leads = False
        # Prefix sums of the stretch: before the window's first new turn, and after its last.
        self.start = self.end = self.number = 0

    def spare(self) -> int:
        """Tokens that the budget leaves beside the system turn."""
        return self.budget - sum(n for _, n in self.system)

    def fits(self, tokens: int) -> bool:
        return not self.new or self.end + tokens - self.start <= self.spare()

    def add(self, turn: str, tokens: int, learned: bool, leads: bool) -> None:
        """A new turn; ``leads`` is the system turn that opens a conversation."""
        self.new.append((turn, tokens, learned))
        self.end += tokens
        self.leads |= leads

    def remember(self, *turns: tuple[str, int]) -> None:
        self.recent = [*self.recent, *turns][len(self.recent) + len(turns) - self.turns :] if self.turns else []

    def window(self) -> dict:
        """The window of the new turns, which are then old."""
        repeated: list[tuple[str, int]] = []
        left = min(self.history, self.spare() - (self.end - self.start))
        for turn in reversed(self.recent):
            left -= turn[1]
            if left < 0:
                break
            repeated.insert(0, turn)
        repeated = self.system + repeated
        at, loss = sum(len(t) for t, _ in repeated), []
        for turn, _, learned in self.new:
            if learned:
                loss.append({"start": at + turn.index("\n") + 1, "end": at + len(turn) - len(END) - 1})
            at += len(turn)
        made = {
            "window": self.number, "n_repeated": len(repeated), "n_turns": len(self.new),
            "n_tokens": sum(n for _, n in repeated) + self.end - self.start,
            "text": "".join([t for t, _ in repeated] + [t for t, _, _ in self.new]), "loss": loss,
        }
        old = [(t, n) for t, n, _ in self.new]
        if self.leads:
            self.system, old, self.leads = old[:1], old[1:], False
        self.remember(*old)
        self.new, self.start, self.number = [], self.end, self.number + 1
        return made


# What a row is to a stretch.
SYSTEM, BEFORE, OWN = 0, 1, 2


def _windows(batches, budget: int, history: int, turns: int, tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Formatted windows of sorted rows; a window that is not full yet is all that is held."""
    schema = None
    at = writer = None
    fixed: dict = {}
    out: list[dict] = []
    for batch in batches:
        if schema is None:
            schema = pa.schema([batch.schema.field("conv_id"), *_ARROW])
        for row in batch.to_pylist():
            if at != (row["key"], row["stretch"]):
                if writer and writer.new:
                    out.append({**fixed, **writer.window()})
                at, writer = (row["key"], row["stretch"]), Writer(budget, history, turns)
                fixed = {n: row[n] for n in ("conv_id", "long", "stretch")}
            turn = formatted(row["role"], row["text"])
            tokens = count_tokens(turn, tokenizer)
            if row["kind"] == SYSTEM:
                writer.system = [(turn, tokens)]
            elif row["kind"] == BEFORE:
                writer.remember((turn, tokens))
            else:
                if not writer.fits(tokens):
                    out.append({**fixed, **writer.window()})
                opens = row["role"] == "system" and row["stretch"] == 0 and not writer.new and not writer.number
                writer.add(turn, tokens, row["role"] == "assistant", opens)
        yield pa.RecordBatch.from_pylist(out, schema)
        out = []
    if writer and writer.new:
        yield pa.RecordBatch.from_pylist([{**fixed, **writer.window()}], schema)


_ARROW = [
    pa.field("long", pa.bool_()), pa.field("stretch", pa.int64()), pa.field("window", pa.int64()),
    pa.field("n_repeated", pa.int32()), pa.field("n_turns", pa.int32()), pa.field("n_tokens", pa.int64()),
    pa.field("text", pa.string()),
    pa.field("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
]


def _key(conv_id: Column) -> Column:
    """A conversation as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _few(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if there are few of them; counted, as they are written."""
    return F.broadcast(rows) if rows.count() <= FEW else rows


def _laid(conversations: DataFrame, turns: int, stretch: int) -> DataFrame:
    """All turns with the stretch they go to, some to several: ``key, conv_id, turn, tie, role, text, long, stretch, kind``."""
    tie = F.xxhash64("role", "text").alias("tie")
    rows = conversations.select(_key(F.col("conv_id")).alias("key"), "conv_id", "turn", "role", "text", tie)
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("turns")).where(F.col("turns") > stretch)
    sizes = materialised(sizes, "long_conversations")
    plain = [F.lit(False).alias("long"), F.lit(0).cast("long").alias("stretch"), F.lit(OWN).alias("kind")]
    if sizes.isEmpty():
        return rows.select("*", *plain)
    known = _few(sizes)
    short = rows.join(known, "key", "left_anti").select("*", *plain)
    long = rows.join(known, "key")
    # Rows that are equal altogether share a place.
    places = numbered(long.select("key", "turn", "tie"), "key", ["turn", "tie"])
    places = places.groupBy("key", "turn", "tie").agg(F.min("pos").alias("pos"))
    tags = F.struct(F.coalesce("turn", F.lit(0)).alias("t"), F.col("turn").isNull().alias("none"))
    keyed = places.select("key", tags.alias("tag"), "tie", "pos")
    placed = lookup(long.withColumn("tag", tags), keyed, ["key", "tag", "tie"])
    own, last = F.expr(f"pos div {stretch}"), F.expr(f"(turns - 1) div {stretch}")

    def to(number: Column, kind: int) -> Column:
        return F.struct(number.cast("long").alias("stretch"), F.lit(kind).alias("kind"))

    later = F.when((F.col("pos") == 0) & (F.col("role") == "system"), F.transform(F.sequence(F.lit(1).cast("long"), last), lambda s: to(s, SYSTEM)))
    none = F.array().cast("array<struct<stretch:bigint,kind:int>>")
    before = F.when((F.col("pos") % stretch >= stretch - turns) & (own < last), F.array(to(own + 1, BEFORE)))
    copies = F.concat(F.array(to(own, OWN)), F.coalesce(before, none), F.coalesce(later, none))
    return short.unionByName(
        placed.select(*rows.columns, F.lit(True).alias("long"), F.inline(copies))
    )


def format_chat(
    conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY, turns: int = TURNS,
    stretch: int = STRETCH,
) -> DataFrame:
    """Windows of ``conversations(conv_id, turn, role, text)``, those of a stretch in order.

    ``conv_id, long, stretch, window, n_repeated, n_turns, n_tokens, text, loss``: a window holds ``n_repeated`` old turns
    (the system turn, which opens the conversation, and up to ``turns`` others of up to ``history``
    tokens together), then ``n_turns`` new ones; ``loss`` are the places in ``text``, in code points, of what
    assistants say in the new ones. ``budget`` is in tokens of the vocabulary file ``tokenizer``, which
    all executors must see; only a turn that is larger by itself, or together with the system turn, exceeds
    it. Conversations of more than ``stretch`` turns are ``long`` and come in stretches.

    Null and empty texts are turns without text, a null role is the empty one; a null ``turn`` comes
    before all others, and rows of one ``turn`` go by a hash of what they say, so repeated rows are
    repeated turns. A null ``conv_id`` is one conversation. Very long texts are windows of their own. An empty
    table gives none. Extra columns are not read.
    """
    # A stretch must hold what the next one repeats.
    laid = _laid(conversations.select("conv_id", "turn", "role", "text"), turns, max(stretch, turns + 1))
    dealt = laid.repartition("key", "stretch").sortWithinPartitions("key", "stretch", "kind", "turn", "tie")
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return dealt.select("key", "conv_id", "role", "text", "long", "stretch", "kind").mapInArrow(
        lambda batches: _windows(batches, budget, history, turns, tokenizer), f"conv_id {kind}, {WINDOWS}"
    )


class Digest:
    """What is read back of one conversation."""

    def __init__(self):
        self.turns = self.learned = self.formatted = 0
        self.said, self.under = hashlib.sha256(), hashlib.sha256()

    def add(self, turns: int, said: bytes, learned: str, formatted: int) -> None:
        self.turns += turns
        self.said.update(said)
        self.under.update(learned.encode())
        self.learned += len(learned)
        self.formatted += formatted

    def row(self, conv_id) -> dict:
        return {
            "conv_id": conv_id, "n_turns": self.turns, "turns_sha256": self.said.hexdigest(), "loss_chars": self.learned,
            "loss_sha256": self.under.hexdigest(), "formatted_chars": self.formatted,
        }


REPORT = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
PIECES = "long boolean, stretch long, window long, said binary, learned string"
_REPORT = [
    pa.field("n_turns", pa.int64()), pa.field("turns_sha256", pa.string()), pa.field("loss_chars", pa.int64()),
    pa.field("loss_sha256", pa.string()), pa.field("formatted_chars", pa.int64()),
]
_PIECES = [
    pa.field("long", pa.bool_()), pa.field("stretch", pa.int64()), pa.field("window", pa.int64()),
    pa.field("said", pa.binary()), pa.field("learned", pa.string()),
]


def _read(batches) -> Iterator[pa.RecordBatch]:
    """Digests of conversations that lie together; of long ones, what each window says."""
    schema = at = digest = None
    for batch in batches:
        if schema is None:
            schema = pa.schema([batch.schema.field("conv_id"), *_REPORT, *_PIECES])
        out = []
        for row in batch.to_pylist():
            new = parsed(row["text"])[row["n_repeated"] :]
            said = "".join(f"{role}\n{text}\n" for role, text in new).encode()
            learned = "".join(unescape(row["text"][span["start"] : span["end"]]) for span in row["loss"])
            if row["long"]:
                piece = {n: row[n] for n in ("conv_id", "long", "stretch", "window")}
                out.append({**piece, "said": said, "learned": learned, "n_turns": len(new), "formatted_chars": len(row["text"])})
                continue
            if digest is None or at != row["conv_id"]:
                if digest:
                    out.append({**digest.row(at), "long": False})
                at, digest = row["conv_id"], Digest()
            digest.add(len(new), said, learned, len(row["text"]))
        yield pa.RecordBatch.from_pylist(out, schema)
    if digest:
        yield pa.RecordBatch.from_pylist([{**digest.row(at), "long": False}], schema)


def _joined(batches) -> Iterator[pa.RecordBatch]:
    schema = at = digest = None
    for batch in batches:
        if schema is None:
            schema = pa.schema([batch.schema.field("conv_id"), *_REPORT])
        out = []
        for row in batch.to_pylist():
            if digest is None or at != row["conv_id"]:
                if digest:
                    out.append(digest.row(at))
                at, digest = row["conv_id"], Digest()
            digest.add(row["n_turns"], row["said"], row["learned"], row["formatted_chars"])
        yield pa.RecordBatch.from_pylist(out, schema)
    if digest:
        yield pa.RecordBatch.from_pylist([digest.row(at)], schema)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    ``turns_sha256`` is of role, line end, text, line end of every new turn, ``loss_sha256`` of all text under the loss
    mask, both as they were before the template. ``windows`` lie as ``format_chat`` leaves them, so conversations are read where
    they are; only those of several stretches are brought together, to be hashed one window at a time.
    """
    kind = windows.schema["conv_id"].dataType.simpleString()
    read = materialised(windows.mapInArrow(_read, f"conv_id {kind}, {REPORT}, {PIECES}"), "read")
    fields = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    dealt = read.where("long").repartition("conv_id").sortWithinPartitions("conv_id", "stretch", "window")
    long = dealt.mapInArrow(_joined, f"conv_id {kind}, {REPORT}")
    return read.where("not long").select(*fields).unionByName(long)
