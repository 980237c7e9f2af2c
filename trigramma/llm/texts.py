"""Texts inside tasks: cut into words and hashed with numpy, a megabyte at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

# The characters of ASCII white space, at which bytes.split() cuts.
SPACES = " \t\n\r\x0b\x0c"


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def parts(texts: list[str | None], limit: int = 1_000_000) -> Iterator[list[str]]:
    """Runs of texts of about ``limit`` characters, or one longer text; null becomes empty."""
    part: list[str] = []
    held = 0
    for text in texts:
        part.append(text or "")
        held += len(part[-1]) + 1
        if held >= limit:
            yield part
            part, held = [], 0
    if part:
        yield part


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, a few at a time, so that few of their texts are Python objects at once."""
    for batch in batches:
        for start in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(start, rows)


def raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of every word, the same in every process."""
    if not words:
        return np.empty(0, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    inside = np.arange(len(letters), dtype=np.uint64) - np.repeat(starts, lengths).astype(np.uint64)
    with np.errstate(over="ignore"):
        # Every byte scrambled with its place in the word, then summed up.
        sums = np.add.reduceat(mixed((letters + np.uint64(1)) * _ODD + inside * _MIX[1]), starts)
        return mixed(sums + lengths.astype(np.uint64) * _ODD)


def chained(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of the words in every row of the columns."""
    total = np.full(len(columns[0]), np.uint64(len(columns)))
    with np.errstate(over="ignore"):
        for column in columns:
            total = mixed(total * _ODD + column)
    return total


def name_of(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of hashes."""
    with np.errstate(over="ignore"):
        a = np.add.reduce(mixed(hashes + _ODD)) if len(hashes) else np.uint64(0)
        b = np.add.reduce(mixed(hashes ^ _MIX[1])) if len(hashes) else np.uint64(0)
    return int(np.uint64(a).view(np.int64)), int(np.uint64(b).view(np.int64))
