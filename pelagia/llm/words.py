"""Vectorised word tables over Arrow string columns.

Word splitting and hashing run on the raw UTF-8 buffer of a whole Arrow batch,
so no per-word Python object is made. Words are maximal runs of bytes that are
not ASCII space or \\x09-\\x0D (``words``) or maximal runs of ASCII letters,
digits and non-ASCII bytes (``terms``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: _MASK[k] keeps the first k bytes of a little-endian 8-byte word.
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def _space(b: np.ndarray) -> np.ndarray:
    return ((b - np.uint8(9)) < 5) | (b == 32)


def _not_term(b: np.ndarray) -> np.ndarray:
    return ~((((b | np.uint8(32)) - np.uint8(97)) < 26) | ((b - np.uint8(48)) < 10) | (b >= 128))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit integers."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit multipliers."""
    k = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(k + mix(np.array([seed], np.uint64))) | np.uint64(1)


def byte_hashes(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash byte runs, eight bytes at a time, longer runs in further rounds."""
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(buf) + 1,), (1,))
    h = mix((eight[start] & _MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    left, at = np.flatnonzero(size > 8), 8
    while len(left):
        piece = eight[start[left] + at] & _MASK[np.minimum(size[left] - at, 8)]
        h[left] = mix(h[left] * np.uint64(0xD6E8FEB86659FD93) + piece)
        at += 8
        left = left[size[left] > at]
    return h


@dataclass
class WordTable:
    """Words of a batch of texts: word ``i`` is ``buf[start[i]:end[i]]``; text
    ``d`` owns words ``first[d]`` to ``first[d + 1]``."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def text(self, i: int, j: int) -> bytes:
        """Words i to j (exclusive) joined by one space."""
        raw = self.buf
        return b" ".join(raw[s:e].tobytes() for s, e in zip(self.start[i:j], self.end[i:j], strict=True))


def word_table(texts: pa.Array | pa.ChunkedArray, *, lower: bool = False, terms: bool = False) -> WordTable:
    """Split and hash every text of an Arrow string array; null counts as empty.

    ``lower`` folds A-Z only; hashes then are of the folded bytes.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    off = off - off[0] if len(off) else np.zeros(1, np.int64)
    if lower:
        buf = buf + (((buf - np.uint8(65)) < 26) * np.uint8(32))
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return WordTable(buf, none, none, np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint64))
    gap = (_not_term if terms else _space)(buf)
    edge = np.zeros(n + 1, bool)
    edge[off] = True  # texts never share a word
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = gap[:-1]
    start = np.flatnonzero(~gap & (before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = gap[1:]
    end = np.flatnonzero(~gap & (after | edge[1:])) + 1
    first = np.searchsorted(start, off)
    if not len(start):
        return WordTable(buf, start, end, first, np.zeros(0, np.uint64))
    return WordTable(buf, start, end, first, byte_hashes(buf, start, end - start))


def gram_hashes(h: np.ndarray, n: int, seed: int = 3) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive word hashes (may cross texts)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    mult = stream(n, seed)
    out = h[:m] * mult[0]
    for j in range(1, n):
        out += h[j : j + m] * mult[j]
    return mix(out)


def ids(column: pa.Array) -> np.ndarray:
    """A nullable id column as objects; null stays None."""
    return np.array(column.to_pylist(), object)


def small_batches(spark: SparkSession, rows: int = 512, size: str = "16m") -> None:
    """Bound what one Arrow batch of whole texts can hold in a Python worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
