"""Words of many texts at once, as 64-bit hashes in numpy.

A word is ``[^\\x20\\x09-\\x0D]+``. A batch of texts is one byte buffer; it is worked through in pieces of about
``PIECE`` bytes that end between words, so memory does not grow with the longest text (only with its longest word).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

PIECE = 1 << 18
BATCH_BYTES = 4 << 20  # of an Arrow batch between Spark and Python, unless the session says otherwise
BATCH_SETTING, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits of the argument."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


def lower_ascii() -> np.ndarray:
    """Byte values with A-Z as a-z."""
    table = np.arange(256)
    table[65:91] += 32
    return table


def shape_classes() -> np.ndarray:
    """Byte values with capitals as A, other letters (all of UTF-8 beyond ASCII too) as a, digits as 0."""
    table = np.arange(256)
    table[65:91], table[97:123], table[48:58], table[128:] = 65, 97, 48, 97
    return table


@dataclass
class Words:
    """Hashes of a batch's words in order; words ``ends[i - 1]:ends[i]`` belong to text i."""

    hashes: list[np.ndarray]  # one array for each byte table asked for
    ends: np.ndarray
    starts: np.ndarray  # first byte of each word in the batch's buffer
    sizes: np.ndarray  # bytes of each word

    def bounds(self) -> Iterator[tuple[int, int]]:
        start = 0
        for end in self.ends.tolist():
            yield start, end
            start = end


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and each text's end; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def _pieces(data: np.ndarray, ends: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of the buffer that fall on no word."""
    start, n = 0, len(data)
    while start < n:
        stop = min(start + PIECE, n)
        if stop < n and is_word[data[stop]] and is_word[data[stop - 1]] and not _is_end(ends, stop):
            blanks = np.flatnonzero(~is_word[data[start:stop]])
            last = ends[np.searchsorted(ends, stop) - 1] if ends[0] <= stop else 0
            back = max(start + int(blanks[-1]) + 1 if len(blanks) else start, int(last))
            if back > start:
                stop = back
            else:  # one word longer than a piece
                text_end = int(ends[np.searchsorted(ends, stop, side="right")]) if ends[-1] > stop else n
                while stop < text_end and is_word[data[stop]]:
                    step = ~is_word[data[stop:min(stop + PIECE, text_end)]]
                    stop += int(step.argmax()) if step.any() else len(step)
        yield start, stop
        start = stop


def _is_end(ends: np.ndarray, at: int) -> bool:
    i = np.searchsorted(ends, at)
    return i < len(ends) and ends[i] == at


_powers = [np.ones(0, _U), np.ones(0, _U)]


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, kept for pieces of the usual length."""
    if len(_powers[0]) >= n:
        return _powers
    made = []
    for base in (_BASE, _INVERSE):
        p = np.full(max(n, PIECE + 1), base, _U)
        p[0] = 1
        made.append(np.cumprod(p, dtype=_U))
    if n <= PIECE + 1:
        _powers[:] = made
    return made


def words_of(texts: pa.Array, *tables: np.ndarray | None, is_word: np.ndarray = IS_WORD) -> Words:
    """Hash every word once for each byte table (``None`` for the bytes as they are); ``is_word``: bytes that make words."""
    data, ends = buffer_of(texts)
    values = [_BYTES if t is None else _BYTES[t] for t in tables]
    hashes: list[list[np.ndarray]] = [[] for _ in values]
    sizes, firsts = [], []
    for start, stop in _pieces(data, ends, is_word):
        part = data[start:stop]
        word = is_word[part]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        cuts = ends[(ends > start) & (ends < stop)] - start
        first[cuts] = word[cuts]
        last[cuts - 1] = word[cuts - 1]
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _powers_to(len(part) + 1)
        for out, value in zip(hashes, values, strict=True):
            sums = np.zeros(len(part) + 1, _U)
            np.cumsum(value[part] * up[:len(part)], dtype=_U, out=sums[1:])
            out.append(mix((sums[b] - sums[a]) * down[a]))
        sizes.append(b - a)
        firsts.append(a + start)
    joined = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    return Words([np.concatenate(h) if h else np.zeros(0, _U) for h in hashes], np.searchsorted(joined, ends, side="left"),
                 joined, np.concatenate(sizes) if sizes else np.zeros(0, np.int64))


def small_batches(batch: pa.RecordBatch, column: str, size: int = 4 * PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``size`` bytes, one text at least."""
    _, ends = buffer_of(batch.column(column))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def by_batch(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with batches bounded by bytes: long texts else make batches that fill a worker's memory.

    Lowers the session's limit to ``BATCH_BYTES`` where it stands at Spark's default; a larger row is a batch of its own.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)
