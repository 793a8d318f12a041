"""Words and shingles of a batch of texts as arrays, without a Python object per word.

A word is a run of characters other than space and the controls 9 to 13. Those are single
bytes of UTF-8, so that words are cut and hashed on the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# The multipliers of the splitmix64 finaliser.
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of text in a slice for work that makes many arrays as long as its text.
SMALL_SLICE = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Keeps the first n bytes of a little-endian word.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.concatenate(([0], np.cumsum(byte_lengths(batch.column(column)))))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(sizes, sizes[first] + limit, side="right")) - 1
            last = max(last, first + 1)
            yield batch.slice(first, last - first)
            first = last


def byte_lengths(texts: pa.Array) -> np.ndarray:
    return np.diff(text_bytes(texts)[1])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins and ends; null is empty."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of a batch: row of the batch, first and last byte and hash of each; words per row."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    counts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of each row's first word."""
        return np.cumsum(self.counts) - self.counts


def words(texts: pa.Array, lower: bool = False, space: np.ndarray = SPACE) -> Words:
    """The words of each text, between bytes that ``space`` flags; ``lower`` folds A to Z first."""
    data, bounds = text_bytes(texts)
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none.astype(np.uint64), np.zeros(len(texts), np.int64))
    inside = ~space[data]
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
    end = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1
    row = np.searchsorted(bounds, start, side="right") - 1
    hashes = _hashes(_LOWER[data] if lower else data, start, end)
    return Words(row, start, end, hashes, np.bincount(row, minlength=len(texts)))


def _after_space(data: np.ndarray) -> np.ndarray:
    """Whether the character that ends at each byte is white space of any kind or a separator."""
    one = np.concatenate((np.zeros(1, np.uint8), data[:-1]))
    two = np.concatenate((np.zeros(2, np.uint8), data[:-2]))[: len(data)]
    ascii_space = SPACE[data] | ((data >= 0x1C) & (data <= 0x1F))
    latin = (one == 0xC2) & ((data == 0x85) | (data == 0xA0))
    general = (two == 0xE2) & (one == 0x80) & ((data <= 0x8A) | (data == 0xA8) | (data == 0xA9) | (data == 0xAF))
    wide = (two == 0xE2) & (one == 0x81) & (data == 0x9F)
    other = ((two == 0xE1) & (one == 0x9A) | (two == 0xE3) & (one == 0x80)) & (data == 0x80)
    return ascii_space | latin | general | wide | other


@dataclass
class Units:
    """Distinct units of a batch, which of them each unit is, and units per row."""

    distinct: list[str]
    which: np.ndarray
    counts: np.ndarray


def units(texts: pa.Array, only_blank: bool = False, alone: np.ndarray | None = None) -> Units:
    """Each text cut before white space that follows other characters.

    The units of a text make up the text: a run of white space and what stands up to the next.
    With ``only_blank`` only the character 32 counts as white space. Each byte that ``alone`` (a
    flag a byte) has is a unit of its own.
    """
    data, bounds = text_bytes(texts)
    if not len(data):
        return Units([], np.zeros(0, np.int64), np.zeros(len(texts), np.int64))
    space, gap = (data == 0x20, data == 0x20) if only_blank else (SPACE[data], _after_space(data))
    cut = space & ~np.concatenate(([True], gap[:-1]))
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    if alone is not None:
        single = alone[data]
        cut |= single | np.concatenate(([False], single[:-1]))
    start = np.flatnonzero(cut)
    offsets = np.append(start, len(data))
    # equal units have equal hashes; the first of each stands for all
    coded = pa.array(_hashes(data, start, offsets[1:])).dictionary_encode().indices.to_numpy()
    first = np.zeros(coded.max() + 1, np.int64)
    first[coded[::-1]] = np.arange(len(start))[::-1]
    whole = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    row = np.searchsorted(bounds, start, side="right") - 1
    return Units(whole.take(pa.array(first)).to_pylist(), coded, np.bincount(row, minlength=len(texts)))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, eight bytes of all ranges at a time."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))
    length = end - start
    out = mix(length.astype(np.uint64) * _STEP)
    left, at, which = length, start, slice(None)
    while len(left):
        value = eights[at] & _KEEP[np.minimum(left, 8)]
        out[which] = mix((out[which] ^ value) + _STEP)
        more = np.flatnonzero(left > 8)
        which = more if isinstance(which, slice) else which[more]
        left, at = left[more] - 8, at[more] + 8
    return out


def windows(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``size`` words within a row."""
    n = len(found.row)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(found.row[: n - size + 1] == found.row[size - 1 :])
    return at, _fold(found.hash, at, size)


def _fold(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    out = np.full(len(at), (size * int(_STEP)) % (1 << 64), np.uint64)
    for k in range(size):
        out = (out + hashes[at + k]) * _MIX_1
        out ^= out >> np.uint64(29)
    return mix(out)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each row's distinct shingles, by row and hash.

    A row with fewer words than ``size`` has its whole sequence as its only shingle.
    """
    at, value = windows(found, size)
    rows, values = [found.row[at]], [value]
    for short in range(1, size):
        some = np.flatnonzero(found.counts == short)
        if len(some):
            rows.append(some)
            values.append(_fold(found.hash, found.first[some], short))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]
