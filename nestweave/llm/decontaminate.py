"""Benchmark items inside documents: SimHash of item-sized windows, multi-index Hamming search.

Documents meet the benchmark in blocks of items, so that what every task holds is bounded.
For a block, each document's words are hashed once. A window of as many words as an item gets
a 64-bit SimHash of its weighted shingles; eight 8-bit parts, each looked up within two bits, give
every item of that size within 23 bits (more would need three bits in some part), and the
weighted similarity of the full shingle multisets decides. At a similarity of 0.8 some 10 of 64
bits differ, with a standard deviation of 3, so that 23 bits leave a margin above four.

Windows are not formed where none can pass: shingles that the item's block does not have add to a
window's weight and to no item's share, so a window in which the known shingles weigh less than
the threshold's share of it has no similar item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestweave.llm.words import Words, mix, slices, windows, words

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 23
#: Items, and bytes of their texts, that a pass over the documents compares with.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
#: Windows whose bits are summed, and window-item pairs that are compared, at a time.
_STEP = 1 << 10
_PAIRS = 1 << 22

#: Hash bits by which most shingles that no item has are told apart.
_LOW = np.uint64((1 << 22) - 1)

#: For every 8-bit part, which other parts are within its share of the radius.
_NEAR = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None]) <= RADIUS // 8


def _shingles_of(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, hash and weight (its characters' bytes) of every shingle of five words."""
    at, value = windows(found, SHINGLE)
    weight = (found.end[at + SHINGLE - 1] - found.start[at]).astype(np.int64) if len(at) else at
    return at, value, weight


def _bits(value: np.ndarray) -> np.ndarray:
    return np.unpackbits(value.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _print(sums: np.ndarray, total: np.ndarray) -> np.ndarray:
    """SimHash of windows from the weight of the shingles that have each bit."""
    return np.packbits(2 * sums > total[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


def weighted_similarity(one: tuple, two: tuple) -> float:
    """Shared weight over joint weight of two multisets of (hash, weight)."""
    values, weights = np.concatenate((one[0], two[0])), np.concatenate((one[1], two[1]))
    _, at, which = np.unique(values, return_index=True, return_inverse=True)
    counts = [np.bincount(w, minlength=len(at)) for w in np.split(which, [len(one[0])])]
    joint = (np.maximum(*counts) * weights[at]).sum()
    return float((np.minimum(*counts) * weights[at]).sum() / joint) if joint else 0.0


class Items:
    """A block of items: known shingles, and per number of words the prints and part tables."""

    def __init__(self, ids: list, texts: pa.Array):
        found = words(texts)
        at, value, weight = _shingles_of(found)
        row = found.row[at] if len(at) else at
        self.known = np.unique(value)
        self.maybe = np.zeros(int(_LOW) + 1, bool)
        self.maybe[value & _LOW] = True
        self.ids = ids
        self.sets: dict[int, tuple] = {}
        self.by_size: dict[int, tuple] = {}
        self.short: dict[int, dict[int, list[int]]] = {}
        bits = _bits(value)
        sizes: dict[int, list[int]] = {}
        prints = np.zeros(len(ids), np.uint64)
        self.mass = np.zeros(len(ids), np.int64)  # weight of all shingles
        for item in range(len(ids)):
            size = int(found.counts[item])
            if 0 < size < SHINGLE:
                only = found.hash[found.first[item] : found.first[item] + size]
                self.short.setdefault(size, {}).setdefault(int(_whole(only)), []).append(item)
            elif size:
                mine = slice(*np.searchsorted(row, [item, item + 1]))
                self.sets[item] = value[mine], weight[mine]
                self.mass[item] = weight[mine].sum()
                sums = (bits[mine] * weight[mine][:, None]).sum(axis=0)
                prints[item] = _print(sums[None], weight[mine].sum()[None])[0]
                sizes.setdefault(size, []).append(item)
        #: Shingles of the largest item.
        self.largest = max(sizes, default=0) - SHINGLE + 1
        for size, members in sizes.items():
            own = prints[members]
            parts = own.astype("<u8").view(np.uint8).reshape(-1, 8)
            # for each part and each of its values, which items are near
            tables = [_NEAR[:, parts[:, p]] for p in range(8)]
            self.by_size[size] = np.array(members), own, tables


def _whole(hashes: np.ndarray) -> np.uint64:
    out = np.array([len(hashes)], np.uint64)
    for h in hashes:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h)
    return out[0]


def _matches(batch: pa.RecordBatch, items: Items, threshold: float) -> list[tuple]:
    """(row, item, similarity, first word, words) of the best window of each item in each text."""
    found = words(batch.column("text"))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}

    def add(row: int, item: int, similarity: float, word: int, size: int) -> None:
        key = (row, item)
        if key not in best or (-similarity, word) < (-best[key][0], best[key][1]):
            best[key] = similarity, word, size

    first = found.first
    for size, known in items.short.items():
        starts = np.flatnonzero(found.row[: max(0, len(found.row) - size + 1)] == found.row[size - 1 :])
        heads = {h for h in known}
        for at in starts[np.isin(_whole_windows(found.hash, starts, size), np.array(sorted(heads), np.uint64))]:
            row = int(found.row[at])
            for item in known[int(_whole(found.hash[at : at + size]))]:
                add(row, item, 1.0, int(at - first[row]), size)
    at, value, weight = _shingles_of(found)
    hit = items.maybe[value & _LOW]
    hit[hit] = np.isin(value[hit], items.known)
    # only rows with a known shingle are looked at further
    row = found.row[at] if len(at) else at
    some = np.isin(row, np.unique(row[hit]))
    row, value, weight, hit = row[some], value[some], weight[some], hit[some]
    head = np.searchsorted(row, row)  # each row's first shingle
    for start, item, similarity, size in _similar(row, value, weight, hit, items, threshold):
        add(int(row[start]), item, similarity, start - int(head[start]), size)
    return [(r, i, *v) for (r, i), v in best.items()]


def _whole_windows(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    out = np.full(len(starts), size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[starts + k])
    return out


def _similar(row, value, weight, hit, items: Items, threshold: float) -> Iterator[tuple]:
    """(first shingle, item, similarity, words) of every window that is similar to an item."""
    total = np.concatenate(([0], np.cumsum(weight)))
    known = np.concatenate(([0], np.cumsum(weight * hit)))
    bits = _bits(value)
    done: dict[tuple[int, bytes], float] = {}  # windows of common passages come again and again
    for size, (members, prints, tables) in items.by_size.items():
        n = size - SHINGLE + 1
        if n > len(value):
            continue
        whole, share = total[n:] - total[:-n], known[n:] - known[:-n]
        starts = np.flatnonzero((share >= threshold * whole) & (row[: len(row) - n + 1] == row[n - 1 :]))
        step = max(1, min(_STEP, _PAIRS // len(members)))
        for k in range(0, len(starts), step):
            some = starts[k : k + step]
            at = some[:, None] + np.arange(n)
            codes = _print(np.einsum("wnb,wn->wb", bits[at], weight[at]), whole[some])
            parts = codes.astype("<u8").view(np.uint8).reshape(-1, 8)
            near = tables[0][parts[:, 0]]
            for p in range(1, 8):
                near |= tables[p][parts[:, p]]
            window, member = np.nonzero(near)
            close = np.bitwise_count(prints[member] ^ codes[window]) <= RADIUS
            for w, m in zip(window[close].tolist(), member[close].tolist(), strict=True):
                start, item = int(some[w]), int(members[m])
                span = slice(start, start + n)
                key = item, value[span].tobytes()
                if key not in done:
                    done[key] = weighted_similarity(items.sets[item], (value[span], weight[span]))
                similarity = done[key]
                if similarity >= threshold:
                    yield start, item, similarity, size
    yield from _similar_whole(row, value, weight, total, known, items, threshold)


def _similar_whole(row, value, weight, total, known, items: Items, threshold: float) -> Iterator[tuple]:
    """The same for texts with fewer words than an item: the whole text is the item's window.

    A text that can reach the threshold has that share of the item's weight at least, and the item that
    of the text's.
    """
    if not len(row):
        return
    heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    ends = np.append(heads[1:], len(row))
    some = (known[ends] - known[heads] >= threshold * (total[ends] - total[heads])) & (ends - heads < items.largest)
    for start, end in zip(heads[some].tolist(), ends[some].tolist(), strict=True):
        span, mass = slice(start, end), int(total[end] - total[start])
        code = _print((weight[span] @ _bits(value[span]))[None], np.array([mass]))[0]
        for size, (members, prints, _) in items.by_size.items():
            if size - SHINGLE + 1 <= end - start:
                continue
            fits = items.mass[members] * threshold <= mass
            close = fits & (mass * threshold <= items.mass[members]) & (np.bitwise_count(prints ^ code) <= RADIUS)
            for item in members[close].tolist():
                similarity = weighted_similarity(items.sets[item], (value[span], weight[span]))
                if similarity >= threshold:
                    yield start, item, similarity, end - start + SHINGLE - 1


def _blocks(benchmark: DataFrame, id: str, text: str) -> Iterator[tuple[list, pa.Array]]:
    """The items in blocks of bounded number and size (or of one item)."""
    plain = benchmark.select(F.col(id).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit("")))
    ids, texts, size = [], [], 0
    for item, body in plain.toLocalIterator():
        if ids and (len(ids) >= BLOCK_ITEMS or size + len(body) > BLOCK_BYTES):
            yield ids, pa.array(texts, pa.string())
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(body)
        size += len(body)
    yield ids, pa.array(texts, pa.string())


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """A row (doc_id, item_id, similarity, word, n_words) for each item that a document holds.

    An item is held if some window of as many words (of fewer, the whole text) is similar to it at ``threshold`` or more:
    shared over joint weight of the multisets of 5-word shingles, weighted by their length in
    bytes. ``word`` is the first such word of the best window, from 0. An item of fewer than five
    words is held where it stands word for word; an item without words nowhere. Null texts are
    empty, null ids stay null, repeated rows of ``docs`` get repeated rows, and equal items are
    reported each.
    """
    plain = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = None
    for ids, texts in _blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Items(ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                rows = _matches(batch, shared.value, threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                        pa.array([shared.value.ids[r[1]] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.float64()),
                        pa.array([r[3] for r in rows], pa.int64()),
                        pa.array([r[4] for r in rows], pa.int64()),
                    ],
                    ["doc_id", "item_id", "similarity", "word", "n_words"],
                )

        found = plain.mapInArrow(run, "doc_id long, item_id long, similarity double, word long, n_words long")
        out = found if out is None else out.unionByName(found)
    return out
