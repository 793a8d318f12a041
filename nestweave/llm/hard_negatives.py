"""Hard negatives for anchors, by exact integer inner products.

Anchors are taken in blocks of bounded size. A block goes to all tasks, which read the candidates
once and multiply tile by tile: Strassen's recursion on int64 tiles padded with zeros. Each task keeps a heap
of best positives per anchor; heaps are merged by Spark. The positives fix each anchor's
windows of scores, and a second pass keeps a heap of best negatives per window, merged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestweave.llm.storage import stage
from nestweave.llm.vectors import as_integers, common_length, is_whole, matrix
from nestweave.session import scratch_dir

POSITIVES = 5
NEGATIVES = 3
#: A negative scores from this to that many percent of the positive.
LOW, HIGH = 50, 95
#: Anchors of a block at most (in expectation: they are dealt by hash), and numbers of a block.
ANCHORS = 12_288
BLOCK_NUMBERS = 1 << 23
#: Rows of a tile of anchors or of candidates.
TILE = 1024
#: Tiles are halved as long as all sides are longer than this.
LEAF = 32
#: Stands for no score; real ones are larger.
NEVER = np.iinfo(np.int64).min
NO_ID = np.iinfo(np.int64).max


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact product of int64 matrices whose result fits into 64 bits.

    Seven products of halves instead of eight; odd sides are padded with zeros. Sums of
    halves that overflow do so modulo 2^64 and cancel again, so that the result is exact.
    """
    if min(*a.shape, b.shape[1]) <= LEAF:
        return _product(a, b)
    (m, k), n = a.shape, b.shape[1]
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2  # noqa: E741
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    one = strassen(a11 + a22, b11 + b22)
    two = strassen(a21 + a22, b11)
    three = strassen(a11, b12 - b22)
    four = strassen(a22, b21 - b11)
    five = strassen(a11 + a12, b22)
    six = strassen(a21 - a11, b11 + b12)
    seven = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = one + four - five + seven
    out[:i, l:] = three + five
    out[i:, :l] = two + four
    out[i:, l:] = one - two + three + six
    return out[:m, :n]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A leaf's product, in doubles where all its partial sums are whole numbers they hold."""
    most = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (a, b)]
    if most[0] * most[1] * max(a.shape[1], 1) < 1 << 53:
        return (a.astype(float) @ b.astype(float)).astype(np.int64)
    return a @ b


def tile_best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best scores of each row and the ids of their columns (which rise); ``scores`` is used up."""
    rows = np.arange(len(scores))
    found, whose = np.full((len(scores), k), NEVER), np.full((len(scores), k), NO_ID)
    for j in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)  # the first of equal ones
        found[:, j] = scores[rows, at]
        whose[:, j] = np.where(found[:, j] > NEVER, ids[at], NO_ID)
        scores[rows, at] = NEVER
    return found, whose


class Heaps:
    """The best scores of each anchor so far and whose they are: higher first, then smaller ids."""

    def __init__(self, anchors: int, k: int):
        self.scores, self.ids = np.full((anchors, k), NEVER), np.full((anchors, k), NO_ID)

    def merge(self, at: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        both = np.concatenate((self.scores[at], scores), axis=1), np.concatenate((self.ids[at], ids), axis=1)
        # of 64-bit scores, ~s falls where s rises, without overflow
        order = np.lexsort((both[1], ~both[0]), axis=1)[:, : self.scores.shape[1]]
        self.scores[at], self.ids[at] = (np.take_along_axis(x, order, axis=1) for x in both)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, score and id of every entry."""
        anchor, place = np.nonzero(self.scores > NEVER)
        return anchor, self.scores[anchor, place], self.ids[anchor, place]


class Block:
    """Anchors by id: ids, labels, vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]

    def tiles(self, batches: Iterator[pa.RecordBatch], dims: int):
        """Slice of the anchors, ids and labels of candidates, their scores: tile by tile."""
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            vectors = matrix(batch.column("x"), dims)
            order = np.argsort(ids)
            for first in range(0, len(ids), TILE):
                some = order[first : first + TILE]
                right = np.ascontiguousarray(vectors[some].T)
                for begin in range(0, len(self.ids), TILE):
                    at = slice(begin, min(begin + TILE, len(self.ids)))
                    yield at, ids[some], labels[some], strassen(self.vectors[at], right)


def _first(rows: DataFrame, key: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each key with their ``place``, from 1: heaps of tasks merged."""
    by = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc("id"))
    return rows.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k)


def _positives(candidates: DataFrame, shared, dims: int, k: int) -> DataFrame:
    """(anchor, score, id, place): the best candidates of each anchor's own label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        heaps = Heaps(len(block.ids), k)
        for at, ids, labels, scores in block.tiles(batches, dims):
            no = (block.labels[at, None] != labels) | (block.ids[at, None] == ids)
            scores[no] = NEVER
            heaps.merge(at, *tile_best(scores, ids, k))
        anchor, score, id = heaps.rows()
        yield pa.RecordBatch.from_arrays([pa.array(block.ids[anchor]), pa.array(score), pa.array(id)], ["anchor", "score", "id"])

    return _first(candidates.mapInArrow(run, "anchor long, score long, id long"), ["anchor"], k)


def window_of(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score ``s`` with ``low * score <= 100 * s <= high * score``."""
    return -((-low * score) // 100), (high * score) // 100


def _negatives(candidates: DataFrame, shared, windows, dims: int, k: int, low: int, high: int) -> DataFrame:
    """(anchor, positive, score, id, place): the best candidates of other labels in each window.

    ``windows`` has, by place and anchor of the block, the positive's score, or ``NEVER``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, positive = shared.value, windows.value
        heaps = [Heaps(len(block.ids), k) for _ in positive]
        bounds = [window_of(np.where(p > NEVER, p, 0), low, high) for p in positive]
        for at, ids, labels, scores in block.tiles(batches, dims):
            scores[block.labels[at, None] == labels] = NEVER
            best = scores.max(axis=1)
            for heap, p, (least, most) in zip(heaps, positive, bounds, strict=True):
                some = np.flatnonzero((p[at] > NEVER) & (least[at] <= most[at]) & (best >= least[at]))
                if not len(some):
                    continue
                inside = scores[some]
                inside[(inside < least[at][some, None]) | (inside > most[at][some, None])] = NEVER
                found, whose = tile_best(inside, ids, k)
                heap.merge(np.arange(at.start, at.stop)[some], found, whose)
        for place, heap in enumerate(heaps):
            anchor, score, id = heap.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids[anchor]), pa.array(np.full(len(anchor), place + 1)), pa.array(score), pa.array(id)],
                ["anchor", "positive", "score", "id"],
            )

    made = candidates.mapInArrow(run, "anchor long, positive long, score long, id long")
    return _first(made, ["anchor", "positive"], k)


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Vectors become integers (``floor(256 * x)``); a score is an inner product, higher first, then
    smaller ids. For each row that ``is_anchor`` holds for (a condition on ``id`` and ``label``), its first ``positives`` other rows of
    its label are positives; for each of them, the first ``negatives`` rows of other labels that score
    from ``low`` to ``high`` percent of it are returned. A pair without such rows gives none.

    Rows with a null id or label, or a vector that is null or holds null or non-finite
    entries, take no part. Of rows that share an id the first by label and vector counts. Other columns are
    ignored; an empty table gives no rows. Vectors of different lengths, or so large that a score
    may not fit into 64 bits, are an error. All candidates are read twice for each block of anchors.
    """
    spark = df.sparkSession
    plain = df.where(is_whole(vector) & F.col(id).isNotNull() & F.col(label).isNotNull()).select(
        F.col(id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        as_integers(vector).alias("x"),
    )
    once = plain.groupBy("id").agg(F.min(F.struct("label", "x", "is_anchor")).alias("row"))
    rows = stage(once.select("id", "row.*"), "candidates")
    dims = common_length(rows, "x")
    none = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if dims is None:
        return spark.createDataFrame([], none)
    most = rows.agg(F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))).first()[0] or 0
    if most * most * dims >= 1 << 62:
        raise ValueError("scores may not fit into 64 bits")
    anchors = rows.where("is_anchor")
    total = anchors.count()
    size = max(1, min(ANCHORS, BLOCK_NUMBERS // max(dims, 1)))
    blocks = -(-total // size)
    if not blocks:
        return spark.createDataFrame([], none)
    candidates = rows.select("id", "label", "x")
    path = scratch_dir(spark, "hard-negatives")
    for number in range(blocks):
        of_block = anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).select("id", "label", "x").toArrow()
        if not of_block.num_rows:
            continue
        columns = of_block.combine_chunks()
        block = Block(
            columns.column("id").to_numpy(), columns.column("label").to_numpy(),
            matrix(columns.column("x").combine_chunks(), dims),
        )
        shared = spark.sparkContext.broadcast(block)
        best = stage(_positives(candidates, shared, dims, positives), "positives")
        found = best.toArrow()  # bounded by the block
        scores = np.full((positives, len(block.ids)), NEVER)
        at = np.searchsorted(block.ids, found.column("anchor").to_numpy())
        scores[found.column("place").to_numpy() - 1, at] = found.column("score").to_numpy()
        windows = spark.sparkContext.broadcast(scores)
        held = best.select("anchor", F.col("place").cast("long").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        _negatives(candidates, shared, windows, dims, negatives, low, high).join(held, ["anchor", "positive"]).select(
            F.col("anchor").alias("anchor_id"),
            "positive_id",
            F.col("place").cast("int").alias("rank"),
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.parquet(f"{path}/block={number}")
        shared.unpersist()
        windows.unpersist()
    return spark.read.schema(none).option("recursiveFileLookup", True).parquet(path)
