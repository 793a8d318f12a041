"""Quality by votes of the nearest labelled documents in a latent-semantic space.

A text's terms are its words, the shapes of its words (``Aa*``: runs of letter cases, digits and single
other characters), pairs of neighbouring shapes and repetitions, each hashed into a fixed number of places. Their
TF-IDF vectors, with document counts over all documents, are projected on the leading singular
directions of a bounded labelled sample. The sample's latent vectors go to all tasks; blocks of
documents are multiplied with all of them, exactly, and the nearest vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.storage import stage
from nestweave.llm.words import SPACE, _hashes, mix, slices, text_bytes, words

#: Labelled documents of each class that are fitted on at most, the first by a hash of the id.
SAMPLE = 2048
#: Places that words, and that shapes and their pairs, are hashed into.
WORD_PLACES = 2048
SHAPE_PLACES = 2048
PLACES = WORD_PLACES + SHAPE_PLACES
#: Length of the part that words have of a text's vector; the shapes' part is 1.
WORD_SHARE = 0.5
DIMENSIONS = 64
#: Subspace iterations; directions beyond those kept that they carry along.
ROUNDS = 6
SPARE = 16
NEIGHBOURS = 25
#: Power of the similarity that a vote weighs: few examples of a class still win against many distant others.
POWER = 4
#: Similarities this close count as equal: all neighbours as near as the last one vote.
TIE = 1e-9
#: Documents that meet the sample at a time.
BLOCK = 256
THRESHOLD = 0.3
#: Weight of the classes' overall share in a vote.
PRIOR_WEIGHT = 0.1

# Classes of bytes: letters in lower case, capitals, digits; other characters stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = ord("a")
_SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every term of the texts."""
    found = words(texts, lower=True)
    if not len(found.row):
        return found.row, found.row
    data, _ = text_bytes(texts)
    shape = _SHAPE[data]
    begins = np.zeros(len(data), bool)
    begins[found.start] = True
    kept = ~SPACE[data] & (begins | np.concatenate(([True], shape[1:] != shape[:-1])))
    at = np.concatenate(([0], np.cumsum(kept)))
    form = _hashes(shape[kept], at[found.start], at[found.end])
    side = np.flatnonzero(found.row[1:] == found.row[:-1])
    pair = mix(form[side] ^ mix(form[side + 1]))
    again = side[found.hash[side + 1] == found.hash[side]]
    some = [found.hash, form, pair, np.full(len(again), 1, np.uint64)]
    sizes, first = (WORD_PLACES, *[SHAPE_PLACES] * 3), (0, *[WORD_PLACES] * 3)
    places = [(mix(h + np.uint64(k)) % np.uint64(n)).astype(np.int64) + f for k, (h, n, f) in enumerate(zip(some, sizes, first, strict=True))]
    return np.concatenate((found.row, found.row, found.row[side], found.row[again])), np.concatenate(places)


def counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and number of the terms, by row and place."""
    row, place = terms(texts)
    both, n = np.unique(row * PLACES + place, return_counts=True)
    return both // PLACES, both % PLACES, n


def vectors(texts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and weight of the texts' TF-IDF vectors: words and shapes each of fixed length."""
    row, place, n = counted(texts)
    weight = (1 + np.log(n)) * idf[place]
    part = 2 * row + (place >= WORD_PLACES)
    length = np.sqrt(np.bincount(part, weight**2, 2 * len(texts)))
    return row, place, weight / length[part] * np.where(place >= WORD_PLACES, 1.0, WORD_SHARE)


def projected(texts: pa.Array, idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit latent vectors of the texts, zero for texts without words."""
    row, place, weight = vectors(texts, idf)
    out = np.zeros((len(texts), axes.shape[1]))
    bounds = np.searchsorted(row, np.arange(len(texts) + 1))
    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if b > a:
            out[k] = weight[a:b] @ axes[place[a:b]]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=out, where=length > 0)


def latent_axes(sample: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The leading right singular directions of a matrix, by subspace iteration, as columns."""
    width = min(dimensions + SPARE, *sample.shape)
    space = np.random.default_rng(5).standard_normal((sample.shape[1], width)).astype(sample.dtype)
    for _ in range(ROUNDS):
        space = np.linalg.qr(sample.T @ (sample @ np.linalg.qr(space)[0]))[0]
    inner = sample @ space
    _, turn = np.linalg.eigh((inner.T @ inner).astype(float))
    return space.astype(float) @ turn[:, ::-1][:, : min(dimensions, width)]


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


class Voters:
    """Latent vectors of labelled documents, their labels, and what each stands for."""

    def __init__(self, idf, axes, latent, good, keys, shares, overall):
        self.idf, self.axes, self.latent, self.good, self.keys = idf, axes, latent, good, keys
        self.shares, self.overall = shares, overall

    def scores(self, texts: pa.Array, keys: np.ndarray) -> np.ndarray:
        asked = projected(texts, self.idf, self.axes)
        return np.concatenate(
            [np.zeros(0), *[self.votes(asked[a : a + BLOCK], keys[a : a + BLOCK]) for a in range(0, len(asked), BLOCK)]]
        )

    def votes(self, asked: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Weighted share of good documents among the nearest, a document's own text aside."""
        prior = PRIOR_WEIGHT * min(self.shares)
        for_, all_ = np.full(len(asked), prior * self.overall), np.full(len(asked), prior)
        if len(self.latent):
            near = asked @ self.latent.T
            near[keys[:, None] == self.keys] = 0.0
            k = min(NEIGHBOURS, near.shape[1])
            least = np.partition(near, -k, axis=1)[:, -k]
            weight = np.where((near >= least[:, None] - TIE) & (near > TIE), near, 0.0) ** POWER
            weight *= np.where(self.good, self.shares[1], self.shares[0])
            for_ += (weight * self.good).sum(axis=1)
            all_ += weight.sum(axis=1)
        return np.divide(for_, all_, out=np.full(len(asked), self.overall), where=all_ > 0)


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % 5 == 0, F.lit(False))


def document_counts(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of all documents, and of those with a term at each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0, np.zeros(PLACES, np.int64)
        for batch in slices(batches, "text"):
            n += np.bincount(counted(batch.column("text"))[1], minlength=PLACES)
            total += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, PLACES)), pa.array(np.append(total, n))], ["place", "n"])

    sums = docs.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    out = np.zeros(PLACES + 1)
    out[table.column("place").to_numpy() + 1] = table.column("n").to_numpy()
    return int(out[0]), out[1:]


def fit(docs: DataFrame, labels: DataFrame) -> Voters:
    """Voters from at most ``SAMPLE`` labelled documents of either class of ``docs`` (doc_id, text)."""
    plain = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = plain.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = stage(known.groupBy("doc_id").agg(F.max("quality").alias("quality")), "labelled")
    sizes = {r["quality"]: r["count"] for r in labelled.groupBy("quality").count().collect()}
    place = F.xxhash64("doc_id")
    bad, good = (labelled.where(F.col("quality") == c).orderBy(place, "doc_id").limit(SAMPLE) for c in (0, 1))
    # ids of 2 * SAMPLE documents at most
    sample = stage(bad.unionByName(good), "sample")
    examples = stage(docs.join(F.broadcast(sample), "doc_id").withColumn("key", text_key(F.col("text"))), "examples")
    total, held = document_counts(docs)
    idf = np.log((1 + total) / (1 + held)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, place, weight = vectors(batch.column("text"), idf)
            ends = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("quality"),
                    pa.ListArray.from_arrays(ends, pa.array(place, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(weight, pa.float32())),
                ],
                ["key", "quality", "place", "weight"],
            )

    # 2 * SAMPLE rows of PLACES entries at most; copies of a text with one label count once
    made = examples.mapInArrow(run, "key long, quality int, place array<int>, weight array<float>")
    table = made.dropDuplicates(["key", "quality"]).orderBy("key", "quality").toArrow().combine_chunks()
    found = np.zeros((table.num_rows, PLACES), np.float32)
    if table.num_rows:
        lists = table.column("place").combine_chunks()
        rows = np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy())
        found[rows, lists.flatten().to_numpy()] = table.column("weight").combine_chunks().flatten().to_numpy()
    some = found.any(axis=1)
    is_good = table.column("quality").to_numpy()[some] == 1
    keys = table.column("key").to_numpy()[some]
    found = found[some]
    axes = latent_axes(found) if len(found) else np.zeros((PLACES, 1))
    latent = found.astype(float) @ axes
    length = np.linalg.norm(latent, axis=1, keepdims=True)
    latent = np.divide(latent, length, out=latent, where=length > 0)
    counts = {c: int((is_good == c).sum()) for c in (0, 1)}
    # how many labelled documents an example of either class stands for
    shares = tuple(sizes.get(c, 0) / counts[c] if counts[c] else 0.0 for c in (0, 1))
    everything = sum(sizes.values())
    overall = sizes.get(1, 0) / everything if everything else 1.0
    return Voters(idf, axes, latent, is_good, keys, shares, overall)


def score_quality(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    ``labels`` (doc_id, quality) is learned from where crc32(doc_id as text) mod 5 is not 0; of several
    labels of a document the highest counts. ``score`` (0 to 1) is the share of good documents among the
    nearest examples, weighted by similarity and to the classes' true sizes; examples as near as the
    last of them vote too, those with the document's own text do not. ``predicted`` is 1 from 0.3 on.

    Texts without words, null and empty ones too, get the share of all labelled documents; without
    labels every score is 1. Null ids stay null and are not held out; repeated rows get equal
    rows; an empty table gives none. Other columns are ignored.
    """
    plain = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(plain, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores = shared.value.scores(batch.column("text"), batch.column("key").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    scored = plain.withColumn("key", text_key(F.col("text"))).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
