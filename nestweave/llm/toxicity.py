"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words in lower case and the stems of longer words (their first bytes), all those of a bounded
sample of labelled documents; their document counts cover all documents. A term's TF-IDF weight is
multiplied by how strongly it goes with a class (the phi coefficient, chi-squared by the sample's size, so that
the size is no switch) plus a floor, so that no term is dropped. Terms that no example has lengthen a text's
vector. Examples are indexed by term: frequent terms as a dense matrix in single precision, the others as
postings. What comes near the k-th best sum is summed again in double precision: the neighbours are exact.
Neighbours vote with their similarity, weighted to the classes' true sizes, so that a score is the
share of toxic documents among comparable ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestweave.llm.storage import stage
from nestweave.llm.words import mix, slices, text_bytes, words

#: Labelled documents of each class that the index is fitted on at most, the first by a hash of the id.
SAMPLE = 4096
#: Weight of a term that goes with neither class.
FLOOR = 0.01
NEIGHBOURS = 25
#: Terms of a larger share of the examples are kept as a dense matrix; texts that meet it at a time.
DENSE_SHARE = 1 / 16
TEXTS = 64
#: Share by which sums of single precision may be off.
MARGIN = 1e-3
THRESHOLD = 0.3
#: Weight of the classes' overall share in a vote.
PRIOR_WEIGHT = 0.1
#: Similarities this close are equal; examples as near as the last neighbour vote too, and an example
#: that is all of the text (a document itself, a copy) does not.
TIE = 1e-9
#: Neighbours named as evidence.
EVIDENCE = 3

#: Bytes of a stem.
STEM = 4
_LOW = np.uint64((1 << 20) - 1)
#: What stands between words: ASCII other than letters and digits.
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of every word and stem."""
    found = words(texts, lower=True, space=_BETWEEN)
    long = np.flatnonzero(found.end - found.start > STEM)
    data = text_bytes(texts)[0]
    stem = np.zeros(len(long), np.uint64)
    for k in range(STEM):
        byte = data[found.start[long] + k]
        byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        stem = (stem << np.uint64(8)) | byte.astype(np.uint64)
    return np.concatenate((found.row, found.row[long])), np.concatenate((found.hash, mix(stem + np.uint64(1 << 40))))


class Known:
    """Terms in order, and which of them the terms of texts are."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.maybe = np.zeros(int(_LOW) + 1, bool)
        self.maybe[self.keys & _LOW] = True

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and how often it occurs, by row and term; row and number of each other term."""
        row, key = _terms(texts)
        some = self.maybe[key & _LOW]
        # words come again and again: each is looked up once
        coded = pa.array(key[some]).dictionary_encode()
        which, asked = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        place = np.searchsorted(self.keys, asked)
        at = place[which]
        known = np.zeros(len(key), bool)
        known[some] = (self.keys[np.minimum(place, len(self.keys) - 1)] == asked)[which] if len(self.keys) else False
        place = row[known] * (len(self.keys) + 1) + at[known[some]]
        place, n = np.unique(place, return_counts=True)
        row, key = row[~known], key[~known]
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])))) if len(row) else row
        times = np.diff(np.append(new, len(row)))
        return place // (len(self.keys) + 1), place % (len(self.keys) + 1), n, row[new], times


@dataclass
class Example:
    doc_id: int
    toxic: int
    terms: np.ndarray
    weights: np.ndarray


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The integers of all the ranges."""
    size = end - begin
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


class Index:
    """The examples by term: a dense matrix of frequent terms, postings of the others."""

    def __init__(self, examples: list[Example], terms: int):
        order = sorted(examples, key=lambda e: e.doc_id)
        self.ids = np.array([e.doc_id for e in order], np.int64)
        self.toxic = np.array([e.toxic for e in order], np.int64)
        sizes = [len(e.terms) for e in order]
        # as given, by example
        self.first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.terms = np.concatenate([e.terms for e in order]).astype(np.int32) if order else np.zeros(0, np.int32)
        self.weights = np.concatenate([e.weights for e in order]) if order else np.zeros(0)
        self.build(terms)

    def __getstate__(self):
        """What was given; what follows from it is several times as large and built where it is used."""
        return self.ids, self.toxic, self.first, self.terms, self.weights, len(self.column)

    def __setstate__(self, state):
        self.ids, self.toxic, self.first, self.terms, self.weights, terms = state
        self.build(terms)

    def build(self, terms: int) -> None:
        """The examples by term."""
        example = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        by = np.lexsort((example, self.terms))
        self.example, self.weight = example[by], self.weights[by]
        self.begin = np.searchsorted(self.terms[by], np.arange(terms + 1))
        frequent = np.flatnonzero(np.diff(self.begin) > DENSE_SHARE * len(self.ids))
        self.column = np.full(terms, -1)
        self.column[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), len(self.ids)), np.float32)
        at = _ranges(self.begin[frequent], self.begin[frequent + 1])
        self.dense[np.repeat(np.arange(len(frequent)), np.diff(self.begin)[frequent]), self.example[at]] = self.weight[at]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The ``k`` most similar examples as (similarity, place), and those as similar as the last of them.

        Examples with the very same vector are left out.
        """
        return self.nearest_of([(terms, weights)], k)[0]

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
        """The same for each vector."""
        if not len(self.ids):
            return [[] for _ in vectors]
        out = []
        full = np.zeros(len(self.column))
        for first in range(0, len(vectors), TEXTS):
            some = vectors[first : first + TEXTS]
            asked = np.zeros((len(some), len(self.dense)), np.float32)
            for k_, (terms, weights) in enumerate(some):
                column = self.column[terms]
                asked[k_, column[column >= 0]] = weights[column >= 0]
            for sums, (terms, weights) in zip(asked @ self.dense, some, strict=True):
                rare = self.column[terms] < 0
                begin, end = self.begin[terms[rare]], self.begin[terms[rare] + 1]
                at = _ranges(begin, end)
                rest = np.repeat(weights[rare], end - begin)
                rest *= self.weight.take(at)
                about = sums + np.bincount(self.example.take(at), rest, len(self.ids))
                full[terms] = weights
                wanted = k
                while True:
                    least = np.partition(about, -wanted)[-wanted] if wanted < len(about) else 0.0
                    near = np.flatnonzero((about > 0) & (about >= least * (1 - MARGIN)))
                    spans = zip(self.first[near].tolist(), self.first[near + 1].tolist(), strict=True)
                    exact = np.array([full.take(self.terms[a:b]) @ self.weights[a:b] for a, b in spans], np.float64)
                    others = exact < 1 - TIE
                    if others.sum() >= k or wanted >= len(about):
                        break
                    wanted += 2 * k + len(near) - int(others.sum())  # copies of the text took places
                full[terms] = 0.0
                near, exact = near[others], exact[others]
                best = np.lexsort((near, -exact))
                kept = best[exact[best] >= exact[best[k - 1]] - TIE] if len(best) > k else best
                out.append(list(zip(exact[kept].tolist(), near[kept].tolist(), strict=True)))
        return out


def _vectors(texts: pa.Array, known: Known, weight_of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms and weights of each text, of unit length with the terms that no example has."""
    row, term, n, other, times = known.find(texts)
    weight = (1 + np.log(n)) * weight_of[term]
    squares = np.bincount(row, weights=weight**2, minlength=len(texts))
    squares = squares + np.bincount(other, weights=((1 + np.log(times)) * weight_of[-1]) ** 2, minlength=len(texts))
    weight = weight / np.sqrt(squares)[row]
    bounds = np.searchsorted(row, np.arange(len(texts) + 1))
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield term[a:b], weight[a:b]


class Scorer:
    """Scores of texts from their nearest examples."""

    def __init__(self, known: Known, idf: np.ndarray, index: Index, shares: tuple[float, float], overall: float):
        self.known, self.idf, self.index, self.shares, self.overall = known, idf, index, shares, overall

    def scores(self, texts: pa.Array) -> list[tuple[float, str]]:
        vectors = list(_vectors(texts, self.known, self.idf))
        # copies are looked up once
        places: dict[bytes, int] = {}
        which = [places.setdefault(hashlib.sha256(t.tobytes() + w.tobytes()).digest(), len(places)) for t, w in vectors]
        once = [vectors[i] for i in np.unique(np.array(which, np.int64), return_index=True)[1]]
        found = [self.vote(t, near) for (t, _), near in zip(once, self.index.nearest_of(once, NEIGHBOURS), strict=True)]
        return [found[k] for k in which]

    def vote(self, terms: np.ndarray, near: list[tuple[float, int]]) -> tuple[float, str]:
        """Weighted share of toxic neighbours, and the first neighbours by id and similarity."""
        if not len(terms):
            return self.shares[1] * self.index_free, ""
        for_, all_ = PRIOR_WEIGHT * self.overall * min(self.shares), PRIOR_WEIGHT * min(self.shares)
        for similarity, place in near:
            share = self.shares[self.index.toxic[place]]
            for_ += similarity * share * self.index.toxic[place]
            all_ += similarity * share
        named = ",".join(f"{self.index.ids[place]}:{similarity:.3f}" for similarity, place in near[:EVIDENCE])
        return for_ / all_ if all_ else self.overall, named

    index_free = 0.0


def _labelled(labels: DataFrame) -> DataFrame:
    """Labels to learn from, one a document (toxic if any of its labels says so)."""
    plain = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = plain.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> Scorer:
    """A scorer from at most ``SAMPLE`` labelled documents of either class; its size is bounded."""
    labelled = stage(_labelled(labels), "labelled")
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    place = F.xxhash64("doc_id")
    sample = None
    for toxic in (0, 1):
        some = labelled.where(F.col("toxic") == toxic).orderBy(place, "doc_id").limit(SAMPLE)
        sample = some if sample is None else sample.unionByName(some)
    plain = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # at most 8192 ids
    examples = stage(plain.join(F.broadcast(stage(sample, "sample")), "doc_id"), "examples")
    counts = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    known, strength = _weigh_terms(examples, counts.get(1, 0), counts.get(0, 0))
    total, held = _document_counts(plain, known)
    # the last entry is for terms that no example has
    idf = (np.log((1 + total) / (1 + np.append(held, 0.0))) + 1) * np.append(FLOOR + strength, FLOOR)
    shared = docs.sparkSession.sparkContext.broadcast((known, idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = list(_vectors(batch.column("text"), *shared.value))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic"),
                    pa.array([m[0].tolist() for m in made], pa.list_(pa.int64())),
                    pa.array([m[1].tolist() for m in made], pa.list_(pa.float64())),
                ],
                ["doc_id", "toxic", "terms", "weights"],
            )

    vectors = examples.mapInArrow(run, "doc_id long, toxic int, terms array<long>, weights array<double>")
    rows = []
    for batch in vectors.toArrow().to_batches():
        ids, toxic, terms, weights = batch.columns
        ends = terms.offsets.to_numpy()
        values = terms.values.to_numpy(), weights.values.to_numpy()
        for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            rows.append(Example(ids[k].as_py(), toxic[k].as_py(), values[0][a:b], values[1][a:b]))
    # how many documents an example of either class stands for
    shares = tuple(sizes.get(c, 0) / counts[c] if counts.get(c) else 0.0 for c in (0, 1))
    everything = sum(sizes.values())
    overall = sizes.get(1, 0) / everything if everything else 0.0
    scorer = Scorer(known, idf, Index([e for e in rows if len(e.terms)], len(known.keys)), shares, overall)
    bare = [sum(shares[c] for e in rows if e.toxic == c and not len(e.terms)) for c in (0, 1)]
    mass = sum(bare) + 1.0
    free = (bare[1] + overall) / mass
    scorer.index_free = free / shares[1] if shares[1] else 0.0
    return scorer


def _weigh_terms(examples: DataFrame, toxic: int, other: int) -> tuple[Known, np.ndarray]:
    """All terms of the examples, and how strongly each goes with a class, from 0 to 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, key = _terms(batch.column("text"))
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            label = batch.column("toxic").to_numpy()[row[new]]
            found, which = np.unique(key[new], return_inverse=True)
            n = [np.bincount(which[label == c], minlength=len(found)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(n[1], pa.int64()), pa.array(n[0], pa.int64())], ["key", "a", "b"]
            )

    counted = examples.mapInArrow(run, "key long, a long, b long").groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    c, d = F.lit(float(toxic)) - F.col("a"), F.lit(float(other)) - F.col("b")
    n = float(toxic + other)
    chi = F.try_divide(n * (F.col("a") * d - F.col("b") * c) ** 2, (F.col("a") + F.col("b")) * (c + d) * float(toxic) * float(other))
    # less what chance alone gives
    phi = F.sqrt(F.greatest(F.lit(0.0), F.coalesce(chi, F.lit(0.0)) - 1) / n) if n else F.lit(0.0)
    table = counted.select("key", phi.alias("phi")).toArrow()
    keys = table.column("key").to_numpy().view(np.uint64)
    return Known(keys), table.column("phi").to_numpy()[np.argsort(keys)]


def _document_counts(docs: DataFrame, known: Known) -> tuple[int, np.ndarray]:
    """Number of all documents, and of those that have each term."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0, np.zeros(len(shared.value.keys), np.int64)
        for batch in slices(batches, "text"):
            n += np.bincount(shared.value.find(batch.column("text"))[1], minlength=len(n))
            total += batch.num_rows
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, seen)), pa.array(np.append(total, n[seen]))], ["term", "n"])

    counted = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(len(known.keys) + 1)
    table = counted.toArrow()
    out[table.column("term").to_numpy() + 1] = table.column("n").to_numpy()
    return int(out[0]), out[1:]


def score_toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence.

    ``labels`` (doc_id, toxic) is learned from where crc32(doc_id as text) mod 4 is not 2.
    ``score`` (0 to 1) is the weighted share of toxic documents among the nearest examples;
    texts without any term, null and empty ones too, get the share among such examples. Examples as near
    as the last neighbour vote too, and the text's own example and its copies do not. ``predicted`` is 1 from a score of 0.3. ``evidence`` names the first neighbours and their similarities. Null
    ids stay null and are not held out; repeated rows get equal rows; without labels scores are 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.string())],
                ["doc_id", "score", "evidence"],
            )

    plain = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = plain.mapInArrow(run, "doc_id long, score double, evidence string")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )
