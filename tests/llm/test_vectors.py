"""Operators on vectors, and the classifier by votes, against brute force; their edge cases."""

import collections
import os

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nestweave.llm import hard_negatives as mining
from nestweave.llm import semantic_votes as votes
from nestweave.llm.eigen import counts_below, leading, leading_values, tridiagonal
from nestweave.llm.queries import ORACLES, QUERIES
from nestweave.llm.whitening import deviations, whiten

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def symmetric(kind, n, seed=1):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((n, n))
    if kind == "any":
        return a @ a.T
    if kind == "diagonal":
        return np.diag(rng.integers(0, 3, n).astype(float))
    if kind == "rank one":
        return np.outer(a[0], a[0])
    turn, _ = np.linalg.qr(a)
    made = turn @ np.diag([3.0] * min(n, 3) + [1.0] * (n - min(n, 3))) @ turn.T
    return (made + made.T) / 2


@pytest.mark.parametrize("kind", ["any", "diagonal", "rank one", "repeated values"])
@pytest.mark.parametrize("n", [1, 2, 3, 5, 30, 64, 100])
def test_leading_eigenpairs(kind, n):
    a = symmetric(kind, n)
    values, vectors = leading(a, 4)
    size = np.abs(a).sum() or 1.0
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:4], atol=1e-13 * size)
    assert np.allclose(a @ vectors.T, vectors.T * values, atol=1e-12 * size)
    assert np.allclose(vectors @ vectors.T, np.eye(min(n, 4)), atol=1e-13)


def test_steps_of_the_eigensolver():
    a = symmetric("any", 12)
    diagonal, beside, _ = tridiagonal(a)
    similar = np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1)
    expected = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(similar), expected)
    assert counts_below(diagonal, beside, (expected[1:] + expected[:-1]) / 2).tolist() == list(range(1, 12))
    assert np.allclose(leading_values(diagonal, beside, 12), expected[::-1])


@pytest.mark.parametrize("shape", [(1, 1, 1), (1, 64, 90), (65, 67, 33), (200, 33, 40), (256, 64, 300)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(3)
    for most in (300, 1 << 28):
        a, b = rng.integers(-most, most, shape[:2]), rng.integers(-most, most, shape[1:])
        assert (mining.strassen(a, b) == a @ b).all()


def brute_negatives(rows, is_anchor):
    kept = {}
    for id, vector, label in sorted((r for r in rows if r[0] is not None and r[2] is not None), key=lambda r: r[2]):
        if vector is None or any(c is None or not np.isfinite(c) for c in vector):
            continue
        kept.setdefault(id, (label, [int(np.floor(256 * float(np.float32(c)))) for c in vector]))
    out = set()
    for a, (own, x) in kept.items():
        if not is_anchor(a):
            continue
        score = {b: sum(p * q for p, q in zip(x, y)) for b, (_, y) in kept.items() if b != a}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if kept[b][0] == own][:5]:
            inside = [b for b in order if kept[b][0] != own and 50 * score[p] <= 100 * score[b] <= 95 * score[p]]
            out |= {(a, p, k, b, score[p], score[b]) for k, b in enumerate(inside[:3], 1)}
    return out


def odd_vectors():
    rng = np.random.default_rng(4)
    rows = [(k, (rng.standard_normal(6) / 3).tolist(), int(rng.integers(0, 3))) for k in range(120)]
    rows += [(k, [0.1, 0.2, 0.3, 0.1, 0.2, 0.3], k % 2) for k in range(200, 240)]  # ties
    rows += rows[:30]
    rows += [(None, [0.5] * 6, 1), (300, None, 1), (301, [0.5] * 5 + [None], 1), (302, [0.5] * 5 + [float("nan")], 1),
             (303, [0.5] * 5 + [float("-inf")], 0), (304, [0.5] * 6, None), (400, [0.5] * 6, 9)]
    return rows


@pytest.mark.parametrize("tile, anchors", [(1024, 12_288), (7, 5)])
def test_hard_negatives(spark, monkeypatch, tile, anchors):
    monkeypatch.setattr(mining, "TILE", tile)
    monkeypatch.setattr(mining, "ANCHORS", anchors)
    rows = odd_vectors()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS + ", x int, score string").repartition(3)
    found = mining.hard_negatives(frame, F.col("vec_id") % 10 == 0).collect()
    expected = brute_negatives(rows, lambda a: a % 10 == 0)
    assert len(expected) > 50
    assert collections.Counter(map(tuple, found)) == collections.Counter(expected)


def test_hard_negatives_empty(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert mining.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0], 1)], VECTORS)
    assert mining.hard_negatives(alone, F.col("vec_id") % 10 == 0).count() == 0
    assert mining.hard_negatives(alone, F.lit(False)).count() == 0


def test_hard_negatives_against_sql(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    cursor = connection.execute(ORACLES["op11_hard_negatives"])
    found = QUERIES["op11_hard_negatives"](spark, FOLDER)
    names = [d[0] for d in cursor.description]
    assert collections.Counter(map(tuple, found.select(*names).collect())) == collections.Counter(cursor.fetchall())


def test_windows():
    scores = np.array([-3, -1, 0, 1, 2, 7, 100, 101])
    least, most = mining.window_of(scores, 50, 95)
    for s, a, b in zip(scores.tolist(), least.tolist(), most.tolist()):
        inside = [x for x in range(-300, 300) if 50 * s <= 100 * x <= 95 * s]
        assert inside == list(range(a, b + 1))


def whitened_by_hand(rows):
    x = {k: [int(np.floor(256 * float(np.float32(c)))) for c in v] for k, (_, v, _) in enumerate(rows)
         if v is not None and all(c is not None and np.isfinite(c) for c in v)}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    return n, {
        (rows[k][0], c + 1): (int(((n * np.array(v) - sums) ** 2).sum()), (np.array(v) - sums / n) @ vectors[:, c] / np.sqrt(values[c]),
                              values[c] / np.trace(centred.T @ centred / n))
        for k, v in x.items() for c in range(4)
    }


def test_whitening(spark):
    rows = [r for r in odd_vectors() if r[0] is not None]
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], VECTORS + ", n int, x string").repartition(3)
    found = whiten(frame).collect()
    n, expected = whitened_by_hand(rows)
    assert collections.Counter((r.vec_id, r.component) for r in found) == collections.Counter(
        (id, c) for id, v, _ in rows for c in range(1, 5) if (id, c) in expected and v is not None)
    sign = {}
    for r in found:
        deviation, value, share = expected[r.vec_id, r.component]
        sign.setdefault(r.component, 1 if r.whitened * value >= 0 else -1)
        assert (r.n, r.deviation) == (n, deviation)
        assert r.whitened == pytest.approx(sign[r.component] * value, abs=1e-9)
        assert r.explained == pytest.approx(share, rel=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_without_spread(spark):
    assert whiten(spark.createDataFrame([], VECTORS)).count() == 0
    same = spark.createDataFrame([(k, [0.25, 0.5], 0) for k in range(5)], VECTORS)
    assert whiten(same).count() == 0
    line = spark.createDataFrame([(k, [0.25, float(k)], 0) for k in range(5)] + [(None, [0.25, 9.0], 0)], VECTORS)
    found = whiten(line).collect()
    assert {r.component for r in found} == {1} and len(found) == 6
    assert all(r.explained == pytest.approx(1.0) for r in found)
    with pytest.raises(ValueError):
        whiten(spark.createDataFrame([(1, [0.5], 0), (2, [0.5, 1.0], 0)], VECTORS))


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, 3], [2, 1]])
    assert deviations(x, 4, [5, 6]) == [None, 9 + 4]
    assert deviations(x, 2, [1 << 40, 3]) == [None, None]
    assert deviations(x[1:], 3, [5, 6]) == [1 + 9]


def test_shapes():
    row, place = votes.terms(pa.array(["Word*** WORD!! ab ab", None, "", "Xy## ABC! q r"]))
    first, last = (set(place[row == r][place[row == r] >= votes.WORD_PLACES].tolist()) for r in (0, 3))
    assert not (row == 1).any() and not (row == 2).any()
    assert (place[row == 0] < votes.WORD_PLACES).sum() == 4
    assert len(first & last) >= 2  # "A!" and "a", though no word is shared


def test_nearest_votes_are_exact():
    rng = np.random.default_rng(6)
    unit = lambda n: (v := rng.standard_normal((n, 8))) / np.linalg.norm(v, axis=1, keepdims=True)
    latent, asked = unit(300), unit(40)
    latent[250:] = latent[:50]  # ties
    good, keys = rng.random(300) < 0.7, np.arange(300)
    voters = votes.Voters(None, None, latent, good, keys, (2.0, 3.0), 0.8)
    own = np.arange(40)
    asked[:20] = latent[:20]
    for k, score in enumerate(voters.votes(asked, own)):
        near = sorted(((float(asked[k] @ latent[e]), e) for e in range(300) if e != k), reverse=True)
        least = near[votes.NEIGHBOURS - 1][0] - votes.TIE
        for_, all_ = votes.PRIOR_WEIGHT * 2.0 * 0.8, votes.PRIOR_WEIGHT * 2.0
        for s, e in near:
            if s >= least and s > votes.TIE:
                weight = s**votes.POWER * (3.0 if good[e] else 2.0)
                for_, all_ = for_ + weight * good[e], all_ + weight
        assert score == pytest.approx(for_ / all_, abs=1e-9)


def test_latent_axes_are_the_leading_singular_directions():
    rng = np.random.default_rng(8)
    sample = rng.standard_normal((60, 5)) @ rng.standard_normal((5, 90)) + 0.01 * rng.standard_normal((60, 90))
    axes = votes.latent_axes(sample, 5)
    exact = np.linalg.svd(sample)[2][:5].T
    assert np.allclose(axes @ axes.T, exact @ exact.T, atol=1e-6)


def test_quality_of_held_out_documents(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    folder = FOLDER.replace("0.001", "0.01")
    scored = QUERIES["op12_quality_classifier"](spark, folder).where("held_out")
    rows = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
    assert sum(r.predicted for r in bad) <= 0.2 * len(bad)
    wins = sum((g.score > b.score) + (g.score == b.score) / 2 for g in good for b in bad)
    assert wins >= 0.98 * len(good) * len(bad)


def test_quality_edge_cases(spark):
    text = "some plain words of a text that goes on"
    odd = [(None, text), (1, None), (2, ""), (3, " \n"), (4, text), (4, text), (5, "Word*** " * 40_000), (7, "a" * 9000)]
    frame = spark.createDataFrame([(*r, "x", 0.5) for r in odd], "doc_id long, text string, key string, score double")
    labels = "doc_id long, quality int"
    none = votes.score_quality(frame, spark.createDataFrame([], labels)).collect()
    assert len(none) == len(odd) and all(r.score == 1.0 and r.predicted == 1 for r in none)
    known = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (7, 1), (None, 0), (1, None), (99, 1)], labels)
    found = votes.score_quality(frame, known).collect()
    assert len(found) == len(odd) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == 4 or r.doc_id is None}) == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert votes.score_quality(empty, known).count() == 0
