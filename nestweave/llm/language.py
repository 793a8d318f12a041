"""Language of web pages by Bayesian fusion of text, markup, address and host.

The text's likelihood comes from character trigrams counted over all labelled documents, hashed
into buckets. The markup's declared language has a likelihood for each true language, and a
host's pages a prior that is smoothed to that of the host's suffix and this to all pages':
both are grouped counts of what the text alone says, without the page itself.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.quality import language_class
from nestweave.llm.storage import stage
from nestweave.llm.urls import host_and_path
from nestweave.llm.words import mix, slices

#: Entries of the text model (languages times buckets) at most; 4 bytes each.
ENTRIES = 1 << 22
BUCKETS = 1 << 14
#: Trigrams after which a longer text says no more: neighbours are not independent.
ENOUGH = 100.0
#: Pages that a host's and a suffix's counts are smoothed by, and declarations a language's.
HOST_WEIGHT = 5.0
SUFFIX_WEIGHT = 20.0
DECLARED_WEIGHT = 20.0
#: Share of declarations expected to be right before any are counted.
TRUST = 0.9

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"<[^>]*(?:>|\Z)")
_DECLARED = r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b"


def _trigrams(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every three characters (letters in lower case, all else a blank)."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), lengths)
    letter = ((code | 32) - 97 < 26) | (code >= 0xAA)
    code = np.where((code >= 65) & (code <= 90), code + np.uint64(32), np.where(letter, code, np.uint64(32)))
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = (code[:-2] << np.uint64(42)) | (code[1:-1] << np.uint64(21)) | code[2:]
    inside = (row[:-2] == row[2:]) & ((code[:-2] != 32) | (code[1:-1] != 32) | (code[2:] != 32))
    return row[:-2][inside], (mix(key[inside]) % np.uint64(buckets)).astype(np.int64)


class TextModel:
    """Log probabilities of buckets, a row a language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.log_p = np.log((counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)).astype(np.float32)
        self.buckets = counts.shape[1]

    def log_likelihoods(self, texts: list[str]) -> list[list[float]]:
        """Of each text under each language, as if it had ``ENOUGH`` trigrams at most."""
        row, bucket = _trigrams(texts, self.buckets)
        many = np.bincount(row, minlength=len(texts))
        scale = np.minimum(1.0, ENOUGH / np.maximum(many, 1))
        sums = [np.bincount(row, weights=p[bucket], minlength=len(texts)) * scale for p in self.log_p]
        return np.array(sums).T.tolist() if sums else [[] for _ in texts]


def fit_text_model(docs: DataFrame, text: str = "text", lang: str = "lang") -> TextModel:
    """Counts of all documents with a language; at most ``ENTRIES`` numbers reach the driver."""
    plain = docs.select(language_class(F.col(lang)).alias("lang"), F.col(text).cast("string").alias("text"))
    plain = plain.where("lang <> 'und' and text is not null")
    languages = sorted(r[0] for r in plain.select("lang").distinct().collect())  # 18,252 codes at most
    buckets = min(BUCKETS, max(256, ENTRIES // max(1, len(languages))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {name: k for k, name in enumerate(languages)}
        total = {}
        for batch in slices(batches, "text"):
            row, bucket = _trigrams(batch.column("text").to_pylist(), buckets)
            lang_of = np.array([place[x] for x in batch.column("lang").to_pylist()])
            key, n = np.unique(lang_of[row] * buckets + bucket, return_counts=True)
            for k, c in zip(key.tolist(), n.tolist(), strict=True):
                total[k] = total.get(k, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["place", "n"])

    counted = plain.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages), buckets))
    for place, n in counted.toLocalIterator():
        counts[place // buckets, place % buckets] = n
    return TextModel(languages, counts)


def _visible(page: str) -> str:
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page)))


def _read(pages: DataFrame, body: str, url: str, model: TextModel, names: list[str]) -> DataFrame:
    """The columns kept (as _0, _1, ...), host, suffix, declared, and the text's log likelihoods."""
    host, _ = host_and_path(F.col(url))
    declared = F.nullif(F.lower(F.regexp_extract(F.coalesce(F.col(body).cast("string"), F.lit("")), _DECLARED, 1)), F.lit(""))
    plain = pages.select(
        *(F.col(c).alias(f"_{k}") for k, c in enumerate(names)),
        F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.element_at(F.split(host, r"\."), -1), F.lit("")).alias("suffix"),
        declared.alias("declared"),
        F.col(body).cast("string").alias("body"),
    )
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            found = shared.value.log_likelihoods([_visible(p or "") for p in batch.column("body").to_pylist()])
            rest = [batch.column(c) for c in batch.schema.names if c != "body"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(found, pa.list_(pa.float64()))], [*(c for c in batch.schema.names if c != "body"), "likelihood"]
            )

    kinds = [f"_{k} {pages.schema[c].dataType.simpleString()}" for k, c in enumerate(names)]
    return plain.mapInArrow(run, ", ".join([*kinds, "host string, suffix string, declared string, likelihood array<double>"]))


def _counts(votes: DataFrame, by: str) -> DataFrame:
    """For each value of ``by``: pages of each language as a map, at most one entry a language."""
    grouped = votes.where(F.col(by).isNotNull()).groupBy(by, "text_lang").agg(F.count("*").alias("n"))
    entries = F.collect_list(F.struct("text_lang", "n"))
    return grouped.groupBy(by).agg(F.map_from_entries(entries).alias(f"of_{by}"), F.sum("n").alias(f"n_{by}"))


def identify_languages(
    pages: DataFrame,
    docs: DataFrame,
    body: str = "html",
    url: str = "url",
    keep: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """The columns ``keep`` of ``pages``, lang, confidence, text_lang, declared.

    ``docs`` (text, lang) is what the text model learns from. ``confidence`` is the posterior of
    ``lang``; equal posteriors go to the first code by name. ``text_lang`` is what the text alone
    says, null for a page without letters, whose language follows from the other evidence.
    Null pages and URLs are pages without text and host. Without labelled documents lang,
    confidence and text_lang are null. Columns named like a result are replaced; repeated
    rows count each.
    """
    names = [c for c in keep if c not in ("lang", "confidence", "text_lang", "declared")]
    kept = [F.col(f"_{k}").alias(c) for k, c in enumerate(names)]
    model = fit_text_model(docs)
    read = _read(pages, body, url, model, names)
    if not model.languages:
        none = F.lit(None)
        return read.select(
            *kept, none.cast("string").alias("lang"), none.cast("double").alias("confidence"), none.cast("string").alias("text_lang"), "declared"
        )
    languages = F.array(*map(F.lit, model.languages))
    best = F.get(languages, (F.array_position("likelihood", F.array_max("likelihood")) - 1).cast("int"))
    said = F.exists("likelihood", lambda x: x < 0)
    votes = stage(read.withColumn("text_lang", F.when(said, best)), "votes")
    some = votes.where("text_lang is not null")
    total = _by_language(some)
    joined = votes.withColumn("of_all", _literal(total)).withColumn("n_all", F.lit(sum(total.values())))
    for by in ("host", "suffix", "declared"):
        joined = joined.join(stage(_counts(some, by), f"by-{by}"), by, "left")
    joined = joined.withColumn("of_declaring", _literal(_by_language(some.where("declared is not null"))))
    scores = F.transform(languages, lambda x, i: F.get("likelihood", i) + _prior(x, len(model.languages)) + _declares(x, len(model.languages)))
    scored = joined.withColumn("scores", scores)
    top = F.array_max("scores")
    place = (F.array_position("scores", top) - 1).cast("int")
    mass = F.aggregate("scores", F.lit(0.0), lambda a, s: a + F.exp(s - top))
    return scored.select(*kept, F.get(languages, place).alias("lang"), (1 / mass).alias("confidence"), "text_lang", "declared")


def _by_language(votes: DataFrame) -> dict[str, int]:
    """Pages of each language of the text model, a bounded number of rows."""
    return {r["text_lang"]: r["count"] for r in votes.groupBy("text_lang").count().collect()}


def _literal(counts: dict[str, int]) -> Column:
    if not counts:
        return F.expr("cast(map() as map<string,bigint>)")
    return F.create_map(*(F.lit(x) for pair in sorted(counts.items()) for x in pair)).cast("map<string,bigint>")


def _own(language: Column) -> Column:
    """1 where the page itself is among the counts of a language."""
    return F.coalesce((F.col("text_lang") == language).cast("int"), F.lit(0))


def _prior(language: Column, many: int) -> Column:
    """Log of the host's share of a language, smoothed to the suffix's, and that to all pages'."""
    voted = F.col("text_lang").isNotNull().cast("int")

    def others(name: str) -> tuple[Column, Column]:
        of = F.coalesce(F.element_at(f"of_{name}", language), F.lit(0))
        n = F.coalesce(F.col(f"n_{name}"), F.lit(0))
        there = F.lit(1) if name == "all" else F.col(name).isNotNull().cast("int")
        return F.greatest(of - there * _own(language), F.lit(0)), F.greatest(n - there * voted, F.lit(0))

    of_all, n_all = others("all")
    share = (of_all + 1) / (n_all + many)
    for name, weight in (("suffix", SUFFIX_WEIGHT), ("host", HOST_WEIGHT)):
        of, n = others(name)
        share = (of + weight * share) / (n + weight)
    return F.ln(share)


def _declares(language: Column, many: int) -> Column:
    """Log likelihood of the declaration under a language; 0 where nothing is declared."""
    of = F.greatest(F.coalesce(F.element_at("of_declared", language), F.lit(0)) - _own(language), F.lit(0))
    n = F.greatest(F.coalesce(F.element_at("of_declaring", language), F.lit(0)) - _own(language), F.lit(0))
    before = F.when(F.col("declared") == language, TRUST).otherwise((1 - TRUST) / max(1, many - 1) if many > 1 else 1 - TRUST)
    value = F.ln((of + DECLARED_WEIGHT * before) / (n + DECLARED_WEIGHT))
    return F.when(F.col("declared").isNull(), 0.0).otherwise(value)
