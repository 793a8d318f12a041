"""Token counts of a byte-level BPE vocabulary, by whole tokens first.

Pre-tokens never reach over white space that follows other characters, so that texts are cut
there and each distinct piece of a batch is looked at once.

Which vocabulary strings encode alone as one token is proved once, before any text is read, by
merging each of them. A pre-token that is such a string counts as one token without being
merged; only the others are merged, and each task remembers what they came to.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nestweave.llm.words import byte_lengths, slices, units

#: Tokens above which ``over_limit`` is true.
LIMIT = 512
#: Merged pre-tokens that a task remembers at most before it starts anew.
REMEMBERED = 600_000
#: Pieces with characters from here on are cut by the library: versions of Unicode differ there.
_FROM = "\u0500"

# Fixed value: how byte-level vocabularies of this kind cut a text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in such vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {**{b: chr(b) for b in kept}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


def whole_tokens(vocabulary: str) -> frozenset[str]:
    """The strings of a vocabulary file's content that encode alone as one token."""
    model = Tokenizer.from_str(vocabulary).model
    back = {c: b for b, c in byte_alphabet().items()}
    out = set()
    for token in json.loads(vocabulary)["model"]["vocab"]:
        if all(c in back for c in token) and len(model.tokenize(token)) == 1:
            try:
                out.add(bytes(back[c] for c in token).decode())
            except UnicodeDecodeError:
                continue  # part of a character: no pre-token
    return frozenset(out)


def _check(vocabulary: str) -> list[str]:
    """The special strings, if the file's pipeline is the one that is counted here."""
    spec = json.loads(vocabulary)
    cut = spec["pre_tokenizer"] or {}
    plain = spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
    bpe = spec["model"]["type"] == "BPE" and not spec["model"].get("ignore_merges")
    special = spec["added_tokens"]
    bare = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in special)
    if not (plain and bpe and bare) or cut.get("add_prefix_space"):
        raise ValueError("not a plain byte-level BPE vocabulary")
    return [t["content"] for t in special]


class Counter(dict):
    """Tokens of a pre-token: one for whole tokens, else what merging gives."""

    def __init__(self, vocabulary: str, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole = whole
        tokenizer = Tokenizer.from_str(vocabulary)
        self.merge, self.cut = tokenizer.model.tokenize, tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = byte_alphabet()  # by code point, for translate()
        self.pre_tokens = regex.compile(PRE_TOKEN)
        special = sorted(_check(vocabulary), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces: dict[str, int] = {}

    def __missing__(self, pre_token: str) -> int:
        if len(self) > REMEMBERED + len(self.whole):
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        self[pre_token] = n = len(self.merge(pre_token.encode().decode("latin-1").translate(self.letters)))
        return n

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special string inside it is one token."""
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        known = list(map(self.pieces.get, texts))
        for k, n in enumerate(known):
            if n is None:
                text = texts[k]
                known[k] = self.pieces[text] = self._count(text)
        return np.array(known, np.int64)

    def _count(self, text: str) -> int:
        low = text.isascii() or max(text) < _FROM
        if low and (text[1:] if text[:1] == " " else text).isalpha():  # a space and letters: one pre-token
            if text in self.whole:
                return 1
            return len(self.merge(text.encode().decode("latin-1").translate(self.letters)))
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self._count(p) for p in parts if p)
        if low:
            return sum(map(self.__getitem__, self.pre_tokens.findall(text)))
        return sum(self[text[a:b]] for _, (a, b) in self.cut(text))


def count_tokens(docs: DataFrame, vocabulary_path: str, id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``).

    Counts are those of the tokenizers library without added special tokens; special strings in
    a text are one token each, its default. Null texts are empty and have no tokens; null ids
    stay null. The vocabulary file is read on the driver and sent to the tasks with the whole
    tokens found in it; both are bounded by the file.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    _check(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, whole_tokens(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            found = units(texts)
            each = counter.counts(found.distinct)
            row = np.repeat(np.arange(len(texts)), found.counts)
            tokens = np.zeros(len(texts), np.int64)
            np.add.at(tokens, row, each[found.which])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(byte_lengths(texts), pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    plain = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    counted = plain.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
