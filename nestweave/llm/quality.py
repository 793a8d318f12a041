"""Quality rules: repetition rules and language-specific bands of n-gram perplexity.

The language model is an interpolated modified Kneser-Ney model over runs of four characters
(words joined by one space, digits as 0), one per language, counted by Spark over all documents.
Four 16-bit code units fill a 64-bit key exactly, so that shifts give contexts and shorter runs,
and all orders follow from the counts of the longest by plain aggregates and joins. The finished
model is a pair of arrays a language, sorted keys and log probabilities, looked up by bisection.

Documents whose mean log probability lies outside their language's band are rejected. A band
is the median plus and minus some widths, where a width is the interquartile range scaled to a
standard deviation and shrinks with the root of the text's length, as means do: bands follow
the corpus, and keep all of it if it has no outliers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestweave.llm.storage import stage
from nestweave.llm.words import SMALL_SLICE, SPACE, slices, text_bytes, windows, words

ORDER = 4
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Widths below and above the median that a band spans; the least width, in nats for a text of one
#: character; the length beyond which bands get no narrower. Junk of regular symbols is likelier than
#: prose, which spreads little on that side; below, clean texts have a longer tail (README, 5).
LOWER_WIDTHS = 4.0
UPPER_WIDTHS = 3.0
LEAST_WIDTH = 0.2
LONG_CHARS = 4096
#: Model entries (12 bytes each) that are broadcast at most; beyond, documents meet their part of
#: the model in groups of so many bytes of text.
BROADCAST_ENTRIES = 4_000_000
GROUP_BYTES = 32 << 20

STATS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
}
JUDGED = [*STATS, "base_failed", "log_prob", "lower", "upper", "kept"]


def language_class(lang: Column) -> Column:
    """The language's code if it is two or three letters, else 'und': 18,253 classes at most."""
    code = F.lower(F.trim(lang))
    return F.when(code.rlike("^[a-z]{2,3}$"), code).otherwise(F.lit("und"))


def text_stats(texts: pa.Array) -> list[np.ndarray]:
    """The columns of ``STATS`` for each text."""
    data, bounds = text_bytes(texts)
    n = len(texts)
    found = words(texts)
    row_of_byte = np.repeat(np.arange(n), np.diff(bounds))
    begins = (data & 0xC0) != 0x80  # the first byte of each character
    chars = np.bincount(row_of_byte[begins & ~SPACE[data]], minlength=n)
    special = np.zeros(256, bool)
    special[list(SYMBOLS.encode())] = True
    symbols = np.bincount(row_of_byte[special[data]], minlength=n)
    return [found.counts, chars, symbols, _repeated_lines(texts), _repeated_words(found, n)]


def _repeated_lines(texts: pa.Array) -> np.ndarray:
    lists = pc.split_pattern(texts.fill_null(""), "\n")
    lines = lists.values.slice(lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py())
    coded = lines.dictionary_encode()
    filled = words(coded.dictionary).counts > 0
    line = coded.indices.to_numpy()
    row = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    keep = filled[line] if len(line) else np.zeros(0, bool)
    key = row[keep] * max(1, len(filled)) + line[keep]
    total = np.bincount(row[keep], minlength=len(texts))
    return total - np.bincount(np.unique(key) // max(1, len(filled)), minlength=len(texts))


def _repeated_words(found, n: int) -> np.ndarray:
    """Words of each row in windows that occur twice or more in it."""
    at, value = windows(found, REPEAT_WINDOW)
    if not len(at):
        return np.zeros(n, np.int64)
    row = found.row[at]
    order = np.lexsort((value, row))
    same = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(found.row) + 1, np.int64)
    np.add.at(steps, at[twice], 1)
    np.add.at(steps, at[twice] + REPEAT_WINDOW, -1)
    return np.bincount(found.row[np.cumsum(steps[:-1]) > 0], minlength=n)


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of every run of ``ORDER`` characters of each text."""
    plain = texts.fill_null("").to_pylist()
    codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter(map(len, plain), np.int64, len(plain))
    row = np.repeat(np.arange(len(plain)), lengths)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    new_row = np.ones(len(codes), bool)
    new_row[1:] = row[1:] != row[:-1]
    before = np.concatenate(([True], space[:-1])) | new_row
    keep = ~(space & before)  # one space for a run, none at the start
    codes, row, space = codes[keep], row[keep], space[keep]
    unit = np.where(space, 32, np.where((codes >= 48) & (codes <= 57), 48, np.minimum(codes, 0xFFFD)))
    unit = unit.astype(np.uint64)
    size = len(unit) - ORDER + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = reduce(lambda k, i: (k << np.uint64(16)) | unit[i : i + size], range(ORDER), np.zeros(size, np.uint64))
    inside = row[:size] == row[ORDER - 1 :]
    return row[:size][inside], key[inside].view(np.int64)


def gram_counts(docs: DataFrame) -> DataFrame:
    """Counts (lang, gram, n) of all runs of characters; ``docs`` has lang and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SMALL_SLICE):
            row, key = _grams(batch.column("text"))
            coded = batch.column("lang").dictionary_encode()
            lang = coded.indices.to_numpy()[row]
            for k, name in enumerate(coded.dictionary.to_pylist()):
                counted = pc.value_counts(pa.array(key[lang == k]))
                size = len(counted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * size, pa.string()), counted.field("values"), counted.field("counts")],
                    ["lang", "gram", "n"],
                )

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def model(counts: DataFrame) -> DataFrame:
    """Log probability (lang, gram, log_prob) of the last character of each run after the others."""
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        low = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1))
        levels[order] = levels[order + 1].groupBy("lang", low.alias("gram")).agg(F.count("*").alias("n"))
        levels[order] = stage(levels[order], f"grams-{order}")
    # uniform over the characters of the language, below single characters
    lower = levels[1].groupBy("lang").agg((1 / F.count("*")).alias("p_lower"))
    for order in range(1, ORDER + 1):
        level = levels[order].withColumn("context", F.shiftrightunsigned("gram", 16))
        many = [F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in range(1, 5)]
        discounts = level.groupBy("lang").agg(*many).select("lang", *_discounts())
        context = (
            level.groupBy("lang", "context")
            .agg(
                F.sum("n").alias("total"),
                F.sum((F.col("n") == 1).cast("long")).alias("ones"),
                F.sum((F.col("n") == 2).cast("long")).alias("twos"),
                F.sum((F.col("n") >= 3).cast("long")).alias("more"),
            )
            .join(F.broadcast(discounts), "lang")
        )
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1)).alias("suffix")
        joined = level.select("lang", "gram", "n", "context", suffix).join(context, ["lang", "context"])
        if order == 1:
            joined = joined.join(F.broadcast(lower), "lang")
        else:
            below = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("p_lower"))
            joined = joined.join(below, ["lang", "suffix"])
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        spare = F.col("d1") * F.col("ones") + F.col("d2") * F.col("twos") + F.col("d3") * F.col("more")
        p = (F.col("n") - off + spare * F.col("p_lower")) / F.col("total")
        lower = joined.select("lang", "gram", p.alias("p"))
        if order < ORDER:
            lower = stage(lower, f"model-{order}")
    return lower.select("lang", "gram", F.ln("p").cast("float").alias("log_prob"))


def _discounts() -> list[Column]:
    """The three discounts from counts of counts; fixed ones where those give none."""
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    enough = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    out = []
    for k, fixed in ((1, 0.5), (2, 1.0), (3, 1.5)):
        d = k - F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}"))
        out.append(F.when(enough & (d > 0) & (d < k), d).otherwise(F.lit(fixed)).alias(f"d{k}"))
    return out


class HashArrays:
    """Keys in ascending order and their values, a pair of arrays a language."""

    def __init__(self, table: pa.Table):
        self.arrays = {}
        lang, gram, value = (table.column(c).to_numpy() for c in ("lang", "gram", "log_prob"))
        order = np.lexsort((gram, lang))
        lang, gram, value = lang[order], gram[order], value[order]
        cuts = np.flatnonzero(lang[1:] != lang[:-1]) + 1 if len(lang) else []
        for keys, values, names in zip(np.split(gram, cuts), np.split(value, cuts), np.split(lang, cuts), strict=True):
            if len(names):
                self.arrays[names[0]] = keys, values

    def find(self, lang: str, gram: np.ndarray) -> np.ndarray:
        keys, values = self.arrays[lang]
        return values[np.searchsorted(keys, gram)]


def _log_probs(batch: pa.RecordBatch, arrays: HashArrays) -> np.ndarray:
    """Mean log probability of each text's characters; not a number where it has no run."""
    row, key = _grams(batch.column("text"))
    coded = batch.column("class").dictionary_encode()
    lang = coded.indices.to_numpy()
    out = np.zeros(batch.num_rows)
    for k, name in enumerate(coded.dictionary.to_pylist()):
        mine = lang[row] == k
        keys = pa.array(key[mine]).dictionary_encode()  # each key of the batch is looked up once
        if len(keys):
            value = arrays.find(name, keys.dictionary.to_numpy())[keys.indices.to_numpy()]
            out += np.bincount(row[mine], weights=value, minlength=batch.num_rows)
    many = np.bincount(row, minlength=batch.num_rows)
    return np.divide(out, many, out=np.full(batch.num_rows, np.nan), where=many > 0)


def _scored(batch: pa.RecordBatch, arrays: HashArrays, keep: list[str]) -> pa.RecordBatch:
    texts = batch.column("text")
    stats = [pa.array(x.astype(np.int64)) for x in text_stats(texts)]
    log_prob = pa.array(_log_probs(batch, arrays), pa.float64(), from_pandas=True)
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in keep), batch.column("class"), *stats, log_prob],
        [*keep, "class", *STATS, "log_prob"],
    )


def score(docs: DataFrame, fitted: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, class, ``STATS`` and log_prob.

    ``docs`` has class and text and is what ``fitted`` was counted on. A small model goes to
    every task; a larger one is split by groups of documents, each of which gets the entries of
    its own runs of characters. Both ways give the same numbers.
    """
    fields = [docs.schema[c] for c in keep]
    more = [T.StructField(c, T.LongType()) for c in STATS]
    schema = T.StructType([*fields, T.StructField("class", T.StringType()), *more, T.StructField("log_prob", T.DoubleType())])
    if fitted.count() <= BROADCAST_ENTRIES:
        shared = docs.sparkSession.sparkContext.broadcast(HashArrays(fitted.toArrow()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", SMALL_SLICE):
                yield _scored(batch, shared.value, keep)

        return docs.mapInArrow(run, schema)
    return _score_by_group(docs, fitted, keep, schema)


def _score_by_group(docs: DataFrame, fitted: DataFrame, keep: list[str], schema: T.StructType) -> DataFrame:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    # repeated rows are spread by their position, all else by content
    spread = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(groups))
    grouped = stage(docs.withColumn("_group", spread), "groups")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SMALL_SLICE):
            row, key = _grams(batch.column("text"))
            group, coded = batch.column("_group").to_numpy()[row], batch.column("class").dictionary_encode()
            lang = coded.indices.to_numpy()[row]
            for k, name in enumerate(coded.dictionary.to_pylist()):
                for g in np.unique(group[lang == k]):
                    keys = pc.unique(pa.array(key[(lang == k) & (group == g)]))
                    names = pa.array([name] * len(keys), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([g] * len(keys), pa.int64()), names, keys], ["_group", "lang", "gram"])

    wanted = grouped.select("_group", "class", "text").mapInArrow(asked, "_group long, lang string, gram long").distinct()
    parts = wanted.join(fitted, ["lang", "gram"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        arrays = HashArrays(right)
        done = [_scored(b, arrays, keep) for b in slices(iter(left.combine_chunks().to_batches()), "text", SMALL_SLICE)]
        return pa.Table.from_batches(done)

    return grouped.groupBy("_group").cogroup(parts.groupBy("_group")).applyInArrow(run, schema)


def bands(scored: DataFrame) -> DataFrame:
    """Middle and width (class, middle, width) of each language class, widths for one character.

    A mean over more characters spreads less, so deviations count times the root of the length.
    """
    some = scored.where(f"log_prob is not null and n_words >= {MIN_WORDS}")
    middles = some.groupBy("class").agg(F.percentile_approx("log_prob", 0.5, 10_000).alias("middle"))
    away = some.join(F.broadcast(middles), "class").withColumn("d", (F.col("log_prob") - F.col("middle")) * _root())
    quartiles = F.percentile_approx("d", [0.25, 0.75], 10_000)
    spread = away.groupBy("class", "middle").agg(quartiles.alias("q"))
    width = F.greatest((F.col("q")[1] - F.col("q")[0]) / 1.349, F.lit(LEAST_WIDTH))
    return spread.select("class", "middle", width.alias("width"))


def _root() -> Column:
    return F.sqrt(F.greatest(F.lit(1), F.least("word_chars", F.lit(LONG_CHARS))))


def judge_quality(docs: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` and, for each row, the columns ``JUDGED``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words lie in 8-word windows that
    repeat. ``kept`` is false for those and for texts whose ``log_prob`` (mean natural logarithm
    of a character's probability; the perplexity is exp(-log_prob)) leaves the band of the
    language. Null and empty texts have no words, fail and have a null log_prob. Languages
    that are null or no code share one model. Columns of ``docs`` named like a result are
    replaced. Repeated rows are judged each; no rows give no rows.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in [*JUDGED, "class"]]
    plain = docs.select(
        *(F.col(c).alias(f"_{k}") for k, c in enumerate(names)),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        language_class(F.col(lang)).alias("class"),
    )
    held = [f"_{k}" for k in range(len(names))]
    counts = stage(gram_counts(plain.select(F.col("class").alias("lang"), "text")), "grams")
    fitted = stage(model(counts), "model")
    numbers = stage(score(plain.select("class", "text"), fitted, []), "scores")
    limits = bands(numbers)  # a row a language class
    scored = score(plain, fitted, held).join(F.broadcast(limits), "class", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    width = F.col("width") / _root()
    lower, upper = F.col("middle") - LOWER_WIDTHS * width, F.col("middle") + UPPER_WIDTHS * width
    inside = F.coalesce(F.col("log_prob").between(lower, upper), F.lit(True))
    return scored.select(
        *(F.col(h).alias(c) for h, c in zip(held, names, strict=True)),
        *STATS,
        failed.alias("base_failed"),
        "log_prob",
        lower.alias("lower"),
        upper.alias("upper"),
        (~failed & inside).alias("kept"),
    )
