"""Section streams of any document size: the chunker's folds over blocks of rows.

A stream ``(doc, seq, content, h1, h2, h3, pageNumber)`` has one row per section; ``seq``
is an integer, unique in its document. Both folds are sequential in a document, yet a
document may be any share of the stream, so no task may need all of one:

1. Rows are gathered per ``(doc, block)``, at most ``block_rows`` of them.
2. For documents of several blocks, each block's *effect* on the carried headings is
   computed without knowing what comes before it; ordered passes over these small records
   (:mod:`nestweave.operators.passes`) give every block the headings it starts with.
3. Every block runs the section fold from there. Groups that lie inside a block are done.
4. Groups that touch a block border are packed the same way: each piece's effect on the
   length of the open buffer, the same passes, then packing from a known buffer.

Documents of one block skip 2 and 4, their joins find nothing. The stream is read by
several of these steps, by most of them in a few columns only: pass a stored table, or a
staged one (:func:`nestweave.session.staged`), rather than a long computation.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nestweave.functions.generators import elements
from nestweave.functions.text import present
from nestweave.operators.folds import (
    CHUNK_MAX,
    CHUNK_OVERLAP,
    chunk_struct,
    fold_sections,
    heading_effect,
    let,
    pack_texts,
)
from nestweave.operators.headings import BLOCK_ROWS, with_block
from nestweave.operators.passes import BLOCKS_PER_RUN, states_before

HEADINGS = ("h1", "h2", "h3")


def block_summary(stream: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """What each block of a long document does to the carried headings.

    A carried heading is compared with the rows only until a row sets it, and the first
    row that has a heading of that level does. So all a block can ask of what it starts
    with is, per level: is it equal to the block's first heading of that level? That makes
    eight cases; ``outcomes`` holds the result of each, where ``u1`` to ``u3`` stand for
    "still what the block started with". It is null if the block has no headings.
    """
    document = F.struct("doc").alias("document")
    long_documents = stream.where(F.col("seq") >= block_rows).select(document).distinct()
    has_heading = F.coalesce(*[present(F.col(h)) for h in HEADINGS]).isNotNull()
    rows = (
        with_block(stream.select("doc", "seq", *HEADINGS), block_rows)
        .withColumn("document", document)
        .join(long_documents, "document", "left_semi")
        .groupBy("at")
        .agg(
            F.sort_array(
                F.collect_list(F.when(has_heading, F.struct("seq", *HEADINGS)))
            ).alias("rows")
        )
    )

    firsts = {
        f"first_{h}": F.expr(f"get(filter(rows.{h}, h -> h <> ''), 0)") for h in HEADINGS
    }

    def case(number: int) -> str:
        equal = [bool(number >> i & 1) for i in range(3)]
        values = [f"first_{h}" if e else "null" for h, e in zip(HEADINGS, equal)]
        unknown = [f"first_{h} IS NULL" if e else "true" for h, e in zip(HEADINGS, equal)]
        start = f"struct({', '.join([*values, *unknown])}, 0)"
        return heading_effect("rows", start)

    cases = ", ".join(case(number) for number in range(8))
    return rows.withColumns(firsts).select(
        "at.doc",
        "at.block",
        F.array(*firsts).alias("firsts"),
        F.expr(f"if(size(rows) = 0, null, array({cases}))").alias("outcomes"),
    )


def block_entries(
    stream: DataFrame, block_rows: int = BLOCK_ROWS, blocks_per_run: int = BLOCKS_PER_RUN
) -> DataFrame:
    """``(at, h1, h2, h3, changes)`` each block of a long document starts with."""
    equal, other = 1, 0

    def apply(state, record):
        """A level is a heading, or stands for what a run started with: a heading that is
        ``equal`` to the first one it will be compared with, or some ``other``."""
        if record["outcomes"] is None:
            return state
        case = sum(
            1 << i
            for i, first in enumerate(record["firsts"])
            if first is not None and state[i] in (first, equal)
        )
        result = record["outcomes"][case]
        levels = [state[i] if result[f"u{i + 1}"] else result[f"h{i + 1}"] for i in range(3)]
        return (*levels, state[3] + result["changes"])

    cases = [(*(equal if case >> i & 1 else other for i in range(3)), 0) for case in range(8)]

    def combine(total, record):
        firsts, states = total
        firsts = [a if a is not None else b for a, b in zip(firsts, record["firsts"])]
        return firsts, [apply(state, record) for state in states]

    def combined(total):
        firsts, states = total
        outcomes = []
        for *levels, changes in states:
            same = [level in (equal, other) for level in levels]
            known = [None if s else level for s, level in zip(same, levels)]
            names = ["h1", "h2", "h3", "u1", "u2", "u3", "changes"]
            outcomes.append(dict(zip(names, [*known, *same, changes])))
        return firsts, outcomes

    return states_before(
        block_summary(stream, block_rows),
        ["doc"],
        ["firsts", "outcomes"],
        StructType.fromDDL("h1 string, h2 string, h3 string, changes bigint"),
        first=(None, None, None, 0),
        apply=apply,
        identity=([None] * 3, cases),
        combine=combine,
        combined=combined,
        blocks_per_run=blocks_per_run,
    )


def _blocks(stream: DataFrame, block_rows: int) -> DataFrame:
    row = F.struct("seq", "content", *HEADINGS, "pageNumber")
    return (
        with_block(stream, block_rows)
        .groupBy("at")
        .agg(F.sort_array(F.collect_list(row)).alias("rows"))
    )


def _pieces(blocks: DataFrame, entries: DataFrame, how: str) -> DataFrame:
    """Groups as far as they lie in one block; ``border`` marks those that may go on."""
    start = "named_struct('h1', h1, 'h2', h2, 'h3', h3, 'changes', coalesce(changes, 0L))"
    groups = fold_sections("rows", start)
    border = "changes IS NOT NULL AND (i = 0 OR i = size(gs) - 1)"
    marked = let("gs", groups, f"transform(gs, (g, i) -> struct(g AS group, {border} AS border))")
    joined = blocks.join(entries, "at", how)
    return elements(joined, ["at"], F.expr(marked), "i", "piece").select("at.*", "piece.*")


def _inner_and_border(
    stream: DataFrame, block_rows: int, blocks_per_run: int
) -> tuple[DataFrame, DataFrame]:
    blocks = _blocks(stream, block_rows)
    entries = block_entries(stream, block_rows, blocks_per_run)
    inner = _pieces(blocks, entries, "left").where(~F.col("border"))
    border = _pieces(blocks, entries, "inner").where("border")
    return inner, border


def stream_groups(
    stream: DataFrame, block_rows: int = BLOCK_ROWS, blocks_per_run: int = BLOCKS_PER_RUN
) -> DataFrame:
    """``(doc, group, h1, h2, h3, pageStart, pageEnd, rows)`` of a section stream."""
    without_text = stream.withColumn("content", F.lit(""))
    inner, border = _inner_and_border(without_text, block_rows, blocks_per_run)

    def columns(pieces: DataFrame) -> DataFrame:
        return pieces.select(
            "doc",
            "block",
            F.col("group.no").alias("group"),
            *[f"group.{c}" for c in (*HEADINGS, "pageStart", "pageEnd", "rows")],
        )

    def at(page: str) -> Column:
        return F.when(F.col(page).isNotNull(), F.col("block"))

    joined = (
        columns(border)
        .groupBy("doc", "group", *HEADINGS)
        .agg(
            F.min_by("pageStart", at("pageStart")).alias("pageStart"),
            F.max_by("pageEnd", at("pageEnd")).alias("pageEnd"),
            F.sum("rows").alias("rows"),
        )
    )
    return columns(inner).drop("block").unionByName(joined)


def run_effect(lengths, max_length: int, overlap: int) -> list[int]:
    """What a run of texts does to the length of the open buffer, as triples ``(from, value, slope)``.

    From this length on, the length after the run is ``value``, or grows along with slope 1. A
    buffer is cut before the first text that no longer fits, found among the sums of lengths by bisection. Once
    cut at a text with the whole overlap kept, it goes on alike whatever it held, so that the
    cut after each cut is a table, and following it to its end is a matter of doubled jumps.
    """
    import numpy as np

    full = max(max_length, overlap)
    sums = np.concatenate(([0], np.cumsum(np.asarray(lengths, np.int64) + 1)))
    n, total = len(sums) - 1, int(sums[-1])
    each = np.arange(n)
    # the first later text at which a buffer cut before this one, now of length overlap + text, overflows
    after = np.maximum(np.searchsorted(sums, max_length - overlap + sums[:-1], side="right") - 1, each + 1)
    last = np.where(after < n, after, each)
    while not np.array_equal(last, last[last]):
        last = last[last]
    left = np.minimum(overlap + total - sums[last], full).tolist()
    sums = sums.tolist()

    pieces = []
    waiting = [(0, full, 0, 0)]  # lengths from and to at the start, length of the first before a text
    while waiting:
        start, end, value, at = waiting.pop()
        room = max_length + sums[at]  # a length overflows at text j if it is above room - sums[j + 1]
        cut = start + max(room - total - value + 1, 0) if at < n else end + 1
        if cut > start:
            pieces.append((start, min(value + total - sums[at], full), 1))
        while cut <= end:
            length = value + cut - start
            j = max(bisect_right(sums, room - length) - 1, at)
            stop = end if j == at else min(end, start + room - sums[j] - value)
            held = length + sums[j] - sums[at]
            if held < overlap:
                short = min(stop, cut + overlap - held - 1)
                waiting.append((cut, short, held + sums[j + 1] - sums[j], j + 1))
                cut = short + 1
            if cut <= stop:
                pieces.append((cut, left[j], 0))
            cut = stop + 1
    out = []
    for start, value, slope in sorted(pieces):
        slope = slope if value < full else 0
        if not (out and slope == 0 and out[-2:] == [value, 0]):
            out += [start, value, slope]
    return out


def buffer_effect(max_length: int, overlap: int):
    """A Pandas UDF: :func:`run_effect` of arrays of lengths."""

    def effect(series):
        import pandas as pd

        return pd.Series([run_effect(lengths, max_length, overlap) for lengths in series])

    return F.pandas_udf(effect, "array<int>")


def value_at(effect: list[int], starts: list[int], size: int, full: int) -> int:
    """An effect at a length, found by bisection of where its pieces start."""
    piece = 3 * (bisect_right(starts, size) - 1)
    start, value, slope = effect[piece : piece + 3]
    return min(value + slope * (size - start), full)


def composed(first: list[int], second: list[int], full: int) -> list[int]:
    """The second effect on the values of the first: on a constant it is a constant, on
    a slope it is its own pieces as far as the slope goes. Equal neighbours become one piece."""
    starts, inner = [*first[0::3], full + 1], second[0::3]
    out: list[int] = []

    def add(start, value, slope):
        slope = slope if value < full else 0
        if not (out and slope == 0 and out[-2:] == [value, 0]):
            out.extend((start, value, slope))

    for i, (value, slope) in enumerate(zip(first[1::3], first[2::3])):
        start, end = starts[i], starts[i + 1] - 1
        at = bisect_right(inner, min(value, full)) - 1
        add(start, value_at(second, inner, min(value, full), full), slope * second[3 * at + 2])
        if slope:
            for k in range(at + 1, bisect_right(inner, min(value + end - start, full))):
                add(start + inner[k] - value, *second[3 * k + 1 : 3 * k + 3])
    return out


def _open_buffers(
    records: DataFrame, max_length: int, overlap: int, blocks_per_run: int
) -> DataFrame:
    """``(at, size, text)``: the open buffer before each piece, its length and its text.

    ``text`` may reach back further than the buffer; ``size`` counts up to "full".
    """
    full = max(max_length, overlap)

    def apply(state, record):
        size, text = state
        starts = record["effect"][0::3]
        return value_at(record["effect"], starts, size, full), (text + record["tail"])[-full:]

    def combine(total, record):
        return composed(total[0], record["effect"], full), (total[1] + record["tail"])[-full:]

    return states_before(
        records,
        ["doc", "no"],
        ["effect", "tail"],
        StructType.fromDDL("size int, text string"),
        first=(0, ""),
        apply=apply,
        identity=([0, 0, 1], ""),
        combine=combine,
        combined=lambda total: total,
        blocks_per_run=blocks_per_run,
    )


def _buffers(
    border: DataFrame, max_length: int, overlap: int, blocks_per_run: int
) -> DataFrame:
    """What each border piece starts with, and the last block and pages of its group."""
    texts = F.col("group.texts")
    full = max(max_length, overlap)
    pieces = border.select(
        "doc",
        F.col("group.no").alias("no"),
        "block",
        F.col("group.pageStart").alias("pageStart"),
        F.col("group.pageEnd").alias("pageEnd"),
        F.right(F.concat(F.array_join(texts, "\n"), F.lit("\n")), F.lit(full)).alias("tail"),
        F.transform(texts, F.length).alias("lengths"),
    )

    def at(page: str) -> Column:
        return F.when(F.col(page).isNotNull(), F.col("block"))

    document_group = F.struct("doc", "no").alias("document_group")
    groups = pieces.groupBy(document_group).agg(
        F.min_by("pageStart", at("pageStart")).alias("pageStart"),
        F.max_by("pageEnd", at("pageEnd")).alias("pageEnd"),
        F.max("block").alias("last_block"),
    )
    records = pieces.select(
        "doc", "no", "block", "tail", buffer_effect(max_length, overlap)("lengths").alias("effect")
    )
    flushed = F.col("size") >= max_length
    kept = F.when(flushed, F.least("size", F.lit(overlap))).otherwise(F.col("size"))
    return (
        _open_buffers(records, max_length, overlap, blocks_per_run)
        .select(
            "at",
            F.struct("at.doc", "at.no").alias("document_group"),
            F.right("text", kept).alias("buffer"),
            flushed.alias("flushed"),
        )
        .join(groups, "document_group")
        .select(
            "at",
            "buffer",
            "flushed",
            (F.col("at.block") == F.col("last_block")).alias("last"),
            "pageStart",
            "pageEnd",
        )
    )


def _border_chunks(
    border: DataFrame, max_length: int, overlap: int, blocks_per_run: int
) -> DataFrame:
    """Chunks of the pieces at block borders, each packed from the buffer it starts with.

    A buffer that is full at the end of a piece is a finished chunk whatever follows; the
    piece emits it, and the next one starts after its last characters.
    """
    key = F.struct("doc", F.col("group.no").alias("no"), "block").alias("at")
    buffers = _buffers(border, max_length, overlap, blocks_per_run)
    pieces = border.select(key, "group").join(buffers, "at")
    # The buffer, with the first text after it if it was flushed, is in the buffer already.
    start = "if(flushed, concat(buffer, get(group.texts, 0)), left(buffer, length(buffer) - 1))"
    rest = "if(flushed, slice(group.texts, 2, size(group.texts)), group.texts)"
    opened = "if(flushed OR buffer <> '', 1, 0)"
    texts = F.expr(f"if({opened} = 1, concat(array({start}), {rest}), group.texts)")
    out = F.expr(
        pack_texts("texts", max_length, overlap, open_texts=opened, ends="last")
    )
    with_pages = F.col("group").withField("pageStart", F.col("pageStart")).withField(
        "pageEnd", F.col("pageEnd")
    )
    packed = pieces.withColumn("texts", texts).select(
        "at.doc", "at.block", with_pages.alias("group"), out.alias("out")
    )
    return elements(packed, ["doc", "block", "group"], "out", "part", "content")


def stream_chunks(
    stream: DataFrame,
    max_length: int = CHUNK_MAX,
    overlap: int = CHUNK_OVERLAP,
    drop_empty: bool = False,
    block_rows: int = BLOCK_ROWS,
    blocks_per_run: int = BLOCKS_PER_RUN,
) -> DataFrame:
    """Chunks of a section stream, footers already dropped.

    ``(doc, group, block, part)`` orders the chunks of a document.
    """
    inner, border = _inner_and_border(stream, block_rows, blocks_per_run)
    packed = F.expr(pack_texts("group.texts", max_length, overlap))
    whole = elements(inner, ["doc", "block", "group"], packed, "part", "content")
    chunks = whole.unionByName(_border_chunks(border, max_length, overlap, blocks_per_run))
    if drop_empty:
        chunks = chunks.where("content != ''")
    return chunks.select(
        "doc",
        F.col("group.no").alias("group"),
        "block",
        "part",
        chunk_struct(F.col("content"), F.col("group")).alias("c"),
    ).select("doc", "group", "block", "part", "c.*")
