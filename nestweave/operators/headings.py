"""Heading groups of a section stream by windows, for data with h1 headings only.

With one heading level the carried heading is simply the last one seen, so groups are gaps
and islands over windows. With h2 or h3 headings use :mod:`nestweave.operators.stream`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestweave.functions.text import present

BLOCK_ROWS = 4096


def with_block(stream: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the key ``at``: the document, and a run of at most ``block_rows`` positions in it.

    As a struct the key is never null, even if ``doc`` is, so joins on it lose nothing.
    """
    block = F.floor(F.col("seq") / block_rows).alias("block")
    return stream.withColumn("at", F.struct("doc", block))


def h1_groups(stream: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each row of ``(doc, seq, h1, ...)`` with its carried ``heading`` and ``group`` number.

    A window over a whole document would put the document into one task. Rows are windowed
    within blocks instead; what a block must know of the rows before it (last heading,
    number of changes) comes from a window over one summary row per block.
    """
    block = Window.partitionBy("at").orderBy("seq")
    up_to_here = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before_here = block.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        with_block(stream, block_rows)
        .withColumn("own", present(F.col("h1")))
        .withColumn("latest", F.last("own", True).over(up_to_here))
        .withColumn("previous", F.last("own", True).over(before_here))
    )

    at_heading = F.when(F.col("own").isNotNull(), F.col("seq"))
    blocks = rows.groupBy("at").agg(
        F.min_by("own", at_heading).alias("first_own"),
        F.max_by("own", at_heading).alias("last_own"),
        F.count_if(F.col("own") != F.col("previous")).alias("inner_changes"),
    )
    blocks = blocks.select("at.*", "first_own", "last_own", "inner_changes")
    earlier = (
        Window.partitionBy("doc")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    entries = (
        blocks.withColumn("entry", F.last("last_own", True).over(earlier))
        .withColumn(
            "block_changes",
            F.col("inner_changes")
            + (
                F.col("first_own").isNotNull()
                & ~F.col("first_own").eqNullSafe(F.col("entry"))
            ).cast("bigint"),
        )
        .select(
            F.struct("doc", "block").alias("at"),
            "entry",
            F.coalesce(F.sum("block_changes").over(earlier), F.lit(0)).alias("changes_before"),
        )
    )

    changed = F.col("own").isNotNull() & ~F.col("own").eqNullSafe(
        F.coalesce("previous", "entry")
    )
    return (
        rows.join(entries, "at")
        .withColumn("changed", changed)
        .withColumn("heading", F.coalesce("latest", "entry"))
        .withColumn(
            "group",
            F.col("changes_before") + F.sum(F.col("changed").cast("bigint")).over(up_to_here),
        )
        .drop("at", "own", "latest", "previous", "entry", "changes_before")
    )


def group_pages(rows: DataFrame) -> DataFrame:
    """Per group: rows, and the first and last page that is not null, in order.

    Plain aggregates with partial sums before the shuffle, so a large group is no problem.
    """
    at_page = F.when(F.col("pageNumber").isNotNull(), F.col("seq"))
    return rows.groupBy("doc", "group", "heading").agg(
        F.min_by("pageNumber", at_page).alias("pageStart"),
        F.max_by("pageNumber", at_page).alias("pageEnd"),
        F.count("*").alias("rows"),
    )
