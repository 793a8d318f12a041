"""Layout results to ordered sections, and the removal of page furniture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.functions.generators import elements
from nestweave.functions.geometry import centroid_y, centroid_y_of_json
from nestweave.functions.text import FOOTER_PHRASE, contains_phrase, is_blank_or_page_number

# Default page-margin bounds, and the category that marks a heading.
FOOTER_Y_HIGH = 0.85
FOOTER_Y_LOW = 0.05
HEADING_CATEGORY = "sectionHeading"


def _markdown_section(section: Column) -> Column:
    headings = section["sections"]
    return F.struct(
        F.coalesce(section["content"], F.lit("")).alias("content"),
        headings["h1"].alias("h1"),
        headings["h2"].alias("h2"),
        headings["h3"].alias("h3"),
        section["pageNumber"].alias("pageNumber"),
        section["boundingPolygons"].alias("polygons"),
    )


def _page_block(page: Column, block: Column) -> Column:
    content = F.coalesce(block["content"], F.lit(""))
    return F.struct(
        content.alias("content"),
        F.when(block["category"] == HEADING_CATEGORY, content).alias("h1"),
        F.lit(None).cast("string").alias("h2"),
        F.lit(None).cast("string").alias("h3"),
        page["pageNumber"].alias("pageNumber"),
        block["boundingPolygons"].alias("polygons"),
    )


def layout_sections(result: Column) -> Column:
    """The ordered section array of an ``analyzeResult``.

    ``markdown.sections`` is used if it is a list, even an empty one; else the blocks of
    all pages in order, where a block of the heading category is its own h1. Lists that
    are null count as missing.
    """
    markdown = result["markdown"]["sections"]
    blocks = F.flatten(
        F.transform(
            F.coalesce(result["pages"], F.array()),
            lambda page: F.transform(
                F.coalesce(page["blocks"], F.array()), lambda block: _page_block(page, block)
            ),
        )
    )
    return F.when(markdown.isNotNull(), F.transform(markdown, _markdown_section)).otherwise(blocks)


def document_sections(layouts: DataFrame) -> DataFrame:
    """``(doc, sections)`` from ``(doc, analyzeResult)``: one row per document, no shuffle.

    A column ``error`` is kept.
    """
    kept = [c for c in ("doc", "error") if c in layouts.columns]
    return layouts.select(*kept, layout_sections(F.col("analyzeResult")).alias("sections"))


def explode_sections(documents: DataFrame) -> DataFrame:
    """The section stream: one row per section, its position in the document as ``seq``."""
    return elements(documents, ["doc"], "sections", "seq", "section").select(
        "doc",
        F.col("seq").cast("bigint").alias("seq"),
        "section.content",
        "section.h1",
        "section.h2",
        "section.h3",
        "section.pageNumber",
        F.coalesce(F.to_json("section.polygons"), F.lit("[]")).alias("boundingPolygons"),
    )


def is_footer(
    content: Column,
    y: Column,
    high: float = FOOTER_Y_HIGH,
    low: float = FOOTER_Y_LOW,
    phrase: str = FOOTER_PHRASE,
) -> Column:
    """Blank, a bare page number, the footer phrase, or strictly outside the y bounds."""
    outside = F.get(F.transform(F.array(y), lambda v: (v > high) | (v < low)), F.lit(0))
    return is_blank_or_page_number(content) | contains_phrase(content, phrase) | outside


def drop_footers(
    stream: DataFrame,
    high: float = FOOTER_Y_HIGH,
    low: float = FOOTER_Y_LOW,
    phrase: str = FOOTER_PHRASE,
) -> DataFrame:
    """The section stream without page furniture. A heading on a dropped row is lost."""
    y = centroid_y_of_json(F.col("boundingPolygons"))
    return stream.where(~is_footer(F.col("content"), y, high, low, phrase))


def usable_sections(
    sections: Column,
    high: float = FOOTER_Y_HIGH,
    low: float = FOOTER_Y_LOW,
    phrase: str = FOOTER_PHRASE,
) -> Column:
    """The same filter inside a section array."""
    return F.filter(
        sections,
        lambda s: ~is_footer(s["content"], centroid_y(s["polygons"]), high, low, phrase),
    )
