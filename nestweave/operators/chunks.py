"""Documents held as one row each: sections to chunks without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestweave.functions.generators import elements
from nestweave.operators.folds import (
    CHUNK_MAX,
    CHUNK_OVERLAP,
    fold_sections,
    group_chunks,
    pack_texts,
)
from nestweave.operators.sections import FOOTER_Y_HIGH, FOOTER_Y_LOW, usable_sections


def document_groups(documents: DataFrame) -> DataFrame:
    """``(doc, no, h1, h2, h3, pageStart, pageEnd, rows, texts)`` from ``(doc, sections)``."""
    groups = F.expr(fold_sections("sections"))
    return elements(documents, ["doc"], groups, "position", "group").select("doc", "group.*")


def document_chunks(
    documents: DataFrame,
    max_length: int = CHUNK_MAX,
    overlap: int = CHUNK_OVERLAP,
    footer_high: float = FOOTER_Y_HIGH,
    footer_low: float = FOOTER_Y_LOW,
    drop_empty: bool = False,
) -> DataFrame:
    """``(doc, chunks)`` from ``(doc, sections)``: footers out, then both folds.

    The sections of a document are already one row, so all of this is one projection. A column
    ``error`` is kept.
    """
    kept = [c for c in ("doc", "error") if c in documents.columns]
    usable = usable_sections(F.col("sections"), footer_high, footer_low)
    return (
        documents.select(*kept, usable.alias("usable"))
        .select(*kept, F.expr(fold_sections("usable")).alias("groups"))
        .select(*kept, group_chunks("groups", max_length, overlap, drop_empty).alias("chunks"))
    )


def explode_chunks(documents: DataFrame) -> DataFrame:
    """A row per chunk, its position in the document as ``chunk``."""
    return elements(documents, ["doc"], "chunks", "chunk", "c").select("doc", "chunk", "c.*")


def document_texts(
    documents: DataFrame,
    max_length: int = CHUNK_MAX,
    overlap: int = CHUNK_OVERLAP,
    drop_empty: bool = False,
) -> DataFrame:
    """``(doc, chunk, content)`` from ``(doc, texts)``: packing alone, headings aside."""
    packed = F.expr(pack_texts("texts", max_length, overlap, drop_empty))
    return elements(documents, ["doc"], packed, "chunk", "content")
