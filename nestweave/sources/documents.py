"""Nested JSON documents and document layouts as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from nestweave.functions.generators import elements
from nestweave.session import staged
from nestweave.sources.worklist import listed_texts

LAYOUT_SCHEMA = """
analyzeResult struct<
  markdown: struct<sections: array<struct<
    content: string,
    sections: struct<h1: string, h2: string, h3: string>,
    pageNumber: int,
    boundingPolygons: variant>>>,
  pages: array<struct<
    pageNumber: int,
    blocks: array<struct<category: string, content: string, boundingPolygons: variant>>>>>
"""

# Messages for a layout that is not valid JSON, and for one that is not there.
UNREADABLE = "layout result is not valid JSON"
NO_LAYOUT = "no layout result"
_LAYOUT_TYPE = LAYOUT_SCHEMA.replace("\n", " ").strip().removeprefix("analyzeResult ")
NO_INPUT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_documents(
    spark: SparkSession,
    path: str | list[str] | DataFrame,
    schema: StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """JSON documents of a folder, one per file, or one per line with ``multiline=False``.

    A file is read by one task, so prefer JSON lines for large inputs. Without ``schema``
    Spark reads all of the input once more to infer it, so that no field is missed.

    A DataFrame of prefixes (column ``prefix``) as ``path``, with a schema, is listed and read by tasks:
    for more files than the driver should list (UTF-8, one document per file).
    """
    if isinstance(path, DataFrame):
        if schema is None:
            raise ValueError("documents below prefixes need a schema")
        return _documents_of(raw_documents(spark.read, path, multiline), schema)
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def _documents_of(raw: DataFrame, schema: StructType | str) -> DataFrame:
    """Documents from their texts, as the reader has them: a list holds one per element, unreadable ones are null."""
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    one = F.from_json("text", ddl)
    several = F.coalesce(F.from_json("text", f"array<struct<{ddl}>>"), F.array(F.lit(None)))
    is_list = F.col("text").rlike(r"\A\s*\[")
    found = raw.select(F.when(is_list, several).otherwise(F.array(one)).alias("documents"))
    return elements(found, [], "documents", "at", "document").select("document.*")


def read_documents_if_any(
    spark: SparkSession, path: str, schema: StructType | str, multiline: bool = True
) -> DataFrame:
    """Like :func:`read_documents`; an empty or missing folder gives no rows."""
    try:
        return read_documents(spark, path, schema, multiline)
    except AnalysisException as error:
        if error.getCondition() not in NO_INPUT:
            raise
        return spark.createDataFrame([], schema)


def documents_if_any(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame | None:
    """Like :func:`read_documents` with an inferred schema; None for an empty or missing folder."""
    try:
        return read_documents(spark, path, multiline=multiline)
    except AnalysisException as error:
        if error.getCondition() not in NO_INPUT:
            raise
        return None


def raw_documents(
    reader: DataFrameReader | DataStreamReader, path: str | list[str] | DataFrame, multiline: bool = True
) -> DataFrame:
    """``(file, text)``: a document's text per file, or per line with ``multiline=False``; blank lines are none.

    A DataFrame of prefixes as ``path`` is listed and read by tasks (:func:`nestweave.sources.worklist.listed_texts`).
    """
    if isinstance(path, DataFrame):
        if not multiline:
            raise ValueError("files below prefixes hold one document each")
        rows = listed_texts(path)
    else:
        rows = reader.text(path, wholetext=multiline)
        rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return rows.where(~F.col("text").rlike(r"\A\s*\z"))


def parsed_documents(raw: DataFrame) -> DataFrame:
    """``(file, text, document)`` with the text as VARIANT, null where it is not valid JSON.

    A text that is a list holds a document per element. The text is kept only where it could not be read.
    """
    parsed = raw.select("file", "text", F.try_parse_json("text").alias("parsed"))
    several = F.try_variant_get("parsed", "$", "array<variant>")
    is_list = F.startswith(F.schema_of_variant("parsed"), F.lit("ARRAY"))
    documents = F.when(F.coalesce(is_list, F.lit(False)), several).otherwise(F.array("parsed"))
    unread = F.when(F.col("parsed").isNull(), F.col("text")).alias("text")
    return elements(parsed.select("file", unread, documents.alias("documents")), ["file", "text"], "documents", "at", "document").drop("at")


def split_unreadable(
    spark: SparkSession, path: str | list[str], schema: StructType, multiline: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Documents under a schema, and ``(file, record)`` of those that are not valid JSON.

    A value of another type than its field's is null in its document, which stays
    (:func:`nestweave.sources.capture.unexpected` reports it). The input is parsed once, into a
    staged copy both results read.
    """
    from nestweave.sources.capture import typed

    rows = staged(parsed_documents(raw_documents(spark.read, path, multiline)), "parsed")
    readable = typed(rows.where("document IS NOT NULL"), schema)
    unreadable = rows.where("document IS NULL").select("file", F.col("text").alias("record"))
    return readable, unreadable


def read_layouts(
    spark: SparkSession, path: str | list[str] | DataFrame, multiline: bool = True
) -> DataFrame:
    """Layout results ``(doc, analyzeResult, error)``, keyed by file path.

    ``error`` tells those that are no valid JSON; a valid one without ``analyzeResult`` is an
    empty document. With one layout per line, use a key inside the record instead of ``doc``. A DataFrame of
    prefixes as ``path`` is listed and read by tasks, see :func:`raw_documents`.
    """
    raw = raw_documents(spark.read, path, multiline)
    return parse_layouts(raw, "file", "text")


def parse_layouts(df: DataFrame, doc: str, layout: str) -> DataFrame:
    """Layout results ``(doc, analyzeResult, error)`` held as JSON text in a column.

    The fields are fixed, so there is no inference pass, and each is read on its own: a page number given as
    text or with a fraction is a number, a value of another kind is null, and what is malformed
    inside a polygon stays there. Only text that is no JSON, or is null, is an error.
    """
    parsed = df.select(F.col(doc).alias("doc"), F.col(layout).alias("layout"), F.try_parse_json(layout).alias("parsed"))
    error = F.when(F.col("layout").isNull(), NO_LAYOUT).when(F.col("parsed").isNull(), UNREADABLE)
    result = F.try_variant_get("parsed", "$.analyzeResult", _LAYOUT_TYPE)
    return parsed.select("doc", result.alias("analyzeResult"), error.alias("error"))
