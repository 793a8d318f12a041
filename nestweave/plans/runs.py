"""End-to-end runs: fetch and land, normalise with drift, chunk documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from nestweave.entities import Entity
from nestweave.functions.text import resource_url
from nestweave.operators.chunks import document_chunks
from nestweave.operators.drift import ddl_feed, new_columns, table_columns
from nestweave.operators.normalize import normalize
from nestweave.operators.sections import document_sections
from nestweave.operators.worklist import enrich, pending_ids
from nestweave.session import staged
from nestweave.sinks.tables import land, land_in_parts, write_registry, write_statements, write_tables
from nestweave.sources.documents import NO_INPUT, parse_layouts, read_layouts
from nestweave.sources.registry import read_registry
from nestweave.sources.worklist import read_worklist
from pyspark.sql import functions as F


def fetch_run(
    spark: SparkSession,
    entity: Entity,
    worklist: str,
    landed: DataFrame | None,
    landing: str,
    batch: int,
    base_url: str,
    fetch: Callable[[str], tuple[int, str | None]],
    parts: int | None = None,
) -> None:
    """Fetch what the worklist asks for and is not landed, and land it as one batch.

    With ``parts`` the batch lands in so many, and one that is run again after a failure goes on
    with the parts that are missing.
    """
    pending = pending_ids(read_worklist(spark, worklist, entity), landed, entity)
    url = resource_url(base_url, entity.name, F.col("id"), entity.query_option)
    pending = pending.withColumn("url", url)

    def fetched(rows: DataFrame) -> DataFrame:
        return enrich(rows, fetch, entity.parallelism, "url")

    if parts:
        land_in_parts(pending, fetched, landing, batch, parts)
    else:
        land(fetched(pending), landing, batch)


def normalize_run(
    documents: DataFrame | None, entity: Entity, root: str, registry_root: str, ddl_path: str
) -> dict[str, DataFrame]:
    """Write all tables of a document set, and what the registry has to say about them.

    Documents are parsed once, into a staged columnar copy each table then reads its own
    columns of. Drift needs schemas only. Where nothing landed (``documents`` is None, see
    :func:`nestweave.sources.documents.documents_if_any`) there is nothing to do: what earlier runs wrote stays.
    """
    if documents is None:
        return {}
    spark = documents.sparkSession
    tables = normalize(staged(documents, entity.name), entity)
    write_tables(tables, root)
    registered = read_registry(spark, registry_root)
    drift = new_columns(table_columns(spark, tables, entity), registered)
    write_statements(ddl_feed(drift, entity), ddl_path)
    write_registry(registered, drift, registry_root)
    return tables


def chunk_run(spark: SparkSession, layouts: str, out: str) -> None:
    """Layout results of a folder to a table ``(doc, chunks, error)``; an empty or missing folder
    gives an empty table."""
    try:
        results = read_layouts(spark, layouts)
    except AnalysisException as error:
        if error.getCondition() not in NO_INPUT:
            raise
        results = parse_layouts(spark.createDataFrame([], "doc string, layout string"), "doc", "layout")
    document_chunks(document_sections(results)).write.mode(
        "overwrite"
    ).parquet(out)
