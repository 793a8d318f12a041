"""Incremental normalising: each landed document is handled once.

A micro-batch leaves, beside its tables, what the run knows after it: the schema and the registered columns
it added, each in a folder ``batch=<n>`` of its own. A batch that is repeated reads only what batches
before it left and replaces all it wrote, so that it comes to the same results.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_json_string

from nestweave.entities import Entity
from nestweave.operators.drift import ddl_feed, new_columns, table_columns
from nestweave.operators.normalize import normalize
from nestweave.session import staged
from nestweave.sources.capture import typed, unexpected
from nestweave.sources.documents import NO_INPUT, parsed_documents, raw_documents
from nestweave.sources.inference import learned, with_new_fields
from nestweave.sources.registry import REGISTRY_SCHEMA

#: Files of a micro-batch at most, unless the caller says otherwise.
MAX_FILES = 10_000
# Folders beside the tables: records that are no valid JSON, values that the fields do not hold,
# the schema after each batch, columns that it added, statements for them.
UNREADABLE = "_unreadable"
UNEXPECTED = "_unexpected"
SCHEMAS = "_schema"
REGISTRY = "_registry"
STATEMENTS = "_statements"


def _before(spark: SparkSession, path: str, schema: str, batch: int) -> DataFrame:
    """Rows that batches before this one left."""
    try:
        rows = spark.read.schema(f"{schema}, batch int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in NO_INPUT:
            raise
        return spark.createDataFrame([], f"{schema}, batch int")
    return rows.where(F.col("batch") < batch)


def schema_before(spark: SparkSession, root: str, batch: int, pinned: StructType) -> StructType:
    """The schema after the last batch before this one."""
    last = _before(spark, f"{root}/{SCHEMAS}", "schema string", batch).agg(F.max_by("schema", "batch")).first()[0]
    return pinned if last is None else _parse_datatype_json_string(last)


def append_batch(
    raw: DataFrame, batch: int, schema: StructType, entity: Entity, root: str, evolve: bool = True
) -> None:
    """Write one micro-batch of texts (file, text) to all tables, as their folder ``batch=<n>``.

    Texts that are no valid JSON go to a folder of their own, and values that the fields do not hold to
    another; their documents stay. With ``evolve``, fields not met before join the schema, with the type their
    values have; known fields keep theirs. Columns that no batch before had are registered and
    give ALTER statements, or one harmless SELECT where nothing is new.
    """
    spark = raw.sparkSession
    parsed = staged(parsed_documents(raw), f"batch-{batch}")

    def write(rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")

    write(parsed.where("document IS NULL").select("file", F.col("text").alias("record")), UNREADABLE)
    documents = parsed.where("document IS NOT NULL")
    fields = schema_before(spark, root, batch, schema)
    if evolve:
        fields = with_new_fields(fields, learned(documents))
    write(unexpected(documents, fields, ["file"]), UNEXPECTED)
    tables = normalize(typed(documents, fields), entity)
    for name, table in tables.items():
        write(table, name)
    registered = _before(spark, f"{root}/{REGISTRY}", REGISTRY_SCHEMA, batch).drop("batch")
    drift = staged(new_columns(table_columns(spark, tables, entity), registered), "drift")
    write(ddl_feed(drift, entity).coalesce(1), STATEMENTS)
    write(drift.select("table", "name", "type").coalesce(1), REGISTRY)
    write(spark.createDataFrame([(fields.json(),)], "schema string").coalesce(1), SCHEMAS)


def run_incremental(
    spark: SparkSession,
    raw: str,
    schema: StructType | str,
    entity: Entity,
    root: str,
    checkpoint: str,
    multiline: bool = True,
    max_files: int = MAX_FILES,
    evolve: bool = True,
) -> None:
    """Handle all files of ``raw`` not seen before, then stop.

    The checkpoint remembers which files are done. ``max_files`` bounds a micro-batch. Tables whose
    fields grew are read with Parquet's ``mergeSchema``.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    query = (
        raw_documents(reader, raw, multiline)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda rows, batch: append_batch(rows, batch, fields, entity, root, evolve))
        .start()
    )
    query.awaitTermination()
