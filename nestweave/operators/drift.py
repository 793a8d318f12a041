"""Compare tables with the registry and state what is new.

Everything here is metadata: a row per column of a table, whatever the size of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.entities import Entity
from nestweave.functions.sqltypes import sql_type
from nestweave.sources.registry import REGISTRY_SCHEMA


def table_columns(
    spark: SparkSession, tables: dict[str, DataFrame], entity: Entity
) -> DataFrame:
    """``(table, name, type)`` of every column, from the schemas alone."""
    rows = [
        (
            table,
            field.name,
            sql_type(field.dataType, table != entity.base_table, entity.child_double_as_text),
        )
        for table, df in tables.items()
        for field in df.schema.fields
    ]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def new_columns(current: DataFrame, registered: DataFrame) -> DataFrame:
    """Columns not registered with this name and type; dropped columns are ignored.

    ``kind`` tells a new name (``new``) from a known name with another type
    (``type_change``), for which an ADD statement will need a person's eye.
    """
    known = registered.select("table", "name").distinct().withColumn("known", F.lit(True))
    return (
        current.distinct()
        .join(registered, ["table", "name", "type"], "left_anti")
        .join(known, ["table", "name"], "left")
        .select(
            "table",
            "name",
            "type",
            F.when(F.col("known"), "type_change").otherwise("new").alias("kind"),
        )
    )


def _sorted_columns() -> Column:
    return F.sort_array(F.collect_list(F.struct("name", "type")))


def merged_registry(registered: DataFrame, new: DataFrame) -> DataFrame:
    """Registered plus new columns."""
    return registered.select("table", "name", "type").unionByName(new.select("table", "name", "type"))


def registry_records(registry: DataFrame) -> DataFrame:
    """``(table, columns)``: the columns of a table as one JSON list."""
    return registry.groupBy("table").agg(F.to_json(_sorted_columns()).alias("columns"))


def alter_statements(new: DataFrame, entity: Entity) -> DataFrame:
    """One ALTER per table with new columns, sorted by name and type."""
    parts = F.transform(
        _sorted_columns(), lambda c: F.format_string(entity.column_format, c["name"], c["type"])
    )
    statement = F.concat(
        F.lit("ALTER TABLE "), F.col("table"), F.lit(" ADD "), F.array_join(parts, ", "), F.lit(";")
    )
    return new.groupBy("table").agg(statement.alias("statement"))


def ddl_feed(new: DataFrame, entity: Entity) -> DataFrame:
    """The ALTER statements, or one harmless SELECT if no table has changed."""
    statements = alter_statements(new, entity)
    idle = (
        new.agg(F.count("*").alias("changes"))
        .where("changes = 0")
        .select(
            F.lit(entity.noop_table).alias("table"), F.lit(entity.noop_statement).alias("statement")
        )
    )
    return statements.unionByName(idle)
