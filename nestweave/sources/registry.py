"""The schema registry: which columns each table already has."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.sources.documents import NO_INPUT

REGISTRY_SCHEMA = "table string, name string, type string"
COLUMNS_TYPE = "array<struct<name:string,type:string>>"


def parse_registry(records: DataFrame) -> DataFrame:
    """``(table, name, type)`` rows from ``(table, columns)`` with a JSON list as text."""
    return records.select("table", F.inline(F.from_json("columns", COLUMNS_TYPE)))


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """All registered columns under ``root``; a missing registry is an empty one.

    Every record of every file counts. A folder per table is named ``table=<name>``.
    """
    try:
        records = spark.read.schema("columns string, table string").json(root)
    except AnalysisException as error:
        if error.getCondition() not in NO_INPUT:
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    return parse_registry(records)
