"""Spark types as the SQL type names used in generated statements."""

from __future__ import annotations

from pyspark.sql.types import DataType, DateType, DoubleType, IntegerType

# Every type not listed is stored as text.
SQL_TYPES = {IntegerType: "INT", DateType: "DATETIME", DoubleType: "FLOAT"}
SQL_TEXT = "NVARCHAR(MAX)"


def sql_type(dtype: DataType, child: bool = False, child_double_as_text: bool = True) -> str:
    """SQL type name; child tables store doubles as text unless told otherwise."""
    if child and child_double_as_text and isinstance(dtype, DoubleType):
        return SQL_TEXT
    return SQL_TYPES.get(type(dtype), SQL_TEXT)
