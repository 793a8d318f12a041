"""Documents under a pinned schema, and what of them lies outside it.

A document is parsed once, to a VARIANT. The pinned fields are taken from it, each on its own: a value
of another type costs that field, not the document. Fields the schema does not have, and values that do not
fit, are reported with their document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestweave.functions.generators import elements


def typed(documents: DataFrame, schema: T.StructType, document: str = "document") -> DataFrame:
    """The fields of the schema from a VARIANT column, null where missing or of another type."""
    whole = F.try_variant_get(document, "$", _ddl(schema))
    return documents.select(whole.alias("fields")).select("fields.*")


def _ddl(dtype: T.DataType) -> str:
    """A type as text with all field names quoted."""
    if isinstance(dtype, T.StructType):
        fields = (f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in dtype.fields)
        return f"struct<{', '.join(fields)}>"
    if isinstance(dtype, T.ArrayType):
        return f"array<{_ddl(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"map<{_ddl(dtype.keyType)}, {_ddl(dtype.valueType)}>"
    return dtype.simpleString()


def unexpected(documents: DataFrame, schema: T.StructType, key: list[str], document: str = "document") -> DataFrame:
    """``(*key, path, kind, value)``: one row per value that the pinned fields do not hold.

    ``kind`` is ``unknown`` for a field outside the schema and ``mistyped`` for a value that cannot be read as
    its field's type; ``value`` is JSON text. ``path`` names fields by dots, elements of lists by ``[]``. Values
    of nested fields are reported at the innermost level the schema reaches.
    """
    start = documents.select(*key, F.col(document).alias("value"))
    return reduce(DataFrame.unionByName, _of_type(start, schema, "", key))


def _of_type(values: DataFrame, dtype: T.DataType, path: str, key: list[str]) -> list[DataFrame]:
    """Reports of ``(*key, value)`` rows that should have the type, one DataFrame a level."""
    there = values.where(F.col("value").isNotNull() & ~F.is_variant_null("value"))
    is_object = F.startswith(F.schema_of_variant("value"), F.lit("OBJECT"))
    if isinstance(dtype, T.StructType):
        own = "map_entries(try_variant_get(value, '$', 'map<string,variant>'))"
        entries = elements(there.where(is_object), key, F.expr(own), "at", "entry").select(
            *key, F.col("entry.key").alias("name"), F.col("entry.value").alias("value")
        )
        names = [f.name for f in dtype.fields]
        unknown = entries.where(~F.col("name").isin(names) if names else F.lit(True))
        prefix = F.lit(f"{path}." if path else "")
        out = [_report(there.where(~is_object), key, F.lit(path), "mistyped")] if path else []
        out.append(_report(unknown, key, F.concat(prefix, "name"), "unknown"))
        for field in dtype.fields:
            inner = f"{path}.{field.name}" if path else field.name
            out += _of_type(entries.where(F.col("name") == field.name).drop("name"), field.dataType, inner, key)
        return out
    if isinstance(dtype, T.ArrayType):
        is_list = F.startswith(F.schema_of_variant("value"), F.lit("ARRAY"))
        inside = elements(there.where(is_list), key, F.expr("try_variant_get(value, '$', 'array<variant>')"), "at", "element")
        inside = inside.select(*key, F.col("element").alias("value"))
        return [
            _report(there.where(~is_list), key, F.lit(path), "mistyped"),
            *_of_type(inside, dtype.elementType, f"{path}[]", key),
        ]
    if isinstance(dtype, T.VariantType):
        return [_report(values.limit(0), key, F.lit(path), "mistyped")]
    unread = F.try_variant_get("value", "$", _ddl(dtype)).isNull()
    return [_report(there.where(unread), key, F.lit(path), "mistyped")]


def _report(values: DataFrame, key: list[str], path: Column, kind: str) -> DataFrame:
    return values.select(*key, path.alias("path"), F.lit(kind).alias("kind"), F.to_json("value").alias("value"))
