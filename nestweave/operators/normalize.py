"""Split nested documents into a base table and one child table per array-bearing field."""

from __future__ import annotations

from pyspark.sql import DataFrame

from nestweave.entities import Entity
from nestweave.functions.naming import rename_columns, sanitise
from nestweave.operators.flatten import array_free_fields, array_parents, flatten, quoted


def base_table(df: DataFrame, map_outer: bool = False) -> DataFrame | None:
    """All fields without arrays, flattened: one row per document. None if there are none."""
    fields = array_free_fields(df.schema)
    if not fields:
        return None
    return rename_columns(flatten(df.select(*map(quoted, fields)), map_outer))


def child_table(
    df: DataFrame, field: str, key: str = "id", map_outer: bool = False
) -> DataFrame:
    """One array-bearing field with the document key, flattened."""
    return rename_columns(flatten(df.select(quoted(key), quoted(field)), map_outer))


def normalize(
    df: DataFrame, entity: Entity, key: str = "id", map_outer: bool = False
) -> dict[str, DataFrame]:
    """All tables of a document set by table name, each planned lazily.

    Every table reads only its own fields of ``df``. Where ``df`` is JSON text, pass a
    staged copy (:func:`nestweave.session.staged`): it is then parsed once, not per table.
    """
    if entity.sanitise_names:
        df = sanitise(df)
    tables = {}
    base = base_table(df, map_outer)
    if base is not None:
        tables[entity.base_table] = base
    for field in array_parents(df.schema):
        tables[entity.child_table(field)] = child_table(df, field, key, map_outer)
    return tables


def join_children(base: DataFrame, child: DataFrame, key: str = "__id__") -> DataFrame:
    """Base rows with their child rows; documents without children stay.

    Written as an inner join plus the childless rows. A document with very many children
    is then split over tasks at run time, which an outer join does not allow on that side.
    """
    matched = base.join(child, key)
    childless = base.join(child.select(key).distinct(), key, "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)
