"""Flatten nested columns by walking the schema.

The walk happens on the driver over ``df.schema``; data is only touched by the resulting
projections and generators, which are narrow. No shuffle is added at any depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from nestweave.functions.naming import distinct_names


def holds_array(dtype: DataType) -> bool:
    """An array, or an array at any depth of structs and map values."""
    if isinstance(dtype, ArrayType):
        return True
    if isinstance(dtype, StructType):
        return any(holds_array(f.dataType) for f in dtype.fields)
    if isinstance(dtype, MapType):
        return holds_array(dtype.valueType)
    return False


def array_parents(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if holds_array(f.dataType)]


def array_free_fields(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not holds_array(f.dataType)]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def expand_structs(df: DataFrame) -> DataFrame:
    """Replace struct columns, to any depth, by ``parent_field`` columns in one projection.

    Expanded columns come after the kept ones; a name already taken gets a suffix.
    """
    leaves = [(f.name, F.col(quoted(f.name)), f.dataType) for f in df.schema.fields]
    while any(isinstance(dtype, StructType) for _, _, dtype in leaves):
        at = next(i for i, leaf in enumerate(leaves) if isinstance(leaf[2], StructType))
        name, column, dtype = leaves.pop(at)
        fields = [(f"{name}_{f.name}", column.getField(f.name), f.dataType) for f in dtype]
        names = distinct_names([n for n, _, _ in leaves + fields])
        leaves = [(n, c, t) for n, (_, c, t) in zip(names, leaves + fields)]
    return df.select(*[column.alias(name) for name, column, _ in leaves])


def explode_array(df: DataFrame, name: str) -> DataFrame:
    """One row per element, in the array's place; empty and null arrays keep their row."""
    return df.select(
        *[
            F.explode_outer(quoted(c)).alias(c) if c == name else F.col(quoted(c))
            for c in df.columns
        ]
    )


def explode_map(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """One row per entry as ``name_key`` and ``name_value``; by default an empty or null
    map drops its row."""
    kept = [c for c in df.columns if c != name]
    *_, key, value = names = distinct_names([*kept, f"{name}_key", f"{name}_value"])
    entries = df.select(
        *[F.col(quoted(c)) for c in kept], F.explode_outer(quoted(name)).alias(key, value)
    ).toDF(*names)
    return entries if outer else entries.where(F.col(quoted(key)).isNotNull())


def explode_array_spread(df: DataFrame, name: str, rows: int) -> DataFrame:
    """:func:`explode_array`, with the elements of one row dealt out to all tasks, ``rows`` at a time.

    What a long array is multiplied with afterwards then has no single task to go through. This is a
    shuffle of one row per slice.
    """
    array = F.col(quoted(name))
    size = F.coalesce(F.size(array), F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(size, F.lit(1)), F.lit(rows))
    slices = F.when(size > rows, F.transform(starts, lambda k: F.slice(array, k, rows))).otherwise(F.array(array))
    pieces = df.select(*[slices.alias(c) if c == name else F.col(quoted(c)) for c in df.columns])
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return explode_array(explode_array(pieces, name).repartition(tasks), name)


def flatten(df: DataFrame, map_outer: bool = False, spread_rows: int | None = None) -> DataFrame:
    """Expand structs, arrays and maps until only plain columns are left.

    Several arrays in one row multiply, element by element. Dotted field names work. With ``spread_rows`` the
    first array of a document is dealt out over all tasks before the others multiply it,
    so that no task has to write a whole huge document.
    """
    while True:
        df = expand_structs(df)
        nested = next(
            (f for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType))), None
        )
        if nested is None:
            return df
        if isinstance(nested.dataType, MapType):
            df = explode_map(df, nested.name, map_outer)
        elif spread_rows:
            df = explode_array_spread(df, nested.name, spread_rows)
            spread_rows = None
        else:
            df = explode_array(df, nested.name)
