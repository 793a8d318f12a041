"""Field names: cleaning, wrapping and collisions. Driver-side metadata only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

# Characters dropped from raw field names, and from table column names.
FIELD_NAME_DROPS = " :?(),/.!"
COLUMN_NAME_DROPS = " :?-()/"
FIELD_NAME_LIMIT = 128


def without(name: str, characters: str) -> str:
    return name.translate({ord(c): None for c in characters})


def distinct_names(names: Iterable[str], limit: int | None = None) -> list[str]:
    """Suffix ``_2``, ``_3``, ... on names already used, ignoring case.

    Where two fields end up with one name a table could not be written, so the later one
    is renamed; names that are free are kept, whatever came before them.
    """
    names = list(names)
    free = {n.lower() for n in names}
    used: set[str] = set()
    out = []
    for name in names:
        candidate, n = name, 1
        while candidate.lower() in used or (n > 1 and candidate.lower() in free):
            n += 1
            suffix = f"_{n}"
            candidate = (name if limit is None else name[: limit - len(suffix)]) + suffix
        used.add(candidate.lower())
        out.append(candidate)
    return out


def sanitise_schema(schema: StructType) -> StructType:
    """The schema with cleaned field names at every struct level.

    Goes into structs, arrays of structs and map values (of any type, not only structs);
    arrays of arrays are left as they are.
    """
    names = distinct_names(
        (without(f.name, FIELD_NAME_DROPS)[:FIELD_NAME_LIMIT] for f in schema.fields),
        FIELD_NAME_LIMIT,
    )
    return StructType(
        [
            StructField(name, _sanitise_type(f.dataType), f.nullable)
            for name, f in zip(names, schema.fields)
        ]
    )


def _sanitise_type(dtype: DataType) -> DataType:
    if isinstance(dtype, StructType):
        return sanitise_schema(dtype)
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType):
        return ArrayType(sanitise_schema(dtype.elementType))
    if isinstance(dtype, MapType):
        return MapType(dtype.keyType, _sanitise_type(dtype.valueType))
    return dtype


def sanitise(df: DataFrame) -> DataFrame:
    """Re-type rows under the cleaned schema: a positional cast, values untouched."""
    target = sanitise_schema(df.schema)
    positions = df.toDF(*[f"c{i}" for i in range(len(target))])
    return positions.select(
        *[F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(target)]
    )


def column_names(names: Iterable[str]) -> list[str]:
    """Names as they appear in the tables: cleaned and wrapped as ``__name__``."""
    return [f"__{n}__" for n in distinct_names(without(n, COLUMN_NAME_DROPS) for n in names)]


def rename_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*column_names(df.columns))
