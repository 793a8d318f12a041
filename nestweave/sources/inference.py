"""Schemas of JSON documents that can be merged, so that no document is read for them twice.

A schema is learned from parsed documents (VARIANT) by one aggregate. What is learned of each
batch of files is stored; stored schemas merge to what all files together would have given.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestweave.sources.documents import NO_INPUT, parsed_documents, raw_documents

#: Integers of more digits than a long has.
LONG_DIGITS = 19


def learned(documents: DataFrame, document: str = "document") -> T.DataType:
    """The schema of a VARIANT column, with nulls and conflicts as such."""
    found = documents.agg(F.schema_of_variant_agg(document)).first()[0]
    return as_type(found or "VOID")


def as_type(text: str) -> T.DataType:
    """The type that a variant schema's text names."""
    return T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))


def merged(one: T.DataType, two: T.DataType) -> T.DataType:
    """A type for values of either: fields of both, a double for any two numbers, null gives way;
    what does not go together is a VARIANT."""
    if isinstance(one, T.NullType) or one == two:
        return two
    if isinstance(two, T.NullType):
        return one
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        fields = {f.name: f.dataType for f in one.fields}
        for field in two.fields:
            fields[field.name] = merged(fields.get(field.name, T.NullType()), field.dataType)
        return T.StructType([T.StructField(name, fields[name]) for name in sorted(fields)])
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        return T.ArrayType(merged(one.elementType, two.elementType))
    if isinstance(one, T.NumericType) and isinstance(two, T.NumericType):
        whole = [t for t in (_number(one), _number(two)) if t != T.DoubleType()]
        return whole[0] if len(whole) == 2 and whole[0] == whole[1] else _wider(_number(one), _number(two))
    return T.VariantType()


def _number(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.DecimalType):
        return dtype if dtype.scale == 0 and dtype.precision > LONG_DIGITS else T.DoubleType()
    return T.LongType() if isinstance(dtype, T.IntegralType) else T.DoubleType()


def _wider(one: T.DataType, two: T.DataType) -> T.DataType:
    if T.DoubleType() in (one, two):
        return T.DoubleType()
    digits = [t.precision if isinstance(t, T.DecimalType) else LONG_DIGITS + 1 for t in (one, two)]
    return T.DecimalType(max(digits), 0)


def settled(dtype: T.DataType) -> T.DataType | None:
    """The type of a column: text for what has only nulls or conflicts; None for objects without fields."""
    if isinstance(dtype, T.StructType):
        kept = [T.StructField(f.name, kind) for f in dtype.fields if (kind := settled(f.dataType)) is not None]
        return T.StructType(sorted(kept, key=lambda f: f.name)) if kept else None
    if isinstance(dtype, T.ArrayType):
        element = settled(dtype.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(dtype, T.NumericType):
        return _number(dtype)
    return dtype if isinstance(dtype, (T.BooleanType, T.TimestampType, T.DateType)) else T.StringType()


def with_new_fields(known: T.DataType, found: T.DataType) -> T.DataType:
    """``known`` with the fields it lacks, at all depths; what it has keeps its type."""
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        own = {f.name: f for f in known.fields}
        of = {f.name: f.dataType for f in found.fields}
        kept = [T.StructField(f.name, with_new_fields(f.dataType, of.get(f.name, f.dataType))) for f in known.fields]
        new = [(name, settled(kind)) for name, kind in of.items() if name not in own]
        return T.StructType([*kept, *(T.StructField(n, kind) for n, kind in new if kind is not None)])
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(with_new_fields(known.elementType, found.elementType))
    return known


def learn(
    spark: SparkSession, raw: str, store: str, checkpoint: str, multiline: bool = True, max_files: int = 10_000
) -> T.StructType:
    """Learn from the files of ``raw`` not seen before, and give the schema of all seen so far.

    Each micro-batch of files becomes one row of ``store``, written again if the batch is repeated.
    """

    def remember(batch: DataFrame, number: int) -> None:
        kind = learned(parsed_documents(batch).where("document IS NOT NULL"))
        row = spark.createDataFrame([(kind.json(),)], "schema string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{store}/batch={number}")

    query = (
        raw_documents(spark.readStream.option("maxFilesPerTrigger", max_files), raw, multiline)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(remember)
        .start()
    )
    query.awaitTermination()
    return learned_schema(spark, store)


def learned_schema(spark: SparkSession, store: str) -> T.StructType:
    """The schema that all stored ones merge to; of nothing, one without fields."""
    try:
        rows = spark.read.schema("schema string").parquet(store).distinct().collect()
    except AnalysisException as error:
        if error.getCondition() not in NO_INPUT:
            raise
        return T.StructType([])
    kinds = [T._parse_datatype_json_string(r["schema"]) for r in rows]
    found = settled(reduce(merged, kinds, T.NullType()))
    return found if isinstance(found, T.StructType) else T.StructType([])

