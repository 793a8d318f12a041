"""Registered queries: each runs an operator over whole tables, with SQL to check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.session import spread, store_uri

#: Folders that files of one document each are dealt over, and the name of a null key.
FILE_SHARDS = 256
NO_KEY = "__HIVE_DEFAULT_PARTITION__"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with equivalent SQL where there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sharded(key: str, shards: int) -> Column:
    """The folder of a key's shard: files of many keys below few prefixes."""
    return F.concat(F.lit("shard="), F.pmod(F.xxhash64(key), F.lit(shards)), F.lit("/"))


def shard_prefixes(spark: SparkSession, root: str, shards: int) -> DataFrame:
    return spark.range(shards).select(F.concat(F.lit(f"{store_uri(root)}/shard="), "id").alias("prefix"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Document keys and texts, over all cores: what follows is costly per character."""
    return spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
