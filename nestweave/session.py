"""Session helpers: where intermediate tables may be written."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting falls back to its warehouse folder; on a
    cluster the setting is asked for.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/nestweave/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows spread over all cores, by key or evenly, if a scan has fewer files or splits than that.

    For expressions that cost far more than a shuffle of their input. Splits alone do not tell: a file
    of one row group has all its rows in one of them. A scan of enough files is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(len(df.inputFiles()), df.rdd.getNumPartitions())
    return df if parts >= cores else df.repartition(cores, *keys)


def store_uri(path: str) -> str:
    """A path with its scheme, for readers and writers inside tasks."""
    if "://" in path:
        return path
    return f"file://{os.path.abspath(path.removeprefix('file:'))}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, so that several tables taken from ``df`` do not repeat its work and
    a lost executor costs a re-read, not a re-computation.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
