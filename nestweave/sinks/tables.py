"""Writing tables, the registry, statements, fetched objects and responses."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nestweave.operators.drift import registry_records
from nestweave.session import scratch_dir, staged, store_uri


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Each table to its own Parquet folder under ``root``."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{root}/{name}")


def write_registry(registered: DataFrame, new: DataFrame, root: str) -> None:
    """Replace the registry of tables with new columns; the others are not touched.

    A table's columns are one record in one file. The rows are staged first, since they
    come from the folder that is replaced.
    """
    changed = new.select("table").distinct()
    merged = (
        registered.join(changed, "table", "left_semi")
        .select("table", "name", "type")
        .unionByName(new.select("table", "name", "type"))
    )
    (
        staged(registry_records(merged), "registry")
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table")
        .json(root)
    )


def write_statements(feed: DataFrame, path: str) -> None:
    """All statements, a row each, in one file."""
    feed.coalesce(1).write.mode("overwrite").json(path)


LANDING_SCHEMA = "id string, status int, body string, error string, ok boolean, place long"


def _landed(fetched: DataFrame) -> DataFrame:
    ok = F.col("status").eqNullSafe(200).alias("ok")
    # tells apart objects of one id in one batch; fixed once written
    place = F.monotonically_increasing_id().alias("place")
    error = F.col("error") if "error" in fetched.columns else F.lit(None).cast("string").alias("error")
    return fetched.select("id", "status", "body", error, ok, place)


def land(fetched: DataFrame, root: str, batch: int) -> None:
    """Write fetched objects once, as the folder ``batch=<n>`` of one table.

    Good and failed calls come out of the same pass, so nothing is fetched twice. A batch
    that is run again replaces all it wrote before, and no other.
    """
    _landed(fetched).write.mode("overwrite").parquet(f"{root}/batch={batch}")


def land_in_parts(
    pending: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    root: str,
    batch: int,
    parts: int,
    part_of: Column | None = None,
) -> None:
    """Fetch and land a batch in parts by id, so that an attempt goes on where the last one ended.

    ``fetch`` gives the fetched objects of some pending rows. The pending rows of the first attempt are
    kept beside the landing. A part is written whole or not at all, and each one there is left as it
    is: its objects are not fetched again. ``part_of`` tells a row's part, 0 to ``parts`` - 1, unless
    by a hash of its id.
    """
    spark = pending.sparkSession
    plan = f"{root}/_pending/batch={batch}"
    if not _is_there(spark, plan):
        by_hash = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(parts)).cast("int")
        pending.withColumn("part", by_hash if part_of is None else part_of).write.mode("overwrite").parquet(plan)
    planned = spark.read.parquet(plan)
    for part in range(parts):
        path = f"{root}/batch={batch}/part={part}"
        if not _is_there(spark, path):
            rows = planned.where(F.col("part") == part).drop("part")
            _landed(fetch(rows)).write.mode("overwrite").parquet(path)


def _is_there(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{LANDING_SCHEMA}, batch int").parquet(root)


def landed_ids(landing: DataFrame) -> DataFrame:
    """Ids with a good object; only the id column is read."""
    return landing.where("ok").select("id")


def landing_failures(landing: DataFrame) -> DataFrame:
    return landing.where(~F.col("ok")).select("id", "status", "error", "batch")


def latest_objects(landing: DataFrame) -> DataFrame:
    """The newest good body of each id, as if a later object had replaced an earlier one.

    Newest is the last batch and, within it, the last place (a batch landed without places counts
    as one place). Which one is newest is found without the bodies.
    """
    good = landing.where("ok")
    if "place" not in good.columns:
        good = good.withColumn("place", F.lit(0).cast("long"))
    good = good.withColumn("place", F.coalesce("place", F.lit(0).cast("long")))
    newest = good.groupBy("id").agg(F.max(F.struct("batch", "place")).alias("last"))
    last = newest.select("id", "last.batch", "last.place")
    return good.join(last, ["id", "batch", "place"], "left_semi").select("id", "body")


def parse_objects(
    objects: DataFrame, schema: StructType | str | None = None
) -> DataFrame:
    """Nested documents from ``body``.

    Without ``schema`` it is inferred from all bodies, written as lines of text for that pass, so
    that no field is missed. Give the schema where it is known.
    """
    if schema is None:
        spark = objects.sparkSession
        path = scratch_dir(spark, "bodies")
        lines = F.translate("body", "\r\n", "  ")  # white space between JSON tokens
        objects.where("body is not null").select(lines).write.text(path)
        schema = spark.read.json(path).schema
    return objects.select(F.from_json("body", schema).alias("doc")).select("doc.*")


def write_objects(objects: DataFrame, root: str, path: str = "path", value: str = "value") -> None:
    """One file per distinct path below ``root``, of a line per row, null as an empty one.

    Tasks write the files through the store that the scheme of ``root`` names, each under a hidden name until it
    is whole, so that nothing is left to do per file in the driver and a task that is repeated replaces its own.
    """
    root = store_uri(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        store, base = FileSystem.from_uri(root)
        base = base.rstrip("/")
        rows = ((p.as_py(), v.as_py()) for batch in batches for p, v in zip(*batch.columns, strict=True))
        last = None
        for name, lines in groupby(rows, itemgetter(0)):
            folder, _, file = f"{base}/{name}".rpartition("/")
            if folder != last:
                store.create_dir(folder)
                last = folder
            hidden = f"{folder}/.{file}.{uuid.uuid4().hex}"
            with store.open_output_stream(hidden) as out:
                for _, line in lines:
                    out.write((line or b"") + b"\n")
            store.move(hidden, f"{folder}/{file}")
        yield from ()

    tasks = int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = objects.select(F.col(path).alias("path"), F.col(value).cast("binary").alias("value"))
    dealt = placed.repartition(tasks, "path").sortWithinPartitions("path")
    dealt.mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()


def write_responses(responses: DataFrame, path: str) -> None:
    """Response records as JSON text, a line per request."""
    responses.select("response").write.mode("overwrite").text(path)
