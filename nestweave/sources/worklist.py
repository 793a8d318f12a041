"""Ids to fetch, and ids already landed."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.entities import Entity

#: Paths that a task hands on at a time.
PATHS = 10_000
#: Bytes of files that a task hands on at a time, or one file.
READ_BYTES = 4 << 20


def read_worklist(spark: SparkSession, path: str | list[str], entity: Entity) -> DataFrame:
    """The ``id`` column of a worklist; records without one are dropped.

    The schema is fixed, so files that lack the column simply give no ids.
    """
    ids = spark.read.schema(f"`{entity.id_column}` string").json(path)
    return ids.select(F.col(entity.id_column).alias("id")).where("id is not null")


def landed_file_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of a folder that holds one file per id, named by it. File content is not read.

    Listing files costs the driver memory per file; for large stores use :func:`listed_ids` or the
    landing table.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.col("_metadata.file_name").alias("id"))


def list_prefix(prefix: str) -> Iterator[str]:
    """Paths of all files below a prefix, through the store that its scheme names."""
    from pyarrow.fs import FileSelector, FileSystem, FileType

    store, root = FileSystem.from_uri(prefix)
    folders = [root]
    while folders:
        for found in store.get_file_info(FileSelector(folders.pop(), allow_not_found=True)):
            if found.type == FileType.Directory:
                folders.append(found.path)
            else:
                yield found.path


def listed_ids(
    prefixes: DataFrame, pattern: str = "([^/]+)$", listing: Callable[[str], Iterable[str]] = list_prefix
) -> DataFrame:
    """Ids of the files below prefixes (column ``prefix``), taken from their paths by a pattern.

    The tasks list, each its share of the prefixes, and hand paths on as they find them: no list is
    held anywhere, on the driver least. ``listing`` gives the paths below a prefix, folder by
    folder. Hidden files are left out, files that do not match have no id; an id comes once.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            for prefix in batch["prefix"]:
                paths = iter(listing(prefix))
                while some := list(islice(paths, PATHS)):
                    yield pd.DataFrame({"path": some})

    found = _dealt(prefixes).mapInPandas(run, "path string")
    named = found.where(~F.col("path").rlike(r"/[._][^/]*$"))
    return named.select(F.regexp_extract("path", pattern, 1).alias("id")).where("id <> ''").distinct()


def listed_texts(prefixes: DataFrame, listing: Callable[[str], Iterable[str]] = list_prefix) -> DataFrame:
    """``(file, text)`` of the files below prefixes (column ``prefix``), as UTF-8; hidden files are left out.

    The tasks list and read, each its share of the prefixes, and hand files on as they read them. The driver
    holds no list of files, and tasks do not get more numerous with them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        def batch_of(files: list[str], texts: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(texts, pa.binary())], ["file", "text"])

        for batch in batches:
            for prefix in batch.column("prefix").to_pylist():
                store, _ = FileSystem.from_uri(prefix)
                files, texts, size = [], [], 0
                for path in listing(prefix):
                    if path.rpartition("/")[2].startswith((".", "_")):
                        continue
                    with store.open_input_stream(path) as file:
                        texts.append(file.read())
                    files.append(path)
                    size += len(texts[-1])
                    if size >= READ_BYTES or len(files) >= PATHS:
                        yield batch_of(files, texts)
                        files, texts, size = [], [], 0
                if files:
                    yield batch_of(files, texts)

    found = _dealt(prefixes).mapInArrow(run, "file string, text binary")
    return found.select("file", F.col("text").cast("string").alias("text"))


def _dealt(prefixes: DataFrame) -> DataFrame:
    tasks = int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return prefixes.select("prefix").where("prefix IS NOT NULL").repartition(tasks)
