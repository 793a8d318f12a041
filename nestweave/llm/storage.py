"""Tables between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from nestweave.session import scratch_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` in the shared folder and read it back.

    Cuts the lineage: later steps read files that every executor sees, so that a lost executor
    costs a read and not the work before it, and rows keep their values on a retry.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        for name in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
