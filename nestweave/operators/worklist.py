"""What is still to fetch, fetching it, and sorting good results from bad."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestweave.entities import Entity

FETCHED_SCHEMA = "id string, status int, body string, error string"
#: Characters of bodies that a worker holds before it hands them on.
FRAME_SIZE = 16 << 20


def pending_ids(work: DataFrame, landed: DataFrame | None, entity: Entity) -> DataFrame:
    """Ids to fetch: all of them, or distinct ones not landed yet, by entity.

    Null ids are dropped. Distinct ids not landed are found by one aggregate over both
    lists, an anti join without the join: an id that repeats, in either list, shrinks to
    one row per task before the only shuffle. (As a join, the optimizer would move it below
    the ``distinct`` and shuffle every repetition.)
    """
    ids = work.select(F.col("id").cast("string").alias("id")).where("id is not null")
    if not entity.skip_landed or landed is None:
        return ids.distinct() if entity.deduplicate else ids
    known = landed.select(F.col("id").cast("string").alias("id"))
    if not entity.deduplicate:
        return ids.join(known.distinct(), "id", "left_anti")
    both = ids.withColumn("landed", F.lit(False)).unionByName(known.withColumn("landed", F.lit(True)))
    return both.groupBy("id").agg(F.bool_or("landed").alias("landed")).where(~F.col("landed")).select("id")


def enrich(
    work: DataFrame,
    fetch: Callable[[str], tuple[int, str | None]],
    parallelism: int,
    argument: str = "id",
    frame_size: int = FRAME_SIZE,
) -> DataFrame:
    """Call ``fetch(argument)`` for every row: ``(id, status, body, error)``.

    ``parallelism`` bounds the number of concurrent callers, for services that ask for it.
    Rows are dealt out evenly, whatever ids repeat. ``fetch`` must stand being called twice
    for one row, since a lost executor repeats its tasks. A call that raises gives a null
    status and says why in ``error``, and the others go on. Bodies are handed on once they come to
    ``frame_size`` characters, so that a worker holds little more, whatever their number.
    """

    def call(batches):
        import pandas as pd

        def frame(out):
            made = pd.DataFrame(out, columns=["id", "status", "body", "error"])
            return made.astype({"status": "Int32"})

        for batch in batches:
            out, size = [], 0
            for key, value in zip(batch["id"], batch["argument"]):
                try:
                    status, body = fetch(value)
                    out.append((key, status, body, None))
                    size += len(body or "")
                except Exception as error:
                    out.append((key, None, None, f"{type(error).__name__}: {error}"))
                if size >= frame_size:
                    yield frame(out)
                    out, size = [], 0
            yield frame(out)

    calls = work.select(
        F.col("id").cast("string").alias("id"), F.col(argument).cast("string").alias("argument")
    )
    return calls.repartition(parallelism).mapInPandas(call, FETCHED_SCHEMA)


def succeeded(fetched: DataFrame) -> DataFrame:
    """``(id, status, body)`` of the calls that gave a 200."""
    return fetched.where(F.col("status") == 200).drop("error")


def failed(fetched: DataFrame) -> DataFrame:
    """``(id, status, error)`` of everything that is not a 200, calls without a status included."""
    return fetched.where(~F.col("status").eqNullSafe(200)).drop("body")
