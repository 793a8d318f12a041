"""Chunk results as response records: good data or an error, record by record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestweave.sources.documents import NO_LAYOUT


def responses(records: DataFrame, documents: DataFrame) -> DataFrame:
    """``(request, position, recordId, response)`` for routed records.

    ``documents`` is ``(doc, chunks)``, with ``error`` where a layout could not be read. ``doc`` is
    ``struct<request, position>``: record ids repeat from request to request, a record's
    place in its request does not. Nulls inside chunks stay in the JSON text. A record with an
    error, or without chunks, says so; the others are not affected.
    """
    keep_nulls = {"ignoreNullFields": "false"}
    unreadable = F.col("error") if "error" in documents.columns else F.lit(None).cast("string")
    results = documents.select("doc.request", "doc.position", "chunks", unreadable.alias("unreadable"))
    joined = records.join(results, ["request", "position"], "left")
    message = F.coalesce("error", "unreadable", F.when(F.col("chunks").isNull(), NO_LAYOUT))
    good = F.to_json(F.struct("recordId", F.struct("chunks").alias("data")), keep_nulls)
    bad = F.to_json(
        F.struct("recordId", F.array(F.struct(message.alias("message"))).alias("errors")),
        keep_nulls,
    )
    return joined.select(
        "request", "position", "recordId", F.when(message.isNull(), good).otherwise(bad).alias("response")
    )


def response_envelopes(rows: DataFrame) -> DataFrame:
    """``(request, response)`` with all records of a request in order.

    A request came in as one JSON record, which bounds what is gathered for it.
    """
    in_order = F.sort_array(F.collect_list(F.struct("position", "response")))
    values = F.array_join(F.transform(in_order, lambda r: r["response"]), ", ")
    return rows.groupBy("request").agg(
        F.concat(F.lit('{"values": ['), values, F.lit("]}")).alias("response")
    )
