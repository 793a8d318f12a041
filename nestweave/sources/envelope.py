"""Request envelopes: records that name the documents to process."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.functions.generators import elements
from nestweave.functions.text import signed_url

FILE_DATA_TYPE = "struct<data:string,url:string,sasToken:string>"
ENVELOPE_SCHEMA = (
    "values array<struct<recordId:string,data:struct<file_data:" + FILE_DATA_TYPE + ">>>"
)

# Messages a caller finds in the response.
NO_SOURCE = "file_data missing 'data' or 'url'"
BAD_PADDING = "Incorrect padding"
EMPTY_PAYLOAD = "Empty PDF bytes passed to di_layout"
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def read_requests(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per record: ``(request, position, recordId, data, url, sasToken)``.

    A file is one envelope, and ``request`` its path.
    """
    envelopes = (
        spark.read.schema(ENVELOPE_SCHEMA)
        .option("multiLine", True)
        .json(path)
        .select(F.col("_metadata.file_path").alias("request"), "values")
    )
    return explode_requests(envelopes)


def parse_requests(df: DataFrame, request: str, envelope: str) -> DataFrame:
    """Records of envelopes held as JSON text in a column, by their request key."""
    parsed = F.from_json(envelope, ENVELOPE_SCHEMA).getField("values")
    return explode_requests(df.select(F.col(request).alias("request"), parsed.alias("values")))


def explode_requests(envelopes: DataFrame) -> DataFrame:
    """Records of ``(request, values)`` envelopes, with their position kept."""
    records = elements(envelopes, ["request"], "values", "position", "record")
    return records.select("request", "position", "record.recordId", "record.data.file_data.*")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _decoded(data: Column, digits: Column, ignored: Column) -> Column:
    """Bytes of ``digits``, which are ``data`` without the characters in ``ignored``."""
    many = F.length(digits) % 4
    # the last run of =, if nothing but ignored characters follow it
    last = F.rtrim(data, F.replace(ignored, F.lit("=")))
    padding = F.length(last) - F.length(F.rtrim(last, F.lit("=")))
    whole = F.when(many == 0, True).when(many == 1, False).otherwise(many + padding >= 4)
    return F.when(whole, F.unbase64(digits))


def decode_payload(data: Column) -> Column:
    """Bytes of base64 text, other characters ignored; null where padding is missing.

    Payloads are long: no regular expression goes over their characters.
    """

    def decoded(held: Column) -> Column:
        text, ignored = held["text"], held["ignored"]
        digits = (
            F.when(ignored == "", text)
            .when(F.replace(ignored, F.lit("=")) == "", F.replace(text, F.lit("=")))
            .otherwise(F.call_function("translate", text, ignored, F.lit("")))
        )
        return _let(digits, lambda d: _decoded(text, d, ignored))

    ignored = F.translate(data, BASE64_ALPHABET, "")
    return _let(F.struct(data.alias("text"), ignored.alias("ignored")), decoded)


def route_payloads(records: DataFrame) -> DataFrame:
    """Add ``payload`` (bytes), ``source_url`` and ``error`` to each record.

    Inline data wins over a URL. A null is treated like a missing key, since a typed
    record cannot tell them apart; a bad record gets an error and the others go on.
    """
    payload = F.when(F.col("data").isNotNull(), decode_payload(F.col("data")))
    routed = records.withColumn("payload", payload).withColumn(
        "source_url",
        F.when(F.col("data").isNull(), signed_url(F.col("url"), F.col("sasToken"))),
    )
    error = (
        F.when(F.col("data").isNull() & F.col("url").isNull(), NO_SOURCE)
        .when(F.col("data").isNotNull() & F.col("payload").isNull(), BAD_PADDING)
        .when(F.length("payload") == 0, EMPTY_PAYLOAD)
    )
    return routed.withColumn("error", error)
