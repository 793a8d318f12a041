"""A corpus from raw documents: quality, near copies, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.llm.decontaminate import benchmark_matches
from nestweave.llm.near_duplicates import near_duplicates
from nestweave.llm.pii import mask_personal_data
from nestweave.llm.quality import judge_quality
from nestweave.llm.sentencepiece_codec import decode, encode
from nestweave.llm.storage import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Bytes of a batch that goes to a Python worker at once. The session's setting bounds 10,000 rows and 64 MB, which
#: the task, its Arrow buffers and the worker each hold, and executors keep the most that they ever held.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

#: SQL cannot express the language model, the signatures or the encoding.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Batches of at most ``BATCH_BYTES`` (and one row) from here on, in this session; what it reads is the same."""
    spark.conf.set(_BATCH, str(BATCH_BYTES))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and lie in their language's perplexity band."""
    _small_batches(spark)
    return judge_quality(docs, keep=list(COLUMNS)).where("kept").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Rows that repeat a document's id count as copies of it: one of them stays, the first by text and
    the other columns. Rows without an id get ids after all others for this stage, in a written column, so
    that they are compared like the rest and go if a document with an id is their copy; equal ones stay once.
    """
    _small_batches(spark)
    ids = docs.where("doc_id is not null")
    anonymous = docs.where("doc_id is null").dropDuplicates(["text"])
    last = None
    if not anonymous.isEmpty():
        last = max(-1, ids.agg(F.coalesce(F.max("doc_id"), F.lit(-1))).first()[0])
        named = stage(anonymous.withColumn("doc_id", F.lit(last + 1) + F.monotonically_increasing_id()), "anonymous")
        ids = ids.unionByName(named)
    groups = near_duplicates(ids)
    gone = groups.where("not kept").select("doc_id").distinct()
    left = ids.join(gone, "doc_id", "left_anti")
    repeated = stage(ids.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        again = left.join(repeated, "doc_id", "left_semi")
        first = again.groupBy("doc_id").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("first"))
        left = left.join(repeated, "doc_id", "left_anti").unionByName(first.select("doc_id", "first.*"))
    if last is not None:
        left = left.withColumn("doc_id", F.when(F.col("doc_id") <= last, F.col("doc_id")))
    return left.select(*COLUMNS)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = stage(benchmark_matches(docs, benchmark).select("doc_id").distinct(), "held")
    return docs.join(held, docs["doc_id"].eqNullSafe(held["doc_id"]), "left_anti").select(*COLUMNS)


def personal_data_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    masked = mask_personal_data(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, their number, and whether they decode to the text.

    The ids are written before they are decoded: a task that runs both in one go holds two Python workers,
    which an executor keeps, each grown by both steps, for the tasks that follow.
    """
    _small_batches(spark)
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = stage(encode(docs, path).select("doc_id", "text", "ids"), "encoded")
    done = decode(encoded, path)
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))
    return done.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == plain).alias("round_trip")
    )


STAGES = [
    ("quality rules", quality_rules),
    ("near copies", near_copies),
    ("benchmark decontamination", benchmark_free),
    ("personal data", personal_data_masked),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written in the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage_function in STAGES[:-1]:
        docs = stage(stage_function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
