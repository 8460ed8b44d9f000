"""Corpus pipeline: quality rules, exact dedup, near-duplicate groups, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents. Decisions are made by
row: the quality rules filter rows, the exact stage keeps one row of each text, whatever ids repeat or are null. To the
near-duplicate stage rows with one id (or without any) are one document: all its texts stay or go together. It takes
85 percent, as the operator does. Null text counts as empty and fails the quality rules.

Every stage sends whole texts to Python workers, so the stages lower the session's bound on the bytes of an Arrow batch
to BATCH_BYTES: what an executor holds of them besides its heap is a few batches a task, whatever the texts' lengths.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillpair.llm.common import read, written
from quillpair.llm.exact_dedup import exact_dedup
from quillpair.llm.near_dedup import near_dedup
from quillpair.llm.packing import pack
from quillpair.llm.quality_rules import keep_quality

TOKENIZER = "word_bpe_49k.json"
BATCH_BYTES = 8 << 20


def _prefix(docs: DataFrame) -> str:
    """A prefix that no column of docs begins with."""
    p = "_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p += "_"
    return p


def _keep(docs: DataFrame, kept: DataFrame, *keys: tuple[Column, str]) -> DataFrame:
    """Rows of docs whose keys stand in kept; nulls are equal."""
    p = _prefix(docs)
    kept = kept.select(*[F.col(name).alias(p + name) for _, name in keys])
    same = [key.eqNullSafe(F.col(p + name)) for key, name in keys]
    return docs.join(kept, same, "left_semi")


def _small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by BATCH_BYTES; a smaller bound of the caller's stays."""
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < _bytes(spark, conf) <= BATCH_BYTES:
        spark.conf.set(conf, f"{BATCH_BYTES}b")


def _bytes(spark: SparkSession, conf: str) -> int:
    """A size setting in bytes, whatever its unit."""
    text = spark.conf.get(conf).strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(text[:-1] if unit else text) << unit


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _small_batches(spark)
    return keep_quality(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, one with the largest id."""
    _small_batches(spark)
    verdicts = written(exact_dedup(docs), "pipeline-verdicts")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    left = _keep(docs, verdicts.filter("kept"), (F.col("doc_id"), "doc_id"), (digest, "text_sha256"))
    # Equal rows of one id are left together; where such are, one row of each is taken.
    p = _prefix(docs)
    twice = verdicts.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    twice = written(twice.select(F.col("doc_id").alias(p + "id"), F.col("text_sha256").alias(p + "sha")), "pipeline-twice")
    many = left.join(twice, F.col("doc_id").eqNullSafe(F.col(p + "id")) & (digest == F.col(p + "sha")), "left")
    one = many.filter(F.col(p + "sha").isNotNull()).dropDuplicates(["doc_id", p + "sha"])
    return many.filter(F.col(p + "sha").isNull()).unionByName(one).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    _small_batches(spark)
    return _keep(docs, near_dedup(docs).filter("kept"), (F.col("doc_id"), "doc_id"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences."""
    _small_batches(spark)
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality_rules", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
          ("packing", packing_stage)]

#: Compression bands, shingle components and the Hilbert order have no SQL form; tests/llm compares run() with the
#: brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents", "*")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
