"""Shared pieces of the corpus operators: scans, written scratch tables, a bounded membership sketch."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Stands for a null id inside operators: smaller than every id in use.
NO_ID = -(1 << 63)
#: Words of 64 bits in a membership sketch: at most this many rows are broadcast, whatever the key count.
SKETCH_WORDS = 1 << 17
#: ASCII white space, as in the word pattern [^\x20\x09-\x0D]+; bytes.split() without arguments cuts at the same bytes.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Only the named columns reach the scan; extra columns of the table never clash with internal names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): null text is the empty text, a null id counts as -1."""
    return df.select(F.coalesce(F.col(key).cast("bigint"), F.lit(-1)).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def keyed_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) where ids are compared: null text is the empty text, a null id is NO_ID until with_null_ids."""
    return df.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))


def with_null_ids(df: DataFrame, *cols: str) -> DataFrame:
    """An operator's rows with NO_ID as null again."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(NO_ID)) for c in cols})


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder below spark.checkpoint.dir, the one place driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: computed once, survives lost executors."""
    path = shared_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _slot(key: Column) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    return F.pmod(h, F.lit(SKETCH_WORDS)).cast("int"), F.pmod(F.shiftrightunsigned(h, 40), F.lit(64)).cast("int")


def maybe_in(df: DataFrame, key: Column, keys: DataFrame, keys_col: str) -> DataFrame:
    """Rows of df whose key may be in keys: none that is in it is lost, a few others may pass.

    The broadcast side is a bitmap of SKETCH_WORDS 64-bit words, so its size is bounded by a constant and not by
    the data. The exact join or grouping that follows settles the false positives.
    """
    word, bit = _slot(F.col(keys_col))
    bitmap = (keys.select(word.alias("_word"), bit.alias("_bit"))
              .groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_mask")))
    word, bit = _slot(key)
    return (df.withColumns({"_word": word, "_bit": bit})
            .join(F.broadcast(bitmap), "_word")
            .filter(F.expr("(shiftrightunsigned(_mask, _bit) & 1L) = 1"))
            .drop("_word", "_bit", "_mask"))

