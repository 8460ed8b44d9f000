"""Readers for the driver tables and the text-pair views derived from them.

Every reader names its columns so Catalyst prunes the Parquet scan to
exactly what a query uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import SCAN_PARTITIONS_CONF, table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _text_table(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A table whose rows are CPU-heavy text. The caller's session may ask
    for a number of tasks (a file in one row group is one split); unset, as
    on a cluster, the scan's own splits stand and nothing is shuffled."""
    df = read_table(spark, sf_dir, name)
    n = spark.conf.get(SCAN_PARTITIONS_CONF, None)
    return df.repartition(int(n), *keys) if n else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_table(spark, sf_dir, "documents", "doc_id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_table(spark, sf_dir, "pages", "page_id")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_table(spark, sf_dir, "conversations", "conv_id", "turn")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels")


def turn_key(conv: str | Column, turn: str | Column) -> Column:
    """The key (conversation, turn) as one text value, "conv:turn": any two
    different pairs of integers give different values."""
    return F.concat_ws(":", F.col(conv) if isinstance(conv, str) else conv,
                       F.col(turn) if isinstance(turn, str) else turn)


def question_context_pairs(conv: DataFrame) -> DataFrame:
    """(pair_id, question, context): a user turn and the assistant turn right after it.

    Written as an equi-join on (conv_id, turn) rather than a ``lead`` window
    over conv_id: both sides hash on the full key, so one very long
    conversation spreads over many tasks instead of landing in one.
    """
    q = (conv.filter(F.col("role") == "user")
         .select("conv_id", F.col("turn").alias("q_turn"), F.col("text").alias("question")))
    a = (conv.filter(F.col("role") == "assistant")
         .select("conv_id", (F.col("turn") - 1).alias("q_turn"), F.col("text").alias("context")))
    return (q.join(a, ["conv_id", "q_turn"], "inner")
            .select(turn_key("conv_id", "q_turn").alias("pair_id"), "question", "context"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return question_context_pairs(conversations(spark, sf_dir))
