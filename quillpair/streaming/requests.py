"""Streaming request path (K1): the web form's handler as a Structured
Streaming job.

``readStream`` over a folder of request files (explicit schema) feeds
``foreachBatch``; each micro-batch runs the same ``answer`` function as the
batch path (validation, routing, n distinct questions, two-model choice),
which needs joins and aggregates that plain streaming operators do not allow
without state. Each batch overwrites its own ``batch_id=N`` folder, so a
replayed batch after a failure rewrites the same output instead of
duplicating it. The vocabularies are written once, before the stream starts,
in the shared folder. How much a trigger reads is the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import requests as RQ
from ..session import materialise, shared_path


def start_request_stream(spark: SparkSession, source_dir: str, out_dir: str, vocab_by_variant: DataFrame,
                         checkpoint_location: str, available_now: bool = True,
                         max_files_per_trigger: int | None = None):
    """Start the stream; returns the ``StreamingQuery``."""
    vocab = materialise(vocab_by_variant, "stream-vocab")
    reader = spark.readStream.schema(RQ.REQUEST_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        RQ.answer(batch, vocab).write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def run_requests_once(spark: SparkSession, requests: DataFrame, vocab_by_variant: DataFrame,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Write ``requests`` as files (as many as they have partitions), answer
    them with an ``availableNow`` stream and return the answers."""
    root = shared_path(spark, "requests")
    requests.write.parquet(f"{root}/in")
    q = start_request_stream(spark, f"{root}/in", f"{root}/out", vocab_by_variant, f"{root}/stream",
                             max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{root}/out").select(
        "request_id", "variant", "rank", "question", "error", F.col("batch_id").cast("bigint"))
