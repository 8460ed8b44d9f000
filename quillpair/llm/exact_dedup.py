"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every task packs its rows into blocks, and a block sends each owner (a range of the fingerprint space) one sorted,
   Golomb-Rice coded list of distinct fingerprints. Copies inside a block collapse before anything moves.
2. An owner merges the lists it received and answers every block with a bitmap: bit i says that the block's i-th
   fingerprint also stands in another block.
3. The block's own state (row ids and digests in fingerprint order) meets its bitmaps again on (block, owner). Rows
   without a set bit are unique; the others are suspects.
4. Only suspects' texts are shuffled: grouped by the whole text, which compares bytes, with a partial aggregate that
   collapses hot copies in each task first. A fingerprint collision ends here as two groups.

Of equal texts one row stays, with the largest id; a null id is smaller than all others, stays null, and of rows with
equal ids one is taken. Null text counts as empty; the empty text is a text like any other. Repeated ids are kept as
rows: each is reported, and group_size counts them. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .coding import rice_decode, rice_encode
from .common import keyed_texts, maybe_in, shuffle_partitions, with_null_ids, written

#: Bits of a fingerprint: with n rows a unique row is a needless suspect with probability n / 2**48.
FP_BITS = 48
#: Rows of one block; bounds a task's memory.
BLOCK_ROWS = 1 << 16
#: Fingerprints an owner merges at a time, on average; sets the number of owners for large inputs.
OWNER_ROWS = 500_000

_MAIL = "block bigint, owner int, codes binary, runs binary, ids binary, digests binary"
_ROWS = "doc_id bigint, row bigint, fp bigint, digest binary, suspect boolean"


def _pack(owners: int):
    def block_rows(block: int, ids: np.ndarray, fps: np.ndarray, digests: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((ids, fps))
        ids, fps, digests = ids[order], fps[order], digests[order]
        owner = (fps >> np.uint64(16)) * np.uint64(owners) >> np.uint64(FP_BITS - 16)
        starts = np.flatnonzero(np.diff(owner, prepend=owner[0] + np.uint64(1)))
        out: list[list] = [[], [], [], [], [], []]
        for a, b in zip(starts, [*starts[1:], len(fps)]):
            distinct, runs = np.unique(fps[a:b], return_counts=True)
            for col, v in zip(out, (block, int(owner[a]), rice_encode(distinct), runs.astype("<u4").tobytes(),
                                    ids[a:b].astype("<i8").tobytes(), digests[a:b].tobytes())):
                col.append(v)
        types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                          names=["block", "owner", "codes", "runs", "ids", "digests"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first, held, n, blocks = TaskContext.get().partitionId() << 32, [], 0, 0

        def flush():
            ids, fps, dig = (np.concatenate(x) for x in zip(*held))
            return block_rows(first + blocks, ids, fps, dig)

        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                b = batch.slice(a, BLOCK_ROWS)
                dig = np.frombuffer(b"".join(b.column(2).to_pylist()), "V32")
                held.append((b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.uint64), dig))
                n += b.num_rows
                if n >= BLOCK_ROWS:
                    yield flush()
                    held, n, blocks = [], 0, blocks + 1
        if n:
            yield flush()
    return pack


def _answer(table: pa.Table) -> pa.Table:
    """All lists of one owner: which of their fingerprints stand in more than one list."""
    lists = [rice_decode(c) for c in table.column("codes").to_pylist()]
    sizes = np.array([len(x) for x in lists])
    fps = np.concatenate(lists)
    order = np.argsort(fps, kind="stable")
    same = fps[order][1:] == fps[order][:-1]
    dup = np.zeros(len(fps), bool)
    dup[order[1:][same]] = True
    dup[order[:-1][same]] = True
    ends = np.cumsum(sizes)
    bitmaps = [np.packbits(dup[e - s:e]).tobytes() for s, e in zip(sizes, ends)]
    return pa.table({"block": table.column("block"), "owner": table.column("owner"),
                     "bitmap": pa.array(bitmaps, pa.binary())})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        for runs, ids, digests, codes, bitmap in zip(*(batch.column(c).to_pylist() for c in
                                                       ("runs", "ids", "digests", "codes", "bitmap"))):
            runs = np.frombuffer(runs, "<u4")
            flag = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(runs)).astype(bool) | (runs > 1)
            digest = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(digests) // 32,
                                                          [None, pa.py_buffer(digests)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(ids, "<i8")), pa.array(np.arange(row, row + len(ids) // 8)),
                 pa.array(np.repeat(rice_decode(codes).astype(np.int64), runs)),
                 digest.cast(pa.binary()), pa.array(np.repeat(flag, runs))],
                names=["doc_id", "row", "fp", "digest", "suspect"])
            row += len(ids) // 8


def _fingerprint():
    return F.xxhash64("text").bitwiseAND(F.lit((1 << FP_BITS) - 1))


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    spark, docs = df.sparkSession, keyed_texts(df, key, text)
    owners = max(shuffle_partitions(spark), -(-docs.count() // OWNER_ROWS))
    sent = docs.select("doc_id", _fingerprint().alias("fp"), F.unhex(F.sha2("text", 256)).alias("digest"))
    mail = written(sent.mapInArrow(_pack(owners), _MAIL), "dedup-mail")
    answers = (mail.select("block", "owner", "codes").groupBy("owner")
               .applyInArrow(_answer, "block bigint, owner int, bitmap binary"))
    rows = written(mail.join(answers, ["block", "owner"]).mapInArrow(_unpack, _ROWS), "dedup-rows")
    suspects = rows.filter("suspect").select("doc_id", "row", "fp", "digest")
    stays = suspects.groupBy("fp", "digest").agg(F.max(F.struct("doc_id", "row"))["row"].alias("stays"))
    groups = (maybe_in(docs.withColumn("fp", _fingerprint()), F.col("fp"), suspects, "fp")
              .groupBy("fp", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .select("fp", F.unhex(F.sha2("text", 256)).alias("digest"), "keep_id", "group_size"))
    groups = groups.join(stays, ["fp", "digest"])
    copies = suspects.join(groups, ["fp", "digest"]).select("doc_id", "keep_id", "group_size", "digest",
                                                            (F.col("row") == F.col("stays")).alias("kept"))
    unique = rows.filter("NOT suspect").select("doc_id", F.col("doc_id").alias("keep_id"),
                                               F.lit(1).cast("bigint").alias("group_size"), "digest",
                                               F.lit(True).alias("kept"))
    out = unique.unionByName(copies).select("doc_id", "keep_id", "group_size", "kept",
                                            F.lower(F.hex("digest")).alias("text_sha256"))
    return with_null_ids(out, "doc_id", "keep_id")
