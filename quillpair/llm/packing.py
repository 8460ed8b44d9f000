"""Packing along a space-filling curve.

Each document's tokens are hashed to features; the feature counts are projected to four dimensions and normalised, so
similar documents lie close on a small sphere. The Hilbert index of that point orders the documents: neighbours on
the curve are neighbours in the projection. Documents are range-sorted by that key and laid end to end; sequences
are cut from the run every `width` tokens, so a sequence holds documents that belong together and nothing is lost to
padding. The rest of the run that doesn't fill a sequence is cut into sequences whose lengths are powers of two.

The run's order is (cell, part, key, id). A cell is a prefix of the key; a cell with too many tokens (many copies of
one text have one key) is split into parts by a hash of the id, of the row where the id is null. The token totals of cells and parts, a table of
bounded size, give each range its place in the run, so every task lays out its ranges by itself.

A null id stays null, null text counts as empty; an empty text has one token, its end. Repeated ids are laid out as separate documents.
An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, keyed_texts, shuffle_partitions, with_null_ids, written
from .wordtokens import WordTokens

WIDTH = 4096
END_ID = 2
FEATURES = 4096
DIMS = 4
BITS = 12
#: The key's first CELL_BITS bits name the cell: at most 2**CELL_BITS rows in the table of totals, before splits.
CELL_BITS = 12

#: Tokens that one task lays out, on average; sets the number of tasks for large inputs.
TASK_TOKENS = 8_000_000
#: Texts encoded together.
PART_ROWS, PART_BYTES = 100, 2_000_000

_TOKENS = "doc_id bigint, row bigint, key bigint, n bigint, ids binary"
_PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
           "offset bigint")


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points (n, dims) with coordinates under 2**bits."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    for b in range(bits - 1, 0, -1):  # undo the rotations of the sub-cubes, coarse to fine
        bit, low = 1 << b, (1 << b) - 1
        for i, c in enumerate(x):
            on = (c & bit) != 0
            swap = np.where(on, 0, (x[0] ^ c) & low)
            x[0] = x[0] ^ np.where(on, low, 0)
            if i:
                x[0] = x[0] ^ swap
                x[i] = c ^ swap
    for i in range(1, len(x)):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1, (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ turn) >> b) & 1)
    return key


def _directions() -> np.ndarray:
    return np.random.default_rng(11).standard_normal((FEATURES, DIMS)).astype(np.float32)


def _features(ids: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(20)) & np.uint32(FEATURES - 1)


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents given as token id arrays."""
    table = _directions()
    v = np.array([table[_features(x)].sum(0, dtype=np.float64) for x in ids]).reshape(-1, DIMS)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return hilbert_key(np.clip(((v + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1), BITS)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of PART_ROWS rows and PART_BYTES bytes of text at most, or one row."""
    first, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        if i > first and (i - first == PART_ROWS or held + n > PART_BYTES):
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n
    if batch.num_rows > first:
        yield batch.slice(first)


def _tokenise(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        words, row = WordTokens.of(path), TaskContext.get().partitionId() << 40
        end = np.array([END_ID], words.dtype).tobytes()
        for batch in batches:
            for part in _parts(batch):
                raw = [x + end for x in words.encode_all([t.as_buffer().to_pybytes() for t in part.column(1)])]
                ids = [np.frombuffer(x, words.dtype) for x in raw]
                n = len(raw)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.arange(row, row + n)), pa.array(curve_keys(ids)),
                     pa.array([len(x) for x in ids], pa.int64()), pa.array(raw, pa.binary())],
                    names=["doc_id", "row", "key", "n", "ids"])
                row += n
    return run


def _lay_out(total: int, width: int, dtype: str):
    full = total // width * width
    rest, tail = total - full, [full]
    while tail[-1] < total:  # powers of two, largest first
        tail.append(tail[-1] + (1 << ((total - tail[-1]).bit_length() - 1)))

    def sequence(pos: int) -> tuple[int, int, int]:
        """Number, begin and end of the sequence around a place in the run."""
        if pos < full:
            return pos // width, pos // width * width, pos // width * width + width
        k = int(np.searchsorted(tail, pos, "right")) - 1
        return full // width + k, tail[k], tail[k + 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PIECES.split(", ")]
        span, pos = None, 0
        for batch in batches:
            out: list[list[int]] = [[] for _ in names]
            for base, doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if base != span:  # the next range begins
                    span = pos = base
                ids = np.frombuffer(raw.as_buffer(), dtype).astype("<u4")
                at = 0
                while at < len(ids):
                    number, begin, end = sequence(pos)
                    n = min(len(ids) - at, end - pos)
                    for col, v in zip(out, (doc, at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids), number,
                                            pos - begin)):
                        col.append(v)
                    at, pos = at + n, pos + n
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)
    return run


def pack(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per piece of a document in a sequence. tokenizer: file of the tokenizers library."""
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    docs = keyed_texts(df, key, text)
    tokens = written(docs.mapInArrow(_tokenise(tokenizer), _TOKENS), "pack-tokens")
    cells = tokens.select("doc_id", "row", "n", "key",
                          F.shiftright("key", BITS * DIMS - CELL_BITS).cast("int").alias("cell"))
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(parts, -(-total // TASK_TOKENS))
    most = max(width, total // (4 * parts))
    splits = cells.groupBy("cell").agg(F.ceil(F.sum("n") / F.lit(most)).cast("int").alias("splits"))
    who = F.when(F.col("doc_id") == NO_ID, F.col("row")).otherwise(F.col("doc_id"))
    part = F.pmod(F.xxhash64(who), F.col("splits")).cast("int").alias("part")
    # At most 2**CELL_BITS + 4 * parts rows, so the window below and the broadcasts have a bound.
    ranges = (cells.join(F.broadcast(splits), "cell").groupBy("cell", "splits", part).agg(F.sum("n").alias("n")))
    before = Window.orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("cell", "splits", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = (tokens.withColumn("cell", F.shiftright("key", BITS * DIMS - CELL_BITS).cast("int"))
              .join(F.broadcast(splits), "cell").withColumn("part", part)
              .join(F.broadcast(ranges.drop("splits")), ["cell", "part"])
              .repartition(parts, "base")
              .sortWithinPartitions("base", "key", "doc_id", "row"))
    pieces = placed.select("base", "doc_id", "ids").mapInArrow(_lay_out(total, width, WordTokens.dtype), _PIECES)
    return with_null_ids(pieces, "doc_id")
