"""Language-model scoring with an Elias-Fano n-gram trie.

Counting. Each task counts the n-grams of bounded blocks of text and sends every shard one sorted, Golomb-Rice coded
list of keys with counts; a shard merges its lists. A key is the context's hash and the word's hash, so all
successors of a context stand together, in order.

The trie. Level 1 holds the words and, as a monotone sequence of running totals, their counts. Level k holds, per
shard, the contexts; monotone pointers to each context's run of successors and running totals of its counts; the
successors, coded relative to their context (context number, word), which is one monotone sequence; and for each
successor its discounted relative frequency, quantised to 8 bits of log10. All sequences are Elias-Fano coded and
written to one file per level and shard in the shared folder.

Scoring. A task maps the level files into memory and, for chunks of text, looks up each distinct word and n-gram
once: find the context, then search the successor in its run. Probabilities interpolate with absolute discounting,
    p_k(w | c) = max(n(c w) - D, 0) / n(c) + D * followers(c) / n(c) * p_(k-1)(w | shorter c),
down to the add-one unigram model p_1(w) = (n(w) + 1) / (N + V + 1); an unknown context leaves p_(k-1) as it is.

Texts are words (A-Z lowered) and one end token; a begin mark stands before the first word as context only. A null id counts as -1, null
text counts as empty: its one token is the end. Repeated ids are separate rows. With no training text all counts are
zero and every token has probability 1 / 1. An empty table gives no rows.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .coding import rice_decode, rice_encode
from .common import shared_dir, shuffle_partitions, texts, written
from .elias_fano import EliasFano, map_arrays, pack_arrays
from .wordhash import mix64, word_hashes
from .worker import kept

ORDER = 3
DISCOUNT = 0.75
#: Tokens scored at a time.
BLOCK_TOKENS = 1 << 20
#: Tokens counted at a time: larger lists repeat fewer n-grams and take fewer bits a key.
COUNT_TOKENS = 1 << 22
#: log10 of relative frequencies is stored in steps of 1 / QUANTA, from 0 down to -255 / QUANTA.
QUANTA = 32

_U = np.uint64
BEGIN, END = _U(0x626567696E000001), _U(0x656E640000000001)
_LISTS = "level int, shard int, keys binary, counts binary"
_BUILT = "level int, shard int, grams bigint, tokens bigint, bytes bigint"


def _keys(tokens: np.ndarray, held: np.ndarray, level: int) -> np.ndarray:
    """N-gram keys that end at the places `held` of a token run in which each text has ORDER - 1 begin marks."""
    if level == 1:
        return tokens[held]
    context = np.zeros(len(held), _U)
    for back in range(level - 1, 0, -1):
        context = mix64(context * _U(0x9E3779B97F4A7C15) + tokens[held - back])
    return (context & _U(0xFFFFFFFF00000000)) | (mix64(tokens[held]) >> _U(32))


def _runs(docs: Iterator[bytes], order: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tokens with begin marks, places of the scored tokens, scored tokens per text) of chunks of texts."""
    begin = np.full(order - 1, BEGIN, _U)
    parts, sizes, n = [], [], 0
    for raw in docs:
        words = word_hashes(raw)
        parts += [begin, words, np.array([END], _U)]
        sizes.append(len(words) + 1)
        n += len(words) + 1
        if n >= most:
            yield _run(parts, sizes, order)
            parts, sizes, n = [], [], 0
    if sizes:
        yield _run(parts, sizes, order)


def _run(parts: list, sizes: list, order: int):
    size = np.array(sizes)
    return np.concatenate(parts), np.arange(size.sum()) + np.repeat(np.arange(1, len(size) + 1) * (order - 1), size), size


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> _U(32)) * _U(shards)) >> _U(32)


def _pack_counts(c: np.ndarray) -> bytes:
    return np.minimum(c, 255).astype(np.uint8).tobytes() + c[c >= 255].astype("<u4").tobytes()


def _unpack_counts(raw: bytes, n: int) -> np.ndarray:
    c = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    c[c == 255] = np.frombuffer(raw, "<u4", offset=n)
    return c


def _count(order: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = (t.as_buffer().to_pybytes() for b in batches for t in b.column(1))
        for tokens, held, _ in _runs(docs, order, COUNT_TOKENS):
            for level in range(1, order + 1):
                keys, counts = np.unique(_keys(tokens, held, level), return_counts=True)
                cuts = np.searchsorted(_shard_of(keys, shards), np.arange(shards + 1))
                rows = [(level, s, rice_encode(keys[a:b]), _pack_counts(counts[a:b]))
                        for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["level", "shard", "keys", "counts"])
    return run


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    lists = [rice_decode(k) for k in table.column("keys").to_pylist()]
    counts = np.concatenate([_unpack_counts(c, len(k)) for c, k in zip(table.column("counts").to_pylist(), lists)])
    keys = np.concatenate(lists)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def _totals(counts: np.ndarray) -> EliasFano:
    sums = np.concatenate([[0], np.cumsum(counts)])
    return EliasFano.of(sums, int(sums[-1]) + 1, sought=False)


def level_arrays(level: int, keys: np.ndarray, counts: np.ndarray, discount: float) -> list[np.ndarray]:
    """Arrays of one level's shard from its sorted keys."""
    if level == 1:
        return EliasFano.of(keys, 1 << 64).arrays() + _totals(counts).arrays()
    context = keys >> _U(32)
    starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    runs = np.diff(np.append(starts, len(keys)))
    number = np.repeat(np.arange(len(starts), dtype=_U), runs)
    total = np.add.reduceat(counts, starts)
    frequency = np.log10(np.maximum(counts - discount, 1e-9) / np.repeat(total, runs))
    quantised = np.clip(np.rint(-frequency * QUANTA), 0, 255).astype(np.uint8)
    successors = (number << _U(32)) | (keys & _U(0xFFFFFFFF))
    return (EliasFano.of(context[starts], 1 << 32).arrays()
            + EliasFano.of(np.append(starts, len(keys)), len(keys) + 1, sought=False).arrays()
            + _totals(total).arrays()
            + EliasFano.of(successors, len(starts) << 32).arrays() + [quantised])


def _build(folder: str, discount: float):
    def run(table: pa.Table) -> pa.Table:
        level, shard = table.column("level")[0].as_py(), table.column("shard")[0].as_py()
        keys, counts = _merged(table)
        size = _put(f"{folder}/{level}-{shard}", pack_arrays(level_arrays(level, keys, counts, discount)))
        return pa.table({"level": pa.array([level], pa.int32()), "shard": pa.array([shard], pa.int32()),
                         "grams": [len(keys)], "tokens": [int(counts.sum())], "bytes": [size]})
    return run


def _filesystem(uri: str):
    from pyarrow import fs
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _put(uri: str, data: bytes) -> int:
    """Write a file of the shared folder in one step, so that a repeated task does no harm."""
    files, path = _filesystem(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
    with files.open_output_stream(part) as out:
        out.write(data)
    files.move(part, path)
    return len(data)


def _map(uri: str) -> np.ndarray:
    """A file of the shared folder as a memory map; from a store without paths by an unlinked local copy."""
    from pyarrow import fs
    files, path = _filesystem(uri)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with tempfile.NamedTemporaryFile() as copy:
        with files.open_input_stream(path) as src:
            while chunk := src.read(1 << 22):
                copy.write(chunk)
        copy.flush()
        return np.memmap(copy.name, np.uint8, "r")


class Level:
    """One level's shard, mapped."""

    def __init__(self, level: int, buffer: np.ndarray):
        a = map_arrays(buffer)
        ef = [EliasFano.from_arrays(*a[i:i + 5]) for i in range(0, len(a) // 5 * 5, 5)]
        if level == 1:
            self.words, self.totals = ef
        else:
            self.contexts, self.starts, self.totals, self.successors = ef
            self.quantised = a[-1]

    def counts(self, words: np.ndarray) -> np.ndarray:
        at = self.words.find(words)
        hit = np.flatnonzero(at >= 0)
        out = np.zeros(len(words), np.int64)
        out[hit] = (self.totals.get(at[hit] + 1) - self.totals.get(at[hit])).astype(np.int64)
        return out

    def parts(self, keys: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
        """For sorted keys: discounted relative frequency, and the weight of the next lower level."""
        frequency, weight = np.zeros(len(keys)), np.ones(len(keys))
        contexts, of = np.unique(keys >> _U(32), return_inverse=True)  # each context is sought once
        number = self.contexts.find(contexts)
        hit = np.flatnonzero(number >= 0)
        c = number[hit]
        total = (self.totals.get(c + 1) - self.totals.get(c)).astype(np.float64)
        followers = (self.starts.get(c + 1) - self.starts.get(c)).astype(np.float64)
        lower = np.ones(len(contexts))
        lower[hit] = discount * followers / total
        weight[:] = lower[of]
        known = np.flatnonzero(number[of] >= 0)
        at = self.successors.find((number[of[known]].astype(_U) << _U(32)) | (keys[known] & _U(0xFFFFFFFF)))
        found = at >= 0
        frequency[known[found]] = 10.0 ** (self.quantised[at[found]].astype(np.float64) / -QUANTA)
        return frequency, weight


def _levels(folder: str, files: tuple[tuple[int, int], ...]) -> dict[tuple[int, int], Level]:
    """All level files, mapped; only the last trie stays with the worker."""
    held = kept("lm-levels", dict)
    if folder not in held:
        held.clear()
        held[folder] = {(level, shard): Level(level, _map(f"{folder}/{level}-{shard}")) for level, shard in files}
    return held[folder]


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    cuts = np.searchsorted(_shard_of(keys, shards), np.arange(shards + 1))
    return ((s, slice(a, b)) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b)


class Trie:
    """The mapped levels with the corpus totals."""

    def __init__(self, levels: dict, order: int, shards: int, tokens: int, vocabulary: int, discount: float):
        self.levels, self.order, self.shards, self.discount = levels, order, shards, discount
        self.norm = tokens + vocabulary + 1

    def probabilities(self, tokens: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, unigram probability, model probability) of each scored token."""
        words, of = np.unique(tokens[held], return_inverse=True)
        count = np.zeros(len(words), np.int64)
        for s, part in _by_shard(words, self.shards):
            if (level := self.levels.get((1, s))) is not None:
                count[part] = level.counts(words[part])
        base = ((count + 1) / self.norm)[of]
        p = base
        for k in range(2, self.order + 1):
            keys, at = np.unique(_keys(tokens, held, k), return_inverse=True)
            frequency, weight = np.zeros(len(keys)), np.ones(len(keys))
            for s, part in _by_shard(keys, self.shards):
                if (level := self.levels.get((k, s))) is not None:
                    frequency[part], weight[part] = level.parts(keys[part], self.discount)
            p = frequency[at] + weight[at] * p
        return count[of], base, p


def train(df: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER,
          discount: float = DISCOUNT) -> dict:
    """Count all texts of df and write the trie; returns where it lies and the corpus totals."""
    spark, docs = df.sparkSession, texts(df, key, text)
    shards, folder = shuffle_partitions(spark), shared_dir(spark, "lm-trie")
    built = written(docs.mapInArrow(_count(order, shards), _LISTS).groupBy("level", "shard")
                    .applyInArrow(_build(folder, discount), _BUILT), "lm-levels")
    one = built.filter("level = 1").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"),
                                        F.coalesce(F.sum("grams"), F.lit(0)).alias("v")).first()
    files = tuple((r.level, r.shard) for r in built.select("level", "shard").collect())  # order * shards at most
    return {"folder": folder, "files": files, "order": order, "shards": shards, "tokens": one.n,
            "vocabulary": one.v, "discount": discount}


def score(df: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _levels(model["folder"], model["files"])
        trie = Trie(levels, model["order"], model["shards"], model["tokens"], model["vocabulary"], model["discount"])
        for batch in batches:
            at = 0
            for tokens, held, size in _runs((t.as_buffer().to_pybytes() for t in batch.column(1)), model["order"],
                                             BLOCK_TOKENS):
                count, base, p = trie.probabilities(tokens, held)
                starts = np.cumsum(size) - size
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(size)), pa.array(size.astype(np.int64)),
                     pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                     pa.array(np.add.reduceat(np.log10(base), starts)),
                     pa.array(np.add.reduceat(np.log10(p), starts))],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
                at += len(size)
    return texts(df, key, text).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def held_out(key: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 7 == 2, F.lit(False))
