"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a longest stretch of words with smallest period q (words q apart are identical) and a length of at least
max(6, 4 * q). Each of its words stands in it four times or more. So a word that occurs under four times in a segment
is in no run inside the segment and splits it; the pieces have smaller counts and are split again, until nothing
changes. The largest piece inherits its parent's counts, less those of the rest, so a word is recounted only when its
segment at least halves: n log n steps for any text.

Surviving segments are scanned lag by lag, all lags from w to 2 * w at once for w = 1, 2, 4, ...: windows of 2 * w
words are named by pairs of names of half the length, and a run of period q shows as a stretch of windows whose next
equal window is q away. Longer windows than q are equal at no other distance inside a run, so the stretch gives the
run's ends and its smallest period exactly, in n log n steps a doubling instead of n for each lag.

Null text is the text without words, a null id stays null. Repeated ids and repeated rows are rows by themselves. An
empty table gives no rows. A text is one row's work, however long.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 6
MIN_REPEATS = 4
WORD = r"[^\x20\x09-\x0D]+"

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"


def stable_segments(words: Sequence) -> list[tuple[int, int]]:
    """Segments (from, to) in which every word occurs MIN_REPEATS times or more; every run lies in one."""
    def rare(counts: Counter, a: int, b: int) -> list[int]:
        return [i for i in range(a, b) if counts[words[i]] < MIN_REPEATS]

    def pieces(a: int, b: int, cuts: list[int]) -> list[tuple[int, int]]:
        ends = [*cuts, b]
        return [(x, y) for x, y in zip([a, *(c + 1 for c in cuts)], ends) if y - x >= MIN_WORDS]

    def fresh(a: int, b: int) -> tuple:
        counts = Counter(words[a:b])
        return a, b, counts, rare(counts, a, b)

    first = fresh(0, len(words))
    where: dict = defaultdict(list)
    for a, b in pieces(0, len(words), first[3]):
        for i in range(a, b):
            where[words[i]].append(i)
    out, work = [], [first]
    while work:
        lo, hi, counts, cuts = work.pop()
        parts = pieces(lo, hi, cuts)
        if not parts:
            continue
        if not cuts:
            out.append((lo, hi))
            continue
        a, b = max(parts, key=lambda p: p[1] - p[0])
        work += [fresh(*p) for p in parts if p != (a, b)]
        if 2 * (b - a) <= hi - lo:
            work.append(fresh(a, b))
            continue
        gone = Counter(words[lo:a])
        gone.update(words[b:hi])
        counts.subtract(gone)
        low = [where[w] for w in gone if 0 < counts[w] < MIN_REPEATS]
        work.append((a, b, counts, sorted(i for at in low for i in at[bisect_left(at, a):bisect_left(at, b)])))
    return sorted(out)


def lag_scan(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of an integer array."""
    n, w, out = len(ids), 1, []
    name = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    while n >= max(MIN_WORDS, MIN_REPEATS * w):
        more = n - 2 * w + 1  # windows of 2 * w words
        pair = name[:more] * (int(name.max()) + 1) + name[w:w + more]
        order = np.argsort(pair, kind="stable")
        new = np.diff(pair[order], prepend=pair[order[0]]) != 0
        if new.sum() == more - 1:  # all windows differ
            break
        name = np.empty(more, np.int64)
        name[order] = np.cumsum(new)
        gap = np.zeros(more, np.int64)
        gap[order[:-1]] = np.where(new[1:], 0, np.diff(order))
        at = np.flatnonzero(np.diff(gap, prepend=-1))
        last = np.append(at[1:], more) - 1
        q = gap[at]
        length = last - at + q + 2 * w
        good = (q >= w) & (q < 2 * w) & (length >= np.maximum(MIN_WORDS, MIN_REPEATS * q))
        out += zip(at[good].tolist(), length[good].tolist(), q[good].tolist())
        w *= 2
    return out


def word_runs(words: Sequence) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a word sequence, by start, then period."""
    out = []
    for a, b in stable_segments(words):
        ids: dict = {}
        seg = np.fromiter((ids.setdefault(w, len(ids)) for w in words[a:b]), np.int64, b - a)
        out += [(a + s, length, q) for s, length, q in lag_scan(seg)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for first in range(0, whole.num_rows, 500):
            batch = whole.slice(first, 500)
            all_runs, collapsed = [], []
            for text in batch.column(1):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                runs = word_runs(words)
                if runs:
                    keep = np.ones(len(words), bool)
                    for s, length, q in runs:
                        keep[s + q:s + length] = False
                    words = [words[i] for i in np.flatnonzero(keep)]
                all_runs.append([dict(start=s, length=n, period=q) for s, n, q in runs])
                collapsed.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(all_runs, pa.list_(_RUN)),
                                              pa.array(collapsed, pa.binary())], names=["doc_id", "runs", "collapsed"])


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, runs (by start, then period; word numbers from 0) and collapsed, the words that no
    run holds after its first period, joined by one space."""
    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_batches, _OUT).withColumn("collapsed", F.col("collapsed").cast("string"))


def with_planted_periods(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): every tenth document by a hash of its id repeats words from some place on; a null id plants
    nothing. Known repeats for measuring the operator on any table."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    n = F.size(words).cast("bigint")
    a = F.try_mod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")

    def part(c: Column, start: Column, length: Column) -> Column:
        return F.slice(c, start.cast("int"), length.cast("int"))

    times = F.ceil((n - a) / p).cast("int")
    tail = part(F.flatten(F.array_repeat(part(words, a + 1, p), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(part(words, F.lit(1), a), tail), " ")
    return df.select(F.col(key).cast("bigint").alias("doc_id"),
                     F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col(text)).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """periodic_runs' rows as digests: n_runs, the run of greatest length / period (ties: smallest start, then period)
    and its exponent in thousandths, hashes of all runs and of the collapsed text."""
    runs = F.col("runs")
    # Cross-multiplied, so that exponents compare exactly; runs come by start, then period.
    best = F.aggregate(runs, F.get(runs, 0), lambda x, y: F.when(
        y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), "")
    return found.select("doc_id", "collapsed", F.size(runs).cast("bigint").alias("n_runs"), best.alias("b"),
                        lines.alias("lines")).select(
        "doc_id", "n_runs", F.col("b.start").alias("start"), F.col("b.length").alias("length"),
        F.col("b.period").alias("period"),
        F.expr("(1000 * b.length) div b.period").cast("bigint").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
