"""Phrases of a column read as one joined text, without joining it.

Rows stand in order, lower-cased, collapsed, with one space between them; matches are taken left to right and may span
rows. The text is range-sorted; where an earlier match ends inside a partition is one of a few states (words already
taken), so a partition is one function from its entry to its exit state. Every partition is scanned once for all entry
states, the functions are composed in order, a row a partition, and the counts of the true states stay. Null texts are
left out; an empty text is a row. Rows with equal ids stand in any order.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import resources as R
from ..functions import text as T
from ..session import materialise

_SCANNED = "part int, mask int, phrase string, n bigint, first bigint, exits array<int>"
#: Distinct phrases that a task holds before it hands their counts on.
HOLD = 200_000
_WORD = re.compile(r"\w+")


class _Part:
    """Scan of one partition: the undecided end of its text, and per entry state the words of it already taken."""

    def __init__(self, part: int, anchor: str, n_after: int):
        self.part, self.n_after, self.text, self.seen = part, n_after, None, 0
        self.taken = list(range(n_after + 1))
        self.counts: dict[tuple[str, int], list[int]] = {}
        self.match = re.compile(rf"(?<!\w)(?=({re.escape(anchor)}(?: \w+){{{n_after}}}))")

    def _decide(self, text: str, end: int) -> None:
        """Take matches that begin before end; then ``taken`` counts the words behind end."""
        ends = [m.end() for m in itertools.islice(_WORD.finditer(text), self.n_after)]
        block = [0 if not c else ends[c - 1] if c <= len(ends) else len(text) for c in self.taken]
        for m in self.match.finditer(text):
            at = m.start()
            if at >= end:
                break
            mask = sum(1 << s for s, b in enumerate(block) if at >= b)
            if mask:
                block = [m.end(1) if at >= b else b for b in block]
                held = self.counts.setdefault((m.group(1), mask), [0, (self.part << 40) + self.seen])
                held[0] += 1
                self.seen += 1
        self.taken = [len(_WORD.findall(text, end, b)) if b > end else 0 for b in block]

    def feed(self, rows: list[str]) -> None:
        text = " ".join(rows if self.text is None else [self.text, *rows])
        if len(list(itertools.islice(_WORD.finditer(text), self.n_after + 1))) > self.n_after:
            begin, words = len(text), 0
            while words < self.n_after:  # back to the last words, whose phrases are still open
                begin -= 1
                words += _WORD.match(text, begin) is not None and not _WORD.match(text, begin - 1, begin)
            self._decide(text, begin)
            text = text[begin:]
        self.text = re.sub(r"\W{2,}", "--", text)  # no phrase goes over it, however long it is

    def close(self, ahead: str) -> list[int]:
        self._decide(self.text + ahead, len(self.text))
        return self.taken

    def rows(self) -> list[tuple]:
        out = [(self.part, mask, phrase, n, first, None) for (phrase, mask), (n, first) in self.counts.items()]
        self.counts = {}
        return out


def _scan(anchor: str, n_after: int):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
        names = [c.split()[0] for c in _SCANNED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ahead = None, ""

        def closed():
            exits = now.close(ahead)
            return batch_of([*now.rows(), (now.part, None, None, None, None, exits)])

        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for part, group in itertools.groupby(rows, key=lambda r: r[0]):
                group = list(group)
                if now is None or now.part != part:
                    if now is not None:
                        yield closed()
                    now, ahead = _Part(part, anchor, n_after), group[0][2]
                now.feed([r[1] for r in group])
                if len(now.counts) > HOLD:
                    yield batch_of(now.rows())
        if now is not None:
            yield closed()
    return run


def top_phrases_joined(df: DataFrame, row_id: str, text_col: str, anchor: str = "what", n_after: int = 3,
                       k: int = R.TOP_K) -> DataFrame:
    """(rank, phrase, n, share_pct): most common anchor + n words phrases of the joined column."""
    spark = df.sparkSession
    lowered = df.filter(F.col(text_col).isNotNull()).select(F.col(row_id).alias("_id"), T.lower_collapse(text_col).alias("t"))
    tagged = materialise(lowered.orderBy("_id").select(
        "t", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "joined")
    inner = Window.partitionBy("part").orderBy("row")
    begin = rf"^(?:[^\p{{L}}\p{{N}}_]*{T.WORD_RUN}){{{n_after}}}"
    heads = (tagged.withColumn("k", F.row_number().over(inner)).filter(F.col("k") <= n_after)
             .select("part", "k", F.when(F.col("t").rlike(begin), F.regexp_extract("t", begin, 0)).otherwise(F.col("t")).alias("head")))
    following = Window.orderBy("part", "k").rowsBetween(1, n_after)  # n_after rows a partition
    ahead = (heads.withColumn("next", F.collect_list("head").over(following)).groupBy("part")
             .agg(F.max_by("next", "k").alias("next"))
             .select("part", F.concat_ws("", F.transform("next", lambda x: F.concat(F.lit(" "), x))).alias("ahead")))
    rows = tagged.join(ahead, "part").repartition("part").sortWithinPartitions("part", "row").select("part", "t", "ahead")
    scanned = materialise(rows.mapInArrow(_scan(anchor, n_after), _SCANNED), "joined-scan")
    entries, state = [], 0
    for r in scanned.filter("exits IS NOT NULL").select("part", "exits").orderBy("part").collect():  # a row a partition
        entries.append((r.part, state))
        state = r.exits[state]
    entry = spark.createDataFrame(entries, "part int, entry int")
    true = scanned.filter("phrase IS NOT NULL").join(entry, "part").filter("(shiftright(mask, entry) & 1) = 1")
    counts = true.groupBy("phrase").agg(F.sum("n").alias("n"), F.min("first").alias("_first"))
    top = counts.orderBy(F.desc("n"), "_first").limit(k)
    w = Window.orderBy(F.desc("n"), "_first")  # at most k rows
    return top.select(F.row_number().over(w).cast("bigint").alias("rank"), "phrase", "n",
                      F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share_pct"))
