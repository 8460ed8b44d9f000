"""Spelling variants by a variable-length gram index.

1. Words: runs of Latin letters, A-Z lowered, counted by task before the shuffle.
2. Gram dictionary: all grams of MIN_GRAM to MAX_GRAM characters of the words (with a mark at both ends) are counted.
   Grams in over T words are frequent; T is at least the number of grams of a length / MAX_FREQUENT, so the frequent
   ones are at most MAX_FREQUENT of each length, whatever the input. Only these are sent to the tasks.
3. Variable grams: at each place of a word the shortest gram that is not frequent (at most MAX_GRAM characters, or the
   word's end). An edit changes the grams over its place and no other, so a word has a bound on its affected grams:
   the most grams over one letter. All words have more grams than that, so two near words share one.
4. List merging: grams have one order, infrequent first, then longer ones first. Of the grams that an edit leaves alone, the first one is
   preceded by affected grams only, so it is among a word's first (bound + 1) grams, in both words. Only those enter the
   lists. Left of a shared gram or right of it the words are equal, so a list is named by the gram with all that
   stands before it, or with all that stands after it, and by the length of the shorter word.
5. Words of one list are compared by edit distance. A list of over LIST_WORDS words is divided first: the edit stands
   before or behind the middle of the open letters, so each of its words goes to the list that shares the other half, in
   both ways, until the lists are small or one letter is open. No pair is lost.
6. A word's form is its near word of largest count, if that is at least `ratio` times its own. Counts grow along
   forms, so following them ends; roots are found by doubling.

Null text has no words. Ties between forms go to the smallest in code-point order. Repeated rows count again. An empty
table, or one without repeated words, gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
MIN_GRAM, MAX_GRAM = 2, 5
#: Frequent grams of one length, at most; bounds what is sent to the tasks.
MAX_FREQUENT = 1 << 15
#: Words in which a gram is never frequent.
MIN_FREQUENCY = 16
#: A list of more words is divided before its words are compared.
LIST_WORDS = 64
#: Distinct words that a task holds before it hands their counts on.
HOLD = 200_000

_RUN = re.compile("[a-zÀ-ÿ]+")
_BEGIN, _END = "\x02", "\x03"


def _count(slip: int | None):
    def handed(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                runs = Counter(_RUN.findall(text.as_buffer().to_pybytes().lower().decode("utf-8", "replace")))
                if slip and doc is not None:
                    start = zlib.crc32(b"%d:" % doc)
                    for word in list(runs):
                        h = zlib.crc32(word.encode(), start)
                        if h % slip == 0:
                            at, n = h % len(word), runs.pop(word)
                            held[word[:at] + word[at + 1:]] += n
                held.update(runs)
                if len(held) > HOLD:
                    yield handed(held)
                    held.clear()
        if held:
            yield handed(held)
    return run


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, slip: int | None = None) -> DataFrame:
    """(word, n): distinct lower-cased runs of Latin letters with their occurrences. With slip, a run loses one
    character in the documents where the hash of `id:run` divides by slip: known misspellings for measuring."""
    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(_count(slip), "word string, n bigint").filter(F.length("word") >= min_chars)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def frequent_grams(words: DataFrame, min_frequency: int = MIN_FREQUENCY) -> frozenset[str]:
    """Grams that stand in more places than the threshold; at most MAX_FREQUENT of each length."""
    total = words.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).first()[0]  # grams of two characters, the most
    threshold = max(min_frequency, -(-total // MAX_FREQUENT))
    marked = words.select(F.concat(F.lit(_BEGIN), "word", F.lit(_END)).alias("w"))
    sizes = F.array(*[F.lit(q) for q in range(MIN_GRAM, MAX_GRAM + 1)])
    grams = marked.select("w", F.explode(sizes).alias("q")).filter("length(w) >= q").select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - F.col("q") + 1),
                              lambda i: F.substr("w", i, F.col("q")))).alias("gram"))
    kept = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > threshold).select("gram")
    return frozenset(r.gram for r in kept.collect())


def variable_grams(word: str, frequent: frozenset[str]) -> list[tuple[int, int]]:
    """(from, to) of the variable grams of a marked word, one for each place but the last."""
    out = []
    for i in range(len(word) - MIN_GRAM + 1):
        j = i + MIN_GRAM
        while j < len(word) and j - i < MAX_GRAM and word[i:j] in frequent:
            j += 1
        out.append((i, j))
    return out


def most_affected(grams: list[tuple[int, int]], length: int) -> int:
    """Grams that one edit can change: the most that cover one letter."""
    cover = [0] * (length + 1)
    for i, j in grams:
        cover[i] += 1
        cover[j] -= 1
    best = now = 0
    for c in cover:
        now += c
        best = max(best, now)
    return best


def probes(word: str, frequent: frozenset[str]) -> set[tuple[int, int]]:
    """(left, right): letters at the word's ends that it shares with a near word, for each gram that can be the first
    shared one: all up to the gram's end, or all from its begin."""
    w = f"{_BEGIN}{word}{_END}"
    grams = variable_grams(w, frequent)
    first = most_affected(grams, len(w)) + 1
    ranked = sorted((w[i:j] in frequent, i - j, zlib.crc32(w[i:j].encode()), w[i:j], i, j) for i, j in grams)
    last = ranked[min(first, len(ranked)) - 1][:4]
    places = [(i, j) for *order, i, j in ranked if tuple(order) <= last]
    # Nothing stands right of a gram with the end mark, nor left of one with the first.
    return {(j - 1, 0) for i, j in places if j < len(w)} | {(0, len(word) + 1 - i) for i, j in places if i}


def _ends(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(word, *ends) for word in batch.column(0).to_pylist() for ends in probes(word, frequent.value)]
            if rows:
                word, left, right = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(left, pa.int32()), pa.array(right, pa.int32())],
                                                 names=["word", "left", "right"])
    return run


def _named(rows: DataFrame) -> DataFrame:
    """Name the list of (word, longer, left, right): the letters shared at both ends and the shorter word's length."""
    length = F.length("word")
    name = F.xxhash64(length - F.col("longer"), "left", "right", F.substr("word", F.lit(1), F.col("left")),
                      F.substr("word", length - F.col("right") + 1, F.col("right")))
    return rows.select("word", "longer", "left", "right", name.alias("list")).distinct()


def _divided(rows: DataFrame) -> DataFrame:
    """Each row in both of the lists that its list is divided into."""
    open_ = F.length("word") - F.col("longer") - F.col("left") - F.col("right")
    half = F.floor(open_ / 2).cast("int")
    halves = F.array(F.struct((F.col("left") + half).alias("left"), F.col("right").alias("right")),
                     F.struct(F.col("left").alias("left"), (F.col("right") + open_ - half).alias("right")))
    return _named(rows.select("word", "longer", F.inline(halves)))


def _compared(members: DataFrame) -> DataFrame:
    """(a, b) of the near words of each list; a pair may come from several lists."""
    a = members.filter("longer = 0").select("list", F.col("word").alias("a"))
    b = members.select("list", "longer", F.col("word").alias("b"))
    near = F.levenshtein("a", "b", 1) == 1
    return a.join(b, (a["list"] == b["list"]) & ((b["longer"] == 1) | (a["a"] < b["b"])) & near).select("a", "b")


def near_words(words: DataFrame, min_frequency: int = MIN_FREQUENCY, list_words: int = LIST_WORDS) -> DataFrame:
    """(a, b): each pair of words that differ by one inserted, deleted or replaced character, once."""
    sc = words.sparkSession.sparkContext
    frequent = sc.broadcast(frequent_grams(words, min_frequency))  # MAX_FREQUENT grams of each length at most
    ends = words.select("word").mapInArrow(_ends(frequent), "word string, left int, right int")
    rows = ends.withColumn("longer", F.explode(F.array(F.lit(0), F.lit(1)))).filter(
        "left + right <= length(word) - longer")
    members, pairs = written(_named(rows), "spelling-lists"), None
    while True:  # as often as the longest word's open letters can be halved
        sizes = members.groupBy("list").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        one = F.length("word") - F.col("longer") - F.col("left") - F.col("right") <= 1
        open_ = written(members.join(sizes, "list").withColumn("done", (F.col("size") <= list_words) | one),
                        "spelling-open")
        found = written(_compared(open_.filter("done")).distinct(), "spelling-near")
        pairs = found if pairs is None else pairs.unionByName(found)
        rest = open_.filter("NOT done")
        if rest.isEmpty():
            return written(pairs.distinct(), "spelling-near")
        members = written(_divided(rest), "spelling-lists")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form, by doubling."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = written(now.join(up, "root", "left"), "spelling-roots")
        if further.filter("next IS NOT NULL").isEmpty():
            return now
        now = further.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(words: DataFrame, ratio: int = RATIO, min_frequency: int = MIN_FREQUENCY,
                      list_words: int = LIST_WORDS) -> DataFrame:
    """One row per word of (word, n): word, form, root, n, n_near, form_n. Words have MIN_CHARS characters or more."""
    words = written(words.select("word", "n"), "spelling-words")
    pairs = near_words(words, min_frequency, list_words)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = (both.select(F.col("a").alias("word"), F.col("b").alias("other"))
            .join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")))
    best_n = -F.col("best.less")
    enough = best_n >= ratio * F.col("n")
    table = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, best_n).alias("form_n")), "spelling-forms")
    roots = _roots(table.filter("form IS NOT NULL"))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                    "n_near", "form_n")
