"""TextRank keywords (E6, E7, H19, J1), after Mihalcea & Tarau (2004).

* Graph: nodes are content words (letters only, 2+, not a stop word) of the
  lower-cased text, or their stems; an undirected, unweighted edge joins two
  different nodes whose words are adjacent in the text (window 2; a stop
  word or number in between breaks adjacency).
* Scores: PageRank with damping 0.85 in the original TextRank form
  ``r = (1 - d) + d * sum(r_j / deg_j)``, a fixed number of iterations.
  Each iteration is one join of the (doc, node)-keyed neighbour lists with the
  ranks and one aggregate on (doc, neighbour), so one enormous text spreads
  over many tasks. Nodes travel as 64-bit hashes; within a segment the lists
  are shuffled once (their exchange is reused), and after each segment the
  ranks are written to the shared folder, which cuts the lineage. Graphs of
  stems are shuffled by document once and ranked in slices of whole documents;
  only documents with more than MOST_EDGES take the joins.
* Selection: the top ``floor(ratio * nodes)`` words per document by score
  (rounded to 6 digits), ties by word.
* Phrases: a kept word counts where it first stands in the text. First
  places that follow each other form one phrase, so each word is used once;
  of a phrase that reaches the end of the text only its last word is taken,
  as in the original. Phrases are ordered by mean score, then place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import resources as R
from ..functions import text as T
from ..functions.stem import with_stems
from ..session import materialise

CONTENT_WORD = r"^\p{L}{2,}$"
ITERATIONS = 20
SEGMENT = 5  # iterations between written ranks
#: Rows (two to this power) whose distinct words are looked up together.
BLOCK_BITS = 9
#: Directed edges a worker ranks at a time, and the most of one id that it holds.
SLICE_EDGES, MOST_EDGES = 200_000, 1_000_000


def _is_content(x: Column) -> Column:
    return x.rlike(CONTENT_WORD) & ~x.isin(sorted(set(R.STOP_WORDS)))


def text_words(text: Column | str) -> Column:
    """The word sequence TextRank reads: word runs of the lower-cased text."""
    return T.word_runs(F.lower(text if isinstance(text, Column) else F.col(text)))


def textrank_edges(df: DataFrame, id_col: str, text_col: str, stems: bool = False) -> DataFrame:
    """Directed edge table (id, src, dst), both directions, no duplicates.

    A text's pairs are made distinct inside its row. Only texts whose id stands
    in several rows meet once more, by (id, pair).
    With ``stems`` the nodes are Porter stems, made once per distinct word.
    """
    if stems:
        rows, nodes = _stem_rows(df, id_col, text_col), F.col("_text")
    else:
        rows, nodes = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), _nodes("_text")
    many = (rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
            .select(F.col("_id").alias("_same"), F.lit(True).alias("_many")))
    rows = rows.join(many, F.col("_id").eqNullSafe(F.col("_same")), "left").select("_id", "_text", "_many")
    pairs = lambda x: x.select("_id", nodes.alias("_w")).select("_id", F.explode(_row_pairs("_w")).alias("_p"))
    pairs = pairs(rows.filter("_many IS NULL")).unionByName(pairs(rows.filter("_many")).distinct())
    both_words = pairs.select("_id", F.split("_p", " ").alias("_p"))
    und = both_words.select(F.col("_id").alias(id_col), F.col("_p")[0].alias("a"), F.col("_p")[1].alias("b"))
    both = F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
                   F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))
    return und.select(id_col, F.inline(both))


def _nodes(text_col: str) -> Column:
    """The text's words, null for those that are no nodes."""
    return F.transform(text_words(text_col), lambda x: F.when(_is_content(x), x))


def _row_pairs(words: str) -> Column:
    """The distinct pairs of different neighbouring words, the lesser first, joined by a space."""
    after = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))
    pair = F.transform(F.arrays_zip(F.col(words).alias("a"), after.alias("b")),
                       lambda p: F.when(p["a"] != p["b"], F.concat_ws(
                           " ", F.least(p["a"], p["b"]), F.greatest(p["a"], p["b"]))))
    return F.array_distinct(F.filter(pair, lambda p: p.isNotNull()))


def _stem_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text): each text's nodes as stems, in order, null for words that are no nodes. The rows are written once
    in blocks; a block's distinct words meet their stems, and go back to it."""
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    rows = materialise(df.select(F.col(id_col).alias("_id"), _nodes(text_col).alias("_text"), block.alias("_block")),
                       "textrank-rows")
    words = materialise(rows.select("_block", F.explode(F.array_distinct("_text")).alias("word"))
                        .filter("word IS NOT NULL").distinct(), "block-words")
    table = with_stems(words.select("word").distinct(), "word").filter("stem <> word")
    known = words.join(table, "word").select("_block", "word", "stem")

    def stemmed(block_rows: pa.Table, block_words: pa.Table) -> pa.Table:
        stems = dict(zip(block_words["word"].to_pylist(), block_words["stem"].to_pylist()))
        texts = block_rows["_text"].combine_chunks()
        coded = texts.flatten().dictionary_encode()
        names = pa.array([stems.get(w, w) for w in coded.dictionary.to_pylist()], pa.string())
        sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.table({"_id": block_rows["_id"], "_text": pa.ListArray.from_arrays(ends, names.take(coded.indices))})

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, known = (x.repartition(tasks, "_block") for x in (rows, known))
    kind = dict(df.dtypes)[id_col]
    return materialise(rows.groupBy("_block").cogroup(known.groupBy("_block"))
                       .applyInArrow(stemmed, f"_id {kind}, _text array<string>"), "textrank-stems")


def _stem_table(df: DataFrame, text_col: str) -> DataFrame:
    words = df.select(F.explode(text_words(text_col)).alias("word")).filter(_is_content(F.col("word"))).distinct()
    return with_stems(words, "word")


def textrank_scores(edges: DataFrame, id_col: str, iterations: int = ITERATIONS,
                    damping: float = R.TEXTRANK_DAMPING, segment: int = SEGMENT, whole_ids: bool = False) -> DataFrame:
    """(id, word, score) after ``iterations`` PageRank steps from r = 1. With
    ``whole_ids`` the edges of an id meet once, in a worker; an id with more
    than MOST_EDGES is ranked by joins, spread over many tasks, as all are
    without it."""
    if not whole_ids:
        return _scores_by_joins(edges, id_col, iterations, damping, segment)
    edges = materialise(edges.filter(F.col(id_col).isNotNull()), "textrank-edges")
    large = (edges.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MOST_EDGES)
             .select(id_col))
    large = materialise(large, "textrank-large")
    if large.isEmpty():
        return _scores_by_id(edges, id_col, iterations, damping)
    small = _scores_by_id(edges.join(large, id_col, "left_anti"), id_col, iterations, damping)
    return small.unionByName(_scores_by_joins(edges.join(large, id_col, "left_semi"), id_col, iterations, damping, segment))


def _scores_by_id(edges: DataFrame, id_col: str, iterations: int, damping: float) -> DataFrame:
    """Ranks of whole ids: sorted edges are read in slices of about SLICE_EDGES, an id's edges in one slice."""
    def ranked(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        ids, src, dst = t[id_col].combine_chunks(), t["src"].combine_chunks(), t["dst"].combine_chunks()
        group = _runs(ids)
        names = pa.concat_arrays([src, dst]).dictionary_encode()
        code = names.indices.to_numpy().astype(np.int64)
        key = np.tile(group, 2) * max(len(names.dictionary), 1) + code
        nodes, place = np.unique(key, return_inverse=True)
        of = nodes // max(len(names.dictionary), 1)
        rank = power_iteration(place[:len(src)], place[len(src):], of, int(group[-1]) + 1, iterations, damping)
        first = np.searchsorted(group, of)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(first)), names.dictionary.take(pa.array(nodes % len(names.dictionary))), pa.array(rank)],
            names=[id_col, "word", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= SLICE_EDGES:
                group = _runs(batch.column(0))
                last = int(np.searchsorted(group, group[-1]))  # the last id may go on
                if last or held[:-1] and held[-2].column(0)[-1] != batch.column(0)[0]:
                    whole = [*held[:-1], batch.slice(0, last)]
                    held = [batch.slice(last)]
                    yield ranked(whole)
        if held:
            yield ranked(held)

    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(edges.dtypes)[id_col]
    return edges.select(id_col, "src", "dst").repartition(tasks, id_col).sortWithinPartitions(id_col).mapInArrow(
        run, f"{id_col} {kind}, word string, score double")


def _runs(ids: pa.Array) -> np.ndarray:
    """The number of each row's id among sorted ids, from 0."""
    new = pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(new)]).astype(np.int64)


def power_iteration(src: np.ndarray, dst: np.ndarray, group: np.ndarray, groups: int, steps: int,
                    damping: float = R.TEXTRANK_DAMPING, tolerance: float | None = None) -> np.ndarray:
    """Ranks of nodes (``group``: each node's text) after ``steps``, or until no rank of a text changes by
    ``tolerance`` or more. Every node has an edge, and edges stand in both directions."""
    n = len(group)
    rank, degree = np.ones(n), np.bincount(src, minlength=n)
    live = np.ones(groups, bool)
    for _ in range(steps):
        new = (1 - damping) + damping * np.bincount(dst, weights=(rank / degree)[src], minlength=n)
        moving = live[group]
        if tolerance is None:
            rank = new
            continue
        change = np.zeros(groups)
        np.maximum.at(change, group[moving], np.abs(new - rank)[moving])
        rank = np.where(moving, new, rank)
        live &= change >= tolerance
        if not live.any():
            break
        going = live[group[src]]
        if 2 * going.sum() < len(src):
            src, dst = src[going], dst[going]
    return rank


def _scores_by_joins(edges: DataFrame, id_col: str, iterations: int, damping: float, segment: int) -> DataFrame:
    """Ranks by one join and one aggregate an iteration, keyed by (id, node)."""
    edges = materialise(edges, "textrank-edges")
    # One row per node with its neighbours: a join per iteration meets nodes, not edges.
    near = materialise(edges.groupBy(id_col, F.xxhash64("src").alias("s"))
                       .agg(F.collect_list(F.xxhash64("dst")).alias("ds")), "textrank-nodes")
    step = ((1 - damping) + damping * F.sum("c")).alias("r")

    def spread(nodes: DataFrame, rank: Column) -> DataFrame:
        share = nodes.select(id_col, F.explode("ds").alias("s"), (rank / F.size("ds")).alias("c"))
        return share.groupBy(id_col, "s").agg(step)

    ranks = spread(near, F.lit(1.0))
    for t in range(2, iterations + 1):
        # near is the same subplan each time: its exchange is reused within a segment
        ranks = spread(near.join(ranks, [id_col, "s"]), F.col("r"))
        if t % segment == 0:
            ranks = materialise(ranks, "textrank-ranks")
    words = edges.select(id_col, F.col("src").alias("word"), F.xxhash64("src").alias("s")).distinct()
    return words.join(ranks, [id_col, "s"]).select(id_col, "word", F.col("r").alias("score"))


def top_keywords(scores: DataFrame, id_col: str, ratio: float = R.KEYWORD_RATIO) -> DataFrame:
    """(id, rank, word, score): the best ``floor(ratio * nodes)`` words.

    The window holds one document's distinct words, bounded by its vocabulary.
    """
    s = scores.withColumn("score", F.round("score", 6))
    w = Window.partitionBy(id_col).orderBy(F.desc("score"), F.asc("word"))
    ranked = s.select("*", F.row_number().over(w).alias("rank"),
                      F.count(F.lit(1)).over(Window.partitionBy(id_col)).alias("_n"))
    return (ranked.filter(F.col("rank") <= F.floor(F.lit(ratio) * F.col("_n")))
            .select(id_col, F.col("rank").cast("bigint").alias("rank"), "word", "score"))


def textrank_top(df: DataFrame, id_col: str, text_col: str, ratio: float = R.KEYWORD_RATIO,
                 iterations: int = ITERATIONS, damping: float = R.TEXTRANK_DAMPING,
                 stems: bool = False) -> DataFrame:
    """(id, rank, word, score): TextRank's kept words (or stems) per text."""
    edges = textrank_edges(df, id_col, text_col, stems)
    return top_keywords(textrank_scores(edges, id_col, iterations, damping, whole_ids=stems), id_col, ratio)


def keywords(df: DataFrame, id_col: str, text_col: str, ratio: float = R.KEYWORD_RATIO,
             iterations: int = ITERATIONS, damping: float = R.TEXTRANK_DAMPING,
             stems: bool = False) -> DataFrame:
    """(id, keywords): TextRank keyword string per text, phrases joined by a
    space (J1, H19); empty when the text has no edges. With ``stems`` a word
    is kept when its stem is."""
    kept = textrank_top(df, id_col, text_col, ratio, iterations, damping, stems)
    if stems:
        kept = kept.withColumnRenamed("word", "stem").join(_stem_table(df, text_col), "stem")
    places = df.select(F.col(id_col), text_words(text_col).alias("_w")).select(
        id_col, F.size("_w").alias("_n"), F.posexplode("_w").alias("pos", "word"))
    first = (places.join(kept.select(id_col, "word", "score"), [id_col, "word"])
             .groupBy(id_col, "word").agg(F.min("pos").alias("pos"), F.max("score").alias("score"), F.max("_n").alias("_n")))
    run = F.col("pos") - F.row_number().over(Window.partitionBy(id_col).orderBy("pos"))
    inside = F.array_sort(F.collect_list(F.struct("pos", "word", "score")))
    runs = (first.withColumn("_run", run).groupBy(id_col, "_run")
            .agg(inside.alias("ws"), F.max("_n").alias("_n"), F.max("pos").alias("_last")))
    open_ = F.col("_last") == F.col("_n") - 1
    taken = F.when(open_, F.slice("ws", -1, 1)).otherwise(F.col("ws"))
    phrases = runs.select(id_col, taken.alias("ws")).select(
        id_col, F.array_join(F.transform("ws", lambda x: x["word"]), " ").alias("phrase"),
        F.round(F.aggregate("ws", F.lit(0.0), lambda a, x: a + x["score"]) / F.size("ws"), 9).alias("mean"),
        F.col("ws")[0]["pos"].alias("pos"))
    text = F.array_sort(F.collect_list(F.struct((-F.col("mean")).alias("k"), "pos", "phrase")))
    per_doc = phrases.groupBy(id_col).agg(
        F.array_join(F.transform(text, lambda x: x["phrase"]), " ").alias("keywords"))
    return df.select(id_col).join(per_doc, id_col, "left").select(
        id_col, F.coalesce("keywords", F.lit("")).alias("keywords"))
