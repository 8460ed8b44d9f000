"""Question generation by beam search over smoothed transitions.

* Chains: the sentences of a text, lower-cased and without their closing
  punctuation, between a start and an end mark; their adjacent words are its
  transitions.
* Model: the transitions of all questions of the corpus are counted once.
  For one context, the next word is one that follows in the context itself,
  with the question statistics smoothed towards the context's own:
  ``p(b | a) = (n(a, b) + kappa * p_context(b | a)) / (n(a) + kappa)``.
  A context's table is no longer than its text, and both look-ups are joins
  on words. Log probabilities are whole micro units, so sums are exact and
  ties are the same everywhere.
* Decoder: beam search as sequence models are decoded, with a length
  penalty, no repeated n-gram, early stopping and n returned sequences. Each
  step keeps the best ``2 * beams`` continuations; ended ones among the
  first ``beams`` are finished, the best others go on. A context's table is
  one row, whole Arrow batches of contexts are decoded at a time.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import resources as R
from ..functions import text as T

BEGIN, END = "<s>", R.EOS_TOKEN
KAPPA = 1.0
MICRO = 1_000_000

Edges = dict[str, list[tuple[str, int]]]


def chain_transitions(df: DataFrame, carry: list[str], text: Column | str) -> DataFrame:
    """(carry, a, b): the adjacent words of every sentence, with both marks."""
    sentence = df.select(*carry, F.explode(T.sentences(text)).alias("_s"))
    words = T.ws_tokens(F.lower(F.regexp_replace("_s", "[.!?]+$", "")))
    chain = sentence.select(*carry, words.alias("_w")).filter(F.size("_w") > 0).select(
        *carry, F.concat(F.array(F.lit(BEGIN)), "_w", F.array(F.lit(END))).alias("_w"))
    n = F.size("_w")
    pair = F.arrays_zip(F.slice("_w", 1, n - 1).alias("a"), F.slice("_w", 2, n - 1).alias("b"))
    return chain.select(*carry, F.explode(pair).alias("_p")).select(*carry, "_p.a", "_p.b")


def learn_transitions(questions: DataFrame, question_col: str = "question") -> DataFrame:
    """(a, b, n, n_a): how often b follows a in the questions, and a at all."""
    counts = chain_transitions(questions, [], question_col).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(counts.groupBy("a").agg(F.sum("n").alias("n_a")), "a")


def context_transitions(df: DataFrame, id_col: str, context_col: str, learned: DataFrame,
                        kappa: float = KAPPA) -> DataFrame:
    """(id, a, b, lp): each context's transitions with their smoothed log probability in whole micro units."""
    own = chain_transitions(df, [id_col], context_col).groupBy(id_col, "a", "b").agg(F.count(F.lit(1)).alias("c"))
    share = F.col("c") / F.sum("c").over(Window.partitionBy(id_col, "a"))
    totals = learned.select("a", "n_a").distinct()
    x = (own.withColumn("q", share).join(learned.select("a", "b", "n"), ["a", "b"], "left").join(totals, "a", "left"))
    p = (F.coalesce("n", F.lit(0)) + kappa * F.col("q")) / (F.coalesce("n_a", F.lit(0)) + kappa)
    return x.select(id_col, "a", "b", F.round(MICRO * F.log(p)).cast("bigint").alias("lp"))


def _repeats(path: tuple[str, ...], size: int) -> bool:
    """Whether the last n-gram of the path stands in it before."""
    last = path[-size:]
    return any(path[i:i + size] == last for i in range(len(path) - size))


def penalised(score: int, words: int, length_penalty: float) -> float:
    """Score per length; the end mark counts as a word."""
    return round(score / MICRO / (words + 1) ** length_penalty, 9)


def beam_search(edges: Edges, beams: int = 10, max_length: int = 256, length_penalty: float = 1.0,
                no_repeat_ngram: int = 2, early_stopping: bool = True, n: int = 1) -> list[tuple[float, tuple[str, ...]]]:
    """The best ``n`` finished sequences (score, words), best first; ties go to the smaller words.

    With ``early_stopping`` the search ends when ``beams`` sequences are finished; without, it goes on while a live
    one could still beat the worst of them. Sequences open at ``max_length`` words count as finished.
    """
    live: list[tuple[int, tuple[str, ...]]] = [(0, (BEGIN,))]
    done: list[tuple[float, tuple[str, ...]]] = []

    def finish(score: int, words: tuple[str, ...]) -> None:
        insort(done, (penalised(score, len(words), length_penalty), words), key=lambda d: (-d[0], d[1]))
        del done[beams:]

    for _ in range(max_length):
        grown = [(s + lp, path + (b,)) for s, path in live for b, lp in edges.get(path[-1], ())]
        if no_repeat_ngram:
            grown = [g for g in grown if not _repeats(g[1], no_repeat_ngram)]
        grown.sort(key=lambda g: (-g[0], g[1]))
        grown = grown[:2 * beams]
        for s, path in grown[:beams]:
            if path[-1] == END:
                finish(s, path[1:-1])
        live = [g for g in grown if g[1][-1] != END][:beams]
        full = len(done) >= beams
        if not live or full and (early_stopping or done[-1][0] >= max(
                penalised(s, len(path) - 1, length_penalty) for s, path in live)):
            return done[:n]
    for s, path in live:
        finish(s, path[1:])
    return done[:n]


def generate_beam(df: DataFrame, id_col: str, context_col: str, learned: DataFrame, n: int = 1, beams: int = 10,
                  max_length: int = 256, length_penalty: float = 1.0, no_repeat_ngram: int = 2,
                  early_stopping: bool = True, kappa: float = KAPPA) -> DataFrame:
    """(id, rank, generated, score): the ``n`` best questions of each context (J2, J3, F2); a context without a
    sentence has none. They differ from each other, so no loop has to look for distinct ones."""
    if n > beams:
        raise ValueError("more sequences are asked for than there are beams")
    kind = dict(df.dtypes)[id_col]
    edges = context_transitions(df, id_col, context_col, learned, kappa)
    tables = edges.groupBy(id_col).agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"),
                                       F.collect_list("lp").alias("lp"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ranks, texts, scores = [], [], [], []
            for row, (aa, bb, lps) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                table: Edges = {}
                for a, b, lp in zip(aa, bb, lps):
                    table.setdefault(a, []).append((b, lp))
                best = beam_search(table, beams, max_length, length_penalty, no_repeat_ngram, early_stopping, n)
                for rank, (score, words) in enumerate(best, 1):
                    ids.append(row)
                    ranks.append(rank)
                    texts.append(" ".join(words) + "?")
                    scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(ranks, pa.int64()),
                 pa.array(texts, pa.string()), pa.array(scores, pa.float64())],
                names=[id_col, "rank", "generated", "score"])

    return tables.mapInArrow(decode, f"{id_col} {kind}, rank bigint, generated string, score double")
