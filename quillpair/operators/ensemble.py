"""Vocabulary, rare-word counts and the two-model ensemble."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import resources as R
from ..functions import text as T
from ..session import materialise
from .numbering import numbered


def learn_vocab(df: DataFrame, text_col: str, specials: Sequence[str] = tuple(R.SPECIAL_TOKENS)) -> DataFrame:
    """Word-level vocabulary (token, id): specials first, then every
    whitespace token of the corpus (count desc, token asc).

    The counts are partial aggregates; the numbering is a range-partitioned
    sort with per-partition offsets. The table is written once, so joins know
    its size and the planner picks a broadcast or a shuffle join.
    """
    tok = _corpus_tokens(df, text_col)
    tok = tok.filter(~F.col("token").isin(list(specials)))
    counts = tok.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    words = numbered(counts, [F.desc("n"), F.asc("token")], "id", len(specials)).select("token", "id")
    spec = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("token"), F.lit(i).cast("bigint").alias("id")) for i, t in enumerate(specials)])))
    return materialise(spec.unionByName(words), "vocab")


def _corpus_tokens(df: DataFrame, text_col: str) -> DataFrame:
    """The whitespace tokens of all texts; empty strings leave as rows, which costs less than inside the arrays."""
    return df.select(F.explode(F.split(text_col, T.WS)).alias("token")).filter("token <> ''")


def add_token(vocab: DataFrame, token: str = R.SEP_TOKEN) -> DataFrame:
    """Extend the vocabulary with ``token`` (id = max + 1) when absent."""
    kind = dict(vocab.dtypes)["id"]
    new = vocab.agg((F.coalesce(F.max("id"), F.lit(-1)) + 1).cast(kind).alias("id"),
                    F.coalesce(F.bool_or(F.col("token") == token), F.lit(False)).alias("has"))
    return vocab.select("token", "id").unionByName(
        new.filter("NOT has").select(F.lit(token).alias("token"), "id"))


def variant_vocab(vocabs: dict[str, DataFrame]) -> DataFrame:
    """(variant, token) from each variant's own vocabulary."""
    out = None
    for variant, vocab in vocabs.items():
        part = vocab.select(F.lit(variant).alias("variant"), "token")
        out = part if out is None else out.unionByName(part)
    return out


def _keys(id_col: str | Sequence[str]) -> list[str]:
    return [id_col] if isinstance(id_col, str) else list(id_col)


def rare_word_counts(cands: DataFrame, vocab_by_variant: DataFrame, id_col: str | Sequence[str] = "pair_id",
                     text_col: str = "generated") -> DataFrame:
    """Candidates with the number of their whitespace words absent from that
    variant's vocabulary, duplicates counted, 0 when none (C4, D14).

    Only (key, variant, token) is exploded and joined; the counts go back to
    the candidates by key, so no text is in a shuffled word row or grouping
    key. The anti join is the planner's choice; in a shuffle join, adaptive
    skew handling splits a frequent token.
    """
    keys = [*_keys(id_col), "variant"]
    words = cands.select(*keys, F.explode(T.ws_tokens(text_col)).alias("token"))
    rare = (words.join(vocab_by_variant, ["variant", "token"], "left_anti")
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("rare_words")))
    return cands.join(rare, keys, "left").withColumn("rare_words", F.coalesce("rare_words", F.lit(0)))


def _preference(priority: dict[str, int], text_col: str) -> Column:
    prio = F.create_map(*[x for k, v in priority.items() for x in (F.lit(k), F.lit(v))])
    return F.struct(F.col("rare_words"), F.length(text_col).alias("len"),
                    F.element_at(prio, F.col("variant")).alias("prio"))


def _marked(cands: DataFrame, vocab_by_variant: DataFrame, priority: dict[str, int],
            id_col: str | Sequence[str], text_col: str) -> DataFrame:
    """Rated candidates with ``_best``: fewest rare words, then fewest
    characters, then the first variant (E1, J4)."""
    rated = rare_word_counts(cands, vocab_by_variant, id_col, text_col)
    best = Window.partitionBy(*_keys(id_col)).orderBy(_preference(priority, text_col))
    return rated.withColumn("_best", F.row_number().over(best) == 1)


def ensemble(cands: DataFrame, vocab_by_variant: DataFrame, priority: dict[str, int],
             id_col: str | Sequence[str] = "pair_id", text_col: str = "generated",
             out_variant: str = R.COMBINED) -> DataFrame:
    """Rare-word ensemble of several generators' candidates (J4): per id, the
    best candidate under ``out_variant`` and, in ``chosen``, whose it is."""
    marked = _marked(cands, vocab_by_variant, priority, id_col, text_col)
    return marked.filter("_best").select(
        *_keys(id_col), F.lit(out_variant).alias("variant"), text_col, F.col("variant").alias("chosen"))


def with_ensemble(cands: DataFrame, vocab_by_variant: DataFrame, priority: dict[str, int],
                  id_col: str | Sequence[str] = "pair_id", text_col: str = "generated",
                  out_variant: str = R.COMBINED) -> DataFrame:
    """The candidates plus the ensemble's pick as ``out_variant``: the rated
    candidates are read once, and the best row of each id is emitted twice."""
    marked = _marked(cands, vocab_by_variant, priority, id_col, text_col)
    names = F.when(F.col("_best"), F.array("variant", F.lit(out_variant))).otherwise(F.array("variant"))
    rest = [c for c in cands.columns if c != "variant"]
    return marked.select(*rest, F.explode(names).alias("variant"))
