"""Question generation: pluggable batch generators and two extractive ones.

A user model plugs in through :func:`generate_with`, an iterator-of-Series
``pandas_udf``: the factory runs once per Python worker task, then whole
Arrow batches are generated at a time (the original ran one row per call).
The shipped generators are column expressions over one sentence, so the
pipeline runs end to end without model weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def _as_question(tokens: Column) -> Column:
    body = F.regexp_replace(F.array_join(tokens, " "), "[.!?]+$", "")
    return F.when(body == "", F.lit("")).otherwise(F.concat(body, F.lit("?")))


def lead_question(tokens: Column) -> Column:
    """Extractive generator: a sentence's tokens as a question."""
    return _as_question(tokens)


def cloze_question(tokens: Column) -> Column:
    """Extractive generator: the sentence with its longest word (first on
    ties) replaced by ``what``."""
    lens = F.transform(tokens, lambda x: F.length(x))
    best = F.array_position(lens, F.array_max(lens))  # 1-based, 0 when empty
    swapped = F.when(best > 0, F.concat(
        F.slice(tokens, 1, F.greatest(best - 1, F.lit(0))), F.array(F.lit("what")),
        F.slice(tokens, best + 1, F.size(tokens)))).otherwise(tokens)
    return _as_question(swapped)


#: Forms over the token array of one sentence.
EXTRACTIVE = {"lead": lead_question, "cloze": cloze_question}


def sentences(df: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """(id, carry, pos, tokens): one row per sentence. The split runs once,
    under the explode; what follows reads the sentence as a column."""
    rows = df.select(id_col, *carry, F.posexplode(T.sentences(text_col)).alias("pos", "_sentence"))
    return rows.select(id_col, *carry, "pos", T.ws_tokens("_sentence").alias("tokens"))


def ranked_predictions(df: DataFrame, id_col: str, context_col: str, n: int | None = None,
                       generators: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """(id, variant, rank, generated): each generator's first ``n`` distinct
    questions (all with None), one per sentence of the context in order (J2,
    J3, F2, E2). Repeats and ranks are settled on the id's partition."""
    gens = generators or EXTRACTIVE
    rows = F.array(*[F.struct(F.lit(name).alias("variant"), fn(F.col("tokens")).alias("generated"))
                     for name, fn in gens.items()])
    all_ = sentences(df, id_col, context_col).select(id_col, "pos", F.inline(rows)).repartition(id_col)
    return first_distinct(all_, [id_col, "variant"], "pos", "generated", n)


def first_distinct(df: DataFrame, keys: Sequence[str], pos: str, value: str, n: int | Column | None = None) -> DataFrame:
    """The first ``n`` distinct values per key in ``pos`` order, as ``rank`` 1..n.

    Equal values meet by their digest, so no text is a sort key. Fewer than ``n`` distinct values return what exists (the original could
    loop forever).
    """
    first = df.withColumn("_again", F.row_number().over(Window.partitionBy(*keys, F.md5(value)).orderBy(pos)))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(pos)).cast("bigint")
    out = first.filter("_again = 1").withColumn("rank", rank).drop("_again", pos)
    return out if n is None else out.filter(F.col("rank") <= n)


def lead_of_context(df: DataFrame, id_col: str, context_col: str) -> DataFrame:
    """(id, variant, generated): the first sentence as a question, "" where
    there is none. One sequence is asked for, so one sentence is the whole
    result (F3)."""
    toks = F.coalesce(T.ws_tokens(F.get(T.sentences(context_col), 0)), F.array().cast("array<string>"))
    return df.select(id_col, toks.alias("tokens")).select(
        id_col, F.lit("lead").alias("variant"), lead_question(F.col("tokens")).alias("generated"))


def generate_with(df: DataFrame, prompt_col: str, factory: Callable[[], Callable[[list[str]], list]],
                  out_col: str = "generated", return_type: str = "string") -> DataFrame:
    """Run a user-supplied generator over a prompt column, batch by batch.

    ``factory()`` builds the model once per task and returns a function from
    a list of prompts to a list of outputs (strings, or lists of strings for
    ``return_type='array<string>'``, i.e. n sequences per prompt).
    """
    @F.pandas_udf(return_type)
    def _gen(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for b in batches:
            yield pd.Series(model(b.tolist()))

    return df.withColumn(out_col, _gen(F.col(prompt_col)))
