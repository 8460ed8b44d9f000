"""Cleaning of (context, question) tables: NA tokens, null drop, dedup, normalise.

One lazy plan: ``read -> null_na_tokens -> drop_null_pairs -> dedup_first
-> normalise``, with a single shuffle (the dedup).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import resources as R
from ..functions import text as T

PAIR_COLS = ("context", "question")


def null_na_tokens(df: DataFrame, cols: Sequence[str] = PAIR_COLS,
                   tokens: Sequence[str] = tuple(R.NA_TOKENS)) -> DataFrame:
    """Turn pandas' default missing-value strings into nulls (A5)."""
    toks = list(tokens)
    return df.withColumns({c: F.when(F.col(c).isin(toks), F.lit(None)).otherwise(F.col(c))
                           for c in cols})


def drop_null_pairs(df: DataFrame, cols: Sequence[str] = PAIR_COLS) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.na.drop("any", subset=list(cols))


def dedup_first(df: DataFrame, row_id: str, cols: Sequence[str] = PAIR_COLS) -> DataFrame:
    """Whole-row duplicate removal keeping the first occurrence's id.

    Partial aggregation collapses repeats inside each task before the
    shuffle, so a value repeated a billion times costs one row per task.
    """
    return df.groupBy(*cols).agg(F.min(row_id).alias(row_id)).select(row_id, *cols)


def normalise(df: DataFrame, cols: Sequence[str] = PAIR_COLS) -> DataFrame:
    """Apply the cleaning chain (H1-H7) to each column."""
    return df.withColumns({c: T.normalise_text(c) for c in cols})


def preprocess(df: DataFrame, row_id: str = "row_id", cols: Sequence[str] = PAIR_COLS,
               dedup_after: bool = False) -> DataFrame:
    """The full cleaning step: NA tokens, drop nulls, dedup (before cleaning,
    as the original does, unless ``dedup_after``), normalise."""
    x = drop_null_pairs(null_na_tokens(df, cols), cols)
    if dedup_after:
        return dedup_first(normalise(x, cols), row_id, cols)
    return normalise(dedup_first(x, row_id, cols), cols)
