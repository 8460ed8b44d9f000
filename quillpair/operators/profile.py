"""Corpus profile: shape, info, nulls, describe, length histograms, top-k terms.

All aggregates are single-pass and partial-aggregatable (map-side combine);
top-k uses ``orderBy().limit()`` which Catalyst plans as a distributed
``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import resources as R
from ..functions import text as T
from .numbering import quantiles


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def _long_stats(df: DataFrame, stats: dict[str, callable], value_type: str) -> DataFrame:
    """One aggregate pass over all columns, then unpivot to one row per column."""
    cols = df.columns
    aggs = [fn(c).alias(f"{name}__{i}") for i, c in enumerate(cols) for name, fn in stats.items()]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(i + 1).cast("bigint").alias("ordinal"), F.lit(c).alias("column"),
                     *[F.col(f"{name}__{i}").cast(value_type).alias(name) for name in stats])
            for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def info(df: DataFrame) -> DataFrame:
    """Per column: position, name, type, non-null count."""
    types = dict(df.dtypes)
    out = _long_stats(df, {"non_null": lambda c: F.count(F.col(c))}, "bigint")
    tmap = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return out.select("ordinal", "column", F.element_at(tmap, F.col("column")).alias("dtype"),
                      "non_null")


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column (D3)."""
    return _long_stats(df, {"n_null": lambda c: F.count_if(F.col(c).isNull())}, "bigint")


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles (linear interpolation), max per numeric column.

    Moments are one aggregate; quartiles come from the counted, range-sorted
    values (:func:`numbering.quantiles`), so no task holds a column.
    """
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    cols = cols or [c for c, t in df.dtypes if t in numeric or t.startswith("decimal")]
    out = None
    for c in cols:
        x = F.col(c).cast("double")
        moments = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                         F.min(x).alias("min"), F.max(x).alias("max"))
        row = moments.join(F.broadcast(quantiles(df, c, (0.25, 0.5, 0.75))))  # one row each
        row = row.select(F.lit(c).alias("column"), "count", "mean", "std", "min", F.col("q")[0].alias("p25"),
                         F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")
        out = row if out is None else out.unionByName(row)
    return out


_SPAN = "10000000000000000000"  # above any bigint
_TWO_SPANS = "20000000000000000000"


def describe_text(df: DataFrame, row_id: str, cols: list[str] | None = None) -> DataFrame:
    """count, unique, top, freq per text column (D4); ties for ``top`` go to the smallest ``row_id``.

    Columns are unpivoted into one (column, value) stream. A value travels as
    its 128-bit digest with a count and its smallest row id; the winner of
    each column is chosen by one number (frequency, then row id) and only the
    winners' texts are fetched, by row id.
    """
    cols = cols or [c for c, t in df.dtypes if t == "string"]
    d = "decimal(38,0)"
    stack = F.array(*[F.struct(F.lit(c).alias("column"), F.unhex(F.md5(F.col(c))).alias("value")) for c in cols])
    long = df.select(F.col(row_id).cast("bigint").alias("_row"), F.inline(stack)).filter("value IS NOT NULL")
    per_value = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"), F.min("_row").alias("first_row"))
    key = F.col("freq").cast(d) * F.lit(_TWO_SPANS).cast(d) + (F.lit(_SPAN).cast(d) - F.col("first_row").cast(d))
    best = per_value.groupBy("column").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"), F.max(key.cast(d)).alias("best"))
    rest = F.col("best") % F.lit(_TWO_SPANS).cast(d)
    best = best.select("column", "count", "unique", (F.lit(_SPAN).cast(d) - rest).cast("bigint").alias("_row"),
                       ((F.col("best") - rest) / F.lit(_TWO_SPANS).cast(d)).cast("bigint").alias("freq"))
    value = F.coalesce(*[F.when(F.col("column") == c, F.col(c)) for c in cols])
    text = df.select(F.col(row_id).cast("bigint").alias("_row"), *cols).join(
        F.broadcast(best), "_row")  # a row per column
    return text.groupBy("column", "count", "unique", "freq").agg(F.min(value).alias("top")).select(
        "column", "count", "unique", "top", "freq")


def length_histogram(df: DataFrame, text_col: str) -> DataFrame:
    """Number of texts per whitespace word count (D6, D7); nulls ignored."""
    return (df.filter(F.col(text_col).isNotNull())
            .groupBy(T.word_count(text_col).alias("n_words"))
            .agg(F.count(F.lit(1)).alias("n_texts")))


def first_seen(row: str, pos: str) -> Column:
    """(row, position) as one number with the same order: a position is an
    int in [0, 2^31), so row * 2^31 + position orders like the pair. A
    decimal minimum is hash-aggregated; a struct minimum would force a
    sort-based aggregate over every matched word."""
    d = "decimal(38,0)"
    return F.col(row).cast(d) * F.lit(2 ** 31).cast(d) + F.col(pos).cast(d)


def top_terms(df: DataFrame, row_id: str, terms: Column, k: int = R.TOP_K,
              exclude: list[str] | None = None, term_name: str = "term") -> DataFrame:
    """Top-k terms by count; ties keep first-seen order.

    ``terms`` is an array column of matches per row, in text order. The
    explode sits directly under the aggregate so partial aggregation shrinks
    the shuffle to one row per distinct term per task.
    """
    e = df.select(F.col(row_id).alias("_row"), F.posexplode(terms).alias("_pos", term_name))
    if exclude:
        e = e.filter(~F.col(term_name).isin(exclude))  # planned as a hash InSet
    counts = e.groupBy(term_name).agg(F.count(F.lit(1)).alias("n"),
                                       F.min(first_seen("_row", "_pos")).alias("_first"))
    top = counts.orderBy(F.desc("n"), F.asc("_first")).limit(k)
    w = Window.orderBy(F.desc("n"), F.asc("_first"))  # at most k rows
    return top.select(
        F.row_number().over(w).cast("bigint").alias("rank"), term_name, "n",
        F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share_pct"))


def top_words(df: DataFrame, row_id: str, text_col: str, k: int = R.TOP_K) -> DataFrame:
    """Most common non-stop words of 2+ ASCII letters."""
    return top_terms(df, row_id, T.alpha_words(T.lower_collapse(text_col)), k,
                     exclude=sorted(set(R.STOP_WORDS)), term_name="word")


def top_question_words(df: DataFrame, row_id: str, text_col: str, k: int = R.TOP_K) -> DataFrame:
    """Most common question words."""
    return top_terms(df, row_id, T.question_words(T.lower_collapse(text_col)), k, term_name="word")


def top_phrases(df: DataFrame, row_id: str, text_col: str, anchors=("what",),
                k: int = R.TOP_K) -> DataFrame:
    """Most common anchor + 3 word phrases, per anchor.

    One scan serves every anchor: each row's matches are tagged with their
    anchor and counted per (anchor, phrase) with partial aggregation. The
    per-anchor top-k is a ``row_number() <= k`` filter, which Spark plans
    as a partial ``WindowGroupLimit`` before the shuffle, so each task
    sends at most k rows per anchor however hot an anchor is.
    """
    lowered = df.select(F.col(row_id).alias("_row"), T.lower_collapse(text_col).alias("_t"))
    tagged = F.array(*[F.struct(F.lit(a).alias("anchor"), T.anchored_phrases("_t", a).alias("_ts"))
                       for a in anchors])
    e = (lowered.select("_row", F.inline(tagged))
         .select("anchor", "_row", F.posexplode("_ts").alias("_pos", "phrase")))
    counts = e.groupBy("anchor", "phrase").agg(F.count(F.lit(1)).alias("n"),
                                                F.min(first_seen("_row", "_pos")).alias("_first"))
    w = Window.partitionBy("anchor").orderBy(F.desc("n"), F.asc("_first"))
    top = counts.select("*", F.row_number().over(w).alias("_rank")).filter(F.col("_rank") <= k)
    return top.select(
        "anchor", F.col("_rank").cast("bigint").alias("rank"), "phrase", "n",
        F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("anchor")), 6)
        .alias("share_pct"))
