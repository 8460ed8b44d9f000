"""Preference formatting with DataFrame functions only.

A preference pair is a chosen and a rejected conversation with one key. Both are numbered by turn; their longest
common turn prefix (equal role and text at each place) is rendered once, as the prompt; what follows in each is its
completion. A completion comes with its mask: runs of characters, "t" for those that are trained on (the text and
end mark of assistant turns) and "m" for masked ones (headers, and the turns of others), as in "m21 t340 m14".

One shuffle: the turns of a key's two sides meet in one group, since a pair is one output row. No other key's rows
are in it, and no join, window or explode follows.

Null texts count as empty, null roles as "user"; a null turn comes first; equal turn numbers are ordered by role and
text. Rows without a key belong to no conversation and are left out. A key with only one side is a pair whose other
side has no turns, so its prompt is empty; if one side is a prefix of the other, its completion is empty. Marks
inside a text are defused by a space, so that a text can't end its turn. Repeated rows are repeated turns. Empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, MARK = "<|im_start|>", "<|im_end|>", "<|im_"
DEFUSED = "<| im_"
TRAINED_ROLE = "assistant"


def _turns(df: DataFrame, side: str, key: str) -> DataFrame:
    text = F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(DEFUSED))
    role = F.replace(F.coalesce("role", F.lit("user")), F.lit(MARK), F.lit(DEFUSED))
    return df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("pair_id"), F.lit(side).alias("side"),
        F.struct(F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))


def _segments(turns: Column) -> Column:
    """(text, trained) runs of rendered turns."""
    def of(t: Column) -> Column:
        head = F.concat(F.lit(OPEN), t["role"], F.lit("\n"))
        trained = t["role"] == TRAINED_ROLE
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("trained")),
                       F.struct(F.concat(t["text"], F.lit(CLOSE)).alias("text"), trained.alias("trained")),
                       F.struct(F.lit("\n").alias("text"), F.lit(False).alias("trained")))
    return F.flatten(F.transform(turns, of))


def _joined(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def _mask(segments: Column) -> Column:
    run = F.transform(segments, lambda s: F.concat(F.when(s["trained"], "t").otherwise("m"),
                                                   F.length(s["text"]).cast("string")))
    return F.array_join(run, " ")


def format_preferences(chosen: DataFrame, rejected: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per pair: prompt, both completions and their masks, and the numbers of turns in each."""
    def side(name: str) -> Column:
        # A false condition gives null, which collect_list leaves out.
        return F.sort_array(F.collect_list(F.when(F.col("side") == name, F.col("t"))))

    sides = (_turns(chosen, "chosen", key).unionByName(_turns(rejected, "rejected", key))
             .groupBy("pair_id").agg(side("chosen").alias("c"), side("rejected").alias("r")))
    # turn numbers may differ between the sides; what is compared is role and text, place by place
    differs = F.transform(F.arrays_zip("c", "r"), lambda p: ~(
        p["c"]["role"].eqNullSafe(p["r"]["role"]) & p["c"]["text"].eqNullSafe(p["r"]["text"])))
    first = F.array_position(differs, True)
    both = sides.withColumn("n", F.when(first > 0, first - 1).otherwise(F.size("c")).cast("int"))

    def rest(c: str) -> Column:
        return F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))

    cut = both.select("pair_id", "n", F.size("c").alias("nc"), F.size("r").alias("nr"),
                      _joined(_segments(F.slice("c", F.lit(1), F.col("n")))).alias("prompt"),
                      _segments(rest("c")).alias("cs"), _segments(rest("r")).alias("rs"))
    return cut.select(
        "pair_id", F.col("n").cast("bigint").alias("prompt_turns"),
        (F.col("nc") - F.col("n")).cast("bigint").alias("chosen_turns"),
        (F.col("nr") - F.col("n")).cast("bigint").alias("rejected_turns"), "prompt",
        _joined(F.col("cs")).alias("chosen"), _mask(F.col("cs")).alias("chosen_mask"),
        _joined(F.col("rs")).alias("rejected"), _mask(F.col("rs")).alias("rejected_mask"))


def with_weaker_reply(conversations: DataFrame) -> DataFrame:
    """Rejected side for a table without preferences: the last assistant reply loses its second half.

    Every conversation keeps its turns; the text of its last assistant turn is cut to the first half of its
    characters. Where a conversation has no assistant turn, or that text has under two characters, both sides agree.
    """
    last = (conversations.filter("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("last")))
    cut = F.when((F.col("role") == TRAINED_ROLE) & (F.col("turn") == F.col("last")),
                 F.expr("substring(text, 1, (char_length(text) + 1) div 2)")).otherwise(F.col("text"))
    return conversations.join(last, "conv_id", "left").select("conv_id", "turn", "role", cut.alias("text"))
