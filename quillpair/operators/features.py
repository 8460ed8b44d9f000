"""Prompts and fixed-length token-id features.

The variants differ only in data (prefix, keywords, joiner), so they are
rows of a config literal unpivoted onto each pair with ``inline``: no join
and no shuffle. Token ids come from a word-level vocabulary table; the only
other shuffle re-collects each text's ids in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import resources as R
from ..functions import text as T


def variants_config(names: Sequence[str] | None = None) -> Column:
    """The variants table as an array of structs (H15, H18, §2.M)."""
    rows = [v for v in R.VARIANTS if names is None or v[0] in names]
    return F.array(*[F.struct(F.lit(n).alias("variant"), F.lit(p).alias("prefix"),
                              F.lit(k).alias("use_keywords"), F.lit(j).alias("joiner"))
                     for n, p, k, j, _ in rows])


def with_keywords(pairs: DataFrame, keywords: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """Attach each context's keyword string; empty when it has none."""
    return (pairs.join(keywords.select(id_col, "keywords"), id_col, "left")
            .withColumn("keywords", F.coalesce("keywords", F.lit(""))))


def prompts(pairs: DataFrame, names: Sequence[str] | None = None,
            id_col: str = "pair_id", carry: Sequence[str] = ()) -> DataFrame:
    """(id, variant, prompt, target) for each pair and variant.

    prompt = prefix + context [+ joiner + keywords] + " </s>";
    target = question with ``{sep_token}`` -> ``<sep>``, + " </s>".
    Keyword variants need a ``keywords`` column (see :func:`with_keywords`).
    """
    has_kw = "keywords" in pairs.columns
    x = pairs.select("*", F.inline(variants_config(names)))
    if not has_kw:
        x = x.filter(~F.col("use_keywords"))
    kw = F.when(F.col("use_keywords"), F.concat(F.col("joiner"), F.col("keywords"))) \
        if has_kw else F.lit("")
    prompt = F.concat(F.col("prefix"), F.col("context"), F.coalesce(kw, F.lit("")),
                      F.lit(R.EOS_TEXT))
    target = F.concat(F.replace(F.col("question"), F.lit(R.SEP_PLACEHOLDER), F.lit(R.SEP_TOKEN)),
                      F.lit(R.EOS_TEXT))
    return x.select(id_col, *carry, "variant", prompt.alias("prompt"), target.alias("target"))


def encode(df: DataFrame, keys: Sequence[str], columns: dict[str, str], vocab: DataFrame,
           unk_id: int = R.UNK_ID, limits: dict[str, int] | None = None) -> DataFrame:
    """Whitespace tokens -> ids in order for several text columns at once;
    unknown tokens -> ``unk_id`` (C9). ``columns`` maps output -> text column;
    ``limits`` (output -> n) keeps only the first n tokens, cut before the
    explode so a long text never ships more than n rows to the shuffle.

    All texts of a row are exploded in one pass (tagged by side), looked up
    in the vocabulary, and re-collected in order. The rows are shuffled on
    the keys before the explode, so they cross the network as text; where
    the planner broadcasts the vocabulary, the re-collect finds its keys
    co-located. Where the vocabulary is too large for that, the lookup is a
    shuffle join with adaptive skew handling.
    """
    keys = list(keys)
    outs = list(columns)
    def tag(side: int):
        return lambda t, i: F.struct(F.lit(side).alias("side"), i.alias("pos"), t.alias("token"))

    limits = limits or {}

    def tokens(o: str) -> Column:
        t = T.ws_tokens(columns[o])
        return F.slice(t, 1, limits[o]) if o in limits else t

    tagged = [F.transform(tokens(o), tag(side)) for side, o in enumerate(outs)]
    toks = df.repartition(*keys).select(*keys, F.explode_outer(F.concat(*tagged)).alias("_t"))
    toks = toks.select(*keys, "_t.side", "_t.pos", "_t.token")
    looked = toks.join(vocab.select("token", "id"), "token", "left")
    item = F.struct(F.col("pos"), F.coalesce(F.col("id"), F.lit(unk_id)).cast("int").alias("id"))
    agg = looked.groupBy(*keys).agg(*[
        F.array_sort(F.collect_list(F.when(F.col("side") == side, item))).alias(f"_p{side}")
        for side in range(len(outs))])
    return agg.select(*keys, *[F.transform(f"_p{side}", lambda s: s["id"]).alias(o)
                               for side, o in enumerate(outs)])


def fixed_length(ids: Column, max_len: int, eos_id: int = R.EOS_ID,
                 pad_id: int = R.PAD_ID) -> tuple[Column, Column]:
    """Truncate to ``max_len - 1`` ids plus EOS (special tokens count towards
    the limit), right-pad with ``pad_id``; returns (ids, mask) (I1-I3)."""
    body = F.concat(F.slice(ids, 1, max_len - 1), F.array(F.lit(eos_id)))
    n = F.size(body)
    padded = F.concat(body, F.array_repeat(F.lit(pad_id), F.lit(max_len) - n))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n))
    return padded, mask


def masked_labels(ids: Column, pad_id: int = R.PAD_ID) -> Column:
    """Target ids with padding replaced by -100 (I4)."""
    return F.transform(ids, lambda x: F.when(x == pad_id, F.lit(R.LABEL_IGNORE)).otherwise(x))


def features(prompts_df: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("pair_id", "variant"),
             max_input: int = R.MAX_INPUT_LEN, max_target: int = R.MAX_TARGET_LEN) -> DataFrame:
    """The four feature arrays per prompt."""
    keys = list(keys)
    both = encode(prompts_df, keys, {"_src": "prompt", "_tgt": "target"}, vocab,
                  limits={"_src": max_input - 1, "_tgt": max_target - 1})  # the rest is cut anyway
    in_ids, in_mask = fixed_length(F.col("_src"), max_input)
    out_ids, out_mask = fixed_length(F.col("_tgt"), max_target)
    return both.select(*keys, in_ids.alias("input_ids"), in_mask.alias("attention_mask"),
                       out_ids.alias("decoder_input_ids"), out_mask.alias("decoder_attention_mask"))
