"""Request handling: validation, routing and answering.

A request is (request_id, context, n, model). Every request gets an answer:
up to ``n`` distinct questions, or one row with an error. Everything is
DataFrame operations keyed by the request id, so the same function serves
batch tables and each streaming micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import resources as R
from ..session import materialise
from ..sources.tables import turn_key
from . import ensemble as EN
from . import features as FE
from . import generate as G
from . import keywords as KW
from . import textrank_batches as TB

REQUEST_SCHEMA = "request_id string, context string, n string, model string"
PRIORITY = {"lead": 0, "cloze": 1}


def validate(req: DataFrame) -> DataFrame:
    """Add n_int, variant, error, n_in_range.

    Empty context is checked first, then empty n, then a non-integer n
    (the original cast would have raised). Unknown models route to the
    combined path. The 1..5 range is the form's client-side check, kept as
    a flag.
    """
    n_int = F.expr("try_cast(n AS INT)")
    error = (F.when(F.coalesce(F.col("context"), F.lit("")) == "", F.lit(R.MSG_EMPTY_CONTEXT))
             .when(F.coalesce(F.col("n"), F.lit("")) == "", F.lit(R.MSG_EMPTY_N))
             .when(n_int.isNull(), F.lit(R.MSG_BAD_N)))
    variant = F.when(F.col("model").isin(R.MODEL_NAMES), F.col("model")).otherwise(F.lit(R.COMBINED))
    return req.select("*", n_int.alias("n_int"), variant.alias("variant"), error.alias("error"),
                      n_int.between(1, 5).alias("n_in_range"))


def _needs_keywords():
    return F.col("variant").isin([v[0] for v in R.VARIANTS if v[2]])


def request_prompts(req: DataFrame) -> DataFrame:
    """(request_id, variant, prompt): the model input of each valid
    single-model request; keyword variants carry the context's keywords
    (H15-H19)."""
    v = validate(req).filter(F.col("error").isNull() & (F.col("variant") != R.COMBINED))
    kw = TB.keywords(v.filter(_needs_keywords()), "request_id", "context")
    x = FE.with_keywords(v.withColumn("question", F.lit("")), kw, "request_id")
    return (FE.prompts(x.withColumnRenamed("variant", "wanted"), id_col="request_id", carry=["wanted"])
            .filter("variant = wanted").select("request_id", "variant", "prompt"))


def _guided(sentences: DataFrame, valid: DataFrame) -> DataFrame:
    """Sentences with ``hits``: how many of the context's keywords stand in
    them, for variants that are given keywords; 0 for the others."""
    asked = valid.filter(_needs_keywords())
    kept = TB.textrank_top(asked, "request_id", "context").select("request_id", "word")
    words = (sentences.filter(_needs_keywords())
             .select("request_id", "pos", F.explode(KW.text_words(F.array_join("tokens", " "))).alias("word")).distinct())
    hits = words.join(kept, ["request_id", "word"]).groupBy("request_id", "pos").agg(F.count(F.lit(1)).alias("hits"))
    return sentences.join(hits, ["request_id", "pos"], "left").withColumn("hits", F.coalesce("hits", F.lit(0)))


def answer(req: DataFrame, vocab_by_variant: DataFrame) -> DataFrame:
    """(request_id, variant, rank, question, error) for every request.

    Generators stand in for the models: the sentences of the context as
    questions (BART variants) or their cloze forms (T5 variants). Variants
    with keywords take the sentences that hold most of the context's TextRank
    keywords first. The combined path pairs both families' candidates by rank
    (C5) and keeps, per rank, the one with fewer rare words, then fewer
    characters, then the lead one (E1, J4). A request that yields no question
    (an n below 1, a context without a sentence) gets the model's message.
    """
    v = validate(req)
    valid = v.filter("error IS NULL")
    sents = _guided(G.sentences(valid, "request_id", "context", carry=["variant", "n_int"]), valid)
    place = F.row_number().over(Window.partitionBy("request_id").orderBy(F.desc("hits"), "pos"))
    # Written once: the sentences feed both the direct and the combined answers.
    sents = materialise(sents.withColumn("pos", place), "request-sentences")
    lead = F.struct(F.lit("lead").alias("variant"), G.lead_question(F.col("tokens")).alias("generated"))
    cloze = F.struct(F.lit("cloze").alias("variant"), G.cloze_question(F.col("tokens")).alias("generated"))
    routed = (F.when(F.col("variant") == R.COMBINED, F.array(lead, cloze))
              .when(F.col("variant").startswith("T5"), F.array(cloze)).otherwise(F.array(lead)))
    rows = sents.select("request_id", F.col("variant").alias("model"), "n_int", "pos", F.inline(routed))
    ranked = G.first_distinct(rows, ["request_id", "variant"], "pos", "generated", F.col("n_int"))
    direct = ranked.filter(F.col("model") != R.COMBINED).select("request_id", "rank", F.col("generated").alias("question"))
    cands = ranked.filter(F.col("model") == R.COMBINED).select("request_id", "rank", "variant", "generated")
    both = EN.ensemble(cands, vocab_by_variant, PRIORITY, ["request_id", "rank"]).select(
        "request_id", "rank", F.col("generated").alias("question"))
    answered = direct.unionByName(both)
    failed = F.when(F.col("rank").isNull(), F.coalesce("error", F.lit(R.MSG_MODEL_FAILED)))
    return v.select("request_id", "variant", "error").join(answered, "request_id", "left").select(
        "request_id", "variant", "rank", "question", failed.alias("error"))


def requests_from_conversations(conv: DataFrame) -> DataFrame:
    """Derived request table: every turn is a request; system turns have a
    blank context, the first turn of each conversation a blank n, and the
    model cycles through the form's options plus one unknown name."""
    models = F.array(*[F.lit(m) for m in R.MODEL_NAMES + [R.COMBINED, "unknown"]])
    pick = F.element_at(models, (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(6)) + 1).cast("int"))
    return conv.select(
        turn_key("conv_id", "turn").alias("request_id"),
        F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text")).alias("context"),
        F.when(F.col("turn") == 0, F.lit("")).when(F.col("turn") == 7, F.lit("seven"))
        .otherwise((F.col("turn") - 1).cast("string")).alias("n"),
        pick.alias("model"))
