"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole driver tables (or tables Spark derives from them);
there are no id subsets, row caps or text prefixes. Columns are aliased to
the names used by the matching oracle SQL in ``plans.oracle``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import resources as R
from ..functions import text as T
from ..functions.stem import with_stems
from ..operators import beam as BM
from ..operators import ensemble as EN
from ..operators import features as FE
from ..operators import generate as G
from ..operators import grid as GR
from ..operators import requests as RQ
from ..operators import joined as J
from ..operators import keywords as KW
from ..operators import metrics as M
from ..operators import profile as P
from ..operators import sentences as SE
from ..operators import textprep as TP
from ..operators import textrank_batches as TB
from ..session import materialise, shared_path
from ..sources import csv as C
from ..sources import tables as S

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- profile (M0, M2)

@query("top_words")
def q_top_words(spark, sf):
    return P.top_words(S.documents(spark, sf), "doc_id", "text")


@query("top_question_words")
def q_top_question_words(spark, sf):
    return P.top_question_words(S.documents(spark, sf), "doc_id", "text")


@query("top_phrases")
def q_top_phrases(spark, sf):
    return P.top_phrases(S.documents(spark, sf), "doc_id", "text", anchors=("what", "the"))


@query("top_phrases_joined")
def q_top_phrases_joined(spark, sf):
    return J.top_phrases_joined(S.documents(spark, sf), "doc_id", "text", "the")


@query("profile_shape")
def q_profile_shape(spark, sf):
    return P.shape(S.read_table(spark, sf, "documents"))


@query("profile_info")
def q_profile_info(spark, sf):
    return P.info(S.read_table(spark, sf, "documents"))


@query("profile_nulls")
def q_profile_nulls(spark, sf):
    return P.null_counts(S.read_table(spark, sf, "documents"))


@query("describe_text")
def q_describe_text(spark, sf):
    return P.describe_text(S.read_table(spark, sf, "documents"), "doc_id", ["text", "lang", "source"])


@query("describe_numeric")
def q_describe_numeric(spark, sf):
    out = P.describe_numeric(S.read_table(spark, sf, "documents"), ["doc_id", "n_chars"])
    return out.select("column", "count", *[F.round(c, 6).alias(c) for c in
                                           ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("context_length_hist")
def q_context_length_hist(spark, sf):
    return P.length_histogram(S.documents(spark, sf), "text")


@query("question_length_hist")
def q_question_length_hist(spark, sf):
    conv = S.conversations(spark, sf).filter(F.col("role") == "user")
    return P.length_histogram(conv, "text")


# ---------------------------------------------------------------- cleaning (M1)

@query("clean_pages")
def q_clean_pages(spark, sf):
    return S.pages(spark, sf).select("page_id", T.normalise_text("html").alias("clean"))


def _with_contractions(text):
    """Derived input: put contractions into the documents text."""
    x = F.replace(text, F.lit(" the "), F.lit(" it's "))
    return F.replace(x, F.lit(" and "), F.lit(" Don't "))


@query("expand_contractions")
def q_expand_contractions(spark, sf):
    d = S.documents(spark, sf)
    src = F.replace(_with_contractions(F.col("text")), F.lit(" '"), F.lit("'"))
    return d.select("doc_id", T.expand_contractions(src).alias("expanded"))


@query("na_and_dedup")
def q_na_and_dedup(spark, sf):
    d = S.documents(spark, sf).select(F.col("doc_id").alias("row_id"),
                                      F.col("text").alias("context"),
                                      F.col("lang").alias("question"))
    return TP.dedup_first(TP.drop_null_pairs(TP.null_na_tokens(d)), "row_id")


@query("clean_pairs")
def q_clean_pairs(spark, sf):
    p = S.pairs(spark, sf).withColumnRenamed("pair_id", "row_id")
    return TP.preprocess(p, "row_id")


# ---------------------------------------------------------------- generation, ensemble (M6)

PRIORITY = RQ.PRIORITY  # tie -> first variant, like BART in the original
RANKED = ["pair_id", "rank"]
SCORED = ["pair_id", "rank", "variant"]


def _pairs(spark, sf):
    return S.pairs(spark, sf)


def _candidates(spark, sf, n=None, generators=None):
    """Every distinct question of each generator, one per sentence of the context."""
    return G.ranked_predictions(_pairs(spark, sf), "pair_id", "context", n, generators)


def _vocab(spark, sf):
    return EN.add_token(EN.learn_vocab(S.documents(spark, sf), "text"))


def _vocabs(spark, sf):
    """Each variant counts rare words in its own vocabulary."""
    return EN.variant_vocab({"lead": _vocab(spark, sf),
                             "cloze": EN.add_token(EN.learn_vocab(S.conversations(spark, sf), "text"))})


@query("pairs")
def q_pairs(spark, sf):
    return _pairs(spark, sf)


@query("generate_lead")
def q_generate_lead(spark, sf):
    return G.lead_of_context(_pairs(spark, sf), "pair_id", "context")


@query("generate_cloze")
def q_generate_cloze(spark, sf):
    return _candidates(spark, sf, generators={"cloze": G.cloze_question})


@query("generate_beam")
def q_generate_beam(spark, sf):
    """One question per context, decoded as the original's batch inference."""
    p = materialise(_pairs(spark, sf), "pairs")
    out = BM.generate_beam(p, "pair_id", "context", BM.learn_transitions(p), length_penalty=1.5)
    return out.select("pair_id", "rank", "generated", "score")


@query("generate_nbest")
def q_generate_nbest(spark, sf):
    """Five questions per context, decoded as the original's request form."""
    p = materialise(_pairs(spark, sf), "pairs")
    out = BM.generate_beam(p, "pair_id", "context", BM.learn_transitions(p), n=5)
    return out.select("pair_id", "rank", "generated", "score")


@query("generate_plugin")
def q_generate_plugin(spark, sf):
    """A caller's own function over the prompts, batch by batch: the first and the last word as a question."""
    def factory():
        def model(prompts):
            words = [p.removesuffix(R.EOS_TEXT).split() for p in prompts]
            return [f"{w[0]} {w[-1]}?" if w else "" for w in words]
        return model
    p = FE.prompts(_pairs(spark, sf), names=["BART", "T5"])
    return G.generate_with(p, "prompt", factory).select("pair_id", "variant", "generated")


@query("vocab")
def q_vocab(spark, sf):
    return _vocab(spark, sf)


@query("rare_words")
def q_rare_words(spark, sf):
    return EN.rare_word_counts(_candidates(spark, sf), _vocabs(spark, sf), RANKED)


@query("ensemble_select")
def q_ensemble_select(spark, sf):
    return EN.ensemble(_candidates(spark, sf), _vocabs(spark, sf), PRIORITY, RANKED)


@query("ensemble_ranked")
def q_ensemble_ranked(spark, sf):
    return EN.ensemble(_candidates(spark, sf, 5), _vocabs(spark, sf), PRIORITY, RANKED)


@query("n_distinct_candidates")
def q_n_distinct_candidates(spark, sf):
    s = G.sentences(S.documents(spark, sf), "doc_id", "text").repartition("doc_id")
    s = s.select("doc_id", "pos", F.array_join("tokens", " ").alias("candidate"))
    return G.first_distinct(s, ["doc_id"], "pos", "candidate", 5).select("doc_id", "rank", "candidate")


# ---------------------------------------------------------------- metrics (M4)

def _with_truth(cands, spark, sf):
    return cands.join(_pairs(spark, sf).select("pair_id", "question"), "pair_id")


def _scored(spark, sf, *metrics, stems=True, synonyms=None):
    cands = _with_truth(_candidates(spark, sf), spark, sf)
    return M.score_rows(cands, SCORED, stems=stems, synonyms=synonyms, metrics=metrics, by=["pair_id"])


def _rounded(*cols):
    return [F.round(c, 6).alias(c) for c in cols]


@query("rouge_l")
def q_rouge_l(spark, sf):
    s = _scored(spark, sf, "rouge")
    return s.select(*SCORED, *[F.round(f"rouge_{c[0]}", 6).alias(c) for c in ("precision", "recall", "fmeasure")])


@query("bleu")
def q_bleu(spark, sf):
    return _scored(spark, sf, "bleu").select(*SCORED, *_rounded("bleu1", "bleu2", "bleu3", "bleu4"))


@query("meteor_exact")
def q_meteor_exact(spark, sf):
    return _scored(spark, sf, "meteor", stems=False).select(*SCORED, "matches", "chunks", *_rounded("meteor"))


@query("meteor_stem")
def q_meteor_stem(spark, sf):
    return _scored(spark, sf, "meteor").select(*SCORED, "matches", "chunks", *_rounded("meteor"))


@query("meteor_synonym")
def q_meteor_synonym(spark, sf):
    """Synonym sets derived from the data: stems with the same letters belong together."""
    words = (S.conversations(spark, sf).select(F.explode(T.ws_tokens(F.lower("text"))).alias("token")).distinct())
    stems = with_stems(words, "token").select(F.col("stem").alias("word")).distinct()
    sets = stems.select("word", F.regexp_replace("word", "[^a-z]", "").alias("set_id")).filter("set_id <> ''")
    return _scored(spark, sf, "meteor", synonyms=sets).select(*SCORED, "matches", "chunks", *_rounded("meteor"))


@query("meteor_synonym_sets")
def q_meteor_synonym_sets(spark, sf):
    """Several sets per word, derived from the data: the first three and the last three letters of a stem."""
    words = (S.conversations(spark, sf).select(F.explode(T.ws_tokens(F.lower("text"))).alias("token")).distinct())
    stems = with_stems(words, "token").select(F.col("stem").alias("word")).distinct()
    bare = F.regexp_replace("word", "[^a-z]", "")
    sets = stems.filter(F.length(bare) >= 3).select("word", F.explode(F.array(
        F.concat(F.lit("a:"), F.left(bare, F.lit(3))), F.concat(F.lit("b:"), F.right(bare, F.lit(3))))).alias("set_id"))
    return _scored(spark, sf, "meteor", synonyms=sets).select(*SCORED, "matches", "chunks", *_rounded("meteor"))


#: Derived input: abbreviations before names, before small letters and within sentences, initials, numbers.
ABBREVIATED = ((" (by|de) ", " cf. "), (" (with|la) ", " Dr. Anea "), (" (is|der) ", " e.g. "), (" (was|que) ", " J. Thor "), (" (on|et) ", " No. 7. "))


@F.arrow_udf(StringType())
def _with_abbreviations(texts: pa.Array) -> pa.Array:
    out = texts.to_pylist()
    for pattern, new in ABBREVIATED:
        sub = re.compile(pattern).sub
        out = [None if t is None else sub(new, t) for t in out]
    return pa.array(out, pa.string())


def _abbreviated(spark, sf):
    return S.documents(spark, sf).select("doc_id", _with_abbreviations(F.col("text")).alias("text"))


@query("sentence_model")
def q_sentence_model(spark, sf):
    return SE.model_rows(SE.learn_sentences(_abbreviated(spark, sf), "text")).withColumn("score", F.round("score", 4))


@query("split_sentences")
def q_split_sentences(spark, sf):
    d = _abbreviated(spark, sf)
    return SE.split_sentences(d, ["doc_id"], "text", SE.learn_sentences(d, "text"))


@query("bleu_sentences")
def q_bleu_sentences(spark, sf):
    """BLEU on words of sentences, of which the corpus has learned the abbreviations."""
    model = SE.learn_sentences(_abbreviated(spark, sf), "text")
    c = _with_truth(_candidates(spark, sf), spark, sf).withColumns(
        {col: _with_abbreviations(F.col(col)) for col in ("generated", "question")})
    return M.score_rows(c, SCORED, metrics=("bleu",), sentences=model).select(
        *SCORED, *_rounded("bleu1", "bleu2", "bleu3", "bleu4"))


@query("bootstrap_rouge")
def q_bootstrap_rouge(spark, sf):
    s = _scored(spark, sf, "rouge").select("pair_id", "variant", (100 * F.col("rouge_f")).alias("f"))
    return M.bootstrap_mean(s, "pair_id", "f", "variant").select("variant", *_rounded("low", "mid", "high"))


@query("leaderboard")
def q_leaderboard(spark, sf):
    cands = EN.with_ensemble(_candidates(spark, sf), _vocabs(spark, sf), PRIORITY, RANKED)
    scored = materialise(M.score_rows(_with_truth(cands, spark, sf), SCORED, by=["pair_id"]), "scored")
    return M.leaderboard(scored, "pair_id")


# ---------------------------------------------------------------- features (M3)

def _ids_text(c):
    """Id arrays serialised as text for the order-insensitive hash compare."""
    return F.array_join(F.col(c).cast("array<string>"), ",")


FEATURES = ("input_ids", "attention_mask", "decoder_input_ids", "decoder_attention_mask")


def _features(spark, sf):
    p = FE.prompts(_pairs(spark, sf), names=["BART", "T5"])
    return FE.features(p, _vocab(spark, sf))


@query("prompts")
def q_prompts(spark, sf):
    return FE.prompts(_pairs(spark, sf), names=["BART", "T5"])


@query("encode_features")
def q_encode_features(spark, sf):
    return _features(spark, sf).select("pair_id", "variant", *[_ids_text(c).alias(c) for c in FEATURES])


@query("labels_masked")
def q_labels_masked(spark, sf):
    lab = FE.masked_labels(F.col("decoder_input_ids"))
    return _features(spark, sf).select(
        "pair_id", "variant", F.array_join(lab.cast("array<string>"), ",").alias("labels"),
        F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_input"))


# ---------------------------------------------------------------- keywords (M5)

@query("textrank_edges")
def q_textrank_edges(spark, sf):
    return KW.textrank_edges(S.documents(spark, sf), "doc_id", "text")


@query("textrank_keywords")
def q_textrank_keywords(spark, sf):
    return TB.textrank_top(S.documents(spark, sf), "doc_id", "text")


@query("textrank_converged")
def q_textrank_converged(spark, sf):
    """Ranks until no rank of the text moves by the tolerance."""
    return TB.textrank_top(S.documents(spark, sf), "doc_id", "text", steps=TB.MOST_STEPS, tolerance=TB.TOLERANCE)


@query("textrank_stems")
def q_textrank_stems(spark, sf):
    return KW.textrank_top(_pairs(spark, sf), "pair_id", "context", stems=True)


@query("keywords_text")
def q_keywords_text(spark, sf):
    return TB.keywords(S.documents(spark, sf), "doc_id", "text")


@query("prompts_keywords")
def q_prompts_keywords(spark, sf):
    p = materialise(_pairs(spark, sf), "pairs")
    kw = TB.keywords(p, "pair_id", "context")
    return FE.prompts(FE.with_keywords(p, kw), names=["BART with keywords", "T5 with keywords"])


# ---------------------------------------------------------------- sources and sinks (A, C2, E3, G)

def _csv(spark, sf):
    """The pairs as CSV in the shared folder, rows in key order; the number of files grows with the pairs."""
    path = shared_path(spark, "pairs-csv")
    C.write_csv(_pairs(spark, sf).repartitionByRange("pair_id").sortWithinPartitions("pair_id"), path)
    return path


@query("csv_projected")
def q_csv_projected(spark, sf):
    return C.read_projected(spark, _csv(spark, sf))


@query("csv_all_columns")
def q_csv_all_columns(spark, sf):
    return C.read_all(spark, _csv(spark, sf))


@query("csv_row_index")
def q_csv_row_index(spark, sf):
    return C.read_indexed(spark, _csv(spark, sf), ("pair_id", "context", "question"))


@query("csv_splits")
def q_csv_splits(spark, sf):
    """Clean splits written by split, one folder read back per split."""
    part = F.length("question") % 10
    split = F.when(part == 0, "test").when(part == 1, "valid").otherwise("train")
    path = shared_path(spark, "splits")
    C.write_splits(_pairs(spark, sf).withColumn("split", split), path, fmt="csv")
    return C.read_splits(spark, {s: f"{path}/split={s}" for s in ("train", "valid", "test")},
                         ("pair_id", "context", "question")).drop("row_id")


@query("predictions_scored")
def q_predictions_scored(spark, sf):
    """Predictions written per variant, read back, joined to the truth and scored."""
    path = shared_path(spark, "predictions")
    C.write_predictions(_candidates(spark, sf, 1), path)
    s = M.score_rows(_with_truth(C.read_predictions(spark, path), spark, sf), SCORED, by=["pair_id"])
    return s.select(*SCORED, F.round("rouge_f", 6).alias("fmeasure"), *_rounded("meteor", "bleu4"))


@query("features_stored")
def q_features_stored(spark, sf):
    path = shared_path(spark, "features")
    C.write_features(_features(spark, sf).withColumn("split", F.lit("train")), path)
    f = spark.read.parquet(path)
    return f.select("pair_id", "variant", "split", *[_ids_text(c).alias(c) for c in FEATURES])


# ---------------------------------------------------------------- grid, requests (M6, M7)

GRID = {"min_chars": [200.0, 1000.0], "max_non_ascii": [0.02, 0.1]}


def _grid_runs(spark, sf):
    d = S.documents(spark, sf).select("doc_id", "n_chars", "text")
    x = d.join(S.labels(spark, sf).select("doc_id", "quality"), "doc_id").select(
        "n_chars", "quality",
        F.try_divide(F.length(F.regexp_replace("text", r"[\x00-\x7f]", "")),
                     F.length("text")).alias("non_ascii"))

    def loss(p):
        pred = ((F.col("n_chars") >= p["min_chars"])
                & (F.coalesce(F.col("non_ascii"), F.lit(0.0)) <= p["max_non_ascii"])).cast("int")
        return F.avg((pred != F.col("quality")).cast("double"))

    return GR.score_grid(x, GRID, loss)


@query("grid_runs")
def q_grid_runs(spark, sf):
    return _grid_runs(spark, sf).withColumn("loss", F.round("loss", 6))


@query("grid_best")
def q_grid_best(spark, sf):
    b = GR.best_run(_grid_runs(spark, sf), list(GRID))
    return b.withColumn("loss", F.round("loss", 6))


def _requests(spark, sf):
    return RQ.requests_from_conversations(S.conversations(spark, sf))


@query("validate_requests")
def q_validate_requests(spark, sf):
    return RQ.validate(_requests(spark, sf)).select(
        "request_id", "variant", "n_int", "error", "n_in_range")


@query("request_prompts")
def q_request_prompts(spark, sf):
    return RQ.request_prompts(_requests(spark, sf))


@query("answer_requests")
def q_answer_requests(spark, sf):
    return RQ.answer(_requests(spark, sf), _vocabs(spark, sf))


@query("request_stream")
def q_request_stream(spark, sf):
    from ..streaming.requests import run_requests_once
    return run_requests_once(spark, _requests(spark, sf), _vocabs(spark, sf)).drop("batch_id")
