"""Generators, distinct candidates and the request path on hand-made rows."""

from pyspark.sql import functions as F

from quillpair import resources as R
from quillpair.operators import generate as G
from quillpair.operators import requests as RQ
from quillpair.operators import textprep as TP


def test_user_generator_runs_in_batches(spark):
    def factory():
        return lambda prompts: [[p.upper(), p] for p in prompts]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, prompt string")
    out = G.generate_with(df, "prompt", factory, return_type="array<string>").collect()
    assert {r.id: list(r.generated) for r in out} == {1: ["A", "a"], 2: ["B", "b"]}


def test_ranked_predictions_are_distinct_and_whole(spark):
    long = " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([(1, f"One two. One two. Three! {long}."), (2, ""), (3, None)], "id int, t string")
    got = {(r.variant, r.rank): r.generated for r in G.ranked_predictions(df, "id", "t").collect()}
    assert got["lead", 1] == "One two?" and got["lead", 2] == "Three?" and got["cloze", 1] == "One what?"
    assert len(got["lead", 3].split()) == 400  # no sentence is cut
    assert {k for k in got} == {(v, n) for v in ("lead", "cloze") for n in (1, 2, 3)}


def test_dedup_after_cleaning(spark):
    df = spark.createDataFrame([(1, "A b", "q"), (2, "a b", "Q"), (3, "NA", "q")], "row_id int, context string, question string")
    assert TP.preprocess(df).count() == 2
    assert [tuple(r) for r in TP.preprocess(df, dedup_after=True).collect()] == [(1, "a b", "q")]


def test_every_request_is_answered(spark):
    text = "The fox runs. A red fox and a red hen sleep. Nothing else."
    later = "It was so. The quick fox likes red apples. Grey fox hunts. Old fox rests."
    rows = [("a", text, "2", "BART"), ("b", text, "2", "T5"), ("c", text, "1", "BART with keywords"), ("d", text, "9", "x"),
            ("e", text, "0", "BART"), ("f", " ", "2", "T5"), ("g", "", "2", "T5"), ("h", text, "", "T5"), ("i", text, "2.5", "T5"),
            ("j", text, "-3", "x"), ("k", None, "1", "x"),
            ("l", later, "1", "BART with keywords"), ("m", later, "1", "BART")]
    req = spark.createDataFrame(rows, RQ.REQUEST_SCHEMA)
    vv = spark.createDataFrame([("lead", "The"), ("cloze", "what")], "variant string, token string")
    out = {}
    for r in RQ.answer(req, vv).collect():
        out.setdefault(r.request_id, []).append((r.rank, r.question, r.error))
    assert set(out) == {r[0] for r in rows}
    assert sorted(out["a"]) == [(1, "The fox runs?", None), (2, "A red fox and a red hen sleep?", None)]
    assert sorted(out["b"])[0] == (1, "The fox what?", None)
    assert out["c"] == [sorted(out["a"])[0]]  # "fox" wins a tie by name and stands in the first sentence
    assert out["l"] == [(1, "The quick fox likes red apples?", None)]  # the best keyword stands in a later one only
    assert sorted(out["m"])[0] == (1, "It was so?", None)
    assert len(out["d"]) == 3
    for i in "efj":
        assert out[i] == [(None, None, R.MSG_MODEL_FAILED)]
    assert [out[i][0][2] for i in "ghik"] == [R.MSG_EMPTY_CONTEXT, R.MSG_EMPTY_N, R.MSG_BAD_N, R.MSG_EMPTY_CONTEXT]


def test_streamed_files_are_all_answered(spark):
    from quillpair.streaming.requests import run_requests_once
    req = spark.range(12).select(F.col("id").cast("string").alias("request_id"), F.lit("One two. Three.").alias("context"),
                                 F.lit("1").alias("n"), F.lit("T5").alias("model")).repartition(3)
    vv = spark.createDataFrame([("lead", "a")], "variant string, token string")
    out = run_requests_once(spark, req, vv, max_files_per_trigger=1).collect()
    assert len(out) == 12 and len({r.batch_id for r in out}) >= 2
