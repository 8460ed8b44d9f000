"""Plan shapes the scale design relies on (checked on the physical plan)."""

from pyspark.sql import functions as F

from quillpair.operators import ensemble as EN
from quillpair.operators import features as FE
from quillpair.operators import keywords as KW
from quillpair.operators import profile as P
from quillpair.sources import tables as S

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_encode_shuffles_once_before_the_explode(spark):
    prompts = spark.createDataFrame([(1, "BART", "a b c </s>", "x y </s>"),
                                     (2, "T5", "b c d </s>", "y </s>")],
                                    "pair_id bigint, variant string, prompt string, target string")
    vocab = spark.createDataFrame([("a", 5), ("b", 6), ("</s>", 1)], "token string, id int")
    plan = _plan(FE.features(prompts, F.broadcast(vocab)))
    assert plan.count("Exchange hashpartitioning") == 1  # the key shuffle of the prompt rows
    assert plan.index("Exchange hashpartitioning") > plan.index("Generate explode")  # below it


def test_top_phrases_limits_each_anchor_before_the_shuffle(spark):
    plan = _plan(P.top_phrases(S.documents(spark, SF), "doc_id", "text", anchors=("what", "the")))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.count("FileScan") == 1


def test_top_words_counts_with_a_hash_aggregate(spark):
    plan = _plan(P.top_words(S.documents(spark, SF), "doc_id", "text"))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_rare_words_shuffle_no_text(spark):
    cands = spark.createDataFrame([(1, "lead", "a b x")], "pair_id bigint, variant string, generated string")
    vocab = spark.createDataFrame([("lead", "a")], "variant string, token string")
    plan = _plan(EN.ensemble(cands, vocab, {"lead": 0}))
    assert "SortAggregate" not in plan and "generated" not in "".join(
        x for x in plan.splitlines() if "HashAggregate" in x)


def test_textrank_has_no_python_worker(spark):
    plan = _plan(KW.textrank_top(S.documents(spark, SF), "doc_id", "text", iterations=5))
    assert "Python" not in plan and "Arrow" not in plan


def test_describe_shuffles_digests_only(spark):
    plan = _plan(P.describe_text(S.read_table(spark, SF, "documents"), "doc_id", ["text"]))
    assert not [x for x in plan.splitlines() if "SortAggregate" in x and "value" in x]  # only the winners are sorted
    assert "md5" in plan
