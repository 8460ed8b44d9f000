"""Metrics: pure-Python twins and properties."""

import math

import pytest
import random

from pyspark.sql import functions as F

from quillpair.functions import text as T
from quillpair.operators import metrics as M


def dp_lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if x == y else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def test_bit_parallel_lcs_matches_dp():
    rng = random.Random(1)
    for _ in range(500):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 40))]
        b = [rng.choice("abcd") for _ in range(rng.randint(0, 90))]
        assert M.lcs_len(a, b) == dp_lcs(a, b)


def greedy_meteor(h, r, alpha=0.9, beta=3.0, gamma=0.5):
    hl, rl = list(enumerate(h)), list(enumerate(r))
    matches = []
    for i in range(len(hl))[::-1]:
        for j in range(len(rl))[::-1]:
            if hl[i][1] == rl[j][1]:
                matches.append((hl[i][0], rl[j][0]))
                hl.pop(i)
                rl.pop(j)
                break
    matches.sort()
    m = len(matches)
    if m == 0:
        return 0.0, 0
    chunks, k = 1, 0
    while k < m - 1:
        if not (matches[k + 1][0] == matches[k][0] + 1 and matches[k + 1][1] == matches[k][1] + 1):
            chunks += 1
        k += 1
    p, rc = m / len(h), m / len(r)
    f = p * rc / (alpha * p + (1 - alpha) * rc)
    return (1 - gamma * (chunks / m) ** beta) * f, chunks


def _scored(spark, pairs):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)],
                               "id bigint, generated string, question string")
    return {r.id: r for r in M.score_rows(df, ["id"], stems=False).collect()}


def test_meteor_matches_greedy_alignment(spark):
    rng = random.Random(5)
    pairs = [(" ".join(rng.choice("abcde") for _ in range(rng.randint(1, 12))),
              " ".join(rng.choice("abcde") for _ in range(rng.randint(1, 12)))) for _ in range(300)]
    got = _scored(spark, pairs)
    for i, (h, r) in enumerate(pairs):
        want, chunks = greedy_meteor(h.split(), r.split())
        assert abs(got[i].meteor - want) < 1e-9, (h, r)
        assert got[i].chunks == chunks


def test_identical_pairs_and_edge_cases(spark):
    pairs = [("a b c d e", "a b c d e"), ("x y", "p q"), ("word", "word other"), ("", "a b"),
             ("a a a", "a"), ("b a", "a b")]
    got = _scored(spark, pairs)
    same = got[0]
    assert same.rouge_f == 1.0 and all(getattr(same, f"bleu{n}") == 1.0 for n in range(1, 5))
    assert abs(same.meteor - (1 - 0.5 / 5 ** 3)) < 1e-12
    assert got[1].rouge_f == 0.0 and got[1].bleu1 == 0.0 and got[1].meteor == 0.0
    assert got[3].rouge_f == 0.0 and got[3].bleu4 == 0.0 and got[3].meteor == 0.0
    # one-word hypothesis: brevity penalty exp(1 - 2/1), unigram precision 1
    assert abs(got[2].bleu1 - math.exp(1 - 2)) < 1e-12
    # swapped order: LCS 1 of 2
    assert abs(got[5].rouge_f - 0.5) < 1e-12


def test_bleu_smoothing_method4(spark):
    # h = 3 tokens, r shares the unigrams only: orders 2..3 smoothed with k = 1, 2
    got = _scored(spark, [("a b c", "c b a")])[0]
    ln3 = math.log(3)
    p1, p2, p3 = 1.0, (ln3 / (2 * 5)) / 2, (ln3 / (4 * 5)) / 1
    assert abs(got.bleu2 - math.exp((math.log(p1) + math.log(p2)) / 2)) < 1e-12
    assert abs(got.bleu3 - math.exp((math.log(p1) + math.log(p2) + math.log(p3)) / 3)) < 1e-12


def test_bootstrap_is_seeded_and_brackets_mean(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") % 10).cast("double").alias("x"))
    df = df.withColumn("g", F.lit("a")).unionByName(df.select("id", (F.col("x") + 1).alias("x"), F.lit("b").alias("g")))
    first, again = ({r.g: r for r in M.bootstrap_mean(df, "id", "x", "g", replicates=200).collect()} for _ in range(2))
    assert first == again
    a, b = first["a"], first["b"]
    assert a.low < 4.5 < a.high and a.low <= a.mid <= a.high
    assert b.mid == pytest.approx(a.mid + 1)  # groups share the resamples


def test_bleu_smoothing_methods_0_and_1(spark):
    import sys
    df = spark.createDataFrame([(1, ["a", "b", "c"], ["c", "b", "a"])], "id int, h array<string>, r array<string>")
    m1 = M.bleu_scores(df, ["id"], "h", "r", smoothing="method1").first()
    # unigrams all match; orders 2..4 have no match: 0.1 / (number of hypothesis n-grams)
    p = [1.0, 0.1 / 2, 0.1 / 1, 0.1 / 1]
    for n in range(1, 5):
        want = math.exp(sum(math.log(x) for x in p[:n]) / n)
        assert abs(getattr(m1, f"bleu{n}") - want) < 1e-12
    m0 = M.bleu_scores(df, ["id"], "h", "r", smoothing="method0").first()
    assert m0.bleu1 == 1.0
    assert abs(m0.bleu2 - math.exp(math.log(sys.float_info.min) / 2)) < 1e-160
    with pytest.raises(ValueError):
        M.bleu_scores(df, ["id"], "h", "r", smoothing="method9")


def test_meteor_stem_and_synonym_stages(spark):
    rows = [(1, "the cats run".split(), "a cat runs".split()), (2, ["big", "car"], ["large", "auto"]), (3, ["x"], ["y"])]
    df = spark.createDataFrame(rows, "id int, h array<string>, r array<string>")
    exact = {r.id: r.matches for r in M.meteor_scores(df, ["id"], "h", "r").collect()}
    stems = {r.id: r for r in M.meteor_scores(df, ["id"], "h", "r", stems=True).collect()}
    assert exact == {1: 0, 2: 0, 3: 0}
    assert (stems[1].matches, stems[1].chunks, stems[2].matches) == (2, 1, 0)
    sets = spark.createDataFrame([("big", "s1"), ("larg", "s1"), ("car", "s2"), ("auto", "s2"), ("auto", "s9")],
                                 "word string, set_id string")
    syn = {r.id: (r.matches, r.chunks) for r in M.meteor_scores(df, ["id"], "h", "r", True, sets).collect()}
    assert syn == {1: (2, 1), 2: (2, 1), 3: (0, 0)}
    with pytest.raises(ValueError):
        M.meteor_scores(df, ["id"], "h", "r", synonyms=sets)


def test_long_texts_are_linear(spark):
    import time
    took = []
    for n in (2000, 8000):
        words = [f"w{i % 700}" for i in range(n)]
        df = spark.createDataFrame([(i, words[:5], words) for i in range(8)], "id int, h array<string>, r array<string>")
        M.meteor_scores(df, ["id"], "h", "r").collect()
        t = time.time()
        got = M.meteor_scores(df, ["id"], "h", "r").collect()
        took.append(time.time() - t)
        assert all(r.matches == 5 for r in got)
    assert took[1] < 10 * took[0] + 5


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("metric", ["bleu", "meteor"])
def test_words_of_a_row_stay_in_it(spark, metric):
    """No token and no n-gram becomes a row: only the grouped rows are shuffled."""
    df = spark.createDataFrame([(1, "a b c", "a c b")], "id int, generated string, question string")
    plan = _plan(M.score_rows(df, ["id"], stems=False, metrics=(metric,)))
    assert "explode" not in plan and "Window" not in plan and "Join" not in plan


def test_rows_of_one_key_are_scored_together(spark):
    rows = [(1, "a b", "a c"), (1, "a b", "a c"), (2, "a b", "a b"), (3, None, "a"), (4, "a", None)]
    df = spark.createDataFrame(rows, "id int, generated string, question string")
    meteor = [(r.id, r.matches, r.chunks) for r in M.score_rows(df, ["id"], metrics=("meteor",)).collect()]
    assert sorted(meteor) == [(1, 2, 2), (1, 2, 2), (2, 2, 1), (3, 0, 0), (4, 0, 0)]
    bleu = sorted((r.id, round(r.bleu1, 9)) for r in M.score_rows(df, ["id"], metrics=("bleu",)).collect())
    assert bleu == [(1, 1.0), (1, 1.0), (2, 1.0), (3, 0.0), (4, 0.0)]
    assert M.score_rows(df, ["id"]).filter("id = 1").count() == 8  # as a join of three metrics by key


def test_blocks_look_up_stems_and_sets(spark, monkeypatch):
    """Blocks of one row, of two and of all give the same matches."""
    df = spark.createDataFrame([(i, f"big cats run{'s' * (i % 2)} w{i}", f"a cat runs w{i} large") for i in range(20)],
                               "id int, generated string, question string")
    sets = spark.createDataFrame([("big", "s"), ("larg", "s")], "word string, set_id string")
    got = []
    for bits in (0, 1, 9):
        monkeypatch.setattr(M, "BLOCK_BITS", bits)
        scored = M.score_rows(df, ["id"], synonyms=sets, metrics=("meteor",))
        got.append(sorted((r.id, r.matches, r.chunks) for r in scored.collect()))
    assert got[0] == got[1] == got[2] == [(i, 4, 2) for i in range(20)]


def test_treebank_texts_without_marks_take_the_same_rules(spark):
    texts = ["plain words here.", "a, b: c?", "3,5 and 4:30, ok", "wait... no", "i cannot go. gonna", "x (y) z", "", None, "e.g. it",
             'say "hi"', "it's", "a.b. c!", "ends:", "ends,", "...", "."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    marked = df.select("id", F.concat("t", F.lit(" @")).alias("t"))  # a mark: every rule is applied
    for one in (False,):
        fast = {r.id: r.w for r in df.select("id", T.treebank_tokens("t", one).alias("w")).collect()}
        full = {r.id: r.w for r in marked.select("id", T.treebank_tokens("t", one).alias("w")).collect()}
        for i, t in enumerate(texts):
            if t is None:
                assert fast[i] is None
            elif not t.endswith((":", ",")):
                assert fast[i] == full[i][:-1]
    assert fast[12] == ["ends", ":"] and fast[13] == ["ends", ","]


def test_rows_of_a_pair_are_measured_in_one_step(spark):
    """Grouping by a part of the keys gives the same scores; words are cut in that step, not by expressions on each row."""
    rng = random.Random(6)
    text = lambda: rng.choice([None, "", " ".join(rng.choice(["run", "runs", "cats.", "a", "(b)", "É,"]) for _ in range(rng.randint(1, 9)))])
    rows = [(i // 6, i % 6, v, text(), text()) for i in range(60) for v in ("x", "y")] + [(0, 0, "x", "a cats.", "a")] * 2
    df = spark.createDataFrame(rows, "id int, rank int, variant string, generated string, question string")
    keys = ["id", "rank", "variant"]
    one, all_ = (sorted(map(str, M.score_rows(df, keys, by=by).collect())) for by in (["id"], None))
    assert one == all_ and len(one) == len(rows) - 3 + 27  # three metrics of a key's three rows
    plan = _plan(M.score_rows(df, keys, stems=False, by=["id"]))
    assert "lambda" not in plan and "regexp_replace" not in plan and plan.count("RepartitionByExpression") == 1


def test_words_are_cut_as_by_the_expressions(spark):
    texts = ["The cat's hat, (so) 3,5!", "a b", None, " ", "É É. x"]
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate((h, r) for h in texts for r in texts)],
                               "id int, generated string, question string")
    got = {r.id: r for r in M.score_rows(df, ["id"], stems=False).collect()}
    w = df.select("id", T.rouge_tokens("generated").alias("a"), T.rouge_tokens("question").alias("b"),
                  T.treebank_tokens("generated").alias("h"), T.treebank_tokens("question").alias("r"))
    bleu = {r.id: r for r in M.bleu_scores(w, ["id"], "h", "r").collect()}
    rouge = {r.id: r for r in M.rouge_columns(w, "a", "b").collect()}
    for i, row in got.items():
        assert row.rouge_f == pytest.approx(rouge[i].rouge_f)
        assert [row[f"bleu{n}"] for n in range(1, 5)] == pytest.approx([bleu[i][f"bleu{n}"] for n in range(1, 5)])


def test_bootstrap_ids_are_dealt_out(spark):
    df = spark.range(50).select("id", F.lit("a").alias("g"), F.lit(1.0).alias("x"))
    assert "RepartitionByExpression [id" in _plan(M.bootstrap_mean(df, "id", "x", "g"))


def test_no_words_at_all(spark):
    df = spark.createDataFrame([(1, "", None)], "id int, generated string, question string")
    r = M.score_rows(df, ["id"]).first()
    assert (r.rouge_f, r.bleu4, r.matches, r.meteor) == (0.0, 0.0, 0, 0.0)
    assert M.score_rows(df.filter("id > 1"), ["id"]).count() == 0
