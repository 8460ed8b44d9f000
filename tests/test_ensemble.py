"""Vocabulary extension (I5) and the rare-word ensemble."""

from quillpair.operators import ensemble as EN


def _vocab(spark, rows):
    return spark.createDataFrame(rows, "token string, id bigint")


def test_add_token_absent_gets_next_id(spark):
    v = _vocab(spark, [("<pad>", 0), ("a", 1), ("b", 7)])
    assert sorted(EN.add_token(v, "<sep>").collect()) == sorted(
        [("<pad>", 0), ("a", 1), ("b", 7), ("<sep>", 8)])


def test_add_token_present_is_unchanged(spark):
    v = _vocab(spark, [("<pad>", 0), ("<sep>", 1), ("b", 2)])
    assert sorted(EN.add_token(v, "<sep>").collect()) == sorted(v.collect())


def test_add_token_empty_vocab(spark):
    assert EN.add_token(_vocab(spark, []), "<sep>").collect() == [("<sep>", 0)]


def _vv(spark, **tokens):
    return spark.createDataFrame([(v, t) for v, ts in tokens.items() for t in ts], "variant string, token string")


def test_ensemble_rules(spark):
    vv = _vv(spark, lead="abc", cloze="abc")
    cands = spark.createDataFrame([
        (1, "lead", "a x y"), (1, "cloze", "a b x"),      # fewer rare words wins
        (2, "lead", "a b c x"), (2, "cloze", "a x"),      # equal rare, shorter wins
        (3, "lead", "a x"), (3, "cloze", "b y"),          # full tie -> first variant
    ], "pair_id int, variant string, generated string")
    out = {r["pair_id"]: (r["generated"], r["chosen"])
           for r in EN.ensemble(cands, vv, {"lead": 0, "cloze": 1}).collect()}
    assert out == {1: ("a b x", "cloze"), 2: ("a x", "cloze"), 3: ("a x", "lead")}


def test_each_variant_has_its_own_vocabulary(spark):
    cands = spark.createDataFrame([(1, "lead", "a b"), (1, "cloze", "a b")], "pair_id int, variant string, generated string")
    got = {r.variant: r.rare_words for r in EN.rare_word_counts(cands, _vv(spark, lead="ab", cloze="a")).collect()}
    assert got == {"lead": 0, "cloze": 1}


def test_with_ensemble_matches_ensemble(spark):
    vv = _vv(spark, lead="abc", cloze="abc")
    cands = spark.createDataFrame([
        (1, "lead", "a x y", "q1"), (1, "cloze", "a b x", "q1"),
        (2, "lead", "a b c x", "q2"), (2, "cloze", "a x", "q2"),
        (3, "lead", "a x", "q3"), (3, "cloze", "b y", "q3"), (4, "lead", "", "q4"),
    ], "pair_id int, variant string, generated string, question string")
    prio = {"lead": 0, "cloze": 1}
    both = EN.with_ensemble(cands, vv, prio)
    picked = EN.ensemble(cands, vv, prio).drop("chosen")
    cols = ["pair_id", "generated", "variant"]
    assert (sorted(both.filter("variant = 'combined'").select(cols).collect())
            == sorted(picked.select(cols).collect()))
    assert (sorted(both.filter("variant <> 'combined'").select(cols).collect())
            == sorted(cands.select(cols).collect()))


def test_vocabulary_is_whole_and_ordered(spark):
    df = spark.createDataFrame([("b a c a",), ("a b </s>",), (None,)], "text string")
    got = sorted((r.id, r.token) for r in EN.learn_vocab(df.repartition(3), "text").collect())
    assert got == [(0, "<pad>"), (1, "</s>"), (2, "<unk>"), (3, "a"), (4, "b"), (5, "c")]


def test_corpus_tokens_leave_no_empty_string_and_take_no_lambda(spark):
    rows = [(1, "  red\tfox\n"), (2, ""), (3, None), (4, " red\xa0hen "), (5, " \n")]
    out = EN._corpus_tokens(spark.createDataFrame(rows, "id int, t string"), "t")
    assert sorted(r.token for r in out.collect()) == ["fox", "hen", "red", "red"]
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
