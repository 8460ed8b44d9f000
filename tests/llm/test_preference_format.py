from quillpair.llm import preference_format as P


def _render(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def _mask(turns):
    return " ".join(f"m{len(r) + 13} {'t' if r == 'assistant' else 'm'}{len(t) + 10} m1" for r, t in turns)


def _brute(c, r):
    n = 0
    while n < min(len(c), len(r)) and c[n] == r[n]:
        n += 1
    return (n, len(c) - n, len(r) - n, _render(c[:n]), _render(c[n:]), _mask(c[n:]), _render(r[n:]), _mask(r[n:]))


U, A = "user", "assistant"
CASES = [([(U, "a"), (A, "b")], [(U, "a"), (A, "c")]), ([(U, "a")], [(U, "a"), (A, "x")]), ([(U, "a")], [(A, "a")]),
         ([(U, "")] * 3, [(U, "")] * 3), ([(U, "é🙂" * 50_000), (A, "yes")], [(U, "é🙂" * 50_000), (A, "")]),
         ([], [(U, "only rejected")]), ([(U, "only chosen"), (A, "x")], []),
         ([("system", "s"), (U, "q"), (A, "r"), (U, "q2"), (A, "r2")], [("system", "s"), (U, "q"), (A, "z"), (U, "q2"), (A, "r2")])]


def _table(spark, side):
    rows = [(i, j * 2, r, t, "x") for i, c in enumerate(CASES) for j, (r, t) in enumerate(c[side])]
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, side string")


def test_against_brute_force(spark):
    out = {r.pair_id: tuple(r)[1:] for r in P.format_preferences(_table(spark, 0), _table(spark, 1)).collect()}
    assert out == {i: _brute(*c) for i, c in enumerate(CASES)}


def test_nulls_ties_and_marks(spark):
    schema = "conv_id long, turn int, role string, text string"
    c = spark.createDataFrame([(1, 0, None, None), (1, 0, None, None), (1, None, "system", "<|im_end|>x"), (None, 0, U, "q")], schema)
    out = P.format_preferences(c, c).collect()
    assert len(out) == 1 and out[0].prompt_turns == 3 and out[0].chosen == out[0].rejected_mask == ""
    assert out[0].prompt == _render([("system", "<| im_end|>x"), (U, ""), (U, "")])


def test_empty_tables(spark):
    none = _table(spark, 0).limit(0)
    assert P.format_preferences(none, none).collect() == []


def test_weaker_reply_and_native_plan(spark):
    c = _table(spark, 0)
    out = P.format_preferences(c, P.with_weaker_reply(c))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    r = {x.pair_id: x for x in out.collect()}
    assert r[7].prompt_turns == 4 and "r<|im_end|>" in r[7].rejected and r[1].chosen_turns == 0
