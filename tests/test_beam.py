"""Beam search: against exhaustive search, its limits, and the learned transitions."""

import itertools
import math
import random

import pytest

from quillpair.operators import beam as B


def _edges(seed, words="abcd", end=0.6):
    r = random.Random(seed)
    out = {}
    for a in (B.BEGIN, *words):
        out[a] = [(b, -r.randint(1, 3_000_000)) for b in words if r.random() < 0.6]
        if a != B.BEGIN and r.random() < end:
            out[a].append((B.END, -r.randint(1, 3_000_000)))
    return out


def _all_sequences(edges, max_length, no_repeat):
    """Every finished sequence, or open one of the full length, that the rules allow."""
    out, todo = [], [(0, (B.BEGIN,))]
    while todo:
        s, path = todo.pop()
        for b, lp in edges.get(path[-1], ()):
            new = path + (b,)
            grams = [new[i:i + no_repeat] for i in range(len(new) - no_repeat + 1)]
            if len(grams) > len(set(grams)):
                continue
            if b == B.END:
                out.append((s + lp, new[1:-1]))
            elif len(new) == max_length + 1:
                out.append((s + lp, new[1:]))
            else:
                todo.append((s + lp, new))
    return out


@pytest.mark.parametrize("penalty,no_repeat", [(1.0, 2), (1.5, 2), (0.0, 1), (2.0, 3)])
def test_wide_beam_equals_exhaustive_search(penalty, no_repeat):
    for seed in range(25):
        edges = _edges(seed, "abc")
        want = sorted(((B.penalised(s, len(w), penalty), w) for s, w in _all_sequences(edges, 5, no_repeat)),
                      key=lambda x: (-x[0], x[1]))
        got = B.beam_search(edges, beams=1_000, max_length=5, length_penalty=penalty, no_repeat_ngram=no_repeat,
                            early_stopping=False, n=1_000)
        assert got == want


def test_no_ngram_repeats_and_length_limit():
    edges = {B.BEGIN: [("a", -1)], "a": [("b", -1), ("a", -5)], "b": [("a", -1)]}
    got = B.beam_search(edges, beams=4, max_length=256)
    for _, words in got:
        pairs = list(itertools.pairwise((B.BEGIN, *words)))
        assert len(pairs) == len(set(pairs))
    assert got == []  # no end follows and every path dies out
    assert [w for _, w in B.beam_search(edges, beams=4, max_length=2, n=4)] == [("a", "b"), ("a", "a")]


def test_early_stopping_and_penalty():
    edges = {B.BEGIN: [("a", -100)], "a": [(B.END, -2_000_000), ("b", -1)], "b": [(B.END, -1_900_000), ("c", -1)],
             "c": [(B.END, -1)]}
    assert [w for _, w in B.beam_search(edges, beams=1, early_stopping=True)] == [("a", "b", "c")]
    two = B.beam_search(edges, beams=2, early_stopping=True, n=2)
    assert [w for _, w in two] == [("a", "b"), ("a",)]  # two are finished before the third is reached
    late = B.beam_search(edges, beams=2, early_stopping=False, n=2)
    assert [w for _, w in late] == [("a", "b", "c"), ("a", "b")]
    short = B.beam_search({B.BEGIN: [("a", -9), ("x", -30)], "a": [(B.END, -1)], "x": [("y", -1)], "y": [(B.END, -1)]},
                          length_penalty=0.0, n=1)
    assert short[0][1] == ("a",)


def test_learned_and_smoothed(spark):
    questions = spark.createDataFrame([("What is it? Is it red.",), (None,), ("",), ("is it",)], "question string")
    learned = {(r.a, r.b): (r.n, r.n_a) for r in B.learn_transitions(questions).collect()}
    assert learned["is", "it"] == (3, 3) and learned[B.BEGIN, "is"] == (2, 3) and learned["it", B.END] == (2, 3)
    ctx = spark.createDataFrame([(1, "It is it. Is new!"), (2, ""), (3, None)], "id int, c string")
    got = {(r.a, r.b): r.lp for r in B.context_transitions(ctx, "id", "c", B.learn_transitions(questions)).collect()}
    assert got["is", "it"] == round(1e6 * math.log((3 + 0.5) / 4)) and got["is", "new"] == round(1e6 * math.log(0.5 / 4))
    assert got["new", B.END] == 0 and (B.BEGIN, "what") not in got


def test_questions_per_context(spark):
    ctx = spark.createDataFrame([("x", "The fox runs home. The hen runs away. A fox sleeps."), ("y", " "), ("z", None),
                                 ("x2", "One two three.")], "id string, c string")
    learned = B.learn_transitions(spark.createDataFrame([("The fox sleeps?",)], "question string"))
    rows = B.generate_beam(ctx, "id", "c", learned, n=3).collect()
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r["id"], []).append(r["generated"])
    assert set(out) == {"x", "x2"} and out["x2"] == ["one two three?"]
    assert out["x"][0] == "the fox sleeps?" and len(set(out["x"])) == 3
    assert B.generate_beam(ctx.limit(0), "id", "c", learned).count() == 0
    with pytest.raises(ValueError):
        B.generate_beam(ctx, "id", "c", learned, n=11)
