"""TextRank in batches: equal to the relational form, convergence, slices."""

import random

import numpy as np
import pytest

from quillpair.operators import keywords as KW
from quillpair.operators import textrank_batches as TB

SCHEMA = "id string, t string, word int"


def _df(spark):
    r = random.Random(4)
    words = "red fox hen dog cat the of Éa éa x1 a 日本 barn, hay. owl".split()
    rows = [(f"d{i}", " ".join(r.choice(words) for _ in range(r.randint(0, 80))), 0) for i in range(40)]
    rows += [("big", "big red dog the red cat big", 0), ("end", "one two", 0), ("none", "the of", 0), ("e", "", 0), ("n", None, 0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("ratio", [0.2, 1.0])
def test_equals_the_relational_form(spark, ratio, monkeypatch):
    monkeypatch.setattr(TB, "SLICE_WORDS", 100)
    df = _df(spark)
    key = lambda r: (r.id, r.rank, r.word, r.score)
    assert sorted(map(key, TB.textrank_top(df, "id", "t", ratio).collect())) == sorted(
        map(key, KW.textrank_top(df, "id", "t", ratio).collect()))
    assert sorted(map(tuple, TB.keywords(df, "id", "t", ratio).collect())) == sorted(
        map(tuple, KW.keywords(df, "id", "t", ratio).collect()))


def test_converged_ranks_are_a_fixed_point(spark):
    df = _df(spark)
    near = {(r.id, r.word): r.score for r in TB.textrank_top(df, "id", "t", 1.0, 1000, tolerance=1e-12).collect()}
    edges = KW.textrank_edges(df, "id", "t").collect()
    degree = {}
    for e in edges:
        degree[e.id, e.src] = degree.get((e.id, e.src), 0) + 1
    assert set(near) == set(degree)
    for k in near:
        want = 0.15 + 0.85 * sum(near[e.id, e.src] / degree[e.id, e.src] for e in edges if (e.id, e.dst) == k)
        assert near[k] == pytest.approx(want, abs=5e-6)


def test_a_text_stops_by_itself():
    """A text's ranks don't depend on the texts beside it."""
    def ring(n, at):
        a = np.arange(n) + at
        b = (np.arange(n) + 1) % n + at
        chord = np.array([at, at + n // 2])
        src = np.concatenate([a, b, chord])
        return src, np.concatenate([b, a, chord[::-1]])
    (s1, d1), (s2, d2) = ring(9, 0), ring(40, 9)
    both = TB.power_iteration(np.concatenate([s1, s2]), np.concatenate([d1, d2]), np.repeat([0, 1], [9, 40]), 2, 100,
                              tolerance=1e-4)
    alone = TB.power_iteration(s1, d1, np.zeros(9, int), 1, 100, tolerance=1e-4)
    other = TB.power_iteration(s2 - 9, d2 - 9, np.zeros(40, int), 1, 100, tolerance=1e-4)
    assert both.tolist() == pytest.approx([*alone, *other], abs=1e-15)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([("k", "red fox red hen", 1), ("k", "red fox red hen", 1), ("k", "one two three", 1)], SCHEMA)
    assert sorted(r.keywords for r in TB.keywords(df, "id", "t", 0.4).collect()) == ["red", "red", "two"]
    assert TB.textrank_top(df.limit(0), "id", "t").count() == 0 and TB.keywords(df.limit(0), "id", "t").count() == 0


def test_no_shuffle(spark):
    plan = TB.textrank_top(_df(spark), "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
