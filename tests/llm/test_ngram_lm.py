import math
import random
import zlib
from collections import Counter

import pytest

from quillpair.llm import ngram_lm as L


def _words(t):
    return [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or "").translate(
        {i: " " for i in range(9, 14)})).split(" ") if w] + ["</s>"]


def _brute(rows, order):
    """The model by dictionaries, with frequencies quantised alike."""
    train = [_words(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    grams = [Counter() for _ in range(order + 1)]
    for ws in train:
        run = ["<s>"] * (order - 1) + ws
        for k in range(1, order + 1):
            for j in range(order - 1, len(run)):
                grams[k][tuple(run[j - k + 1:j + 1])] += 1
    total, follow = Counter(), Counter()
    for k in range(2, order + 1):
        for g, c in grams[k].items():
            total[g[:-1]] += c
            follow[g[:-1]] += 1
    n, v = sum(grams[1].values()), len(grams[1])
    out = {}
    for i, t in rows:
        ws = _words(t)
        run, base, score = ["<s>"] * (order - 1) + ws, 0.0, 0.0
        for j in range(order - 1, len(run)):
            p = (grams[1][run[j],] + 1) / (n + v + 1)
            base += math.log10(p)
            for k in range(2, order + 1):
                g = tuple(run[j - k + 1:j + 1])
                if total[g[:-1]]:
                    f = 0.0
                    if grams[k][g]:
                        f = 10 ** (-round(-math.log10((grams[k][g] - .75) / total[g[:-1]]) * 32) / 32)
                    p = f + .75 * follow[g[:-1]] / total[g[:-1]] * p
            score += math.log10(p)
        out[i] = (len(ws), sum(grams[1][w,] > 0 for w in ws), n, base, score)
    return out


def _rows():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(60)] + ["É", "x\u00a0y"]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randrange(80)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, "NEVER seen\tbefore W1"), (503, "w1 " * 3000)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(spark, order, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, level int, keys string")
    model = L.train(df.filter(~L.held_out()), order=order)
    got = {r.doc_id: r for r in L.score(df.repartition(3), model).collect()}
    for i, (n, known, tokens, base, score) in _brute(rows, order).items():
        r = got[i]
        assert (r.n_tokens, r.n_known, model["tokens"]) == (n, known, tokens)
        assert r.base_score == pytest.approx(base, abs=1e-9) and r.score == pytest.approx(score, abs=1e-6)


def test_probabilities_sum_to_about_one(spark):
    rows = [(i, "a b a c b b a") for i in range(20)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = [f"a {w}" for w in ("a", "b", "c")] + ["a"]
    s = {r.doc_id: r.score for r in L.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                                            model).collect()}
    assert all(math.isfinite(x) and x < 0 for x in s.values())


def test_default_order_uses_two_words_of_context(spark):
    rows = [(i, "a b c") for i in range(20)] + [(20 + i, "x b d") for i in range(20)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string"))
    asked = spark.createDataFrame([(1, "a b c"), (2, "a b d")], "doc_id long, text string")
    s = {r.doc_id: r.score for r in L.score(asked, model).collect()}
    assert s[1] > s[2] + 1  # a model of one word of context gives both the same


def test_held_out(spark):
    df = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", L.held_out().alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in df.collect())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = L.train(none)
    assert L.score(none, model).collect() == []
    r = L.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first()
    assert (r.n_tokens, r.n_known, r.base_score, r.score) == (3, 0, 0.0, 0.0)
