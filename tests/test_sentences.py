"""Sentence model: learned abbreviations, boundaries, tokens by sentence; synonym walk against the sequential one."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quillpair.functions import text as T
from quillpair.operators import metrics as M
from quillpair.operators import sentences as SE

WORDS = "the bird sang near river stone deep water many people like old town rain came early year day fruit tools".split()


def sentence(rng):
    """Words of any order; an abbreviation or an initial stands before a name or a small word, never at the end."""
    words = [rng.choice(WORDS) for _ in range(rng.randint(4, 9))]
    at = rng.randint(1, len(words) - 1)
    words[at:at] = rng.choice([[], [], ["Dr.", rng.choice(["Brown", "Green"])], ["e.g."], ["J.", "Smith"]])
    return " ".join([words[0].capitalize(), *words[1:]]) + rng.choice("...!")


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    texts = [" ".join(sentence(rng) for _ in range(8)) for _ in range(150)] + [None, "", " \n "]
    return spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)


@pytest.fixture(scope="module")
def model(corpus):
    return SE.learn_sentences(corpus, "text")


def split(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    out = {}
    for r in sorted(SE.split_sentences(df, ["id"], "text", model).collect()):
        out.setdefault(r.id, []).append(r.sentence)
        assert r.pos == len(out[r.id])
    return [out.get(i, []) for i in range(len(texts))]


def test_abbreviations_are_learned(model):
    found = {r.word: r for r in model.abbreviations.collect()}
    assert set(found) == {"dr", "e.g", "j"}
    assert all(r.n == r.n_period for r in found.values())


def test_abbreviation_score_formula(corpus, model):
    words = [w for r in corpus.collect() for w in (r.text or "").split()]
    n, p = len(words), sum(w.endswith(".") for w in words) / len(words)
    k = words.count("Dr.")
    want = 2 * (k * math.log(0.99) - k * math.log(p)) * math.exp(-2)
    got = model.abbreviations.filter("word = 'dr'").first().score
    assert got == pytest.approx(want) and n > 0


def test_boundaries(spark, model):
    texts = [
        "We met Dr. Brown. He sang.",  # an abbreviation before a name
        "Bring fruit, e.g. apples. Rain came.",  # before a small letter
        "Look for tools, e.g. The bird sang.",  # before a word that is small elsewhere and large at starts only
        "Old J. Smith came! Rain? Yes.",  # an initial
        'They said "Rain came." Then it stopped.',  # a closing quote
        "One (of two). Three, four; five", "Etc., and so on.", "First line\nof a town.\nNext", "Dr.", None, "", " \t ",
    ]
    assert split(spark, model, texts) == [
        ["We met Dr. Brown.", "He sang."], ["Bring fruit, e.g. apples.", "Rain came."],
        ["Look for tools, e.g.", "The bird sang."], ["Old J. Smith came!", "Rain?", "Yes."],
        ['They said "Rain came."', "Then it stopped."], ["One (of two).", "Three, four; five"], ["Etc., and so on."],
        ["First line of a town.", "Next"], ["Dr."], [], [], []]


def test_no_word_is_lost(spark, model):
    rng = random.Random(8)
    parts = ["Dr.", "e.g.", "J.", "The", "town", "3.", "12.5", "...", "wait...", "Why?!", "(so.)", "a,", "É.", "—", ".", "?"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(60)] + ["town! " * 30000]
    for text, got in zip(texts, split(spark, model, texts)):
        assert " ".join(got).split() == text.split()
    assert len(got) == 30000


def test_empty_corpus_cuts_at_every_mark(spark):
    empty = SE.learn_sentences(spark.createDataFrame([], "text string"), "text")
    assert SE.model_rows(empty).count() == 0
    assert split(spark, empty, ["Dr. Brown came. Rain"]) == [["Dr.", "Brown came.", "Rain"]]


def test_corpus_of_periods_only(spark):
    every = SE.learn_sentences(spark.createDataFrame([("a. b. c.",)], "text string"), "text")
    assert every.abbreviations.count() == 0  # a period says nothing where every word has one


def test_clashing_columns(spark, model):
    df = spark.createDataFrame([(1, "We met Dr. Brown. Rain.", "x")], "word bigint, next string, held string")
    rows = SE.split_sentences(df, ["word"], "next", model).collect()
    assert sorted((r.pos, r.sentence) for r in rows) == [(1, "We met Dr. Brown."), (2, "Rain.")]


def test_treebank_keeps_inner_periods(spark):
    row = spark.range(1).select(T.treebank_tokens(F.lit("We met Dr. Brown (again)."), True).alias("one"),
                                T.treebank_tokens(F.lit("We met Dr. Brown (again).")).alias("every")).first()
    assert row.one == ["we", "met", "dr.", "brown", "(", "again", ")", "."]
    assert row.every == ["we", "met", "dr", ".", "brown", "(", "again", ")", "."]


def test_bleu_uses_sentences(spark, model):
    df = spark.createDataFrame([(1, "we met dr. brown .", "we met dr. brown ."), (2, "dr.", "dr . x"), (3, "", "a"), (4, None, "a")],
                               "id bigint, generated string, question string")
    got = {r.id: r for r in M.score_rows(df, ["id"], metrics=("bleu",), sentences=model).collect()}
    assert got[1].bleu4 == pytest.approx(1.0) and got[3].bleu1 == 0.0 and set(got) == {1, 2, 3, 4}
    words = M._sentence_words(df, ["id"], "generated", "question", model).filter("id = 1").first()
    assert words["_h"] == ["we", "met", "dr.", "brown", "."]


def sequential(h, r):
    """Each word from the end, against each free word from the end."""
    free, out = list(range(len(r))), []
    for i in range(len(h))[::-1]:
        for j in free[::-1]:
            if h[i] & r[j]:
                out.append([i, j])
                free.remove(j)
                break
    return out


def test_synonym_walk_is_the_sequential_one():
    rng = random.Random(2)
    for _ in range(500):
        h, r = ([{rng.choice("abcdef") for _ in range(rng.randint(0, 3))} for _ in range(rng.randint(0, 12))] for _ in "hr")
        flat = lambda x: zip(*[(i, s) for i, ws in enumerate(x) for s in sorted(ws)] or [((), ())])
        lists = [list(c) if x and any(x) else [] for x in (h, r) for c in (flat(x) if any(x) else ([], []))]
        assert M.greedy_pairs(*lists) == sequential(h, r)


def test_synonyms_of_several_sets(spark):
    sets = spark.createDataFrame([("car", 1), ("car", 2), ("auto", 2), ("cart", 1), ("auto", 2), (None, 3), ("bus", None)],
                                 "word string, set_id int")
    df = spark.createDataFrame([(1, "auto car", "cart auto x"), (2, "car car", "cart auto"), (3, "bus", "x"), (4, "", "car")],
                               "id bigint, generated string, question string")
    got = {r.id: (r.matches, r.chunks) for r in M.score_rows(df, ["id"], synonyms=sets, metrics=("meteor",)).collect()}
    assert got == {1: (2, 2), 2: (2, 1), 3: (0, 0), 4: (0, 0)}


def test_bare_tokens_equal_the_patterns(spark):
    """Only tokens with a quote, a bracket or one of ,;: at an end need the patterns."""
    import re
    tokens = ["word", "a.b.", "(x)", '"Hi,"', "end;", ",", "»«", "x,y", "it's", "'t", "Éa", "¡no", "3,5", "a):", "...", "“q”.", "\"", "["]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    got = {r.t: (r.b.core, r.b.soft) for r in df.select("t", SE._bare(F.col("t")).alias("b")).collect()}
    for t in tokens:
        assert got[t] == (re.sub(SE.CLOSING, "", re.sub(SE.OPENING, "", t)), bool(re.search(SE.SOFT, t))), t


def test_join_of_held_places_takes_texts_not_arrays(spark):
    df = spark.createDataFrame([(1, "He saw Mr. Fox. It ran.")], "id int, t string")
    plan = SE.sentence_arrays(df, ["id"], "t", SE.learn_sentences(df, "t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_joined" in plan


def test_tokens_are_typed_once_per_distinct_one(spark, model):
    """No expression walks the tokens of a text: they are counted and cut in batches, and distinct ones get a type."""
    df = spark.createDataFrame([(1, "He saw Mr. Fox. It ran.")], "id int, t string")
    for x in (SE.adjacent_types(df, "t"), SE.split_sentences(df, ["id"], "t", model)):
        plan = x._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan and "split(" not in plan


@pytest.mark.parametrize("size", [1, 40, 10**7])
def test_adjacent_counts_equal_a_walk(monkeypatch, size):
    import pyarrow as pa
    from collections import Counter
    rng = random.Random(size)
    parts = ["a", "b.", "c..", "D!", "e,", 'f."', " ", " ", "\n", "\x85", "é.", ",", ".", "(", "ß?"]
    texts = [None if rng.random() < 0.1 else "".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    want, got = Counter(), Counter()
    for t in texts:
        stop, before = "start", None
        for w in (t or "").split():
            want[before if stop == "." else None, stop, w] += 1
            stop, before = SE.token_stop(w), w
    monkeypatch.setattr(SE, "SLICE_BYTES", size)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 37], pa.string())], names=["t"]) for i in range(0, 200, 37)]
    for b in SE._count_adjacent(iter(batches)):
        for p, stop, w, n in zip(*(c.to_pylist() for c in b.columns)):
            got[p, stop, w] += n
    assert got == want


def test_marks_equal_the_typed_ones(spark):
    tokens = ["a.", "a..", "a!", "a?)", 'a."', "a,", 'a,"', "(", ")", '"', ".", "..", "...", "a.)", "a.),", "(.", "«a.»", "a;.", "é.’", "a"]
    df = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", SE._bare(F.col("t")).alias("b"))
    for r in df.select("t", SE._typed(F.col("b"))["stop"].alias("s")).collect():
        assert SE.token_stop(r.t) == r.s, r.t
        assert SE.marks_of([r.t]) == ([(1, r.s)] if r.s else []), r.t


@pytest.mark.parametrize("one", [False, True])
def test_treebank_in_python_equals_the_expressions(spark, one):
    rng = random.Random(4)
    parts = ["a", "can", "not", "cannot", "gonna", "d", "'ye", "'t", "is", "n't", "'s", '"', "''", "``", "“", "’", "»", ".", "...",
             ",", ":", "3", "٣", "½", "é", "Σ", "İ", "_", "--", "(", "]", "?", "$", "&", " ", " ", "\n", "\r", "\r\n", "\x85", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.lower("t").alias("l"), T.treebank_tokens("t", one).alias("w"))
    words = T.Treebank(one)
    for r in df.collect():
        assert words(r.l) == r.w, r.l


def test_words_of_sentences_are_cut_in_batches(spark, model):
    df = spark.createDataFrame([(1, "we met dr. brown .", "x")], "id bigint, generated string, question string")
    plan = M._sentence_words(df, ["id"], "generated", "question", model)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "regexp_replace(_joined" not in plan
