"""TextRank on hand-made texts."""

import pytest

from quillpair.operators import keywords as KW

SCHEMA = "id string, t string, word int"


def _rank(edges, steps=20, d=0.85):
    nodes = sorted({x for e in edges for x in e})
    near = {x: [y for e in edges for y in e if x in e and y != x] for x in nodes}
    r = {x: 1.0 for x in nodes}
    for _ in range(steps):
        r = {x: (1 - d) + d * sum(r[y] / len(near[y]) for y in near[x]) for x in nodes}
    return r


def test_scores_of_a_small_graph(spark):
    df = spark.createDataFrame([("k", "Red fox red dog. The fox fox, hen", 0), ("empty", "", 0), ("null", None, 0)], SCHEMA)
    got = {r.word: r.score for r in KW.textrank_scores(KW.textrank_edges(df, "id", "t"), "id").collect()}
    assert got == pytest.approx(_rank([("red", "fox"), ("red", "dog"), ("fox", "hen")]))


def test_stems_join_word_forms(spark):
    df = spark.createDataFrame([("k", "running dogs run dog", 0)], SCHEMA)
    edges = {(r.src, r.dst) for r in KW.textrank_edges(df, "id", "t", stems=True).collect()}
    assert edges == {("run", "dog"), ("dog", "run")}
    (r,) = KW.keywords(df, "id", "t", ratio=0.5, stems=True).collect()
    assert r.keywords == "dogs dog"  # of two equal stems the first by name; both its words are kept


def test_phrases_use_each_word_once(spark):
    # all words kept: first places 0-2 are one phrase; cat stands alone; the text's last word is a repeat
    df = spark.createDataFrame([("k", "big red dog the red cat big", 0), ("end", "one two", 0), ("none", "the of", 0)], SCHEMA)
    got = {r.id: r.keywords for r in KW.keywords(df, "id", "t", ratio=1.0).collect()}
    assert sorted(got["k"].split()) == ["big", "cat", "dog", "red"] and "big red dog" in got["k"]
    assert got["end"] == "two"  # a phrase that reaches the end of the text gives its last word
    assert got["none"] == ""


def test_one_very_long_text(spark):
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}q" for i in range(676)]
    df = spark.createDataFrame([("k", " ".join(words * 30), 0)], SCHEMA)
    assert KW.textrank_top(df, "id", "t", iterations=3).count() == int(0.2 * 676)


def test_edges_of_repeated_and_null_ids_are_distinct(spark):
    rows = [(1, "red fox red fox"), (1, "fox red hen"), (None, "red fox"), (None, "fox red"), (2, None), (3, ""), (4, "red the fox"),
            (5, "red")]
    df = spark.createDataFrame(rows, "id int, t string")
    edges = sorted(((r.id or 0, r.src, r.dst) for r in KW.textrank_edges(df, "id", "t").collect()))
    want = {(1, "red", "fox"), (1, "red", "hen"), (0, "red", "fox")}
    assert edges == sorted(want | {(i, b, a) for i, a, b in want})


def test_pairs_of_single_ids_are_not_shuffled(spark):
    """Once texts meet their ids' numbers, only the union's branch of repeated ids is aggregated by pair."""
    df = spark.createDataFrame([(1, "red fox red fox")], "id int, t string")
    plan = KW.textrank_edges(df, "id", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.index("Union") < plan.index("Aggregate [_id")


def test_stems_of_repeated_ids_null_texts_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(KW, "BLOCK_BITS", 0)
    rows = [(1, "Running dogs run the dog"), (1, "dogs running hopes"), (2, None), (3, ""), (4, "hoping, dog 5 dogs dog hopes"),
            (None, "hoping dogs")] + [(i, "foxes sleeping") for i in range(10, 30)]
    df = spark.createDataFrame(rows, "id int, t string")
    got = sorted((r.id or 0, r.src, r.dst) for r in KW.textrank_edges(df, "id", "t", stems=True).collect())
    und = {(1, "run", "dog"), (1, "run", "hope"), (4, "hope", "dog"), (0, "hope", "dog")} | {(i, "fox", "sleep") for i in range(10, 30)}
    assert got == sorted(und | {(i, b, a) for i, a, b in und})


@pytest.mark.parametrize("slice_edges,most", [(1, 10**6), (7, 10**6), (10**6, 10), (3, 10)])
def test_ranks_of_slices_and_of_large_ids(spark, monkeypatch, slice_edges, most):
    monkeypatch.setattr(KW, "SLICE_EDGES", slice_edges)
    monkeypatch.setattr(KW, "MOST_EDGES", most)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        graphs = {i: [(f"a{i}", f"b{k}") for k in range(1 + i)] + [("b0", "c")] for i in range(12)}
        edges = [(i, x, y) for i, es in graphs.items() for a, b in es for x, y in ((a, b), (b, a))]
        df = spark.createDataFrame(edges + [(None, "x", "y"), (None, "y", "x")], "id int, src string, dst string")
        got = {(r.id, r.word): r.score for r in KW.textrank_scores(df, "id", whole_ids=True).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == pytest.approx({(i, w): s for i, es in graphs.items() for w, s in _rank(es).items()})


def test_ranks_and_stems_take_no_join_by_word_of_a_text(spark):
    df = spark.createDataFrame([("k", "running dogs run dog", 0)], SCHEMA)
    plan = KW.textrank_top(df, "id", "t", stems=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan
