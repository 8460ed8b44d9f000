import hashlib

from quillpair.llm.exact_dedup import exact_dedup


def _brute(rows):
    by = {}
    for i, t in rows:
        by.setdefault(t or "", []).append(i)
    return sorted((i, max(by[t or ""]), len(by[t or ""]), i == max(by[t or ""]),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


def test_against_brute_force(spark):
    rows = [(i, f"text {i % 70}" if i % 3 else "hot") for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "x" * 300_000), (1003, "x" * 300_000), (1004, "é\n"), (1005, "é")]
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, fp string, block int")
    got = sorted(tuple(r) for r in exact_dedup(df).collect())
    assert got == _brute(rows)


def test_one_row_of_a_group_stays(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (2, "a b"), (2, "a b"), (None, "a b"), (None, "d"), (None, "d"), (None, ""),
            (-1, ""), (None, None), (3, "e"), (3, "e"), (3, "f")] + [(None, "hot")] * 50
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.text_sha256, []).append(r)
    assert len(got) == len(rows) and len(groups) == len({t or "" for _, t in rows})
    for i, t in rows:
        g = groups[hashlib.sha256((t or "").encode()).hexdigest()]
        ids = [x for x, y in rows if (y or "") == (t or "")]
        best = max((x for x in ids if x is not None), default=None)
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in g) == sorted((x is None, x or 0) for x in ids)
        assert {(r.keep_id, r.group_size) for r in g} == {(best, len(ids))}
        assert [r.doc_id for r in g if r.kept] == [best]


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_colliding_fingerprints_are_split_by_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F

    from quillpair.llm import exact_dedup as E
    monkeypatch.setattr(E, "_fingerprint", lambda: F.length("text").cast("bigint"))
    rows = [(i, "abc"[i % 3] * (1 + i % 2)) for i in range(30)]
    got = sorted(tuple(r) for r in E.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == _brute(rows)
