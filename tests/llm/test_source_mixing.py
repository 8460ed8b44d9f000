import random
import re
from collections import defaultdict

import pytest

from quillpair.llm import source_mixing as M

W = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes):
    """Share by weight, cut at twice the size, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        more = {s for s in rest if share[s] > 2 * sizes[s]}
        if not more:
            return {s: share.get(s, 2.0 * sizes[s]) for s in names}
        full |= more


def _check(rows, got, loose=2.0):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (i is None, i or 0, len(W.findall(t or ""))) for i, t, _ in rows)
    sizes, taken, docs, rate = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for _, t, s in rows:
        sizes[s] += len(W.findall(t or ""))
        docs[s] += 1
    want = _targets(sizes)
    most = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.times * r.size and 0 <= r.times <= 2
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.times <= int(rate) + 1
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    for s in sizes:  # within two documents of the target
        assert abs(taken[s] - want[s]) <= loose * most[s] + 1e-6, (s, taken[s], want[s])
    for s in sizes:  # the number of documents is balanced, too
        times = sum(r.times for r in got if r.source == s)
        if sizes[s]:
            assert abs(times - docs[s] * want[s] / sizes[s]) <= 2


def _rows(n, seed):
    r = random.Random(seed)
    names = ["a", "b", "B", "é", None, "z", ""]
    return [(i, " ".join("w" for _ in range(int(r.paretovariate(1.2)) % 400)),
             "a" if r.random() < 0.35 else r.choice(names)) for i in range(n)]


def _df(spark, rows):
    return spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, size int")


def test_totals_and_reruns(spark):
    rows = _rows(3000, 4) + [(None, "a b", "a")] * 3 + [(7, "x y z", "b")] * 40 + [(8, None, "c"), (9, "", "c")]
    df = _df(spark, rows)
    got = M.mix(df, group=64).collect()
    _check(rows, got)
    again = M.mix(df.repartition(7), group=64).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.source or "", r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_flight_keeps_both_totals():
    r = random.Random(2)
    for case in range(200):
        n = r.randint(1, 60)
        size = [float(r.choice((3, 3, 5, 80, r.randint(0, 999)))) for _ in range(n)]
        p = [r.choice((0.25, 0.5, r.random())) for _ in range(n)]
        q = list(p)
        open_ = M.flight(size, q, [r.random() for _ in range(n)])
        assert len(open_) <= 2 and all(x in (0, 1) for i, x in enumerate(q) if i not in open_)
        assert sum(q) == pytest.approx(sum(p), abs=1e-6)
        assert sum(a * b for a, b in zip(q, size)) == pytest.approx(sum(a * b for a, b in zip(p, size)), abs=1e-3)
        M.landing(q, open_, [r.random(), r.random()])
        assert all(x in (0, 1) for x in q)


def test_flight_keeps_expectations():
    r, n, size, p = random.Random(9), 4000, [9.0, 5.0, 5.0, 2.0, 1.0], [0.3, 0.6, 0.5, 0.9, 0.4]
    seen = [0.0] * 5
    for _ in range(n):
        q = list(p)
        M.landing(q, M.flight(size, q, [r.random() for _ in q]), [r.random(), r.random()])
        seen = [a + b for a, b in zip(seen, q)]
    assert [x / n for x in seen] == pytest.approx(p, abs=0.04)


def test_small_tables(spark):
    for rows in ([(1, "a b c", "x")], [(1, None, None), (2, "", None)], [(1, "a", "x"), (1, "a", "x"), (1, "b b", "y")]):
        _check(rows, M.mix(_df(spark, rows)).collect(), loose=3)
    assert M.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_copies_of_one_row_are_listed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(M, "COPIES", 16)
    rows = [(5, "a b", "x")] * 100 + [(i, "a b c", "y") for i in range(100)]
    _check(rows, M.mix(_df(spark, rows)).collect())
