import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from quillpair.llm import periodic_runs as P

W = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(words):
    """Every lag, every maximal stretch, smallest period per interval."""
    n, least = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                least.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, n_, q) for (s, n_), q in least.items()), key=lambda r: (r[0], r[2]))


def _sequences():
    r = random.Random(3)
    out = [[], ["a"] * 5, ["a"] * 6, ["a"] * 50, list("ab") * 4, list("abab") * 3 + list("aaaaaaa"),
           list("aab") * 4 + list("ab") * 4 + ["c"] + list("aab") * 5, list("x") + list("abcde") * 4 + list("abcd")]
    for _ in range(300):
        out.append([r.choice("abc"[:r.randint(1, 3)]) for _ in range(r.randint(0, 60))])
    for _ in range(60):
        words = []
        for _ in range(r.randint(1, 5)):
            unit = [f"w{r.randint(0, 30)}" for _ in range(r.randint(1, 12))]
            words += (unit * r.randint(1, 9))[:r.randint(1, 80)] + [f"w{r.randint(0, 40)}" for _ in range(r.randint(0, 9))]
        out.append(words)
    return out


def test_runs_equal_brute_force():
    for words in _sequences():
        assert P.word_runs(words) == _brute(words), words
        assert sorted(P.lag_scan(np.array([zlib.crc32(w.encode()) for w in words], np.int64)),
                      key=lambda r: (r[0], r[2])) == _brute(words)


def test_segments_hold_only_frequent_words_and_every_run():
    for words in _sequences():
        segments = P.stable_segments(words)
        for a, b in segments:
            assert all(words[a:b].count(w) >= 4 for w in words[a:b])
        assert all(any(a <= s and s + n <= b for a, b in segments) for s, n, _ in _brute(words))


def test_long_texts_take_no_quadratic_time():
    n = 200_000
    assert P.word_runs([b"a"] * n) == [(0, n, 1)]
    unit = [b"%d" % i for i in range(40_000)]
    assert P.word_runs(unit * 5) == [(0, n, 40_000)]
    # each split frees one word more: a segment that shrinks from its end
    shrink = [w for i in range(20_000) for w in (b"%d" % i, b"%d" % (i + 1), b"%d" % i, b"%d" % (i + 1))]
    assert P.word_runs(shrink) == []
    r = random.Random(1)
    assert P.word_runs([b"%d" % r.randint(0, 20) for _ in range(n)]) is not None


def _expected(doc_id, text):
    words = W.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _brute(words)
    best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def test_query_equals_brute_force(spark):
    r = random.Random(8)
    rows = [(None, "x " * 9), (None, None), (1, None), (2, ""), (3, " \n\t"), (3, "a b\n" * 7), (3, "a b\n" * 7),
            (4, "é é  é é  é é é é é é"), (5, "日 本 " * 8)]
    rows += [(i, " ".join(f"w{r.randint(0, 30)}" for _ in range(r.randint(0, 120)))) for i in range(10, 160)]
    df = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, runs long")
    got = P.run_digests(P.periodic_runs(P.with_planted_periods(df))).collect()
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    key = lambda t: tuple((x is not None, x) for x in t)
    assert sorted(map(tuple, got), key=key) == sorted((_expected(*r) for r in rows), key=key)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.run_digests(P.periodic_runs(P.with_planted_periods(df))).count() == 0
