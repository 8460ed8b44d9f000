import random
import re

import numpy as np

from quillpair.llm import near_dedup as N

W = re.compile(r"[^\x20\x09-\x0D]+")


def _set(t):
    w = W.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _brute(rows):
    sets = {i: _set(t) for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                comp[max(ra, rb)] = min(ra, rb)
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i, _ in rows)


def _edited(r, words, k):
    out = list(words)
    for _ in range(k):
        out[r.randrange(len(out))] = f"x{r.randrange(10 ** 6)}"
    return out


def _rows():
    r = random.Random(1)
    vocab = [f"v{i}" for i in range(500)]
    texts = [None, "", "  \n", "one two", "One  TWO", "one two three four five", "É a b c d", "é a b c d"]
    base = [r.choice(vocab) for _ in range(200)]
    texts += [" ".join(_edited(r, base, 3)) for _ in range(60)]  # pairs on both sides of the threshold
    for _ in range(12):
        own = [r.choice(vocab) for _ in range(r.choice([8, 60, 300]))]
        texts += [" ".join(own), " ".join(own).upper(), " ".join(own + ["tail"]), " ".join(_edited(r, own, 2))]
        texts.append(" ".join(own[: len(own) // 2] + base[:30]))
    texts += [" ".join(r.choice(vocab) for _ in range(30_000))] * 2
    return list(enumerate(texts))


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 600)  # several blocks a class
    rows = _rows()
    df = spark.createDataFrame([(i, t, 0, "r") for i, t in rows], "doc_id long, text string, n int, rep string")
    assert sorted(tuple(r) for r in N.near_dedup(df).collect()) == _brute(rows)


def test_empty_table(spark):
    assert N.near_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def _slow_signature(items):
    """The definition, one element at a time, without early stopping."""
    least = np.full(N.SLOTS, np.inf)
    for x in items:
        p = list(range(N.SLOTS))
        for j in range(N.SLOTS):
            d = int(N.mix64(np.array([x], np.uint64) + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2 ** 64))[0])
            k = j + ((d & 0xFFFFFFFF) * (N.SLOTS - j) >> 32)
            p[j], p[k] = p[k], p[j]
            least[p[j]] = min(least[p[j]], (d >> 32) * 2.0 ** -32 + j)
    return least


def test_signature_equals_definition():
    g = np.random.default_rng(0)
    sets = [np.unique(g.integers(0, 2 ** 63, n).astype(np.uint64)) for n in (1, 2, 17, 400, 1500)]
    got = N._sign_chunk(sets)
    for s, row in zip(sets, got):
        assert np.array_equal(row, _slow_signature(s))


def test_estimate_is_close():
    g = np.random.default_rng(2)
    x = g.integers(0, 2 ** 63, 1000).astype(np.uint64)
    sig = N.super_minhash([np.unique(x[:850]), np.unique(x)])
    assert abs((sig[0] == sig[1]).mean() - 0.85) < 0.12


def test_components(spark):
    from quillpair.llm.components import connected_components
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (300, 300), (201, 200)]
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}


def _brute_rows(rows):
    """Rows of one id are one document; None is smaller than all ids."""
    key = lambda i: float("-inf") if i is None else i
    sets = [(key(i), i, _set(t)) for i, t in rows]
    up = {k: k for k, _, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for x, (a, _, s) in enumerate(sets):
        for b, _, t in sets[x + 1:]:
            if s & t and 100 * len(s & t) >= 85 * len(s | t):
                ra, rb = root(a), root(b)
                up[max(ra, rb)] = min(ra, rb)
    names = {key(i): i for i, _ in rows}
    return [(i, len(s), names[root(k)] if s else i, not s or root(k) == k) for k, i, s in sets]


def test_repeated_and_null_ids(spark):
    r = random.Random(7)
    a, b, c, d = ([f"{x}{r.randrange(999)}" for _ in range(60)] for x in "abcd")
    text = lambda w, *more: " ".join([*w, *more])
    rows = [(5, text(a)), (5, text(b)), (5, text(c)), (10, text(a, "tail")), (20, text(b, "tail")), (30, text(c, "tail")),
            (3, text(b)), (7, text(d)), (7, text(d)), (8, text(d, "x")), (7, ""), (8, None), (None, text(a, "null")),
            (None, "alone in the world"), (None, ""), (-1, "alone in the world of five")]
    got = N.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda t: tuple((x is not None, x) for x in t)
    assert sorted(map(tuple, got), key=key) == sorted(_brute_rows(rows), key=key)
