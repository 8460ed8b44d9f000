import random
import re
import zlib
from collections import Counter

import pytest

from quillpair.llm import spelling_variants as S


def _near(a, b):
    """Exactly one inserted, deleted or replaced character, by trying every place."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(words):
    out = {}
    for w, n in words.items():
        near = [x for x in words if _near(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 5 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    rows = []
    for w, (form, n, k, fn) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, k, fn))
    return sorted(rows)


def _words(seed, alphabet, n, lengths):
    r = random.Random(seed)
    out = {}
    while len(out) < n:
        w = "".join(r.choice(alphabet) for _ in range(r.choice(lengths)))
        for _ in range(r.randint(0, 3)):
            out[w] = r.choice((5, 6, 20, 25, 100, 130, 700, 4000))
            i = r.randrange(len(w))
            w = r.choice((w[:i] + w[i + 1:], w[:i] + r.choice(alphabet) + w[i:], w[:i] + r.choice(alphabet) + w[i + 1:]))
            if len(w) < 6:
                break
    return out


@pytest.mark.parametrize("alphabet,lengths,frequency,list_words", [
    ("ab", (6, 7, 8, 9), 16, 256), ("ab", (6, 7, 12), 1, 4), ("abcdefgh", (6, 7, 9, 14), 2, 3),
    ("abcéÿ×", (6, 8), 3, 256), ("abcdefghijklmnopqrst", (6, 7, 8, 30), 0, 2)])
def test_forms_equal_brute_force(spark, alphabet, lengths, frequency, list_words):
    words = _words(len(alphabet) + frequency, alphabet, 500, lengths)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = S.spelling_variants(df, min_frequency=frequency, list_words=list_words).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == _brute(words)


def test_near_words_share_a_list():
    """For any set of frequent grams: the lists that the operator builds hold every near pair."""
    r = random.Random(6)

    def lists(word, frequent, shorter):
        return {(p, q, word[:p], word[len(word) - q:]) for p, q in S.probes(word, frequent) if p + q <= shorter}

    for case in range(400):
        w = "".join(r.choice("abc") for _ in range(r.randint(6, 12)))
        i = r.randrange(len(w) + 1)
        x = r.choice((w[:i] + r.choice("abc") + w[i:], w[:i] + r.choice("abc") + w[i + 1:]))
        marked = [f"\x02{y}\x03" for y in (w, x)]
        grams = {m[i:i + q] for m in marked for q in range(2, 7) for i in range(len(m) - q + 1)}
        frequent = frozenset(g for g in grams if r.random() < r.choice((0.2, 0.6, 1.0)))
        if _near(w, x) and len(x) >= 6:
            m = min(len(w), len(x))
            assert lists(w, frequent, m) & lists(x, frequent, m)


def test_every_word_has_more_grams_than_an_edit_changes():
    for n in range(6, 40):
        w = "\x02" + "a" * n + "\x03"
        for frequent in (frozenset(), frozenset("a" * q for q in range(2, 7)), frozenset({"aa", "aaa", "\x02a"})):
            grams = S.variable_grams(w, frequent)
            assert len(grams) > S.most_affected(grams, len(w))


def _slipped(rows):
    counts = Counter()
    for doc, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_counts_equal_brute_force(spark, monkeypatch):
    r = random.Random(3)
    vocab = ["Straße", "ÉTÉété", "naïveté", "window", "Windows", "x×y÷zab", "日本window", "re-window", "abc", "İstanbul"]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(0, 60)))) for i in range(400)]
    rows += [(None, "window " * 9), (5, None), (6, ""), (7, "window"), (7, "window")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n int")
    got = {r.word: r.n for r in S.word_counts(df, slip=199).collect()}
    assert got == _slipped(rows) and len(got) > 8


def test_empty_tables(spark):
    none = S.word_counts(spark.createDataFrame([], "doc_id long, text string"))
    assert S.spelling_variants(none).count() == 0
    one = spark.createDataFrame([("window", 7)], "word string, n long")
    assert list(map(tuple, S.spelling_variants(one).collect())) == [("window", None, "window", 7, 0, None)]
