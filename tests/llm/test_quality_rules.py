import random
import re

import zstandard

from quillpair.llm import quality_rules as Q

W = re.compile(r"[^\x20\x09-\x0D]+")


def _base(t):
    words = W.findall(t)
    n = len(words)
    wins = [tuple(words[i:i + 3]) for i in range(n - 2)]
    hit = {j for i, w in enumerate(wins) if wins.count(w) > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if W.search(line):
            dup += line in seen
            seen.add(line)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def _texts():
    r = random.Random(5)
    words = [f"w{chr(97 + i % 26)}{i}" for i in range(300)] + ["é", "日本", "#", "<b>", "\u00a0x", "\x1c"]
    clean = " ".join(r.choice(words) for _ in range(900))
    noise = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/ ") for _ in range(9000))
    return [None, "", " \n\t", "a b c a b c a b", clean, clean[:400], "spam spam eggs\n" * 40, noise,
            "same line\nsame line\n\n \nsame line", clean + "\n" + "x y z " * 3000]


def test_against_brute_force(spark):
    texts = _texts()
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, ratio int")
    got = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    z = zstandard.ZstdCompressor(level=Q.LEVEL)
    for i, t in enumerate(texts):
        r, t = got[i], t or ""
        assert tuple(r)[1:7] == _base(t)
        raw = t.encode()
        if raw:
            assert r.ratio == len(z.compress(raw)) / len(raw)
        assert not (r.base_failed and r.kept)
    assert got[4].kept and not got[6].kept and not got[7].kept and not got[9].kept


def _noise(r, alphabet, size):
    words = []
    while sum(map(len, words)) + len(words) < size:
        words.append("".join(r.choice(alphabet) for _ in range(r.randint(3, 8))))
    return " ".join(words)[:size]


def test_planted_noise(spark):
    r = random.Random(11)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    base64 = lower + lower.upper() + digits + "+/"
    sizes = {lower: (2_100, 3_500, 5_000, 12_000, 40_000), lower + digits: (1_600, 2_500, 5_000, 12_000, 40_000),
             base64: (340, 400, 600, 900, 1_500, 3_000, 9_000, 40_000), digits + "abcdef": (8_500, 12_000, 40_000)}
    noise = [_noise(r, alphabet, n) for alphabet, ns in sizes.items() for n in ns]
    got = Q.quality_rules(spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string")).collect()
    assert [(r.doc_id, len(noise[r.doc_id])) for r in got if r.base_failed or r.kept] == []


def test_given_prose_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert Q.quality_rules(docs).filter("NOT base_failed AND NOT kept").count() == 0


def test_many_distinct_words():
    words = [b"%d" % i for i in range(5000)]
    assert Q.repeat_words(words) == 0
    assert Q.repeat_words(words + words[:3]) == 6


def test_empty_table(spark):
    assert Q.quality_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
