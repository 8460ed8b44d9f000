"""Column text functions against Python behaviour on hand-written rows."""

import random
import re

from pyspark.sql import functions as F

from quillpair.functions import text as T
from tests.conftest import one_col

WS_CHARS = [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ",
            "　", " "]


def _col(spark, values, expr):
    df = one_col(spark, values).select("id", expr.alias("out")).orderBy("id")
    return [r.out for r in df.collect()]


def test_ws_tokens_match_python_split(spark):
    rng = random.Random(7)
    alphabet = list("ab é'.,") + WS_CHARS
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    texts += ["", "   ", "a\xa0b", "x y"]
    got = _col(spark, texts, T.ws_tokens("t"))
    assert [list(g) for g in got] == [t.split() for t in texts]


def test_lower_collapse(spark):
    texts = ["  Hello\tWORLD \n x ", "", "A\xa0B"]
    assert _col(spark, texts, T.lower_collapse("t")) == [" ".join(t.lower().split()) for t in texts]


def test_word_boundaries_like_python(spark):
    texts = ["café the_b a1 what's", "café abc", "it's don't 12ab ab", "whatever what WHAT"]
    got = _col(spark, texts, T.alpha_words(T.lower_collapse("t")))
    want = [re.findall(r"\b[a-zA-Z]{2,}\b", " ".join(t.lower().split())) for t in texts]
    assert [list(g) for g in got] == want
    qw = _col(spark, texts, T.question_words(T.lower_collapse("t")))
    pat = r"\b(?:how|what|why|who|where|would|whom|which)\b"
    assert [list(g) for g in qw] == [re.findall(pat, " ".join(t.lower().split())) for t in texts]


def test_anchored_phrases_like_python(spark):
    rng = random.Random(3)
    words = ["what", "is", "a", "b", "what,", "c", "the"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(200)]
    texts += ["what is a b", "what what is a b", "what is, a b", "x what is a"]
    got = _col(spark, texts, T.anchored_phrases(T.lower_collapse("t"), "what"))
    want = [re.findall(r"\bwhat\s+\w+\s+\w+\s+\w+\b", " ".join(t.lower().split())) for t in texts]
    assert [list(g) for g in got] == want


def test_normalise_text_urls_tags_entities(spark):
    rows = {"see http://a.b/c now": "see  now", "HTTP://A.B stays": "http://a.b stays", "www.x.y gone": " gone",
            "<i>z</i>": "z", "<p\n>split tag": "<p\n>split tag",
            "&amp; &AMP; &#39; &#x27; ok": " &amp;   ok", "café ok": "caf ok", "": "", "tab\there": "tab\there",
            "it 's Don't": "it is do not", "<b>Bold</b> Text": "bold text"}
    assert _col(spark, list(rows), T.normalise_text("t")) == list(rows.values())


def test_contractions(spark):
    texts = ["let's go", "can't", "Don't", "it 's", "we 're", "It’s", "foo's", "I'm HERE", "DON'T"]
    got = _col(spark, texts, T.expand_contractions(F.replace(F.col("t"), F.lit(" '"), F.lit("'"))))
    assert got == ["let us go", "cannot", "Do not", "it is", "we are", "It is", "foo's",
                   "I am HERE", "DO NOT"]


def test_leading_apostrophe(spark):
    rows = {"'cause": "because", "'CAUSE why": "BECAUSE why", "'Cause I": "Because I", "x 'cause y": "x because y",
            "'causeway": "'causeway", "'don't'": "'do not'", "rock ’n’ roll": "rock ’n’ roll", "''": "''"}
    assert _col(spark, list(rows), T.expand_contractions("t")) == list(rows.values())


def test_treebank_tokens(spark):
    rows = {
        "Hello, world. How are you?": ["hello", ",", "world", ".", "how", "are", "you", "?"],
        "I can't go (now)!": ["i", "ca", "n't", "go", "(", "now", ")", "!"],
        "a--b; c": ["a", "--", "b", ";", "c"],
        "cannot": ["can", "not"],
        "'Tis the season": ["'t", "is", "the", "season"],
        "so 'twas": ["so", "'t", "was"],
        "d'ye more'n that": ["d", "'ye", "more", "'n", "that"],
        "say “hello” now": ["say", "“", "hello", "”", "now"],
        'he said "yes".': ["he", "said", "``", "yes", "''", "."],
    }
    got = [list(x) for x in _col(spark, list(rows), T.treebank_tokens("t"))]
    assert got == list(rows.values())


def test_rouge_tokens(spark):
    got = _col(spark, ["Hello, World-2 ÉTÉ"], T.rouge_tokens("t"))
    assert list(got[0]) == ["hello", "world", "2", "t"]


def test_contraction_guard_keeps_slang_and_plain_text(spark):
    # rows without an apostrophe take the guarded fast path
    texts = ["I'm gonna go", "GONNA win", "Kinda odd", "plain text here", None, "it’ll rain"]
    got = _col(spark, texts, T.expand_contractions("t"))
    assert got == ["I am going to go", "GOING TO win", "Kind of odd", "plain text here", None,
                   "it will rain"]
