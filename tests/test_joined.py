"""Phrases of the joined column equal one regex over the joined text."""

import random
import re
from collections import Counter

from quillpair.operators.joined import top_phrases_joined


def test_equal_to_the_joined_text(spark):
    rng = random.Random(5)
    words = ["what", "what", "is", "a", "-", "what,", ""]
    rows = [(i, None if i % 17 == 3 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 5)))) for i in range(300)]
    joined = " ".join(" ".join(t.lower().split()) for _, t in rows if t is not None)
    want = Counter(re.findall(r"\bwhat \w+ \w+ \w+", joined))
    df = spark.createDataFrame(rows, "id bigint, text string").repartition(7)
    got = top_phrases_joined(df, "id", "text", k=10_000).collect()
    order = list(want)
    assert [(r.phrase, r.n) for r in got] == sorted(want.items(), key=lambda x: (-x[1], order.index(x[0])))
    assert top_phrases_joined(df.limit(0), "id", "text").collect() == []
