"""Profile helpers: the first-seen key orders like (row, position)."""

import random

from pyspark.sql import functions as F

from quillpair.operators import profile as P


def test_first_seen_orders_like_the_pair(spark):
    rng = random.Random(3)
    big = 2 ** 62
    rows = [(rng.choice([rng.randint(-big, big), rng.randint(-3, 3)]),
             rng.choice([0, 1, 2 ** 31 - 1, rng.randint(0, 2 ** 31 - 1)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "r bigint, p int")
    got = [(x.r, x.p) for x in df.orderBy(P.first_seen("r", "p")).collect()]
    assert got == sorted(rows)
    m = df.agg(F.min(P.first_seen("r", "p")).alias("m")).first().m
    assert int(m) == min(rows)[0] * 2 ** 31 + min(rows)[1]
