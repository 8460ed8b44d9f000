"""Connected components of a link table, by local union-find and alternating stars; nothing meets in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition: each node with its smallest local root."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up.setdefault(y, y)
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    links = [(x, r) for x in up if (r := root(x)) != x]
    if links:
        u, v = np.array(links, np.int64).T
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); component is the smallest node reachable."""
    edges = written(links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
                    .mapInArrow(_forest, "u bigint, v bigint"), "components")  # u > v throughout
    while True:
        parents = edges.select(F.col("v").alias("u")).distinct()
        more = edges.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("x")).filter("m <> x").select("u")
        if edges.join(parents, "u", "left_semi").select("u").unionByName(more).limit(1).isEmpty():
            return edges.distinct().select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                parents.select(F.col("u").alias("node"), F.col("u").alias("component")))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).filter("u <> v").distinct())
        large = written(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = written(small, "components")
