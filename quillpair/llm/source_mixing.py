"""Mixing sources to target weights by the cube method.

Targets: sources in code-point order (null last) get the weights in turn and share a multiple of all words by weight. No
target exceeds `most` times its source's words; what it would get beyond is shared again by weight. That is one water
level for all sources: sorted by (cap / weight), the sources before the level are at their caps. Sorting and running
totals are distributed (operators.numbering), so the number of sources has no bound.

Sampling: a document of a source is wanted rate = target / source words times. It is taken floor(rate) times for sure,
and once more with the fractional probability that is left. Which ones: equal rows (id, source, size) are one unit with
a count, units are dealt by hash to groups of about GROUP, and in a group the cube method's flight moves the
probabilities of three units at a time along the null space of the two balance constraints (documents and words), until
one of them is 0 or 1; the expected values of all units and both totals stay as they are. At most two units of a group
stay open. They meet again in groups of their source, level by level, until a source fits in one group; there the
landing drops the constraint on words, then that on documents. Units fly by falling size, so the last ones are small.
Groups depend on ids and sizes only and draws on the group, so a rerun gives the same rows however they are partitioned.

Null text counts as no words; a null id is an id like any other. Repeated rows are drawn together and reported one by
one. Documents without words are balanced by number. A table without words takes nothing; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import numbered, running_total
from .common import SPACE_CLASS, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Units of one group, about; bounds a task's memory and changes no total.
GROUP = 4096
SEED = 12
#: Copies of one row that an array lists at a time.
COPIES = 1 << 16
_NEAR = 1e-9

_FLOWN = "doc_id bigint, skey string, size bigint, copies bigint, sure bigint, p double, settled boolean"


def _move(p: list[float], units: list[int], v: tuple[float, ...], u: float) -> None:
    """Move the probabilities of units along v or -v, until one is 0 or 1; expectations stay."""
    up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(units, v) if d)
    down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(units, v) if d)
    step = up if u * (up + down) < down else -down
    for i, d in zip(units, v):
        x = p[i] + step * d
        p[i] = 0.0 if x < _NEAR else 1.0 if x > 1 - _NEAR else x


def flight(size: Sequence[float], p: list[float], draws: Sequence[float]) -> list[int]:
    """Cube flight phase in place: afterwards p is 0 or 1 but for the returned units, two at most, and sum(p) and
    sum(p * size) are what they were."""
    open_: list[int] = []
    for unit, u in enumerate(draws):
        if not 0 < p[unit] < 1:
            continue
        open_.append(unit)
        if len(open_) == 3:
            x, y, z = (size[i] for i in open_)
            _move(p, open_, (z - y, x - z, y - x) if x != y or y != z else (1.0, -1.0, 0.0), u)
            open_ = [i for i in open_ if 0 < p[i] < 1]
    return open_


def landing(p: list[float], open_: list[int], draws: Sequence[float]) -> None:
    """Settle the last units: keep the number of documents while two are open, then draw."""
    if len(open_) == 2:
        _move(p, open_, (1.0, -1.0), draws[0])
        open_ = [i for i in open_ if 0 < p[i] < 1]
    for i in open_:
        p[i] = 1.0 if draws[1] < p[i] else 0.0


def _fly(level: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("place", "ascending"), ("doc_id", "ascending"),
                               ("copies", "ascending")])
        n, p = table.num_rows, table.column("p").to_pylist()
        size = [float(x) for x in table.column("size").to_pylist()]
        first = table.slice(0, 1).to_pylist()[0]
        draws = np.random.default_rng([SEED, level, first["bucket"], zlib.crc32(first["skey"].encode())]).random(n + 2)
        open_ = flight(size, p, draws[:n].tolist())
        if first["buckets"] == 1:
            landing(p, open_, draws[n:].tolist())
        settled = [not 0 < x < 1 for x in p]
        out = table.select(["doc_id", "skey", "size", "copies", "sure"])
        return out.append_column("p", pa.array(p, pa.float64())).append_column("settled", pa.array(settled, pa.bool_()))
    return run


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """(skey, source, source_size, units, target) from rows (skey, source, size, copies)."""
    per = sizes.groupBy("skey", "source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"),
                                              F.count(F.lit(1)).alias("units"))
    per = numbered(per, [F.col("source").asc_nulls_last()], "rank")
    per = (per.withColumn("weight", F.get(F.array(*[F.lit(w).cast("bigint") for w in weights]),
                                          F.pmod("rank", F.lit(len(weights))).cast("int")))
           .withColumn("cap", most * F.col("source_size")))
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("rank").asc()]
    per = running_total(running_total(per, order, "weight", "weight_before"), order, "cap", "cap_before")
    per = written(per, "mix-sources")
    everything = per.agg(F.sum("weight").alias("w"), F.sum("source_size").alias("s"))
    # The level if all before this source are at their caps; at or above its own ratio, it is too.
    level = (share * F.col("s") - F.col("cap_before")) / (F.col("w") - F.col("weight_before"))
    capped = per.crossJoin(F.broadcast(everything)).withColumn("full", level >= F.col("cap") / F.col("weight"))  # one row
    rest = capped.agg(
        F.try_divide(share * F.max("s") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0)),
                     F.sum(F.when(~F.col("full"), F.col("weight")))).alias("level"))
    return capped.crossJoin(F.broadcast(rest)).select(  # one row
        "skey", "source", "source_size", "units",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, group: int = GROUP) -> DataFrame:
    """One row per input row: doc_id, source, size (words), source_size, target (of the source), times (how often the
    mix takes the document) and taken (its words in the mix)."""
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(f"{SPACE_CLASS.replace('[', '[^')}+"))
    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"),
                     size.cast("bigint").alias("size"))
    units = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    skey = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))  # equal for null sources, so that they join
    units = written(units.withColumn("skey", skey), "mix-units")
    targets = written(source_targets(units, weights, share, most), "mix-targets")
    want = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)) * F.col("copies")
    wanted = units.join(targets.select("skey", "target", "source_size"), "skey").select(
        "doc_id", "skey", "size", "copies", F.floor(want).cast("bigint").alias("sure"), (want - F.floor(want)).alias("p"))
    settled = wanted.filter(f"p < {_NEAR}").withColumn("p", F.lit(0.0))
    open_, level = wanted.filter(f"p >= {_NEAR}"), 0
    while True:
        # Open units of each source: a row per source, written so that the planner knows its size.
        buckets = written(open_.groupBy("skey").agg(F.ceil(F.count(F.lit(1)) / F.lit(group)).cast("int").alias("buckets")),
                          "mix-buckets")
        place = F.xxhash64(F.lit(SEED + level), "doc_id", "size")
        dealt = (open_.join(buckets, "skey").withColumn("place", place)
                 .withColumn("bucket", F.pmod("place", F.col("buckets")).cast("int")))
        flown = written(dealt.groupBy("skey", "bucket").applyInArrow(_fly(level), _FLOWN), "mix-flown")
        settled = settled.unionByName(flown.filter("settled").drop("settled"))
        open_, level = flown.filter("NOT settled").drop("settled"), level + 1
        if open_.isEmpty():
            break
    total = F.col("sure") + F.round("p").cast("bigint")
    out = (settled.withColumn("total", total)
           .withColumn("first", F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES}L)")))
           .withColumn("copy", F.explode(F.expr(f"sequence(first, least(first + {COPIES}L, copies) - 1)")))
           .withColumn("times", F.expr("(total div copies) + if(copy < total % copies, 1, 0)").cast("bigint")))
    return out.join(targets, "skey").select("doc_id", "source", "size", "source_size", "target", "times",
                                            (F.col("times") * F.col("size")).alias("taken"))
