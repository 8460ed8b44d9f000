"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

1. A text's set holds the 64-bit hashes of its distinct shingles of five words (A-Z lowered); a text with fewer
   words is one shingle, one without words has the empty set and is linked with nothing.
2. Texts with equal sets form a class; its smallest id stands for it from here on.
3. SuperMinHash: each shingle draws ranks r + j at the slots of a random permutation, j = 0, 1, ..., and a slot keeps
   the smallest. Slots drawn by one shingle differ, so the estimate varies less than with independent hashes, and a
   text stops at the first j that no slot exceeds: mostly after one or two steps.
4. Banding: classes that agree in all BAND_ROWS slots of a band share a bucket. At a similarity of 0.85 a pair shares
   none of the 24 bands with probability (1 - 0.85**5)**24 < 1e-6.
5. Candidates: in each bucket the smallest member is compared with the others. Buckets that then still hold several
   components compare members of different components in blocks: members are classed by set size, since only equal
   or neighbouring classes can be similar enough, and a large class is dealt to several blocks, so one bucket is the
   work of many tasks. Signatures first tell which members have a likely partner at all; their texts go to the same
   blocks, and a block answers with the links that join its components, at most one per member. So a group of
   thousands of near copies sends rows in proportion to its members, and no link that joins components is lost.
6. A pair needs fitting set sizes and enough agreeing slots (a pair over the threshold has under MIN_AGREE, five
   standard deviations below it, with probability < 1e-6); what passes is verified on the full sets, recomputed from
   the whole texts.
7. Links go through partition-local union-find and alternating stars.

Null text counts as empty. Rows with one id are one document: it is linked by any of its texts, and a text without words
reports the id itself. A null id stays null and is smaller than all others. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed_texts, maybe_in, with_null_ids, written
from .components import connected_components
from .wordhash import mix64, word_hashes

SHINGLE = 5
PERCENT = 85
BANDS = 24
BAND_ROWS = 5
SLOTS = BANDS * BAND_ROWS
MIN_AGREE = 0.69
#: Shingles in one block, about; a pair of blocks is compared at a time.
BLOCK_SHINGLES = 150_000
#: Shingles signed at a time; bounds the permutation state.
CHUNK = 100_000

_MIX = np.random.default_rng(3).integers(1, 1 << 62, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_SKETCH = "doc_id bigint, n bigint, set_hi bigint, set_lo bigint, bands array<bigint>, slots binary"


def shingles(raw: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text in UTF-8."""
    h = word_hashes(raw)
    n = len(h)
    if not n:
        return h
    size = min(n, SHINGLE)
    s = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        s += h[k:n - size + 1 + k] * _MIX[k]
    return np.unique(mix64(s))


def _sign_chunk(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash values (texts, SLOTS) of non-empty sets, all texts one rank level at a time."""
    sizes = np.array([len(s) for s in sets])
    least = np.full((len(sets), SLOTS), np.inf)
    doc = np.repeat(np.arange(len(sets)), sizes)
    item = np.concatenate(sets)
    perm = None
    for j in range(SLOTS):
        draw = mix64(item + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        rank = (draw >> np.uint64(32)).astype(np.float64) * 2.0 ** -32 + j
        k = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(SLOTS - j)) >> np.uint64(32)).astype(np.int64)
        if perm is None:
            slot = k
        else:
            each = np.arange(len(item))
            slot = perm[each, k].astype(np.int64)
            perm[each, k] = perm[each, j]
        np.minimum.at(least.reshape(-1), doc * SLOTS + slot, rank)
        going = least.max(axis=1) > j + 1
        if not going.any():
            break
        stay = going[doc]
        if perm is None:
            item, doc, k = item[stay], doc[stay], k[stay]
            perm = np.tile(np.arange(SLOTS, dtype=np.uint8), (len(item), 1))
            perm[np.arange(len(item)), k] = 0
        elif not stay.all():
            item, doc, perm = item[stay], doc[stay], perm[stay]
    return least


def super_minhash(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of non-empty sets, as 64-bit values that agree where the smallest ranks agree."""
    out, held, n = [], [], 0
    for s in sets:
        if held and n + len(s) > CHUNK:
            out.append(_sign_chunk(held))
            held, n = [], 0
        held.append(s)
        n += len(s)
    if held:
        out.append(_sign_chunk(held))
    return mix64(np.concatenate(out).view(np.uint64)) if out else np.empty((0, SLOTS), np.uint64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _SKETCH.split(", ")]
    for whole in batches:
        for a in range(0, whole.num_rows, 500):
            batch = whole.slice(a, 500)
            sets = [shingles(t.as_buffer().to_pybytes()) for t in batch.column(1)]
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = super_minhash([sets[i] for i in full])
            band = np.zeros((len(full), BANDS), np.uint64)
            for r in range(BAND_ROWS):
                band = mix64(band * np.uint64(31) + sig[:, r::BAND_ROWS] + np.arange(BANDS, dtype=np.uint64))
            bands: list = [None] * len(sets)
            slots: list = [None] * len(sets)
            for i, b, s in zip(full, band.astype(np.int64), (sig & np.uint64(255)).astype(np.uint8)):
                bands[i], slots[i] = b, s.tobytes()
            digest = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            hi, lo = np.frombuffer(b"".join(digest), ">i8").reshape(-1, 2).T.astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(hi), pa.array(lo),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(slots, pa.binary())], names=names)


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x, y = (_slots(batch.column(c)) for c in ("slots_a", "slots_b"))
            keep = pa.array((x == y).mean(axis=1) >= MIN_AGREE)
            yield batch.select(["a", "b"]).filter(keep)


def _slots(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SLOTS)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each task, from batches sorted by task."""
    held: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
        if held is None or not held.num_rows:
            continue
        task = held.column("task").to_numpy()
        cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist()]
        if batch is None:
            cuts.append(len(task))
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                yield held.slice(a, b - a)
        held = held.slice(cuts[-1])  # the last task may go on in the next batch


def _likely(rows: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs between the two blocks of a task (or inside its one block) that have fitting sizes, enough agreeing
    slots and different components."""
    side, n, comp = (rows.column(c).to_numpy() for c in ("side", "n", "component"))
    slots = _slots(rows.column("slots"))
    first, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    inside = not len(other)
    if inside:
        other = first
    for a in range(0, len(first), 64):
        f = first[a:a + 64]
        small, large = np.minimum(n[f][:, None], n[other]), np.maximum(n[f][:, None], n[other])
        fit = (100 * small >= percent * large) & (comp[f][:, None] != comp[other])
        if inside:
            fit &= f[:, None] < other
        i, j = np.nonzero(fit)
        for c in range(0, len(i), 1 << 15):
            x, y = f[i[c:c + (1 << 15)]], other[j[c:c + (1 << 15)]]
            ok = (slots[x] == slots[y]).mean(axis=1) >= MIN_AGREE
            if ok.any():
                yield x[ok], y[ok]


def _with_partner(percent: int):
    """(task, rep) of members that have a likely partner in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            hit = np.zeros(rows.num_rows, bool)
            for x, y in _likely(rows, percent):
                hit[x] = hit[y] = True
            if hit.any():
                yield rows.select(["task", "rep"]).filter(pa.array(hit)).combine_chunks().to_batches()[0]
    return run


def _joining_links(percent: int):
    """Verified links of each task that join components, by union-find inside the task."""
    def of_task(rows: pa.Table) -> list[tuple[int, int]]:
        rep, comp = (rows.column(c).to_pylist() for c in ("rep", "component"))
        texts_, sets, up, out = rows.column("text"), {}, {}, []

        def root(c: int) -> int:
            while (p := up.setdefault(c, c)) != c:
                up[c] = c = up.setdefault(p, p)
            return c

        def shingled(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(texts_[i].as_buffer().to_pybytes())
            return sets[i]

        for xs, ys in _likely(rows, percent):
            for x, y in zip(xs.tolist(), ys.tolist()):
                a, b = root(comp[x]), root(comp[y])
                if a != b:
                    s, t = shingled(x), shingled(y)
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    if 100 * both >= percent * (len(s) + len(t) - both):
                        up[max(a, b)] = min(a, b)
                        out.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            if links := of_task(rows):
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, np.empty(0, np.uint64)  # the leader's text and its set
        for batch in batches:
            keep = []
            for text_a, text_b in zip(batch.column(2), batch.column(3)):
                raw = text_a.as_buffer().to_pybytes()
                if raw != last:  # rows come sorted by a from the join, so a leader's set is made once a text
                    last, x = raw, shingles(raw)
                y = shingles(text_b.as_buffer().to_pybytes())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def near_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    docs = keyed_texts(df, key, text)
    sketch = written(docs.mapInArrow(_sketch, _SKETCH), "near-sketch")
    same = ["set_hi", "set_lo"]
    classes = sketch.filter("n > 0").groupBy(*same).agg(F.min("doc_id").alias("rep"))
    again = written(sketch.filter("n > 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
                    .select("doc_id"), "near-again")
    held = (sketch.filter("n > 0").select("doc_id", *same).join(again, "doc_id", "left_semi").distinct()
            .join(classes, same).select("doc_id", "rep").distinct())
    first = held.groupBy("doc_id").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("reps")).filter("reps > 1")
    one_id = written(held.join(first, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b")), "near-ids")
    reps = sketch.filter("n > 0").join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    member = (reps.select(F.col("doc_id").alias("rep"), "n", F.posexplode("bands").alias("band", "hash"))
              .select(F.xxhash64("band", "hash").alias("bucket"), "rep", "n"))
    shared = (member.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("lead"))
              .filter("size > 1"))
    open_ = written(member.join(shared, "bucket"), "near-buckets")

    slots = sketch.filter("n > 0").select("doc_id", "slots", "n")

    def signed(side: str) -> DataFrame:
        return slots.select(F.col("doc_id").alias(side), F.col("slots").alias(f"slots_{side}"), F.col("n").alias(f"n_{side}"))

    stars = open_.filter("rep > lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    likely = (stars.join(signed("a"), "a").join(signed("b"), "b")
              .filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
              .select("a", "b", "slots_a", "slots_b").mapInArrow(_agree, "a bigint, b bigint"))
    likely = written(likely, "near-pairs")
    body = maybe_in(docs, F.col("doc_id"), likely.select(F.explode(F.array("a", "b")).alias("id")), "id")
    both = (likely.join(body.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(body.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"))
    links = written(both.select("a", "b", "text_a", "text_b")
                    .mapInArrow(_verify(percent), "a bigint, b bigint"), "near-links")
    links = links.unionByName(one_id)
    grouped = written(connected_components(links), "near-components")
    # Members but the leader, in buckets that hold more than one component.
    rest = (open_.filter("size > 2 AND rep > lead").select("bucket", "rep", "n")
            .join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep"))
            .withColumn("cls", F.floor(F.log("n") / F.lit(math.log(100 / percent) * 1.001 + 1e-9)).cast("bigint")))
    mixed = rest.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rest = written(rest.join(mixed.filter("low <> high").select("bucket"), "bucket"), "near-rest")
    blocks = rest.groupBy("bucket", "cls").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    # A member stands in a task with every block of its own class and of the two neighbouring ones.
    near = (rest.join(blocks.withColumnRenamed("blocks", "own"), ["bucket", "cls"])
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("own")).cast("int"))
            .withColumn("step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
            .withColumn("to", F.col("cls") + F.col("step"))
            .join(blocks.select("bucket", F.col("cls").alias("to"), F.col("blocks").alias("others")), ["bucket", "to"])
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1))))
    mine, theirs = F.struct("cls", "block"), F.struct(F.col("to").alias("cls"), F.col("other").alias("block"))
    tasks = near.select(F.xxhash64("bucket", F.least(mine, theirs), F.greatest(mine, theirs)).alias("task"),
                        (mine > theirs).cast("int").alias("side"), "rep", "n", "component")
    tasks = written(tasks.join(slots.select(F.col("doc_id").alias("rep"), "slots"), "rep"), "near-tasks")

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("task").sortWithinPartitions("task")

    asked = written(dealt(tasks).mapInArrow(_with_partner(percent), "task bigint, rep bigint"), "near-asked")
    body = maybe_in(docs, F.col("doc_id"), asked, "rep").select(F.col("doc_id").alias("rep"), "text")
    rest = dealt(tasks.join(asked, ["task", "rep"], "left_semi").join(body, "rep"))
    # Written first: read by the next Python step in one stage, each task would hold two workers.
    joining = written(rest.mapInArrow(_joining_links(percent), "a bigint, b bigint"), "near-links")
    links = links.unionByName(joining)
    grouped = written(connected_components(links), "near-components")
    rows = sketch.select("doc_id", "n", *same)
    linked = (rows.filter("n > 0").join(classes, same).join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
              .select("doc_id", "n", F.coalesce("component", "rep").alias("component_id")))
    empty = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))  # no empty text is joined
    out = linked.unionByName(empty).select("doc_id", F.col("n").alias("n_shingles"), "component_id").withColumn(
        "kept", F.col("doc_id") == F.col("component_id"))
    return with_null_ids(out, "doc_id", "component_id")
