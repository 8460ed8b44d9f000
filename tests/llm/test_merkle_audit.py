import hashlib
import random

from pyspark.sql import functions as F

from quillpair.llm import merkle_audit as M

SCHEMA = "page_id long, url string, html string, idx int, file string"


def _pages():
    r = random.Random(7)
    rows = [(i, f"http://h/{i}", "é" * r.randrange(200), 0, "f") for i in range(0, 9_000, 3)]
    return rows + [(None, None, None, 0, "f"), (-5, "u", "neg", 0, "f"), (3, "again", "copy", 0, "f"), (9, "big", "z" * 500_000, 0, "f")]


def _differing(a, b):
    def by(rows):
        out = {}
        for i, u, h, *_ in rows:
            out.setdefault(-1 if i is None else i, []).append((u, h))
        return {k: sorted(v, key=str) for k, v in out.items()}
    a, b = by(a), by(b)
    return {(k, "missing" if k not in b else "extra" if k not in a else "changed") for k in a.keys() | b.keys()
            if a.get(k) != b.get(k)}


def test_locates_every_difference(spark):
    a, r = _pages(), random.Random(1)
    b = [(i, u, (h or "") + "!", k, f) if r.random() < .002 else (i, u, h, k, f) for i, u, h, k, f in a if r.random() > .001]
    b += [(100_000, "new", "x", 0, "f"), (6, "second copy", "x", 0, "f")]
    out = M.audit(*(M.warc_records(spark.createDataFrame(x, SCHEMA)) for x in (a, b))).collect()
    assert {(x.record, x.kind) for x in out} == _differing(a, b) and len(out) == len(_differing(a, b))
    assert all(x.file == x.record // M.FILE_RECORDS for x in out)


def test_offsets_and_digests(spark):
    rows = [(i, f"u{i}", f"body {i}", 0, "f") for i in range(10)]
    a = spark.createDataFrame(rows, SCHEMA)
    b = a.withColumn("html", F.when(F.col("page_id") == 4, "x").otherwise(F.col("html")))
    (x,) = M.audit(M.warc_records(a), M.warc_records(b)).collect()
    bodies = [r.body.encode() for r in M.warc_records(a).orderBy("record").collect()]
    assert (x.record, x.offset_a, x.size_a) == (4, sum(map(len, bodies[:4])), len(bodies[4]))
    assert x.digest_a == hashlib.sha256(bodies[4]).hexdigest() and x.offset_b == x.offset_a


def test_equal_and_empty(spark):
    a = M.warc_records(spark.createDataFrame(_pages(), SCHEMA))
    assert M.audit(a, a).collect() == []
    assert M.audit(a.limit(0), a.limit(0)).collect() == []
    assert {x.kind for x in M.audit(a, a.limit(0)).collect()} == {"missing"}


def test_equal_copies_do_not_cancel(spark):
    bodies = [f"body {i}" for i in range(100, 108)]
    df = spark.createDataFrame([(1, "u", h, 0, "f") for h in bodies], SCHEMA)
    found = {r.body: hashlib.sha256(r.body.encode()).hexdigest() for r in M.warc_records(df).collect()}
    low, x, y, *_, high = sorted(found, key=found.get)
    a, b = ([(1, t) for t in (low, z, z, high)] for z in (x, y))
    (r,) = M.audit(*(spark.createDataFrame(t, "record long, body string") for t in (a, b))).collect()
    assert (r.record, r.kind, r.size_a) == (1, "changed", r.size_b)
