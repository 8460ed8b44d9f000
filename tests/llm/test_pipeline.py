import random

import corpus_pipeline as C
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_near_dedup import _brute
from test_quality_rules import _base

SF = "/root/testdata/sf0.001"


def test_stages_are_the_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = C.quality_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not any(_base(rows[i])[5] for i in ids) and len(ids) > 0.5 * len(rows)
    exact = C.exact_stage(spark, kept, SF)
    assert {r.doc_id for r in exact.collect()} == {max(j for j in ids if rows[j] == rows[i]) for i in ids}
    near = C.near_stage(spark, exact, SF)
    want = {i for i, _, _, k in _brute([(r.doc_id, r.text) for r in exact.collect()]) if k}
    assert {r.doc_id for r in near.collect()} == want
    packed = C.packing_stage(spark, near, SF)
    assert {r.doc_id for r in packed.collect()} == want
    run = C.run(spark, SF)
    assert run.exceptAll(packed).isEmpty() and packed.exceptAll(run).isEmpty()


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_empty_and_null(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    none = spark.createDataFrame([], schema)
    assert stage(spark, none, SF).collect() == []
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0)], schema)
    assert stage(spark, odd, SF).count() <= 3


def test_batches_are_bounded_by_bytes(spark):
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(conf)
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', 20000)").alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["doc_id"])
    try:
        C.quality_stage(spark, docs, SF)
        most = max(r.doc_id for r in docs.mapInArrow(sizes, "doc_id long").collect())
        assert most * 100_000 <= C.BATCH_BYTES + 100_000  # the row that passes the bound is the last
        spark.conf.set(conf, "64k")
        C.quality_stage(spark, docs, SF)
        assert spark.conf.get(conf) == "64k"
    finally:
        spark.conf.set(conf, before)


def _prose(seed, n=120):
    r = random.Random(seed)
    syllables = "ba ce di fo gu ka le mi no pu ra se ti vo zu".split()
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))


def test_decisions_are_made_by_row(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _kept_doc_id int, _sha string"
    good, other, third = _prose(1), _prose(2), _prose(3)
    rows = [(1, good), (1, "junk"), (2, other), (2, other), (None, third), (None, "junk"), (3, good), (None, good),
            (4, _prose(4, 200_000)), (5, third), (None, _prose(5))]
    docs = spark.createDataFrame([(i, t, "en", None, 1, 7, "s") for i, t in rows], schema)
    kept = C.quality_stage(spark, docs, SF)
    key = lambda r: (r[0] is None, r[0] or 0, len(r[1]), r[1])
    want = [r for r in rows if r[1] != "junk"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(want, key=key)
    assert kept.columns == docs.columns
    exact = C.exact_stage(spark, kept, SF)
    want = [(2, other), (3, good), (4, rows[8][1]), (5, third), (None, _prose(5))]
    assert sorted(((r.doc_id, r.text) for r in exact.collect()), key=key) == sorted(want, key=key)
    assert exact.columns == docs.columns
    near = C.near_stage(spark, exact, SF)
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=key) == sorted(want, key=key)
    pieces = C.packing_stage(spark, near, SF).collect()
    assert {r.doc_id for r in pieces} == {2, 3, 4, 5, None}
